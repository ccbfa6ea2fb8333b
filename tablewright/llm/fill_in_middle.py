"""Fill-in-the-middle training texts, cut through a sparse index of the characters that take more than one byte.

Texts stay UTF-8 bytes. The index of a batch holds only the multibyte characters: where they are and how many bytes they
take beyond one. A cut at a code point is the same cut in bytes plus the excess before it, found by binary search; all
between such characters is arithmetic, so ASCII text needs no index at all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.common import col, fresh

#: Of a hundred documents, those that stay as they are and, of the rest, those that put the suffix first.
PLAIN, SPM = 10, 20
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"


class ExceptionIndex:
    """Code points and bytes of UTF-8 data: the positions of multibyte characters and their excess bytes, nothing else."""

    def __init__(self, data: np.ndarray):
        self.at_byte = np.flatnonzero(data >= 0xC0)
        lead = data[self.at_byte]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate([[0], np.cumsum(excess)])
        self.at_point = self.at_byte - self.excess[:-1]

    def bytes_of(self, points: np.ndarray) -> np.ndarray:
        """Byte positions of code point positions."""
        return points + self.excess[np.searchsorted(self.at_point, points)]

    def points_of(self, at: np.ndarray) -> np.ndarray:
        """Code point positions of byte positions; a position within a character counts as that character's start."""
        k = np.searchsorted(self.at_byte, at)
        before = np.maximum(k - 1, 0)
        if len(self.at_byte):
            end = self.at_byte[before] + 1 + self.excess[before + 1] - self.excess[before]
            inside = (k > 0) & (at < end)
            return np.where(inside, self.at_point[before], at - self.excess[k])
        return np.asarray(at)


def marked(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of the texts that end at ``ends`` hold one of the marks."""
    found = np.zeros(len(ends), bool)
    if len(data) >= 3:
        names = np.isin(data[1:-1], np.frombuffer(b"PSM", np.uint8))
        at = np.flatnonzero((data[:-2] == ord("<")) & (data[2:] == ord(">")) & names)
        text = np.searchsorted(ends, at, "right")
        found[text[at + 2 < ends[text]]] = True
    return found


def transformed(texts: pa.StringArray, draws: list[np.ndarray], unit: str) -> list[pa.Array]:
    """n, form, prefix_chars, middle_chars and output of texts without nulls, from four numbers drawn for each."""
    texts = texts.cast(pa.large_binary())
    _, offsets, values = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    base = offsets[0]
    raw = memoryview(values)[base : offsets[-1]] if values is not None else memoryview(b"")
    data, bounds = np.frombuffer(raw, np.uint8), offsets - base
    index = ExceptionIndex(data)
    first = index.points_of(bounds)
    n = np.diff(first)
    h1, h2, h3, h4 = draws
    room = n if unit == "points" else np.diff(bounds)
    cuts = np.sort(np.stack([h1 % (room + 1), h2 % (room + 1)]), axis=0)
    points = first[:-1] + cuts if unit == "points" else index.points_of(bounds[:-1] + cuts)
    at = index.bytes_of(points)
    plain = (n == 0) | marked(data, bounds[1:]) | (h3 % 100 >= 100 - PLAIN)
    spm = h4 % 100 < SPM
    out, sizes = [], np.diff(bounds) + 9 * ~plain
    for i, (a, p, m, b) in enumerate(zip(bounds[:-1].tolist(), *at.tolist(), bounds[1:].tolist())):
        if plain[i]:
            out.append(raw[a:b])
        elif spm[i]:
            out += [SUFFIX, raw[m:b], PREFIX, raw[a:p], MIDDLE, raw[p:m]]
        else:
            out += [PREFIX, raw[a:p], SUFFIX, raw[m:b], MIDDLE, raw[p:m]]
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    output = pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(ends), pa.py_buffer(b"".join(out)))
    form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
    spans = points[0] - first[:-1], points[1] - points[0]
    return [pa.array(n), pa.array(form), *(pa.array(s, pa.int64(), mask=plain) for s in spans), output]


def fill_in_middle(docs: DataFrame, unit: str = "points", names: tuple[str, ...] = ("n", "form", "prefix_chars", "middle_chars", "output")) -> DataFrame:
    """``docs`` with ``names`` added: code points, form (plain, psm or spm), prefix and middle lengths, new text.

    Cuts are drawn from a hash of doc_id: over code points, or with ``unit`` "bytes" over bytes, a cut within a character
    falling to its start. A null text is an empty one and stays plain; a null id draws like an empty one; repeated rows
    are cut alike. A column of ``docs`` that has one of the names keeps it, and the new one gets underscores in front.
    """
    if unit not in ("points", "bytes"):
        raise ValueError("unit is points or bytes")
    added = fresh(docs, *names)
    text, *draws = fresh(docs, "fim_text", "h1", "h2", "h3", "h4")
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    drawn = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(h) for k, h in enumerate(draws)]
    rows = docs.select(*(col(c) for c in docs.columns), F.coalesce(col("text").cast("string"), F.lit("")).alias(text), *drawn)
    kinds = [T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType()]
    schema = T.StructType([*docs.schema.fields, *(T.StructField(a, k) for a, k in zip(added, kinds, strict=True))])
    width = len(docs.columns)

    def run(batches):
        for batch in batches:
            new = transformed(batch.column(width), [c.to_numpy() for c in batch.columns[width + 1 :]], unit)
            new[-1] = new[-1].cast(pa.string()) if new[-1].nbytes < 2**31 else new[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *new], names=schema.names)

    return rows.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    first = F.when(form == "psm", F.lit(SUFFIX.decode())).otherwise(F.lit(PREFIX.decode()))
    second = F.lit(MIDDLE.decode())
    body = F.substr(output, F.lit(4))
    one = F.substr(body, F.lit(1), F.position(first, body) - 1)
    tail = F.substr(body, F.position(first, body) + 3)
    two = F.substr(tail, F.lit(1), F.position(second, tail) - 1)
    middle = F.substr(tail, F.position(second, tail) + 3)
    whole = F.when(form == "psm", F.concat(one, middle, two)).otherwise(F.concat(two, middle, one))
    return F.when(form == "plain", output).otherwise(whole)
