"""Benchmark decontamination: one Aho-Corasick automaton over the test items, and one scan of each text.

Texts are lower-cased (A-Z) and cut into words of digits, a-z and all characters beyond ASCII. The automaton reads word
numbers, so a match is a run of whole words, whatever stands between them in the original.
"""

from __future__ import annotations

import math
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import add_columns, col, fresh, make_rows
from tablewright.session import cut_lineage

WINDOW = 13
#: Windows in one automaton, about 200 MB in a worker. A larger benchmark is scanned in several passes.
MAX_WINDOWS = 200_000

_KEPT = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
#: Bytes of UTF-8 to lower-case word bytes, all others to blanks.
WORD_BYTES = bytes(b if (b := bytes([x]).lower()[0]) in _KEPT else 32 for x in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


def item_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """Distinct (window, item): every run of ``size`` words, or all words of a shorter item.

    Items without words have none. An item without an id is called by the empty string. Rows with the same id are
    one item.
    """

    def work(batches):
        for ids, texts in batches:
            found = {
                (b" ".join(w[i : i + size]).decode(), key or "")
                for key, t in zip(ids, texts, strict=True)
                if (w := words(t))
                for i in range(max(1, len(w) - size + 1))
            }
            yield [[x[0] for x in found], [x[1] for x in found]]

    rows = benchmark.select(col(item_id).cast("string"), col(text).cast("string"))
    return make_rows(rows, [("window", pa.string()), ("item", pa.string())], work).distinct()


def build(windows: list[tuple[str, list[str]]]) -> tuple[dict, ahocorasick.Automaton]:
    """Word numbers from 1 on, and the automaton over windows of numbers."""
    numbers: dict[bytes, int] = {}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for window, items in windows:
        key = tuple(numbers.setdefault(w, len(numbers) + 1) for w in window.encode().split(b" "))
        automaton.add_word(key, (len(key), items))
    automaton.make_automaton()
    return numbers, automaton


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def char_spans(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word spans as code points of the original text."""
    if not spans:
        return []
    raw = text.encode()
    at = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(WORD_BYTES))]
    # code points before each byte, counted once for all spans
    before = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [(int(before[at[start][0]]), int(before[at[end - 1][1]])) for start, end in spans]


SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _scanner(held):
    def make():
        numbers, automaton = build(held.value) if held.value else ({}, None)
        get = numbers.get

        def work(texts, spans, items):
            counts, all_spans, all_items, chars = [], [], [], []
            for text, old, seen in zip(texts, spans, items, strict=True):
                w = words(text)
                ids = tuple([get(x, 0) for x in w])
                found = [(s["start"], s["end"]) for s in old]
                names = set(seen)
                if any(ids):
                    for last, (length, of) in automaton.iter(ids):
                        found.append((last + 1 - length, last + 1))
                        names.update(of)
                found = merged(found)
                counts.append(len(w))
                all_spans.append([{"start": s, "end": e} for s, e in found])
                all_items.append(sorted(names))
                chars.append([{"start": s, "end": e} for s, e in char_spans(text or "", found)])
            return counts, all_spans, all_items, chars

        return work

    return make


def scan(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", size: int = WINDOW, max_windows: int = MAX_WINDOWS,
) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with what the automaton finds in each whole text, and the names of the new columns by role.

    Roles: n_words; spans (hit words, merged, end exclusive); items (ids, sorted as strings); chars (the spans as code
    points of the original). Null and empty texts have no words. Every row stays, repeated ones too; an empty benchmark
    hits nothing. Windows go to the workers in shares of ``max_windows`` at most; with several shares the rows are
    written out between the passes, so that one automaton at a time is in memory.
    """
    spark = docs.sparkSession
    windows = cut_lineage(item_windows(benchmark, size=size).groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items")))
    shares = max(1, math.ceil(windows.count() / max_windows))
    roles = ("n_words", "spans", "items", "chars")
    names = dict(zip(roles, fresh(docs, *roles), strict=True))
    old = fresh(docs, "old_spans", "old_items")
    share = F.pmod(F.xxhash64("window"), F.lit(shares))
    spans, items = F.expr("array()").cast("array<struct<start:int,end:int>>"), F.expr("array()").cast("array<string>")
    out = docs
    for k in range(shares):
        held = spark.sparkContext.broadcast([(r.window, list(r["items"])) for r in windows.where(share == k).collect()])
        given = out.withColumns({old[0]: col(names["spans"]) if k else spans, old[1]: col(names["items"]) if k else items})
        if k:
            given = given.drop(*names.values())
        kinds = [("n_words", pa.int64()), ("spans", SPAN), ("items", pa.list_(pa.string())), ("chars", SPAN)]
        out = add_columns(given, [text, *old], [(names[r], t) for r, t in kinds], _scanner(held)).drop(*old)
        if k + 1 < shares:
            out = cut_lineage(out)
    return out, names


def verdict(names: dict[str, str]) -> dict:
    """n_hit and whether at least one word in twenty is hit, as columns over the result of ``scan``."""
    n_hit = F.aggregate(col(names["spans"]), F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return {"n_hit": n_hit, "contaminated": (n_hit > 0) & (20 * n_hit >= col(names["n_words"]))}


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hit_chars."""
    found, names = scan(docs.select("doc_id", col("text").cast("string").alias("text")), benchmark)
    rule = verdict(names)
    return found.select(
        "doc_id", col(names["n_words"]).alias("n_words"), rule["n_hit"].alias("n_hit"),
        F.size(col(names["items"])).cast("long").alias("n_items"),
        F.sha2(F.array_join(col(names["items"]), ","), 256).alias("items_sha256"),
        rule["contaminated"].alias("contaminated"),
        F.array_join(
            F.transform(col(names["chars"]), lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ","
        ).alias("hit_chars"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns only."""
    found, names = scan(docs, benchmark)
    return found.where(~verdict(names)["contaminated"]).drop(*names.values())
