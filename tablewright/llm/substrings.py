"""Substring deduplication with suffix trees over groups of suffixes that share a prefix.

A repeat is a run of at least WINDOW words that starts in two places. Each window of words is represented by its least
PREFIX-gram (by hash, the leftmost of equals), and the suffixes that begin there are grouped by that prefix: the windows
of a repeat have the same least gram at the same offset in all its occurrences, so they meet in one group. Only grams
that occur in two places go on. A group of at most GROUP suffixes is small enough for memory: its windows are sorted as
word sequences, neighbours' common prefixes are the internal nodes of its suffix tree, and nodes of depth WINDOW or more
are the repeats. In a larger group the prefix grows to the whole window, where a node is only a count.

Texts with equal words are one text with a number of copies; where that is two or more, all its windows are repeats.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import add_columns, chunks, col, make_rows, mixed, word_hashes
from tablewright.session import cut_lineage

WINDOW = 35
PREFIX = 8
#: Suffixes of one prefix that a task holds at once, about 10 MB.
GROUP = 20_000
#: Suffixes of whole small groups that are sorted together.
BATCH = 4000

#: Compressed bytes of the texts that a task takes apart at once.
PACKED = 500_000

_GRAMS = WINDOW - PREFIX + 1
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words."""
    out = np.zeros(max(0, len(hashes) - size + 1), dtype=np.uint64)
    for k in range(size):
        out = out * _BASE + hashes[k : k + len(out)]
    return mixed(out)


def least_grams(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all grams, place of the least gram of each window); empty for a text shorter than a window."""
    grams = _rolled(hashes, PREFIX)
    if len(hashes) < WINDOW:
        return grams, np.empty(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(grams, _GRAMS)
    return grams, views.argmin(axis=1) + np.arange(len(views))


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def _unpacked(bodies: list[bytes]) -> list[list[bytes]]:
    return [zlib.decompress(b).split() for b in bodies]


def _hash_lists(lists: list[list[bytes]]):
    flat, at = word_hashes(lists)
    return lists, [flat[at[i] : at[i + 1]] for i in range(len(lists))]


def described(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_words, digest and full_sha256 of the words, grams and places of its least grams.

    Grams are given on one row of a digest in each task.
    """

    def make():
        seen: set[bytes] = set()

        def work(texts):
            out = []
            for a, b in chunks(texts):
                for words, hashes in zip(*_hash_lists([_split(t) for t in texts[a:b]]), strict=True):
                    joined = b" ".join(words)
                    digest = hashlib.blake2b(joined, digest_size=16).digest()
                    grams, places = [], []
                    if len(words) >= WINDOW and digest not in seen:
                        seen.add(digest)
                        all_grams, least = least_grams(hashes)
                        at = np.unique(least)
                        grams, places = all_grams[at].view(np.int64).tolist(), at.tolist()
                    out.append((len(words), digest, hashlib.sha256(joined).hexdigest(), grams, places))
            return [list(x) for x in zip(*out, strict=True)] if out else [[] for _ in kinds]

        return work

    kinds = [
        ("n_words", pa.int64()), ("digest", pa.binary()), ("full_sha256", pa.string()), ("grams", pa.list_(pa.int64())),
        ("places", pa.list_(pa.int32())),
    ]
    rows = docs.select(col("doc_id"), col("text").cast("string").alias("text"))
    return add_columns(rows.withColumn("text_key", _text_key()), ["text"], kinds, make).drop("text")


def _text_key():
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def shared_places(rows: DataFrame, group: int = GROUP) -> DataFrame:
    """key, places: where a text's least grams occur elsewhere too; places of large groups as -1 - place."""
    pairs = F.explode(F.arrays_zip("grams", "places"))
    # eight bytes of a text's digest do here: texts that share them would only look at some more places
    marks = rows.select(F.xxhash64("digest").alias("key"), pairs.alias("m")).select(
        F.col("m.grams").alias("gram"), "key", F.col("m.places").alias("place")
    ).withColumn("one", F.xxhash64("key", "place"))
    met = marks.groupBy("gram").agg(F.count("*").alias("n"), F.min("one").alias("x"), F.max("one").alias("y"))
    met = met.where("x != y").select("gram", (F.col("n") > group).alias("large"))
    place = F.when(F.col("large"), -1 - F.col("place")).otherwise(F.col("place"))
    return marks.select("gram", "key", "place").join(met, "gram").groupBy("key").agg(F.collect_set(place).alias("places"))


def _runs(hashes: np.ndarray, places: list[int]):
    """(place, first and last window) of the wanted least grams of one text."""
    _, least = least_grams(hashes)
    at, first, n = np.unique(least, return_index=True, return_counts=True)
    want = np.isin(at, places)
    return at[want], first[want], first[want] + n[want] - 1


def suffixes(texts: DataFrame) -> DataFrame:
    """gram, digest, place, first, last, words: the surroundings of each least gram in a small group.

    Words are 32 bits of each word's hash, from WINDOW - PREFIX before the gram to WINDOW from its start on, so that all
    windows it stands for are in them.
    """
    before = WINDOW - PREFIX

    def work(batches):
        for digests, bodies, wanted in batches:
            for a, b in chunks(bodies, PACKED):
                rows = []
                for digest, hashes, places in zip(digests[a:b], _hash_lists(_unpacked(bodies[a:b]))[1], wanted[a:b], strict=True):
                    at, first, last = _runs(hashes, [p for p in places if p >= 0])
                    if not len(at):
                        continue
                    short = np.concatenate([np.zeros(before, np.uint32), hashes.astype(np.uint32), np.zeros(WINDOW, np.uint32)])
                    content = short[at[:, None] + np.arange(before + WINDOW)].astype(">u4")
                    grams = _rolled(hashes, PREFIX)[at].view(np.int64)
                    rows += zip(
                        grams.tolist(), [digest] * len(at), at.tolist(), (at - first).tolist(), (at - last).tolist(),
                        (x.tobytes() for x in content), strict=True,
                    )
                if rows:
                    yield [list(x) for x in zip(*rows, strict=True)]

    kinds = [
        ("gram", pa.int64()), ("digest", pa.binary()), ("place", pa.int32()), ("far", pa.int32()), ("near", pa.int32()),
        ("words", pa.binary()),
    ]
    return make_rows(texts.select("digest", "body", "places"), kinds, work)


def tree_repeats(found: DataFrame) -> DataFrame:
    """digest, start, end: the repeats of small groups, group after group in tasks that hold some groups at a time."""

    def work(batches):
        held, key = [], None
        for columns in batches:
            for row in zip(*columns, strict=True):
                if row[0] != key and len(held) >= BATCH:
                    yield deep_nodes(held)
                    held = []
                key = row[0]
                held.append(row)
        if held:
            yield deep_nodes(held)

    rows = found.repartition("gram").sortWithinPartitions("gram")
    return make_rows(rows, [("digest", pa.binary()), ("start", pa.int32()), ("end", pa.int32())], work)


def deep_nodes(rows: list[tuple]) -> list[list]:
    """Merged repeats (digests, starts, ends) of whole groups of rows (gram, digest, place, far, near, words).

    The windows are sorted; one whose common prefix with a neighbour is the whole window is a leaf below a node of depth
    WINDOW. Rows that say the same twice are one occurrence.
    """
    rows = list({(r[1], r[2]): r for r in rows}.values())
    content = np.frombuffer(b"".join(r[5] for r in rows), dtype=">u4").reshape(len(rows), -1)
    far, near = (np.array([r[i] for r in rows]) for i in (3, 4))
    places = np.array([r[2] for r in rows])
    member, start = [], []
    for offset in range(int(near.min()), int(far.max()) + 1):  # equal windows have their least gram at one offset
        these = np.flatnonzero((near <= offset) & (offset <= far))
        first = WINDOW - PREFIX - offset
        leaves = np.ascontiguousarray(content[these, first : first + WINDOW])
        order = np.argsort(leaves.view(f"V{4 * WINDOW}").ravel(), kind="stable")
        same = leaves[order]
        deep = (same[1:] == same[:-1]).all(axis=1)
        hit = np.unique(np.concatenate([order[1:][deep], order[:-1][deep]]))
        member.append(these[hit])
        start.append(places[these[hit]] - offset)
    member, start = np.concatenate(member), np.concatenate(start)
    order = np.lexsort((start, member))
    member, start = member[order], start[order]
    if not len(member):
        return [[], [], []]
    # a member's windows come in order: consecutive ones are one repeat
    new = np.concatenate([[True], (member[1:] != member[:-1]) | (start[1:] != start[:-1] + 1)])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(member)) - 1
    return [[rows[m][1] for m in member[head]], start[head].tolist(), (start[tail] + WINDOW).tolist()]


def large_repeats(texts: DataFrame) -> DataFrame:
    """digest, start, end of the repeats of large groups: their windows, as prefixes of full length, are counted."""

    def work(batches):
        for digests, bodies, wanted in batches:
            for a, b in chunks(bodies, PACKED):
                keys, of, starts = [], [], []
                for digest, hashes, places in zip(digests[a:b], _hash_lists(_unpacked(bodies[a:b]))[1], wanted[a:b], strict=True):
                    _, first, last = _runs(hashes, [-1 - p for p in places if p < 0])
                    if len(first):
                        windows = np.concatenate([np.arange(x, y + 1) for x, y in zip(first, last, strict=True)])
                        keys += _rolled(hashes, WINDOW)[windows].view(np.int64).tolist()
                        of += [digest] * len(windows)
                        starts += windows.tolist()
                yield [keys, of, starts]

    wide = texts.where(F.exists("places", lambda p: p < 0)).select("digest", "body", "places")
    rows = make_rows(wide, [("window", pa.int64()), ("digest", pa.binary()), ("start", pa.int32())], work)
    rows = rows.withColumn("one", F.xxhash64("digest", "start"))
    met = rows.groupBy("window").agg(F.min("one").alias("x"), F.max("one").alias("y")).where("x != y").select("window")
    return rows.join(met, "window").select("digest", "start", (F.col("start") + WINDOW).alias("end"))


def repeats(docs: DataFrame, rows: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(digest, spans: its repeats in words, overlapping ones not merged; digest, body of the texts that were looked at)."""
    places = shared_places(rows)
    wanted = places.join(classes.select(F.xxhash64("digest").alias("key"), "digest", "rep", "rep_key"), "key")
    bodies = docs.select(col("doc_id"), col("text").cast("string").alias("text")).withColumn("text_key", _text_key())
    joined = bodies.join(wanted, F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("text_key") == F.col("rep_key")))
    texts = cut_lineage(add_columns(joined.select("digest", "text", "places"), ["text"], [("body", pa.binary())], _packed).drop("text"))
    found = tree_repeats(suffixes(texts)).unionByName(large_repeats(texts))
    spans = found.groupBy("digest").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return spans, texts.select("digest", "body")


def _packed():
    """Texts that are written out between passes are compressed."""
    return lambda texts: [[zlib.compress((t or "").encode(), 1) for t in texts]]


def _removed():
    def make():
        def work(bodies, found):
            n, shas = [], []
            for body, spans in zip(bodies, found, strict=True):
                words = zlib.decompress(body).split()
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(gone, [s["start"] for s in spans], 1)
                np.add.at(gone, [s["end"] for s in spans], -1)
                out = np.cumsum(gone)[:-1] > 0
                n.append(int(out.sum()))
                shas.append(hashlib.sha256(b" ".join(w for w, x in zip(words, out, strict=True) if not x)).hexdigest())
            return n, shas

        return work

    return make


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 of the words that no repeat covers.

    Null and empty texts have no words, and texts of fewer than WINDOW words no repeats. Every row stays, repeated ones
    and null ids too; repeated rows are copies of each other.
    """
    rows = cut_lineage(described(docs))
    rep = F.min(F.struct("doc_id", "text_key"))
    classes = cut_lineage(
        rows.where(F.col("n_words") >= WINDOW).groupBy("digest").agg(F.count("*").alias("copies"), rep.alias("r"))
        .select("digest", "copies", F.col("r.doc_id").alias("rep"), F.col("r.text_key").alias("rep_key"))
    )
    spans, texts = repeats(docs, rows, classes)
    single = spans.join(classes.where("copies = 1").select("digest"), "digest", "left_semi")
    kinds = [("removed", pa.int64()), ("kept", pa.string())]
    partly = add_columns(texts.join(single, "digest"), ["body", "spans"], kinds, _removed()).select("digest", "removed", "kept")
    wholly = classes.where("copies > 1").select("digest", F.lit(-1).cast("long").alias("removed"), F.sha2(F.lit(""), 256).alias("kept"))
    out = rows.select("doc_id", "n_words", "digest", "full_sha256").join(partly.unionByName(wholly), "digest", "left")
    return out.select(
        "doc_id", "n_words", F.when(F.col("removed") < 0, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.coalesce("kept", "full_sha256").alias("kept_sha256"),
    )
