"""The manifest against SQL and plain Python: blocks of any height, edge rows, addresses and proofs."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import merkle
from tablewright.llm.oracles import MERKLE_SQL
from tests.compare import connect, differences

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, place int, digest string, leaf string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def beside(levels, i):
    steps = []
    for level in levels[:-1]:
        run = i // 16 * 16
        steps.append(("".join(level[run:i]), "".join(level[i + 1 : run + 16])))
        i //= 16
    return steps


def python_rows(rows):
    """What ``verify`` returns, from whole trees held in memory."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    by = {}
    for r in rows:
        digest = leaf(r.doc_id, r.source, r.lang, r.n_chars, r.text)
        tampered = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        text = r.text.translate(lower) if tampered and r.text is not None else r.text
        seen = leaf(r.doc_id, r.source, r.lang, r.n_chars, text)
        by.setdefault(r.source, []).append(((r.doc_id is not None, r.doc_id or 0, digest), r.doc_id, digest, seen))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([x[2] for x in sorted(by[s])]) for s in names}
    top = levels_of([trees[s][-1][0] for s in names])
    out = []
    for at, s in enumerate(names):
        for i, (_, doc_id, digest, seen) in enumerate(sorted(by[s])):
            steps = beside(trees[s], i) + beside(top, at)
            now = seen
            for a, b in steps:
                now = h(a, now, b)
            out.append((doc_id, digest, trees[s][-1][0], top[-1][0], h(*(a + b for a, b in steps)), now, now == top[-1][0]))
    return sorted(out, key=str)


def test_addresses_are_a_layout_of_halves():
    for levels in range(1, 6):
        at = [merkle.address(d, np.arange(merkle.FANOUT**d), levels) for d in range(levels)] if levels < 5 else []
        if at:
            assert sorted(np.concatenate(at).tolist()) == list(range(merkle.nodes(levels)))
    # four levels: a root with its 16 children, then 256 subtrees of two levels, each in one piece
    assert merkle.address(1, np.arange(3), 4).tolist() == [1, 2, 3]
    assert merkle.address(2, np.arange(3), 4).tolist() == [17, 34, 51]
    assert merkle.address(3, np.arange(18), 4).tolist() == [*range(18, 34), 35, 36]


@pytest.mark.parametrize("levels", [1, 2])
def test_blocks_of_any_height_give_the_same_rows(spark, levels):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.withColumn("source", F.when(F.col("source") == "src3", None).otherwise(F.col("source")))
    found = merkle.verify(docs, levels).collect()
    assert sorted(map(tuple, found), key=str) == python_rows(docs.collect())


def test_sql_over_several_tiers(spark):
    sf = "/root/testdata/sf0.001"
    assert differences(merkle.verify(spark.read.parquet(f"{sf}/documents.parquet"), 1), connect(sf), MERKLE_SQL) == []


def test_edge_rows(spark):
    long = "Wörd X " * 100_000
    rows = [(1, None, None, None, None), (2, "", "", "", 0), (3, "ABC", "en", "a", 3), (3, "ABC", "en", "a", 3), (3, "abc", "en", "a", 3),
            (None, "No Id", "en", "a", 5), (None, None, None, "a", None), (0, long, "de", "é", len(long)), (-7, "\0Z", "en", "-", 2),
            (10, "Q", "en", "+a", 1), (2**62, "Q", "en", None, 1), (6, "UPPER", None, "z" * 300, 5), (12, "lower", "en", "a", 5), (29, None, "en", "a", 5)]
    docs = spark.createDataFrame([(*r, "t", 1, "d", "l") for r in rows], DOCS)
    found = merkle.verify(docs).collect()
    assert sorted(map(tuple, found), key=str) == python_rows(docs.collect())
    tampered = [r for r in found if not r.verified]
    assert tampered and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in tampered)
    one = merkle.verify(docs.where("doc_id = 10")).first()
    assert one.leaf == one.subroot == one.root and one.proof_sha256 == h("")
    assert merkle.verify(docs.limit(0)).collect() == []


def test_proofs_show_any_change(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "en", "s" if i % 3 else "t", 6) for i in range(100)], ", ".join(DOCS.split(", ")[:5]))
    rows = merkle.manifest(docs, "source", "doc_id", ["doc_id", "text"], levels=1)
    good = merkle.folded(F.col("leaf"), F.col("lefts"), F.col("rights")) == F.col("root")
    bad = merkle.folded(F.sha2(F.lit(b"x"), 256), F.col("lefts"), F.col("rights")) == F.col("root")
    assert rows.where(good).count() == 100 and rows.where(bad).count() == 0
