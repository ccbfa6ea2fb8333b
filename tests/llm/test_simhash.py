"""SimHash groups against brute force, on real texts, on edge rows and on crowds of like fingerprints."""

import numpy as np
import pytest
import xxhash

from tablewright.llm import simhash
from tablewright.llm.near_duplicates import components


def python_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def python_roots(prints):
    """The least position that each fingerprint reaches over links of at most three bits."""
    x = np.array(prints, np.uint64)
    root = list(range(len(x)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[i + 1 :] ^ x[i]) <= 3) + i + 1:
            a, b = top(i), top(int(j))
            root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(x))]


def wanted(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    prints = [python_print(t) for _, t in rows]
    return sorted(((rows[i][0], f"{prints[i]:016x}", rows[r][0]) for i, r in enumerate(python_roots(prints))), key=str)


def found(docs):
    return sorted(map(tuple, simhash.simhash_groups(docs).collect()), key=str)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = found(docs)
    assert rows == wanted([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert len({r[2] for r in rows}) < len(rows)


def test_edge_rows(spark):
    prose = " ".join(f"word{i}" for i in range(200))
    texts = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One  Two"), (8, "one two three"), (9, prose),
             (9, prose), (9, prose.upper()), (10, prose + " end"), (None, prose), (None, "lone text without id here"), (11, "É é ß 漢字"),
             (12, " ".join(f"w{i % 997}x{i}" for i in range(60_000)))]
    docs = spark.createDataFrame([(i, t, "f", "c", 1, 2) for i, t in texts], "doc_id long, text string, fingerprint string, component_id string, n int, own int")
    assert found(docs) == wanted(texts)
    assert found(docs.limit(0)) == []
    # rows without any id have no name to give
    assert found(docs.where("doc_id IS NULL").limit(1))[0][2] is None


def test_hot_fingerprint(spark):
    rows = [(i, "the very same words here") for i in range(3, 400)] + [(i, f"words that differ {i} by number {i * i} each") for i in range(400, 420)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == wanted(rows)


@pytest.mark.parametrize("crowd", [20, 2048])
def test_crowds(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    draw = np.random.default_rng(3)
    prints = {int(v) for v in draw.integers(0, 2**64, 500, dtype=np.uint64)}
    for center in list(prints)[:3]:
        for bits in draw.integers(0, 8, 900):
            v = center
            for b in draw.integers(0, 64, bits):
                v ^= 1 << int(b)
            prints.add(v)
    signed = sorted(int(np.uint64(v).view(np.int64)) for v in prints)
    links = simhash.links(spark.createDataFrame([(v,) for v in signed], "fingerprint long").repartition(4))
    roots = {r.node: r.root for r in components(links).collect()}
    expected = python_roots([v % 2**64 for v in signed])
    assert [roots.get(v, v) for v in signed] == [signed[i] for i in expected]


def test_tables_lose_no_pair():
    draw = np.random.default_rng(5)
    tables = simhash.whole_tables()
    x = draw.integers(0, 2**64, 3000, dtype=np.uint64)
    y = x.copy()
    for _ in range(3):
        y ^= np.uint64(1) << draw.integers(0, 64, len(y)).astype(np.uint64)
    assert (tables.keys(x) == tables.keys(y)).any(axis=1).all()
    distances = np.bitwise_count(x[:, None] ^ tables.pivots[None, :])
    assert (tables.coordinates(x) == distances).all()
    assert simhash.near_pairs(x, y, tables.coordinates(x), tables.coordinates(y)).all()
    z = draw.integers(0, 2**64, 3000, dtype=np.uint64)
    assert not simhash.near_pairs(x, z, tables.coordinates(x), tables.coordinates(z)).any()
    for part in map(tables.free_bits, range(len(tables.TABLES))):
        again = simhash.PivotTables(part)
        close = np.bitwise_count(x ^ y) <= 3
        inside = close & ((x ^ y) & ~np.uint64(sum(1 << b for b in part)) == 0)
        assert (again.keys(x[inside]) == again.keys(y[inside])).any(axis=1).all()
