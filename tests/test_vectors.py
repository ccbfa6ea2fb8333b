import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright.functions.columns import dot, l2_normalize
from tablewright.operators import buckets, retrieval, term_index, vectors


def make(spark, matrix, name):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} bigint, vector array<float>").repartition(3)


def wanted(queries, corpus, k, metric):
    queries, corpus = np.float64(np.float32(queries)), np.float64(np.float32(corpus))
    if metric == "l2":
        scores = -np.sqrt(((queries[:, None] - corpus[None]) ** 2).sum(-1))
    else:
        scores = queries @ corpus.T
        if metric == "cosine":
            norms = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(corpus, axis=1)[None]
            scores = np.divide(scores, norms, out=np.zeros_like(scores), where=norms > 0)
    scores = np.round(scores, 6) + 0.0
    out = set()
    for q in range(len(queries)):
        order = sorted(range(len(corpus)), key=lambda c: (-scores[q, c], c))[:k]
        out |= {(q, r + 1, c, abs(scores[q, c]) if metric == "l2" else scores[q, c]) for r, c in enumerate(order)}
    return out


@pytest.fixture
def data():
    rng = np.random.default_rng(2)
    corpus = rng.standard_normal((90, 6))
    corpus[3] = 0.0
    corpus[40:70] = corpus[10]  # a third of the corpus are copies
    return rng.standard_normal((23, 6)), corpus


@pytest.mark.parametrize("metric", ["dot", "cosine", "l2"])
@pytest.mark.parametrize("block_rows", [7, 1000])
def test_nearest_is_exact(spark, data, metric, block_rows):
    queries, corpus = data
    got = vectors.nearest(make(spark, queries, "query_id"), make(spark, corpus, "corpus_id"), 4, metric, block_rows)
    got = {tuple(r) for r in got.collect()}
    want = wanted(queries, corpus, 4, metric)
    assert {r[:3] for r in got} == {r[:3] for r in want}
    assert sorted(r[3] for r in got) == pytest.approx(sorted(r[3] for r in want), abs=2e-6)


def test_all_cells_are_exact_and_few_cells_find_most(spark, data):
    queries, corpus = data
    asked, known = make(spark, queries, "query_id"), make(spark, corpus, "corpus_id")
    exact = vectors.nearest(asked, known, 4, "cosine")
    centres = vectors.fit_cells(known, 5)
    every = vectors.nearest_in_cells(asked, known, 4, centres, probes=5, block_rows=8)
    assert sorted(map(tuple, every.collect())) == sorted(map(tuple, exact.collect()))
    few = vectors.nearest_in_cells(asked, known, 4, centres, probes=3, block_rows=8)
    report = vectors.recall(few, exact).first()
    assert report.wanted == 92 and report.recall > 0.5


def test_k_above_corpus_size(spark, data):
    queries, corpus = data
    got = vectors.nearest(make(spark, queries, "query_id"), make(spark, corpus[:2], "corpus_id"), 5, "dot")
    assert got.count() == 2 * len(queries)


@pytest.mark.parametrize("metric", ["dot", "cosine", "l2"])
def test_many_sides_and_tiles_are_exact(spark, data, metric):
    queries, corpus = data
    asked, known = make(spark, queries, "query_id"), make(spark, corpus, "corpus_id")
    want = sorted(map(tuple, vectors.nearest(asked, known, 4, metric).collect()))
    got = vectors.nearest(asked, known, 4, metric, block_rows=5, side_values=40, tile=3)
    assert sorted(map(tuple, got.collect())) == want
    centres = vectors.fit_cells(known, 5)
    for probes in (2, 5):
        few = vectors.nearest_in_cells(asked, known, 4, centres, probes, metric, block_rows=5, side_values=40, tile=3)
        assert sorted(map(tuple, few.collect())) == sorted(
            map(tuple, vectors.nearest_in_cells(asked, known, 4, centres, probes, metric).collect()))
    assert sorted(map(tuple, vectors.nearest_in_cells(asked, known, 4, centres, 5, metric).collect())) == want


def test_queries_see_their_closest_cells_only(spark, data):
    queries, corpus = data
    known = make(spark, corpus, "corpus_id")
    centres = vectors.fit_cells(known, 5)
    near = lambda m, n: np.argsort(-(np.float64(np.float32(m)) @ centres.T), axis=1, kind="stable")[:, :n]
    probed, cell = near(queries, 2), near(corpus, 1)[:, 0]
    found = vectors.nearest_in_cells(make(spark, queries, "query_id"), known, 90, centres, 2, side_values=90).collect()
    assert {(r.query_id, r.corpus_id) for r in found} == {(q, c) for q in range(len(queries)) for c in range(90) if cell[c] in probed[q]}


def test_kernel_in_any_order():
    rng = np.random.default_rng(5)
    known = np.concatenate([np.repeat(rng.standard_normal((3, 4)), 30, axis=0), rng.standard_normal((60, 4))])
    asked, ids = np.concatenate([known[::7], np.zeros((1, 4))]), rng.permutation(len(known))
    frame = lambda name, ids, m: pd.DataFrame({name: ids, "vector": list(m)})
    for metric in vectors.METRICS:
        for sign in (1, -1):  # best last, best first
            by = np.argsort(sign * (known @ asked[0]))
            found = vectors.best_in_block(
                frame("query_id", np.arange(len(asked)), asked), frame("corpus_id", ids[by], known[by]), 6, metric, 6, tile=8)
            a, b = (vectors.unit_rows(asked), vectors.unit_rows(known)) if metric == "cosine" else (asked, known)
            scores = -np.sqrt(((a[:, None] - b[None]) ** 2).sum(-1)) if metric == "l2" else a @ b.T
            scores = np.round(scores, 6) + 0.0
            for q in range(len(asked)):
                best = sorted(range(len(known)), key=lambda c: (-scores[q, c], ids[c]))[:6]
                assert found[found.query_id == q].corpus_id.tolist() == [ids[c] for c in best]


def test_rows_are_not_copied_once_per_block(spark, monkeypatch):
    rows, copies = 1500, []
    hits = vectors.block_hits
    monkeypatch.setattr(vectors, "block_hits", lambda a, b, *rest: copies.extend([a.count(), b.count()]) or hits(a, b, *rest))
    matrix = np.random.default_rng(6).standard_normal((rows, 4))
    asked, known = make(spark, matrix, "query_id"), make(spark, matrix, "corpus_id")
    once = 2 * spark.sparkContext.defaultParallelism
    assert vectors.nearest(asked, known, 3, "dot", block_rows=16).count() == 3 * rows
    assert sum(copies) <= rows * (once + 1)
    copies.clear()
    centres = vectors.fit_cells(known, 30)
    assert vectors.nearest_in_cells(asked, known, 3, centres, probes=30, block_rows=4).count() == 3 * rows
    assert sum(copies) <= rows * (once + 1)


def test_unknown_metric(spark, data):
    queries, corpus = data
    with pytest.raises(ValueError):
        vectors.nearest(make(spark, queries, "query_id"), make(spark, corpus, "corpus_id"), 5, "hamming")


def test_unit_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    rows = df.select(l2_normalize("v").alias("u"), dot("v", "v").alias("d")).collect()
    assert rows[0].u == [0.6, 0.8] and rows[0].d == 25.0 and rows[1].u == [0.0, 0.0]


TWEETS = [
    (1, "pancakes and eggs for breakfast"), (2, "the weather will be cloudy tomorrow"),
    (3, "robbers stole a million in money from the bank"), (4, "a great movie tonight"),
    (5, "the stock market lost money today"),
]


def python_matches(queries, docs, k):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    df = Counter(w for _, t in docs for w in set(words(t)))
    rarity = {w: math.log((len(docs) + 1) / (n + 1)) for w, n in df.items()}

    def unit(text):
        raw = {w: n * rarity[w] for w, n in Counter(words(text)).items() if w in rarity}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        return {w: x / norm for w, x in raw.items()} if norm else {}

    out, vectors_ = [], [(i, unit(t)) for i, t in docs]
    for q, text in queries:
        mine = unit(text)
        scores = [(round(sum(x * v[w] for w, x in mine.items() if w in v), 6), i) for i, v in vectors_ if mine.keys() & v.keys()]
        out += [(q, r + 1, i, s) for r, (s, i) in enumerate(sorted(scores, key=lambda p: (-p[0], p[1]))[:k])]
    return sorted(out)


@pytest.mark.parametrize("k", [1, 3, 50])
def test_index_finds_what_a_full_scan_finds(spark, k):
    draw = random.Random(k)
    sometimes = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(draw.choices(sometimes, [1 / (i + 1) for i in range(60)], k=n))
    docs = [(i, text(draw.randint(1, 30))) for i in range(300)] + [(300, None), (301, ""), (302, "Größe, 漢字 w59"), (303, "w59"), (304, "w59")]
    queries = [(i, text(draw.randint(1, 8))) for i in range(40)] + [(40, None), (41, "unheard of"), (42, "größe W59 w59")]
    index = term_index.build_index(spark.createDataFrame(docs, "id bigint, content string").repartition(3))
    found = term_index.best_matches(spark.createDataFrame(queries, "id bigint, question string"), index, k)
    assert sorted(map(tuple, found.collect())) == python_matches(queries, docs, k)
    sides = term_index.best_matches(spark.createDataFrame(queries, "id bigint, question string"), index, k, side_rows=300)
    assert sorted(map(tuple, sides.collect())) == python_matches(queries, docs, k)


def test_texts_meet_queries_in_sides_and_not_by_word(spark, monkeypatch):
    """A word that all share makes no row per pair of query and text; a word of all texts weighs nothing but is found."""
    docs = spark.createDataFrame([(i, f"all most{i % 50} w{i}") for i in range(400)] + [(400, "all")], "id bigint, content string")
    asked = spark.createDataFrame([(i, f"all w{i} most{i % 7}") for i in range(100)] + [(100, "all")], "id bigint, question string")
    index = term_index.build_index(docs)
    found = term_index.best_matches(asked, index, 2)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 0 and plan.count("FlatMapCoGroupsInPandas") == 1
    got = found.collect()
    assert {r.query_id: r.corpus_id for r in got if r["rank"] == 1} | {100: 0} == {i: i for i in range(100)} | {100: 0}


def test_index_without_texts(spark):
    docs = spark.createDataFrame([], "id bigint, content string")
    asked = spark.createDataFrame([(1, "a b")], "id bigint, question string")
    assert term_index.best_matches(asked, term_index.build_index(docs), 3).collect() == []


def test_tables_get_finer_with_more_rows_and_reach_the_recall():
    draw = np.random.default_rng(1)
    near, other = np.abs(draw.normal(0.6, 0.1, 2000)), draw.normal(1.41, 0.1, 2000)
    shares = []
    for rows in (10**3, 10**6, 10**9):
        tables = buckets.choose_tables(near, other, rows, 0.9)
        p = buckets.shared_step(near, tables.width)
        assert 1 - ((1 - p**tables.cuts) ** tables.tables).mean() >= 0.9
        shares.append((tables.tables * buckets.shared_step(other, tables.width) ** tables.cuts).mean())
    assert shares == sorted(shares, reverse=True) and shares[-1] < 0.01 * shares[0]


def test_shared_steps_come_as_often_as_computed():
    directions, offsets = buckets.projections(20_000, 3)
    for distance in (0.2, 1.0, 1.8):
        a, b = np.array([1.0, 0, 0]), np.array([1.0 - distance, 0, 0])
        same = np.floor(directions @ a / 1.5 + offsets) == np.floor(directions @ b / 1.5 + offsets)
        assert same.mean() == pytest.approx(buckets.shared_step(np.array([distance]), 1.5)[0], abs=0.02)


def test_buckets_find_clustered_neighbours_among_few(spark):
    draw = np.random.default_rng(4)
    centres = draw.standard_normal((60, 16))
    corpus = np.concatenate([c + 0.05 * draw.standard_normal((10, 16)) for c in centres] + [np.zeros((1, 16))])
    known, asked = make(spark, corpus, "corpus_id"), make(spark, corpus[::7], "query_id")
    tables = buckets.Tables(6, 4, 0.75)
    report = vectors.recall(buckets.nearest_by_tables(asked, known, 5, tables, block_rows=8), vectors.nearest(asked, known, 5)).first()
    assert report.recall > 0.9
    found = tables.buckets()
    placed = known.select("corpus_id", F.explode(found("vector")).alias("b"))
    pairs = placed.join(placed.withColumnRenamed("corpus_id", "other"), "b").select("corpus_id", "other").distinct().count()
    assert pairs < 0.1 * len(corpus) ** 2
    chosen = vectors.recall(buckets.search(asked, known, 5), vectors.nearest(asked, known, 5)).first()
    assert chosen.recall >= 0.9


def test_small_buckets_share_a_group(spark, data, monkeypatch):
    corpus = np.random.default_rng(8).standard_normal((400, 6))
    asked, known = make(spark, corpus[::3], "query_id"), make(spark, corpus, "corpus_id")
    tables, groups, hits = buckets.Tables(4, 6, 0.5), [], vectors.block_hits
    monkeypatch.setattr(
        buckets, "block_hits", lambda a, b, keys, *rest: groups.append(a.select(*keys).distinct().count()) or hits(a, b, keys, *rest))
    want, find = [], tables.buckets()
    placed = [df.select(name, F.explode(find("vector")).alias("b")).collect() for df, name in ((asked, "query_id"), (known, "corpus_id"))]
    inside = {}
    for r in placed[1]:
        inside.setdefault(r.b, set()).add(r.corpus_id)
    met = {}
    for r in placed[0]:
        met.setdefault(r.query_id, set()).update(inside[r.b])
    a, b = (vectors.unit_rows(np.float64(np.float32(m))) for m in (corpus[::3], corpus))
    for q, others in met.items():
        scores = np.round(b @ a[q], 6)
        want += [(q, i + 1, c) for i, c in enumerate(sorted(others, key=lambda c: (-scores[c], c))[:3])]
    for size in (dict(), dict(block_rows=2, side_values=12)):
        got = buckets.nearest_by_tables(asked, known, 3, tables, **size).select("query_id", "rank", "corpus_id").collect()
        assert sorted(map(tuple, got)) == sorted(want)
    assert len(inside) > 1000 and groups[0] <= 4 * spark.sparkContext.defaultParallelism


def test_retrieve_context(spark):
    docs = spark.createDataFrame(TWEETS, "id bigint, content string")
    model = retrieval.fit_text_vectors(docs, dimensions=1024)
    unit = retrieval.embed_text(model, docs).select(F.sqrt(dot("vector", "vector")).alias("n")).collect()
    assert [r.n for r in unit] == pytest.approx([1.0] * 5, abs=1e-5)
    questions = spark.createDataFrame([(7, "money {question}"), (8, "movie tonight")], "id bigint, question string")
    got = {r.id: r for r in retrieval.retrieve_context(questions, docs, term_index.build_index(docs), k=2).collect()}
    assert {p.split()[0] for p in got[7].passages} == {"robbers", "the"}
    assert got[8].passages == ["a great movie tonight"]
    assert got[8].system_prompt.endswith(
        "Context: " + "".join(f"Passage: {p}\n" for p in got[8].passages))


def test_short_vectors_do_not_make_endless_sides(spark, monkeypatch):
    """A row takes memory besides its numbers, so a side has so many rows at most, however short they are."""
    known = spark.range(5000).select(F.col("id").alias("corpus_id"), F.array(F.lit(1.0)).alias("vector"))
    assert vectors.side_rows(known, 10, 1 << 22) == (5000, vectors.SIDE_ROWS)
    assert vectors.side_rows(known, 10, 300) == (5000, 300) and vectors.side_rows(known, 1 << 20, 300) == (5000, 1 << 20)
    assert vectors.side_rows(known.select("corpus_id", F.array_repeat(F.lit(1.0), 64).alias("vector")), 4096, vectors.SIDE_VALUES) == (5000, 65536)
