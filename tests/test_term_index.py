"""Text search: what the index holds, and the ways to it that few corpora take."""

import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest

from tablewright.operators import term_index
from tests.test_vectors import python_matches


def corpus(seed: int) -> tuple[list, list]:
    draw = random.Random(seed)
    word = lambda: f"w{min(int(draw.expovariate(0.08)), 90)}" if draw.random() < 0.8 else f"x{draw.randrange(400)}"
    text = lambda n: " ".join(word() for _ in range(n))
    docs = [(i, text(draw.randint(1, 40))) for i in range(200)] + [(200, None), (201, " ,; "), (202, "É漢字 w1_w2")]
    return docs, [(i, text(draw.randint(1, 12))) for i in range(60)] + [(60, "é漢字"), (61, "漢字 É漢字 x3")]


def search(spark, docs, queries, k=3, hot_words=term_index.HOT_WORDS, **how):
    index = term_index.build_index(spark.createDataFrame(docs, "id bigint, content string").repartition(3), hot_words=hot_words)
    asked = spark.createDataFrame(queries, "id bigint, question string")
    return index, sorted(map(tuple, term_index.best_matches(asked, index, k, **how).collect()))


def test_index_has_a_row_per_text(spark):
    """Not one per word and text, and all words of all texts."""
    docs, queries = corpus(1)
    index, found = search(spark, docs, queries)
    assert index.rows.count() == 201
    assert index.rows.selectExpr("sum(size(terms))").first()[0] == index.size == index.terms.selectExpr("sum(df)").first()[0]
    assert found == python_matches(queries, docs, 3)


@pytest.mark.parametrize("hot_words, how", [(0, {}), (60, dict(side_rows=200))])
def test_rarity_of_words_that_tasks_do_not_hold_is_joined(spark, hot_words, how):
    docs, queries = corpus(2)
    index, found = search(spark, docs, queries, hot_words=hot_words, **how)
    assert found == python_matches(queries, docs, 3)
    assert index.terms.count() > 60


def test_texts_of_one_id_are_one_text(spark):
    """Their words are counted together; rarity goes by rows and by texts that hold a word."""
    docs, queries = corpus(3)
    split = [(i, part) for i, t in docs for part in ([t] if i % 3 or not t else [t[: len(t) // 2] + " ", " " + t[len(t) // 2 :]])]
    whole = [(i, t if i % 3 or not t else t[: len(t) // 2] + "  " + t[len(t) // 2 :]) for i, t in docs]
    # as many rows in all
    whole += [(1000 + i, None) for i in range(len(split) - len(whole))]
    assert search(spark, split, queries, hot_words=10)[1] == search(spark, whole, queries)[1] != []


def test_texts_without_an_id_count_but_are_not_found(spark):
    docs, queries = corpus(4)
    big = 2**60
    docs = [(i + big if i is not None else i, t) for i, t in docs]
    found = search(spark, [*docs, (None, docs[0][1])], queries)[1]
    known = search(spark, [*docs, (big - 1, docs[0][1])], queries, k=4)[1]
    rest = {q: [c for *_, c, _ in sorted(r for r in known if r[0] == q) if c != big - 1][:3] for q, _ in queries}
    assert {q: [c for *_, c, _ in sorted(r for r in found if r[0] == q)] for q, _ in queries} == rest


def test_words_with_one_number_get_others(spark, monkeypatch):
    docs, queries = corpus(5)
    numbers, seeds = term_index.term_numbers, []
    monkeypatch.setattr(term_index, "term_numbers", lambda terms, seed: numbers(terms, seed) % (50 if seed < 2 else 2**62))
    stats = term_index.word_stats
    monkeypatch.setattr(term_index, "word_stats", lambda *given: (out := stats(*given), seeds.append(out[2]))[0])
    assert search(spark, docs, queries)[1] == python_matches(queries, docs, 3)
    assert seeds == [2]


@pytest.mark.parametrize("words, block", [(30, 1 << 20), (3000, 1 << 20), (3000, 999)])
def test_a_side_is_scored_in_bounded_memory(monkeypatch, words, block):
    """Words of many and of few texts, copies, and texts without length; a block of scores at a time, not all pairs."""
    draw = np.random.default_rng(1)
    monkeypatch.setattr(term_index, "BLOCK", block)
    bag = lambda n: np.unique((words * draw.random(n) ** 3).astype(np.int64) * 7919)
    terms = [bag(40) for _ in range(3000)]
    terms[100:160] = [terms[100]] * 60
    counts = [draw.integers(1, 4, len(t)).astype(np.int32) for t in terms]
    counts[100:160] = [counts[100]] * 60
    square = np.array([float((c**2).sum()) for c in counts])
    square[5] = 0.0
    asked = [bag(12) for _ in range(700)] + [terms[100], np.array([-1])]
    shares = [draw.random(len(t)) for t in asked]
    texts = pd.DataFrame({"corpus_id": draw.permutation(3000), "terms": terms, "counts": counts, "square": square})
    queries = pd.DataFrame({"query_id": range(len(asked)), "terms": asked, "shares": shares})
    tracemalloc.start()
    got = term_index.best_in_sides(queries, texts, 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    size = 7919 * words
    matrix = np.zeros((3000, size // 7919 + 1))
    for i, (t, c) in enumerate(zip(terms, counts)):
        matrix[i, t // 7919] = c
    matrix /= np.sqrt(np.where(square > 0, square, np.inf))[:, None]
    order = np.argsort(texts["corpus_id"].to_numpy())
    want = []
    for q, (t, s) in enumerate(zip(asked, shares)):
        if t[0] < 0:
            continue
        score = np.round(matrix[order][:, t // 7919] @ s, 6)
        best = np.lexsort((np.arange(3000), -score))[:4]
        want += [(q, c, score[c]) for c in best if matrix[order[c]][t // 7919].any()]
    assert [tuple(r)[:2] for r in got.itertuples(index=False)] == [w[:2] for w in want]
    assert got["score"].to_numpy() == pytest.approx([w[2] for w in want], abs=1e-9)
    assert peak < 60e6
