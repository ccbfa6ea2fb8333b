import math

import pytest
from pyspark.sql import functions as F

from tablewright.operators import evaluate, factors
from tablewright.operators.orders import clean_orders
from tablewright.operators.split import feature_target_split, temporal_split
from tablewright.sources import synthetic


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "y int, y_hat int")


def test_classification_report(spark):
    # class 2 is never predicted, class 3 never true
    pairs = [(0, 0)] * 3 + [(0, 1)] + [(1, 1)] * 2 + [(2, 0)] * 2 + [(1, 3)]
    got = {r.label: tuple(r)[1:] for r in evaluate.classification_report(rows(spark, pairs)).collect()}
    p0, r0 = 3 / 5, 3 / 4
    p1, r1 = 2 / 3, 2 / 3
    f0, f1 = 2 * p0 * r0 / (p0 + r0), 2 * p1 * r1 / (p1 + r1)
    assert got["0"] == pytest.approx((p0, r0, f0, 4))
    assert got["1"] == pytest.approx((p1, r1, f1, 3))
    assert got["2"] == (0, 0, 0, 2) and got["3"] == (0, 0, 0, 0)
    assert got["accuracy"] == pytest.approx((5 / 9, 5 / 9, 5 / 9, 9))
    assert got["macro avg"] == pytest.approx(((p0 + p1) / 4, (r0 + r1) / 4, (f0 + f1) / 4, 9))
    assert got["weighted avg"] == pytest.approx(((4 * p0 + 3 * p1) / 9, (4 * r0 + 3 * r1) / 9, (4 * f0 + 3 * f1) / 9, 9))


@pytest.mark.parametrize("challenger, promote", [([0, 1, 1], True), ([0, 1, 0], True), ([1, 0, 1], False)])
def test_bakeoff(spark, challenger, promote):
    df = spark.createDataFrame([(y, a, b) for y, a, b in zip([0, 1, 1], [0, 1, 0], challenger)], "y int, a int, b int")
    found = evaluate.bakeoff(df, "y", "a", "b").first()
    assert found.promote is promote and found.winner == ("challenger" if promote else "champion")


def test_model_aliases(spark):
    df = spark.createDataFrame(
        [("one", 1, 0.5), ("up", 1, 0.5), ("up", 2, 0.1), ("up", 3, 0.5), ("down", 1, 0.5), ("down", 4, 0.4)],
        "name string, version int, score double")
    assert {tuple(r) for r in evaluate.model_aliases(df).collect()} == {
        ("one", "Champion", 1), ("up", "Champion", 3), ("up", "Retired", 1),
        ("down", "Champion", 1), ("down", "Challenger", 4)}


def test_hit_and_ndcg(spark):
    df = spark.createDataFrame(
        [(["a", "b", "c"], "a"), (["a", "b", "c"], "c"), (["a", "b", "c"], "z"), (["a", "b", "c"], "b"),
         (None, "a")],
        "items array<string>, label string")
    got = evaluate.hit_and_ndcg(df, "items", "label", 2).first()
    assert (got.n, got.hit, got.ndcg, got.cold) == (4, 0.5, pytest.approx((1 + 1 / math.log2(3)) / 4), 1)


def test_classifier_learns(spark):
    wide = synthetic.synthetic_wide(spark, 600, 2, 2).withColumn("target", F.expr("int(r_0 > r_1)"))
    train, test = feature_target_split(wide, "id", "target")
    judged = evaluate.fit_classifier(train, "target").transform(test).selectExpr("target y", "int(y_hat) y_hat")
    report = {r.label: r for r in evaluate.classification_report(judged).collect()}
    assert report["accuracy"].f1_score > 0.9


def test_throughput(spark):
    df = spark.createDataFrame([("a", 640, 10.0), ("a", 0, 10.0), ("b", 640, 5.0)], "f string, n int, s double")
    got = {r.f: r for r in evaluate.relative_throughput(df, "f", "n", "s", 64).collect()}
    assert got["a"].ratio == 1.0 and got["b"].ratio == 4.0 and got["b"].ms_per_batch == 500.0


def test_factor_model_end_to_end(spark):
    cleaned = clean_orders(synthetic.synthetic_orders(spark, 80, 1500), synthetic.REMOVED_ITEMS)
    split = temporal_split(cleaned, "mpid", "order_timestamp", "order_id").cache()
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    matrix = factors.prepare(train)
    totals = matrix.shares.groupBy("user_id").agg({"proportion_of_orders": "sum"}).collect()
    assert [r[1] for r in totals] == pytest.approx([1.0] * len(totals))
    linked = factors.link_orders(test, matrix)
    report = factors.link_report(test, matrix).first()
    assert report.linked == linked.count() and report.total == test.count() == report.linked + report.dropped
    model = factors.fit(matrix.shares, rank=6, max_iter=3)
    lists = factors.recommend_users(model, 20)
    own = {(r.user_id, r.item_id): r.score for r in lists.collect()}
    theirs = {(r.user_id, x.item_id): x.rating for r in model.recommendForAllUsers(20).collect() for x in r.recommendations}
    assert own.keys() == theirs.keys() and list(own.values()) == pytest.approx([theirs[key] for key in own], abs=1e-5)
    ranked = factors.with_labels(lists, matrix)
    published = factors.publish_lists(ranked).cache()
    for r in published.collect():
        assert len(r.recommendations) == len(r.scores) == 18 and len(set(r.recommendations)) == 18
        assert r.scores == sorted(r.scores, reverse=True)
    asked = spark.createDataFrame([("999999",), (published.first().mpid,)], "mpid string")
    found = {r.mpid: r for r in factors.lookup_lists(asked, published, 5).collect()}
    assert found["999999"].recommendations == [] and found["999999"].scores == []
    assert sorted(len(r.recommendations) for r in found.values()) == [0, 5]
    search = factors.tune(matrix, linked, trials=2, ranks=(2, 5), iterations=(1, 2))
    assert len(search.trials) == 2 and search.best["hit"] == max(t["hit"] for t in search.trials)
    whole, final = factors.refit(cleaned, search)
    assert final.rank == search.best["rank"] and final.userFactors.count() == whole.users.count()
    users, items = factors.unit_vectors(model, matrix)
    for r in [*users.collect(), *items.collect()]:
        assert sum(x * x for x in r.embedding) == pytest.approx(1.0, abs=1e-5)
