import random

import pytest
from pyspark.sql import functions as F

from tablewright.operators.ordered import (
    dense_ids, global_positions, index_percentiles, running_by_bucket, top_per_group, vocabulary,
)


def test_running_by_bucket_with_one_key_holding_most_rows(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 else f"k{i % 7}", i, rng.randint(0, 9)) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, t bigint, v bigint").repartition(5)
    got = running_by_bucket(df, ["k"], ["t"], F.floor(F.col("t") / 16), row_number="n", sums={"s": "v"})
    want, n, s = {}, {}, {}
    for k, t, v in rows:
        n[k], s[k] = n.get(k, 0) + 1, s.get(k, 0) + v
        want[k, t] = (n[k], s[k])
    assert {(r.k, r.t): (r.n, r.s) for r in got.collect()} == want


def test_global_positions_are_consecutive(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    got = global_positions(df.repartition(7), ["x"], "p", start=5)
    assert sorted((r.p, r.x) for r in got.collect()) == [(i + 5, i) for i in range(1000)]


def test_dense_ids_and_vocabulary(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",), ("a",)], "x string")
    assert {(r.x, r.id) for r in dense_ids(df, "x", "id").collect()} == {("a", 1), ("b", 2), ("c", 3)}
    assert {(r.x, r.i) for r in vocabulary(df, "x", "i").collect()} == {("a", 0), ("b", 1), ("c", 2)}


def test_top_per_group(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)] + [("b", 1)], "k string, v int")
    got = top_per_group(df, ["k"], [F.col("v").desc()], 2)
    assert {(r.k, r.v, r["rank"]) for r in got.collect()} == {("a", 9, 1), ("a", 8, 2), ("b", 1, 1)}


def wanted(values, p):
    values = sorted(values)
    return values[min(int(len(values) * p / 100), len(values) - 1)]


@pytest.mark.parametrize("kind", ["uniform", "heavy", "constant", "few", "signs", "extremes", "close"])
def test_percentiles_through_the_bracket(spark, kind):
    rng = random.Random(3)
    values = {
        "uniform": [rng.random() for _ in range(20000)],
        "heavy": [rng.paretovariate(0.5) for _ in range(20000)],
        "constant": [1.5] * 9000 + [rng.random() for _ in range(9000)],
        "few": [float(rng.randint(0, 3)) for _ in range(20000)],
        "signs": [rng.gauss(0, 1) for _ in range(9000)] + [0.0, -0.0] * 50,
        "extremes": [float("inf"), float("-inf"), 5e-324, -5e-324, 1.7e308, -1.7e308, 0.0] * 20,
        "close": [1.0 + i * 2.0**-52 for i in range(5000)],
    }[kind]
    df = spark.createDataFrame([(v, None if i % 2 else v) for i, v in enumerate(values)], "a double, b double")
    percents = [1, 25, 50, 75, 95, 99, 100]
    got = index_percentiles(df, ["a", "b"], percents).collect()
    assert len(got) == 2 * len(percents)
    for r in got:
        column = values if r.metric == "a" else values[::2]
        assert (r.n, r.value, r["max"]) == (len(column), wanted(column, r.percent), max(column))


def test_percentiles_of_one_row_and_of_nulls(spark):
    df = spark.createDataFrame([(2.0, None), (float("nan"), float("nan"))], "a double, b double")
    got = index_percentiles(df, ["a", "b"], [50, 95]).collect()
    assert {(r.metric, r.percent, r.value, r.n, r["max"]) for r in got} == {("a", 50, 2.0, 1, 2.0), ("a", 95, 2.0, 1, 2.0)}
