import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright.operators import groups
from tablewright.sources import synthetic

NAMES = [f"features_{i}" for i in range(4)]


@pytest.fixture(scope="module")
def samples(spark):
    noise = F.sin(F.col("features_0") * 1000) * 5
    return synthetic.synthetic_groups(spark, 6, 4, 80).withColumn("target", F.col("target") + noise).cache()


def least_squares(x, y):
    design = np.c_[x, np.ones(len(x))]
    return np.linalg.lstsq(design, y, rcond=None)[0]


def test_fit_matches_numpy_and_folds_match_refitting(spark, samples):
    models = {r.group_name: r for r in groups.fit_linear_groups(samples, ["group_name"], NAMES, "target", folds=4).collect()}
    fold = F.pmod(F.xxhash64(*[F.col(c).cast("double") for c in [*NAMES, "target"]]), F.lit(4)).alias("fold")
    data = samples.select("*", fold).toPandas()
    assert len(models) == 6
    for name, rows in data.groupby("group_name"):
        x, y = rows[NAMES].to_numpy(float), rows["target"].to_numpy(float)
        want, model = least_squares(x, y), models[name]
        assert [*model.coefficients, model.intercept] == pytest.approx(list(want), rel=1e-6, abs=1e-6)
        fitted = x @ want[:-1] + want[-1]
        assert model.r2 == pytest.approx(1 - ((y - fitted) ** 2).sum() / ((y - y.mean()) ** 2).sum())
        assert model.prediction == pytest.approx(fitted.mean())
        error = 0.0
        for f in range(4):
            inside, outside = rows.fold == f, rows.fold != f
            w = least_squares(x[outside], y[outside])
            error += ((y[inside] - x[inside] @ w[:-1] - w[-1]) ** 2).sum()
        assert model.cross_validation_metric == pytest.approx(np.sqrt(error / len(y)), rel=1e-6)


def test_layout_does_not_matter(spark, samples):
    one = groups.fit_linear_groups(samples.coalesce(1), ["group_name"], NAMES, "target").orderBy("group_name").toPandas()
    many = groups.fit_linear_groups(samples.repartition(9), ["group_name"], NAMES, "target").orderBy("group_name").toPandas()
    assert np.allclose(np.stack(one.coefficients), np.stack(many.coefficients))


def test_fewer_rows_than_features_and_nulls(spark):
    rows = [("a", 1.0, 2.0, 5.0), ("a", 2.0, 4.0, 9.0), ("a", None, 1.0, 1.0), ("b", 1.0, 1.0, 3.0)]
    df = spark.createDataFrame(rows, "g string, x double, z double, y double")
    models = groups.fit_linear_groups(df, ["g"], ["x", "z"], "y", folds=1)
    got = {r.g: r for r in models.collect()}
    assert got["a"].n_rows == 2 and got["b"].n_rows == 1
    assert got["b"].intercept == 3.0 and got["b"].r2 is None
    scored = groups.predict_groups(df.dropna(), models, ["g"], ["x", "z"])
    assert {(r.y, round(r.prediction, 9)) for r in scored.collect()} == {(5.0, 5.0), (9.0, 9.0), (3.0, 3.0)}


def test_unknown_group_scores_null(spark, samples):
    models = groups.fit_linear_groups(samples, ["group_name"], NAMES, "target")
    other = samples.limit(2).withColumn("group_name", F.lit("nobody"))
    assert [r.prediction for r in groups.predict_groups(other, models, ["group_name"], NAMES).collect()] == [None, None]


def test_model_bytes_round_trip(spark, samples, tmp_path):
    models = groups.fit_linear_groups(samples, ["group_name"], NAMES, "target")
    models.write.parquet(str(tmp_path / "models"))
    stored = spark.read.parquet(str(tmp_path / "models"))
    assert {r.algorithm for r in stored.collect()} == {"linear"}
    rows = samples.join(stored, "group_name", "left")
    both = groups.predict_groups(rows, stored, ["group_name"], NAMES, "native").select(
        "native", groups.score_model_column("model_binary", F.struct(*NAMES)).alias("stored")).collect()
    assert [r.stored for r in both] == pytest.approx([r.native for r in both])
    none = rows.limit(1).withColumn("model_binary", F.lit(None).cast("binary"))
    assert none.select(groups.score_model_column("model_binary", F.struct(*NAMES)).alias("p")).first().p is None


def test_newest_models(spark):
    rows = [("a", "old", 1), ("a", "new", 2), ("b", "only", 1)]
    df = spark.createDataFrame(rows, "g string, m string, creation_time int")
    assert {(r.g, r.m) for r in groups.newest_models(df, ["g"]).collect()} == {("a", "new"), ("b", "only")}


def test_map_groups_streams_any_group(spark):
    df = spark.range(50_000).select(F.when(F.col("id") < 45_000, "hot").otherwise("b").alias("g"), (F.col("id") % 7).alias("v"))

    def total(batches):
        name, n, s, most = None, 0, 0, 0
        for batch in batches:
            name, n, s, most = batch.g.iloc[0], n + 1, s + int(batch.v.sum()), max(most, len(batch))
        yield pd.DataFrame({"g": [name], "batches": [n], "s": [s], "most": [most]})

    got = {r.g: r for r in groups.map_groups(df, ["g"], total, "g string, batches int, s bigint, most int").collect()}
    assert {g: r.s for g, r in got.items()} == {"hot": sum(i % 7 for i in range(45_000)), "b": sum(i % 7 for i in range(45_000, 50_000))}
    assert got["hot"].batches > 1 and got["hot"].most < 45_000
    assert groups.map_groups(df.limit(0), ["g"], total, "g string, batches int, s bigint, most int").collect() == []


def test_forecast_follows_trend_and_week(spark):
    day = F.timestamp_seconds((F.col("id") + 19000) * 86400)
    week = F.sin(F.col("id") * 2 * np.pi / 7)
    series = spark.range(120).where("id != 50").select(
        F.lit("a").alias("g"), day.alias("ds"), (F.col("id") * 2 + 10 * week).alias("y")
    ).unionByName(spark.range(30).select(F.lit("flat").alias("g"), day.alias("ds"), F.lit(4.0).alias("y")))
    got = groups.forecast_groups(series, "g", 14, periods=((7.0, 1),)).orderBy("g", "ds").collect()
    future = [r for r in got if r.is_future and r.g == "a"]
    assert len(got) == 119 + 30 + 28 and all(r.y is None for r in future)
    want = [i * 2 + 10 * np.sin(i * 2 * np.pi / 7) for i in range(120, 134)]
    assert [r.yhat for r in future] == pytest.approx(want, abs=1e-4)
    assert [r.yhat for r in got if r.g == "flat"] == pytest.approx([4.0] * 44, abs=1e-6)
