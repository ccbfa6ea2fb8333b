"""Classifier reports, the champion bake-off, and ranking metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def classification_report(
    predictions: DataFrame, truth: str = "y", predicted: str = "y_hat", by: Sequence[str] = ()
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    Only the confusion counts are shuffled; a class may be absent on either side.
    """
    by = list(by)
    cells = predictions.groupBy(*by, truth, predicted).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(
        *by,
        F.explode(
            F.array(
                F.struct(F.col(truth).cast("string").alias("label"), F.col("n").alias("support"),
                         F.lit(0).cast("long").alias("guessed"),
                         F.when(F.col(truth) == F.col(predicted), F.col("n")).otherwise(0).alias("correct")),
                F.struct(F.col(predicted).cast("string").alias("label"), F.lit(0).cast("long").alias("support"),
                         F.col("n").alias("guessed"), F.lit(0).cast("long").alias("correct")),
            )
        ).alias("s"),
    ).select(*by, "s.*")
    counts = sides.groupBy(*by, "label").agg(*[F.sum(c).alias(c) for c in ("support", "guessed", "correct")])
    precision = ratio(F.col("correct"), F.col("guessed"))
    recalled = ratio(F.col("correct"), F.col("support"))
    classes = counts.select(
        *by, "label", precision.alias("precision"), recalled.alias("recall"),
        ratio(2 * precision * recalled, precision + recalled).alias("f1_score"), "support", "correct",
    )
    total = F.sum("support")
    measures = ("precision", "recall", "f1_score")
    weighted = {m: ratio(F.sum(F.col(m) * F.col("support")), total) for m in measures}
    summary = classes.groupBy(*by).agg(
        F.struct(*[ratio(F.sum("correct"), total).alias(m) for m in measures], total.alias("support")).alias("a"),
        F.struct(*[F.avg(m).alias(m) for m in measures], total.alias("support")).alias("m"),
        F.struct(*[weighted[m].alias(m) for m in measures], total.alias("support")).alias("w"),
    )
    tails = [
        summary.select(*by, F.lit(label).alias("label"), f"{side}.*")
        for side, label in (("a", "accuracy"), ("m", "macro avg"), ("w", "weighted avg"))
    ]
    out = classes.drop("correct")
    for tail in tails:
        out = out.unionByName(tail)
    return out


def bakeoff(predictions: DataFrame, truth: str, champion: str, challenger: str) -> DataFrame:
    """Weighted F1 of both models on the same rows; the challenger wins ties."""
    both = predictions.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(m).alias("model"), F.col(truth).alias("y"), F.col(c).alias("y_hat"))
                    for m, c in (("champion", champion), ("challenger", challenger))
                ]
            )
        ).alias("p")
    ).select("p.*")
    f1 = classification_report(both, by=["model"]).where(F.col("label") == "weighted avg")

    def of(model: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col("f1_score")))

    scores = f1.agg(of("champion").alias("champion_f1"), of("challenger").alias("challenger_f1"))
    wins = F.col("challenger_f1") >= F.col("champion_f1")
    return scores.select(
        "champion_f1", "challenger_f1", wins.alias("promote"),
        F.when(wins, "challenger").otherwise("champion").alias("winner"),
    )


def model_aliases(versions: DataFrame, score: str = "score") -> DataFrame:
    """Alias of each version after the bake-off, for a table ``(name, version, score)``.

    The first version starts as Champion and the newest is its Challenger; the
    Challenger takes the alias over when it scores at least as well.
    """
    ends = versions.groupBy("name").agg(
        F.min("version").alias("first"), F.max("version").alias("newest"),
        F.min_by(score, "version").alias("first_score"), F.max_by(score, "version").alias("newest_score"),
    )
    promoted = (F.col("newest") > F.col("first")) & (F.col("newest_score") >= F.col("first_score"))
    winner = F.when(promoted, F.col("newest")).otherwise(F.col("first"))
    loser = F.when(F.col("newest") > F.col("first"), F.when(promoted, F.col("first")).otherwise(F.col("newest")))
    return ends.select(
        "name",
        F.explode(
            F.array(
                F.struct(F.lit("Champion").alias("alias"), winner.alias("version")),
                F.struct(F.when(promoted, "Retired").otherwise("Challenger").alias("alias"), loser.alias("version")),
            )
        ).alias("a"),
    ).select("name", "a.alias", "a.version").where(F.col("version").isNotNull())


def latest_version(versions: DataFrame, name: str, version: str) -> DataFrame:
    return versions.groupBy(name).agg(F.max(version).alias("latest_version"))


def fit_classifier(
    train: DataFrame, target: str, max_iter: int = 1000, features: Sequence[str] | None = None
) -> PipelineModel:
    """Logistic regression on all columns but the target; the row id must not be among them."""
    columns = list(features or [c for c in train.columns if c != target])
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=columns, outputCol="__features"),
            LogisticRegression(featuresCol="__features", labelCol=target, maxIter=max_iter, predictionCol="y_hat"),
        ]
    ).fit(train)


def hit_and_ndcg(lists: DataFrame, items: str, label: str, k: int) -> DataFrame:
    """Mean Hit@k and NDCG@k with one relevant item per row; rows without a list (null) are counted as cold, not judged."""
    place = F.array_position(F.slice(F.col(items), 1, k), F.col(label))
    found = lists.select(F.when(F.col(items).isNotNull(), F.coalesce(place, F.lit(0))).alias("place"))
    hit = F.when(F.col("place") > 0, 1.0).when(F.col("place") == 0, 0.0)
    return found.agg(
        F.count("place").alias("n"),
        F.count_if(F.col("place").isNull()).alias("cold"),
        F.avg(hit).alias("hit"),
        F.avg(hit / F.log2(F.greatest("place", F.lit(1)) + 1)).alias("ndcg"),
    )


def relative_throughput(metrics: DataFrame, group: str, samples: str, seconds: str, batch: int) -> DataFrame:
    """Samples per second and milliseconds per batch of each format, and the ratio to the slowest."""
    totals = metrics.groupBy(group).agg(
        F.sum(samples).alias("total_samples"), F.sum(seconds).alias("elapsed_sec")
    )
    rates = totals.select(
        group, "total_samples", "elapsed_sec",
        (F.col("total_samples") / F.col("elapsed_sec")).alias("samples_per_sec"),
        (F.col("elapsed_sec") * 1000 / F.ceil(F.col("total_samples") / batch)).alias("ms_per_batch"),
    )
    slowest = rates.agg(F.min("samples_per_sec")).scalar()
    return rates.withColumn("ratio", F.col("samples_per_sec") / slowest)
