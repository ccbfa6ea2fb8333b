"""Comparing billed usage of two kinds of compute over like windows.

Usage rows hold job_id, run_id, is_serverless, record_type, sku_name,
usage_quantity and usage_start_time; :func:`flatten_billing` makes them from the
nested billing table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.columns import compute_label
from tablewright.operators.ordered import top_per_group

ORIGINAL = "ORIGINAL"


def flatten_billing(billing: DataFrame) -> DataFrame:
    return billing.select(
        F.col("usage_metadata.job_id").alias("job_id"),
        F.col("usage_metadata.job_run_id").alias("run_id"),
        F.col("product_features.is_serverless").alias("is_serverless"),
        "record_type", "sku_name", "usage_quantity", "usage_start_time",
    )


def usage_windows(usage: DataFrame, runs: int = 144, job_id: object | None = None, by: str = "record") -> DataFrame:
    """Newest ``runs`` classic entries and oldest serverless ones from the classic end on, per job.

    With ``by='record'`` every usage row takes a place; with ``by='run'`` a run
    takes one, at its first start. Equal times are ordered by run id.
    """
    if by not in ("record", "run"):
        raise ValueError("by must be 'record' or 'run'")
    billed = usage.where(F.col("record_type") == ORIGINAL)
    if job_id is not None:
        billed = billed.where(F.col("job_id") == F.lit(job_id))
    classic = billed.where(~F.col("is_serverless")).select("job_id", "run_id", "usage_start_time")
    cutoff = classic.groupBy("job_id").agg(F.max("usage_start_time").alias("cutoff"))
    serverless = (
        billed.where("is_serverless").select("job_id", "run_id", "usage_start_time")
        .join(cutoff, "job_id")
        .where(F.col("usage_start_time") >= F.col("cutoff"))
        .drop("cutoff")
    )
    if by == "run":
        classic, serverless = (
            side.groupBy("job_id", "run_id").agg(F.min("usage_start_time").alias("usage_start_time"))
            for side in (classic, serverless)
        )
    newest = top_per_group(classic, ["job_id"], [F.col("usage_start_time").desc(), F.col("run_id").desc()], runs)
    oldest = top_per_group(serverless, ["job_id"], ["usage_start_time", "run_id"], runs)
    return newest.withColumn("compute_type", F.lit("classic")).unionByName(
        oldest.withColumn("compute_type", F.lit("serverless"))
    )


def window_sizes(windows: DataFrame, runs: int) -> DataFrame:
    """Entries found per job and class, and whether they are enough."""
    return windows.groupBy("job_id", "compute_type").agg(F.count(F.lit(1)).alias("found")).withColumn(
        "enough", F.col("found") >= runs
    )


def usage_compare(usage: DataFrame, windows: DataFrame) -> DataFrame:
    """Records, runs, total and time range of the chosen runs per job, class and SKU."""
    chosen = windows.select("job_id", "run_id").distinct()
    return (
        usage.where(F.col("record_type") == ORIGINAL)
        .join(chosen, ["job_id", "run_id"], "left_semi")
        .groupBy("job_id", compute_label("is_serverless").alias("compute_type"), "sku_name")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count_distinct("run_id").alias("runs"),
            F.round(F.sum(F.col("usage_quantity").cast("decimal(28,6)")), 6).cast("double").alias("total"),
            F.min("usage_start_time").alias("window_start"),
            F.max("usage_start_time").alias("window_end"),
        )
    )


def usage_ratio(compared: DataFrame) -> DataFrame:
    """Classic over serverless total per job; infinite when serverless billed nothing."""

    def total(label: str):
        return F.coalesce(F.sum(F.when(F.col("compute_type") == label, F.col("total"))), F.lit(0.0))

    totals = compared.groupBy("job_id").agg(total("Classic").alias("classic"), total("Serverless").alias("serverless"))
    return totals.withColumn(
        "ratio",
        F.when(F.col("serverless") == 0, F.lit(float("inf"))).otherwise(
            F.col("classic") / F.nullif(F.col("serverless"), F.lit(0.0))
        ),
    )
