"""Positions, running totals and percentiles that never sort a whole key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tablewright.session import cut_lineage

# monotonically_increasing_id keeps the row index of a partition in its low 33 bits
ROW_INDEX_BITS = 33


def running_by_bucket(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    bucket: Column,
    row_number: str | None = None,
    sums: dict[str, str] | None = None,
    total: str | None = None,
) -> DataFrame:
    """Row number, inclusive running sums and row count per key, for keys of any size.

    ``bucket`` must be non-null and must grow with ``order`` inside a key (a day,
    a block of turns). Rows are sorted only inside one (key, bucket); what lies
    before a bucket comes from the bucket totals, which are pre-aggregated. A null
    key is a key like any other.
    """
    sums = sums or {}
    # a struct is never null, so join and window use the same columns and share one shuffle
    tagged = df.withColumn("__keys", F.struct(*keys)).withColumn("__bucket", bucket)
    group = ["__keys", "__bucket"]
    totals = tagged.groupBy(*group).agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.sum(src).alias(f"__sum_{name}") for name, src in sums.items()],
    )
    whole = Window.partitionBy("__keys")
    before = whole.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *group,
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__rows_before"),
        *[
            F.coalesce(F.sum(f"__sum_{name}").over(before), F.lit(0)).alias(f"__before_{name}")
            for name in sums
        ],
        *([F.sum("__rows").over(whole).alias(total)] if total else []),
    )
    inside = Window.partitionBy(*group).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = tagged.join(offsets, group)
    added = [total] if total else []
    if row_number:
        out = out.withColumn(row_number, F.row_number().over(inside) + F.col("__rows_before"))
        added.append(row_number)
    for name, src in sums.items():
        out = out.withColumn(name, F.coalesce(F.sum(src).over(upto), F.lit(0)) + F.col(f"__before_{name}"))
        added.append(name)
    kept = [c for c in df.columns if c not in added]
    return out.select(*kept, *added)


def global_positions(df: DataFrame, order: Sequence[str | Column], name: str, start: int = 0) -> DataFrame:
    """Consecutive positions over the whole table, sorted in parallel.

    Rows are range-partitioned and written once, so every task sees the same
    partitions; each partition then adds the row count of those before it. Only
    one count per partition reaches the driver.
    """
    spark = df.sparkSession
    ranged = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order))
    tagged = ranged.withColumn("__id", F.monotonically_increasing_id())
    tagged = tagged.withColumn("__part", F.shiftrightunsigned("__id", ROW_INDEX_BITS))
    sizes = sorted((r["__part"], r["count"]) for r in tagged.groupBy("__part").count().collect())
    offsets, seen = [], start
    for part, size in sizes:
        offsets.append((part, seen))
        seen += size
    schema = T.StructType([T.StructField("__part", T.LongType()), T.StructField("__offset", T.LongType())])
    table = spark.createDataFrame(offsets, schema)
    index = F.col("__id").bitwiseAND(F.lit((1 << ROW_INDEX_BITS) - 1))
    return (
        tagged.join(F.broadcast(table), "__part")
        .withColumn(name, index + F.col("__offset"))
        .drop("__id", "__part", "__offset")
    )


def dense_ids(df: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct labels with 1-based ids in label order."""
    labels = df.select(column).where(F.col(column).isNotNull()).distinct()
    return global_positions(labels, [column], name, start=1)


def vocabulary(df: DataFrame, column: str, name: str) -> DataFrame:
    """Labels with 0-based indices, most frequent first, ties by label."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    return global_positions(counts, [F.col("__n").desc(), F.col(column)], name).drop("__n")


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], k: int, name: str = "rank") -> DataFrame:
    """First k rows of each group; Spark trims each group to k before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


#: Buckets of a counting pass after the first; five such passes tell all numbers between two powers of two apart.
BUCKETS = 4096
_SCALE = 1100  # above the exponent of any double, so that buckets of positive and negative numbers stay apart


def magnitude(value: Column) -> Column:
    """A whole number that grows with the value: its sign and power of two."""
    size = F.abs(value)
    power = F.when(size == float("inf"), 2 * _SCALE).otherwise(F.floor(F.log2(size)) + _SCALE)
    return F.when(value == 0, 0).when(value > 0, power).otherwise(-power).cast("long")


def index_percentiles(df: DataFrame, metrics: Sequence[str], percents: Sequence[int]) -> DataFrame:
    """Value at index ``floor(n * p / 100)`` of each sorted metric, nulls and NaN ignored.

    One row per metric and percent, with ``n``, ``avg`` and ``max``. Nothing is sorted: values are counted by sign and
    power of two, then those in the bucket that holds an index are counted again in finer buckets between its least and
    largest value, until these are the same. That takes six passes at most, for any number of values, and each pass
    goes over the values of the last one's buckets only.
    """
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), (F.col(m).cast("double") + 0.0).alias("value")) for m in metrics])
    long = df.select(F.explode(pairs).alias("__m")).select("__m.metric", "__m.value")
    long = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    counted = [F.count(F.lit(1)).alias("c"), F.min("value").alias("lo"), F.max("value").alias("hi")]
    first = cut_lineage(long.groupBy("metric", magnitude(F.col("value")).alias("bucket")).agg(*counted, F.sum("value").alias("total")))
    stats = first.groupBy("metric").agg(
        F.sum("c").alias("n"), (F.sum("total") / F.sum("c")).alias("avg"), F.max("hi").alias("max")
    )
    aim = F.explode(F.array(*[
        F.struct(F.lit(p).alias("percent"), F.least(F.floor(F.col("n") * p / 100), F.col("n") - 1).alias("target"))
        for p in percents
    ]))
    wanted = stats.select("metric", "n", "avg", "max", aim.alias("a")).select("metric", "n", "avg", "max", "a.percent", "a.target")
    named = ["metric", "percent", "n", "avg", "max"]

    def holding(buckets: DataFrame) -> DataFrame:
        """The bucket that holds each target, and the target's index in it."""
        before = Window.partitionBy("metric", "percent").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        placed = buckets.withColumn("before", F.coalesce(F.sum("c").over(before), F.lit(0)))
        inside = (F.col("target") >= F.col("before")) & (F.col("target") < F.col("before") + F.col("c"))
        return placed.where(inside).select(*named, (F.col("target") - F.col("before")).alias("target"), "lo", "hi")

    # a row per metric and percent, and a few thousand buckets for each
    held = cut_lineage(holding(first.select("metric", "bucket", "c", "lo", "hi").join(wanted, "metric")))
    done, values, keys = held.where("lo = hi"), long, ["metric"]
    while not (held := held.where("lo < hi")).isEmpty():
        inside = (F.col("value") >= F.col("lo")) & (F.col("value") <= F.col("hi"))
        values = cut_lineage(values.join(F.broadcast(held), keys).where(inside))
        share = (F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo"))
        bucket = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1)).alias("bucket")
        held = cut_lineage(holding(values.groupBy(*named, "target", bucket).agg(*counted)))
        done = done.unionByName(held.where("lo = hi"))
        values, keys = values.select("metric", "percent", "value"), ["metric", "percent"]
    return done.select(*named, F.col("lo").alias("value"))
