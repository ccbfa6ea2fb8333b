"""Keeping a keyed table up to date from files that arrive.

The table is plain Parquet, partitioned by a hash of its key; the partition column's name tells their number. A batch
reads the partitions that its changes touch, writes them to a staged copy beside the stream's checkpoint, and overwrites
just these partitions with it. A batch that runs again finds its staged copy, or applies the same changes once more; both
leave the same rows. Deleted keys stay as marked rows until their partition is written next, as an overwrite needs a row
for every partition that it replaces.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tablewright.operators.keyed import apply_changes, change_feed, newest_per_key, require_key
from tablewright.operators.retrieval import embed_text

PARTS = 64
PART_OF = "part_of_"
#: The stream batch that last wrote a row (-1: published), and whether the row only marks a deleted key.
BATCH, DELETED = "written_by_batch", "is_deleted"


def placed(df: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    return df.withColumn(f"{PART_OF}{parts}", F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))


def part_column(df: DataFrame) -> str:
    return next(c for c in df.columns if c.startswith(PART_OF))


def file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at)


def publish(df: DataFrame, path: str, keys: Sequence[str], parts: int = PARTS) -> None:
    """Write a whole table after checking its key. A key's partition may be any size; its files are split by size."""
    marked = require_key(df, keys).withColumn(BATCH, F.lit(-1).cast("long")).withColumn(DELETED, F.lit(False))
    rows = placed(marked, keys, parts)
    rows.hint("rebalance", part_column(rows)).write.mode("overwrite").partitionBy(part_column(rows)).parquet(path)


def read_table(spark: SparkSession, path: str, with_batch: bool = False) -> DataFrame:
    """The rows in force, with ``written_by_batch`` on request."""
    rows = spark.read.parquet(path)
    return rows.where(~F.col(DELETED)).drop(DELETED, part_column(rows), *([] if with_batch else [BATCH]))


def read_file_stream(
    spark: SparkSession, path: str, schema: str | T.StructType, fmt: str = "parquet", pattern: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def run_available(
    stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Process what has arrived since the last run, then stop."""
    query = (
        stream.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(handle)
        .start()
    )
    query.awaitTermination()
    return query


def merged_parts(spark: SparkSession, target: str, changes: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    """The new rows of the partitions that ``changes`` touch. A table that is not there yet is empty."""
    current = spark.read.parquet(target) if exists(spark, target) else None
    parts = int(part_column(current).removeprefix(PART_OF)) if current else parts
    marked = placed(changes.withColumn(DELETED, F.col("change_type") == "delete").drop("change_type"), keys, parts)
    if current is None:
        return marked
    part = part_column(current)
    # at most as many rows as the table has partitions
    touched = F.broadcast(marked.select(part).distinct())
    live = current.where(~F.col(DELETED)).join(touched, part, "left_semi")
    kept = live.join(marked.select(*keys), list(keys), "left_anti")
    return kept.unionByName(marked.select(*current.columns))


def triggered_sync(
    stream: DataFrame,
    target: str,
    keys: Sequence[str],
    order: str | Column,
    checkpoint: str,
    parts: int = PARTS,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Apply arrived changes to the table; it keeps the number of partitions that it was published with.

    The stream holds the table's columns and ``change_type``; the last change of a key by ``order`` wins. ``prepare``
    turns the last changes of a batch into the table's columns and ``change_type``. One stream at a time may write a table.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        staged = f"{checkpoint.rstrip('/')}-staged/batch={batch_id}"
        if not exists(spark, f"{staged}/_SUCCESS"):
            changes = newest_per_key(batch, keys, order)
            changes = (prepare(changes) if prepare else changes).withColumn(BATCH, F.lit(batch_id).cast("long"))
            changes = changes.persist()
            try:
                rows = merged_parts(spark, target, changes, keys, parts)
                part = part_column(rows)
                rows.hint("rebalance", part).write.mode("overwrite").partitionBy(part).parquet(staged)
            finally:
                changes.unpersist()
        fs, at = file_system(spark, staged)
        if any(f.isDirectory() for f in fs.listStatus(at)):  # a batch without rows has no partitions
            rows = spark.read.parquet(staged)
            part = part_column(rows)
            writer = rows.hint("rebalance", part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(part).parquet(target)
        fs.delete(at, True)

    return run_available(stream, checkpoint, handle)


def index_sync(
    stream: DataFrame, target: str, model: PipelineModel, key: str, text: str, order: str | Column, checkpoint: str,
    parts: int = PARTS,
) -> StreamingQuery:
    """Keep an index ``(key, vector)`` up to date with documents that change; only changed texts are embedded.

    The stream holds the key, the text, ``change_type`` and what ``order`` needs; of several changes of a document in one
    batch only the last is embedded. A null text is embedded as an empty one.
    """

    def embedded(changes: DataFrame) -> DataFrame:
        gone = F.col("change_type") == "delete"
        rows = changes.select(key, "change_type", F.coalesce(text, F.lit("")).alias(text))
        fresh = embed_text(model, rows.where(~gone)).select(key, "change_type", "vector")
        return fresh.unionByName(rows.where(gone).select(key, "change_type", F.lit(None).cast("array<float>").alias("vector")))

    return triggered_sync(stream, target, [key], order, checkpoint, parts, embedded)


def incremental_append(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Add arrived rows to a Parquet table, each exactly once."""
    query = (
        stream.writeStream.trigger(availableNow=True).format("parquet")
        .option("checkpointLocation", checkpoint).option("path", target).outputMode("append").start()
    )
    query.awaitTermination()
    return query


def sync_vectors(
    old: DataFrame, new: DataFrame, index: DataFrame, model: PipelineModel, key: str, text: str
) -> DataFrame:
    """Index ``(key, vector)`` after a new version of its documents; only changed ones are embedded again."""
    changes = change_feed(old.select(key, text), new.select(key, text), [key])
    vectors = embed_text(model, changes.where(F.col("change_type") != "delete")).select(key, "change_type", "vector")
    gone = changes.where(F.col("change_type") == "delete").select(
        key, "change_type", F.lit(None).cast("array<float>").alias("vector")
    )
    return apply_changes(index.select(key, "vector"), vectors.unionByName(gone), [key])
