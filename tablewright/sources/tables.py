"""Reading and writing tables and files, guards, and the dataset manifest."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tablewright.operators.ordered import global_positions


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table, or Parquet files when ``name`` looks like a path."""
    df = spark.read.parquet(name) if "/" in name else spark.read.table(name)
    return df.select(*columns) if columns else df


def read_csv(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None, header: bool = False, **options: str
) -> DataFrame:
    """CSV files; without a schema all columns are strings, named ``_c0`` on when there is no header."""
    reader = spark.read.options(header=str(header).lower(), **options)
    return reader.schema(schema).csv(path) if schema else reader.csv(path)


def read_json_docs(spark: SparkSession, path: str, schema: str | T.StructType, lines: bool = True) -> DataFrame:
    """JSON documents, one per line. With ``lines=False`` each file is one document or array."""
    return spark.read.schema(schema).option("multiLine", str(not lines).lower()).json(path)


def local_rows(spark: SparkSession, rows: Sequence, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def list_files(spark: SparkSession, path: str, extensions: Sequence[str] = ()) -> DataFrame:
    """Path, size and time of every file below ``path``; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        .select("path", "length", "modificationTime")
    )
    if extensions:
        files = files.where(reduce(lambda a, b: a | b, [F.lower("path").endswith(e.lower()) for e in extensions]))
    return files


def new_files(listed: DataFrame, known: DataFrame) -> DataFrame:
    """Listed files that the inventory lacks or holds in an older version."""
    return listed.join(known.select("path", "modificationTime"), ["path", "modificationTime"], "left_anti")


def read_payloads(spark: SparkSession, refs: DataFrame, path_column: str, root: str) -> DataFrame:
    """Add the bytes behind each path reference as ``content``, null where the file is missing.

    A local file is the same with and without ``file:`` in front. Reads every file below ``root``; for a few
    references use :func:`fetch_payloads_by_path`.
    """

    def plain(path: str):
        return F.regexp_replace(F.col(path), "^file:/*", "/")

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    found = files.select(plain("path").alias("__path"), "content")
    return refs.join(found, plain(path_column) == F.col("__path"), "left").drop("__path")


def read_bytes(path: str) -> bytes | None:
    """Content of a file on any file system Arrow knows, null when it is missing."""
    files, name = (fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path))
    try:
        with files.open_input_stream(name) as stream:
            return stream.read()
    except FileNotFoundError:
        return None


def fetch_payloads_by_path(refs: DataFrame, path_column: str, threads: int = 16, chunk: int = 64) -> DataFrame:
    """Add the bytes of the referenced files alone as ``content``, a chunk of rows at a time."""
    schema = T.StructType([*refs.schema.fields, T.StructField("content", T.BinaryType())])

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(max_workers=threads) as pool:
            for batch in batches:
                for start in range(0, len(batch), chunk):
                    part = batch.iloc[start : start + chunk]
                    yield part.assign(content=list(pool.map(read_bytes, part[path_column])))

    return refs.mapInPandas(fetch, schema)


def write_table(df: DataFrame, name: str, mode: str = "overwrite", overwrite_schema: bool = True) -> None:
    """Save as a Parquet table. Overwriting takes the new schema unless told not to."""
    spark = df.sparkSession
    if mode == "overwrite" and not overwrite_schema and spark.catalog.tableExists(name):
        old, new = spark.table(name).schema, df.schema
        if [(f.name, f.dataType) for f in old] != [(f.name, f.dataType) for f in new]:
            raise ValueError(f"schema of {name} differs")
    df.write.format("parquet").mode(mode).saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    df.write.format("parquet").mode("append").saveAsTable(name)


def write_files(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def parquet_to_table(spark: SparkSession, path: str, drop: Sequence[str], name: str) -> None:
    """Load Parquet files, leave columns out, and save the rest as a table."""
    write_table(spark.read.parquet(path).drop(*drop), name)


def report_rows(df: DataFrame, limit: int = 1000):
    """The first rows as pandas, for display."""
    return df.limit(limit).toPandas()


def verify_counts(tables: Mapping[str, DataFrame], target: int | Mapping[str, int]) -> DataFrame:
    """Row count of each table and whether it is the wanted one."""

    def wanted(name: str) -> int:
        return target[name] if isinstance(target, Mapping) else target

    rows = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", (F.col("rows") == wanted(name)).alias("matches")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def short_classes(df: DataFrame, by: str, classes: Sequence[str], least: int) -> DataFrame:
    """Classes with fewer than ``least`` rows, absent ones included."""
    counts = [F.count_if(F.col(by) == c).alias(c) for c in classes]
    pairs = F.array(*[F.struct(F.lit(c).alias("class"), F.col(c).alias("found")) for c in classes])
    return df.agg(*counts).select(F.explode(pairs).alias("p")).select("p.*").where(F.col("found") < least)


def with_loose_id(df: DataFrame, name: str = "id") -> DataFrame:
    """Unique increasing ids with gaps, which change when the table is written anew."""
    return df.withColumn(name, F.monotonically_increasing_id())


def with_load_stamp(df: DataFrame, id_name: str = "row_id", time_name: str = "loaded_at") -> DataFrame:
    """A random id per row and the time of the load."""
    return df.withColumns({id_name: F.expr("uuid()"), time_name: F.current_timestamp()})


def with_dense_id(df: DataFrame, order: Sequence[str], name: str = "id") -> DataFrame:
    """Ids 1, 2, 3 ... in the given order."""
    return global_positions(df, list(order), name, start=1)


MANIFEST = (
    "dataset_name string, volume_path string, lance_version bigint, row_count bigint, "
    "schema_json string, written_at timestamp, written_by string, run_id string"
)


def next_version(manifest: DataFrame, dataset: str) -> int:
    newest = manifest.where(F.col("dataset_name") == dataset).agg(F.max("lance_version")).first()[0]
    return (newest or 0) + 1


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], MANIFEST)


def write_manifest(df: DataFrame, dataset: str, path: str, manifest_path: str, written_by: str, run_id: str) -> int:
    """Append one row that records a written dataset; returns its version."""
    spark = df.sparkSession
    version = next_version(read_manifest(spark, manifest_path), dataset)
    row = df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(dataset).alias("dataset_name"), F.lit(path).alias("volume_path"),
        F.lit(version).cast("long").alias("lance_version"), "row_count",
        F.lit(df.schema.json()).alias("schema_json"), F.current_timestamp().alias("written_at"),
        F.lit(written_by).alias("written_by"), F.lit(run_id).alias("run_id"),
    )
    row.coalesce(1).write.mode("append").parquet(manifest_path)
    return version


def newest_entry(manifest: DataFrame, dataset: str, version: int | None = None) -> DataFrame:
    """The manifest row of a version, by default the newest."""
    mine = manifest.where(F.col("dataset_name") == dataset)
    if version is not None:
        return mine.where(F.col("lance_version") == version)
    return mine.orderBy(F.col("lance_version").desc()).limit(1)
