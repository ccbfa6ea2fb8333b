"""Pieces the operators share: unused column names, words, Arrow batches and files in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words by white space, as a Java and as a Python pattern. ``bytes.split()`` gives the same words.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

_TYPES = {
    pa.int32(): T.IntegerType(), pa.int64(): T.LongType(), pa.float64(): T.DoubleType(), pa.string(): T.StringType(),
    pa.binary(): T.BinaryType(), pa.bool_(): T.BooleanType(),
}


def spark_type(kind: pa.DataType) -> T.DataType:
    if pa.types.is_list(kind):
        return T.ArrayType(spark_type(kind.value_type))
    if pa.types.is_struct(kind):
        return T.StructType([T.StructField(f.name, spark_type(f.type)) for f in kind])
    return _TYPES[kind]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def col(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col(f"`{name.replace('`', '``')}`")


def add_columns(
    df: DataFrame, inputs: Sequence[str], outputs: Sequence[tuple[str, pa.DataType]], make: Callable[[], Callable],
) -> DataFrame:
    """``df`` with more columns, worked out batch by batch.

    ``make()`` runs once per task and gives a function from the lists of the input columns to lists of the output
    columns. Other columns pass through untouched.
    """
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, spark_type(k)) for n, k in outputs)])
    at = [df.columns.index(n) for n in inputs]
    names, kinds = schema.names, [k for _, k in outputs]

    def run(batches):
        work = make()
        for batch in batches:
            new = work(*(batch.column(i).to_pylist() for i in at))
            arrays = [v if isinstance(v, pa.Array) else pa.array(v, k) for v, k in zip(new, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=names)

    return df.mapInArrow(run, schema)


def make_rows(df: DataFrame, outputs: Sequence[tuple[str, pa.DataType]], work: Callable) -> DataFrame:
    """Rows that ``work`` makes of an iterator of batches, given as lists by column."""
    schema = T.StructType([T.StructField(n, spark_type(k)) for n, k in outputs])
    names, kinds = schema.names, [k for _, k in outputs]

    def run(batches):
        for lists in work([c.to_pylist() for c in b.columns] for b in batches):
            arrays = [v if isinstance(v, pa.Array) else pa.array(v, k) for v, k in zip(lists, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chunks(texts: Sequence[str | None], limit: int = 2_000_000):
    """(start, end) of runs of texts with about ``limit`` characters, or one longer text, each."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > limit:
            yield start, i
            start, size = i, 0
        size += len(t or "") + 1
    if start < len(texts):
        yield start, len(texts)


_STEP = np.uint64(0x9E3779B97F4A7C15)  # fixed values of the SplitMix64 generator
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers scrambled by the SplitMix64 finaliser."""
    x = x + _STEP
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def word_hashes(word_lists: Sequence[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in a row, and where each list's words begin (one entry more than lists)."""
    bounds = np.zeros(len(word_lists) + 1, dtype=np.int64)
    np.cumsum([len(w) for w in word_lists], out=bounds[1:])
    flat = np.empty(bounds[-1], dtype=object)
    flat[:] = [w for words in word_lists for w in words]
    return pd.util.hash_array(flat) if len(flat) else np.empty(0, np.uint64), bounds


def store(uri: str):
    """The file system of a folder's address and the path in it, as tasks reach the shared folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
