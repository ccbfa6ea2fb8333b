"""Splits and samples that depend on row keys, not on how the data is laid out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.ordered import running_by_bucket

SLOTS = 1_000_000


def key_slot(keys: Sequence[str], seed: int) -> Column:
    """A number below SLOTS from the MD5 of seed and keys as text, which any engine can repeat; a null key is empty text."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long"), F.lit(SLOTS))


def hash_split(df: DataFrame, keys: Sequence[str], weights: Sequence[float], seed: int = 42) -> list[DataFrame]:
    """Disjoint parts that cover ``df``; a key always falls into the same part."""
    total = float(sum(weights))
    edges, acc = [0], 0.0
    for weight in weights:
        acc += weight
        edges.append(round(acc / total * SLOTS))
    slot = key_slot(keys, seed)
    return [df.where((slot >= lo) & (slot < hi)) for lo, hi in zip(edges, edges[1:])]


def hash_sample(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample by key."""
    return df.where(key_slot(keys, seed) < round(fraction * SLOTS))


def feature_target_split(
    df: DataFrame, key: str, target: str, test_fraction: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Train and test tables without the row id among the features."""
    train, test = hash_split(df, [key], [1 - test_fraction, test_fraction], seed)
    features = [c for c in df.columns if c not in (key, target)]
    return train.select(*features, target), test.select(*features, target)


def temporal_split(orders: DataFrame, user: str, ts: str, order: str, fraction: float = 0.8) -> DataFrame:
    """Mark the earliest ``fraction`` of each user's orders as train, the rest as test."""
    day = F.coalesce(F.to_date(ts), F.lit("0001-01-01").cast("date"))
    numbered = running_by_bucket(orders, [user], [ts, order], day, row_number="__position", total="__orders")
    is_train = F.col("__position") <= F.ceil(F.col("__orders") * F.lit(fraction))
    return (
        numbered.withColumn("split", F.when(is_train, "train").otherwise("test"))
        .drop("__position", "__orders")
    )
