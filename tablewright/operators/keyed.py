"""Keyed tables: key checks, differences between versions, and upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, rows with a null in the key, and keys that occur more than once."""
    null = F.lit(False)
    for key in keys:
        null = null | F.col(key).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.first(null).alias("__null"))
    return per_key.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("__null"), F.col("__n"))), F.lit(0)).alias("null_keys"),
        F.count_if(~F.col("__null") & (F.col("__n") > 1)).alias("duplicate_keys"),
    )


def require_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table itself when ``keys`` can serve as its primary key, else an error."""
    found = key_check(df, keys).first()
    if found["null_keys"] or found["duplicate_keys"]:
        raise ValueError(
            f"{list(keys)} is no key: {found['null_keys']} null, {found['duplicate_keys']} duplicate"
        )
    return df


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that differ between two versions, with insert, update or delete and the new values."""
    values = [c for c in new.columns if c not in keys]
    left = old.select(*keys, F.struct(*values).alias("__old"))
    right = new.select(*keys, F.struct(*values).alias("__new"))
    kind = (
        F.when(F.col("__old").isNull(), "insert")
        .when(F.col("__new").isNull(), "delete")
        .when(~F.col("__old").eqNullSafe(F.col("__new")), "update")
    )
    return (
        left.join(right, list(keys), "full_outer")
        .select(*keys, kind.alias("change_type"), F.coalesce("__new", "__old").alias("__v"))
        .where(F.col("change_type").isNotNull())
        .select(*keys, "change_type", "__v.*")
    )


def newest_per_key(changes: DataFrame, keys: Sequence[str], order: str | Column) -> DataFrame:
    """The last change of each key."""
    rest = [c for c in changes.columns if c not in keys]
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__v"))
    return last.select(*keys, "__v.*")


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after the changes; a change row replaces its key or deletes it. Keys in ``changes`` are unique."""
    kept = target.join(changes.select(*keys), list(keys), "left_anti")
    fresh = changes.where(F.col("change_type") != "delete").select(*target.columns)
    return kept.unionByName(fresh)
