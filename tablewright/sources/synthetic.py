"""Seeded synthetic tables. Every value is a hash of the row number, so reruns agree."""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.columns import numbered_key
from tablewright.operators.groups import map_groups

# fixed values: items, their features, and the rates of the order generator
ITEM_CATALOG = [
    ("pepperoni-pizza", "pizza", 12.99, "high", False),
    ("cheese-pizza", "pizza", 10.99, "high", True),
    ("supreme-pizza", "pizza", 13.99, "high", False),
    ("meat-lovers-pizza", "pizza", 14.99, "high", False),
    ("veggie-pizza", "pizza", 11.99, "medium", True),
    ("hawaiian-pizza", "pizza", 12.99, "high", False),
    ("bbq-chicken-pizza", "pizza", 13.49, "high", False),
    ("deep-dish-pepperoni", "pizza", 15.99, "high", False),
    ("crazy-bread", "side", 4.99, "medium", True),
    ("italian-cheese-bread", "side", 5.99, "medium", True),
    ("caesar-wings", "side", 6.99, "medium", False),
    ("stuffed-crazy-bread", "side", 5.49, "medium", True),
    ("pepsi", "drink", 2.49, "low", True),
    ("mountain-dew", "drink", 2.49, "low", True),
    ("diet-pepsi", "drink", 2.49, "low", True),
    ("orange-fanta", "drink", 2.49, "low", True),
    ("cookie-dough-brownie", "dessert", 4.49, "high", True),
    ("cinnamon-loaded-crazy-bites", "dessert", 3.99, "medium", True),
]
SAUCES = ["marinara-sauce", "ranch-dressing"]
UTENSILS = ["plastic-fork", "plastic-knife"]
REMOVED_ITEMS = SAUCES + UTENSILS
EXTRA_RATES = [("side", 0.60), ("drink", 0.50), ("dessert", 0.20)]
NOISE_RATES = [(SAUCES, 0.35), (UTENSILS, 0.25)]
MOST_MAINS = 3
FIRST_DAY, DAYS = "2022-01-01 00:00:00", 730
UNIFORM_BITS = 1 << 53


def uniform(seed: int, *keys: str | Column) -> Column:
    """Number in [0, 1) that depends on the keys and the seed only."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(UNIFORM_BITS)) / F.lit(float(UNIFORM_BITS))


def pick(options: list[str], draw: Column) -> Column:
    return F.get(F.array(*[F.lit(o) for o in options]), F.floor(draw * len(options)).cast("int"))


def item_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        ITEM_CATALOG, "item string, category string, base_price double, calories_bucket string, is_vegetarian boolean"
    )


def synthetic_orders(spark: SparkSession, n_users: int = 2000, n_orders: int = 15000, seed: int = 42) -> DataFrame:
    """Raw orders: one to three mains, then extras and items to be cleaned out, at fixed rates."""
    by_category: dict[str, list[str]] = {}
    for item, category, *_ in ITEM_CATALOG:
        by_category.setdefault(category, []).append(item)
    mains = by_category["pizza"]
    shuffled = F.transform(
        F.array_sort(F.array(*[F.struct(uniform(seed + i, "id").alias("u"), F.lit(m).alias("m")) for i, m in enumerate(mains)])),
        lambda x: x["m"],
    )
    count = F.floor(uniform(seed + 100, "id") * MOST_MAINS).cast("int") + 1
    extras = []
    for i, (options, rate) in enumerate([(by_category[c], r) for c, r in EXTRA_RATES] + NOISE_RATES):
        chosen = pick(options, uniform(seed + 300 + i, "id"))
        extras.append(F.when(uniform(seed + 200 + i, "id") < rate, chosen))
    items = F.concat(F.slice(shuffled, F.lit(1), count), F.array_compact(F.array(*extras)))
    user = F.floor(uniform(seed + 400, "id") * n_users)
    second = F.floor(uniform(seed + 500, "id") * DAYS * 86400)
    start = F.unix_seconds(F.lit(FIRST_DAY).cast("timestamp"))
    return spark.range(n_orders).select(
        (F.lit(10_000_000) + user).cast("string").alias("mpid"),
        numbered_key("ORD-", F.col("id") + 1, 6).alias("order_id"),
        F.array_join(items, ", ").alias("order_products"),
        F.date_format(F.timestamp_seconds(start + second), "yyyy-MM-dd HH:mm:ss").alias("order_timestamp"),
    )


def synthetic_wide(
    spark: SparkSession, rows: int, n_features: int, n_labels: int, partitions: int | None = None, seed: int = 42
) -> DataFrame:
    """id, float features r_0 ... and an integer target below ``n_labels``."""
    ids = spark.range(0, rows, numPartitions=partitions)
    features = [uniform(seed + i, "id").cast("float").alias(f"r_{i}") for i in range(n_features)]
    target = F.floor(uniform(seed + n_features, "id") * n_labels).cast("int").alias("target")
    return ids.select("id", *features, target)


def group_samples(seed: int, n_samples: int, n_features: int, name: str) -> pd.DataFrame:
    """Samples of one linear model with the group's own coefficients."""
    rng = np.random.default_rng([seed, *name.encode()])
    x = rng.standard_normal((n_samples, n_features)).astype("float32")
    y = x @ (100 * rng.random(n_features))
    out = pd.DataFrame(x, columns=[f"features_{i}" for i in range(n_features)])
    out.insert(0, "group_name", name)
    out["target"] = y.astype("float32")
    return out


def synthetic_groups(
    spark: SparkSession, groups: int = 5000, n_features: int = 10, n_samples: int = 200, seed: int = 42
) -> DataFrame:
    """One regression sample set per group, made where the group lives."""
    names = spark.range(1, groups + 1).select(numbered_key("group_", "id", 2).alias("group_name"))
    schema = T.StructType(
        [T.StructField("group_name", T.StringType())]
        + [T.StructField(f"features_{i}", T.FloatType()) for i in range(n_features)]
        + [T.StructField("target", T.FloatType())]
    )

    def made(batches):
        for batch in batches:
            for name in batch["group_name"]:
                yield group_samples(seed, n_samples, n_features, name)

    return map_groups(names, ["group_name"], made, schema)
