"""Per-user features, encodings, and the interaction table that feeds a ranker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.columns import bucketize, label_code
from tablewright.operators.orders import explode_items

# fixed values: tier and recency thresholds, label codes, feature names
TIERS = [(">=", 8, "Gold"), (">=", 4, "Silver")]
TIER_ELSE = "Bronze"
RECENCY = [("<=", 30, "Active"), ("<=", 90, "Lapsed")]
RECENCY_ELSE = "Churned"
CATEGORY_CODES = {"pizza": 0, "side": 1, "drink": 2, "dessert": 3}
CALORIES_CODES = {"low": 0, "medium": 1, "high": 2}
TIER_CODES = {"Bronze": 0, "Silver": 1, "Gold": 2}
RECENCY_CODES = {"Active": 0, "Lapsed": 1, "Churned": 2}
USER_FEATURES = [
    "u_total_orders", "u_avg_order_size", "u_lifetime_spend", "u_days_since_last",
    "u_pref_cat_enc", "u_tier_enc", "u_recency_enc",
]
ITEM_FEATURES = ["i_base_price", "i_is_vegetarian", "i_category_enc", "i_calories_enc"]


def basket_stats(orders: DataFrame) -> DataFrame:
    """Orders, mean basket size, last order and days before the newest order of all."""
    newest = orders.agg(F.max("order_timestamp")).scalar()
    per_user = orders.groupBy("mpid").agg(
        F.count("order_id").alias("total_orders"),
        F.round(F.avg(F.size("order_product_list")), 2).alias("avg_order_size"),
        F.max("order_timestamp").alias("last_order_ts"),
    )
    return per_user.withColumn("days_since_last_order", F.datediff(newest, F.col("last_order_ts")))


def taste_stats(orders: DataFrame, catalog: DataFrame) -> DataFrame:
    """Spend and most frequent category per user.

    Items that the catalog lacks count as a null category. Ties go to the first
    category, null before all others. Prices are summed as decimals, so the
    result does not depend on row order.
    """
    priced = explode_items(orders, "mpid").join(
        catalog.select("item", "category", F.col("base_price").cast("decimal(18,2)").alias("price")),
        "item", "left",
    )
    per_category = priced.groupBy("mpid", "category").agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").alias("spend")
    )
    return per_category.groupBy("mpid").agg(
        F.round(F.sum("spend"), 2).cast("double").alias("lifetime_spend"),
        F.min(F.struct((-F.col("n")).alias("neg"), "category"))["category"].alias("preferred_category"),
    )


def user_features(orders: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row per user. Pass the training orders only, or the features leak the test set."""
    return basket_stats(orders).join(taste_stats(orders, catalog), "mpid", "left").select(
        "mpid", "total_orders", "avg_order_size", "lifetime_spend", "preferred_category",
        "last_order_ts", "days_since_last_order",
        bucketize("total_orders", TIERS, TIER_ELSE).alias("customer_tier"),
        bucketize("days_since_last_order", RECENCY, RECENCY_ELSE).alias("recency_bucket"),
    )


def encode_users(features: DataFrame, categories: dict[str, int] = CATEGORY_CODES) -> DataFrame:
    return features.select(
        "mpid",
        F.col("total_orders").alias("u_total_orders"),
        F.col("avg_order_size").alias("u_avg_order_size"),
        F.col("lifetime_spend").alias("u_lifetime_spend"),
        F.col("days_since_last_order").alias("u_days_since_last"),
        label_code("preferred_category", categories).alias("u_pref_cat_enc"),
        label_code("customer_tier", TIER_CODES).alias("u_tier_enc"),
        label_code("recency_bucket", RECENCY_CODES).alias("u_recency_enc"),
    )


def encode_items(
    catalog: DataFrame,
    categories: dict[str, int] = CATEGORY_CODES,
    calories: dict[str, int] = CALORIES_CODES,
) -> DataFrame:
    return catalog.select(
        "item",
        F.col("base_price").alias("i_base_price"),
        F.col("is_vegetarian").cast("float").alias("i_is_vegetarian"),
        label_code("category", categories).alias("i_category_enc"),
        label_code("calories_bucket", calories).alias("i_calories_enc"),
    )


def interactions(
    orders: DataFrame,
    user_vocab: DataFrame,
    item_vocab: DataFrame,
    users: DataFrame,
    items: DataFrame,
) -> DataFrame:
    """One row per user and bought item with dense features, nulls as 0.0.

    Users and items outside the vocabularies, which are fitted on training data,
    are left out.
    """
    item_side = item_vocab.join(items, "item", "left")
    user_side = user_vocab.join(users, "mpid", "left")
    columns = [*USER_FEATURES, *ITEM_FEATURES]
    return (
        explode_items(orders, "mpid")
        .join(item_side, "item")
        .join(user_side, "mpid")
        .select("user_idx", "item_idx", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    )


def interaction_share(pairs: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Count of each user-item pair and its share of the user's item lines."""
    counts = pairs.groupBy(user, item).agg(F.count(F.lit(1)).alias("historical_ordered_amount"))
    totals = counts.groupBy(user).agg(F.sum("historical_ordered_amount").alias("total_orders"))
    return counts.join(totals, user).withColumn(
        "proportion_of_orders", F.col("historical_ordered_amount") / F.col("total_orders")
    )


def unseen_report(rows: DataFrame, links: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """How many rows have all their keys in the given key tables, and how many would be dropped."""
    tagged = rows
    flags = []
    for i, (column, known) in enumerate(links):
        flag = f"__known_{i}"
        keys = known.select(F.col(column)).distinct().withColumn(flag, F.lit(1))
        tagged = tagged.join(keys, column, "left")
        flags.append(F.col(flag).isNotNull())
    linked = flags[0]
    for flag in flags[1:]:
        linked = linked & flag
    return tagged.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(linked).alias("linked"),
        F.count_if(~linked).alias("dropped"),
    )
