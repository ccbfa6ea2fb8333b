"""Cleaning order logs into baskets, and the simple reports over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.ordered import running_by_bucket


def split_items(text: Column) -> Column:
    """Comma-separated text as distinct trimmed items, first occurrence first."""
    return F.array_distinct(F.transform(F.split(text, ","), lambda x: F.trim(x)))


def without_items(items: Column, removed: Sequence[str]) -> Column:
    drop = [*removed, ""]
    return F.filter(items, lambda x: ~x.isin(*drop))


def holds_items(text: Column, removed: Sequence[str]) -> Column:
    """Whether anything is left after the removal; stops at the first such item."""
    drop = [*removed, ""]
    return F.exists(F.split(text, ","), lambda x: ~F.trim(x).isin(*drop))


def clean_orders(raw: DataFrame, removed: Sequence[str] = ()) -> DataFrame:
    """Baskets with a per-user order number, 1 = earliest; equal times by order id. A malformed time is null and comes first."""
    day = F.coalesce(F.to_date("order_timestamp"), F.lit("0001-01-01").cast("date"))
    baskets = (
        raw.where(holds_items(F.col("order_products"), removed)).select(
            "mpid",
            "order_id",
            without_items(split_items(F.col("order_products")), removed).alias("order_product_list"),
            F.try_to_timestamp("order_timestamp").alias("order_timestamp"),
        )
    )
    numbered = running_by_bucket(
        baskets, ["mpid"], ["order_timestamp", "order_id"], day, row_number="order_number"
    )
    return numbered.withColumn("order_number", F.col("order_number").cast("int"))


def explode_items(orders: DataFrame, *keep: str) -> DataFrame:
    return orders.select(*keep, F.explode("order_product_list").alias("item"))


def item_support(orders: DataFrame) -> DataFrame:
    """Orders holding each item, and their share of all orders."""
    total = orders.agg(F.count(F.lit(1))).scalar()
    return (
        explode_items(orders)
        .groupBy("item")
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("support", F.col("count") / total)
    )


def popular_items(orders: DataFrame, k: int) -> DataFrame:
    """The k items found in most orders, as one row with a ranked array."""
    top = item_support(orders).orderBy(F.col("count").desc(), "item").limit(k)
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("neg"), "item")))
    return top.agg(F.transform(ranked, lambda x: x["item"]).alias("popular"))


def hold_out_last(orders: DataFrame, *keep: str) -> DataFrame:
    """Orders of two items or more, split into cart and the item added last."""
    items = F.col("order_product_list")
    return orders.where(F.size(items) > 1).select(
        *keep,
        F.slice(items, F.lit(1), F.size(items) - 1).alias("cart"),
        F.element_at(items, -1).alias("added"),
    )
