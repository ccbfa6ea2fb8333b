"""The test tables in the roles that the jobs expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.ordered import top_per_group
from tablewright.operators.orders import clean_orders
from tablewright.operators.serving import turn_profile
from tablewright.operators.split import temporal_split
from tablewright.session import write_once

REMOVED_BRANDS = ["Brand#4", "Brand#9"]
MIN_SUPPORT = 0.01
SERVERLESS_FROM = "2024-01-04 00:00:00"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table whose rows are costly to work on, spread over the cores when its files are fewer than these."""
    df = table(spark, sf, name)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def order_items(spark: SparkSession, sf: str, item: str) -> DataFrame:
    """Items of orders, a row per line: order_id, item, l_linenumber."""
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_id"), "l_partkey", "l_linenumber")
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col(item).cast("string").alias("item"))
    return lines.join(parts, "l_partkey").select("order_id", "item", "l_linenumber")


def first_lines(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id", "item").agg(F.min("l_linenumber").alias("line"))


def item_lines(spark: SparkSession, sf: str, item: str = "p_brand") -> DataFrame:
    """Distinct items of each order with the line they first stand on."""
    return first_lines(order_items(spark, sf, item))


def basket_lists(spark: SparkSession, sf: str, item: str) -> DataFrame:
    """Orders as arrays of distinct items in line order. An array is no longer than the item list.

    Lines are placed by order, so that neither step needs a shuffle of its own.
    """
    ordered = F.array_sort(F.collect_list(F.struct("line", "item")))
    lines = first_lines(order_items(spark, sf, item).repartition("order_id"))
    return lines.groupBy("order_id").agg(ordered["item"].alias("order_product_list"))


def baskets(spark: SparkSession, sf: str, item: str = "p_brand") -> DataFrame:
    """Baskets as a saved table: the jobs read them several times."""
    return write_once(basket_lists(spark, sf, item), "baskets")


def user_orders(spark: SparkSession, sf: str, item: str = "p_brand") -> DataFrame:
    """Baskets with user and time: mpid, order_id, order_product_list, order_timestamp."""
    heads = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("mpid"),
        F.col("o_orderdate").alias("order_timestamp"),
    )
    return write_once(basket_lists(spark, sf, item).join(heads, "order_id"), "orders")


def raw_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a log would hold them, items and time as text."""
    return user_orders(spark, sf).select(
        "mpid", "order_id", F.array_join("order_product_list", ", ").alias("order_products"),
        F.date_format("order_timestamp", "yyyy-MM-dd HH:mm:ss").alias("order_timestamp"),
    )


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return clean_orders(raw_orders(spark, sf), REMOVED_BRANDS)


def train_test(spark: SparkSession, sf: str, item: str = "p_brand") -> tuple[DataFrame, DataFrame]:
    split = temporal_split(user_orders(spark, sf, item), "mpid", "order_timestamp", "order_id")
    split = write_once(split, "split", by=["split"])
    return split.where(F.col("split") == "train"), split.where(F.col("split") == "test")


def part_catalog(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("item"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("base_price"),
        F.when(size <= 15, "low").when(size <= 35, "medium").otherwise("high").alias("calories_bucket"),
        F.col("p_name").like("%ring%").alias("is_vegetarian"),
    )


TYPE_CODES = {"ECONOMY": 0, "STANDARD": 1, "PROMO": 2, "LARGE": 3, "SMALL": 4}


def billing(spark: SparkSession, sf: str) -> DataFrame:
    """Events as nested billing rows: a run per user and hour, which may have several rows."""
    ts, kind = F.col("ts"), F.col("event_type")
    return table(spark, sf, "events").select(
        F.struct(
            F.col("user_id").alias("job_id"),
            F.concat_ws("-", F.col("user_id").cast("string"), F.date_format(ts, "yyyyMMddHH")).alias("job_run_id"),
        ).alias("usage_metadata"),
        F.struct(
            ((ts >= F.lit(SERVERLESS_FROM).cast("timestamp_ntz")) | (kind == "signup")).alias("is_serverless")
        ).alias("product_features"),
        F.when(kind == "error", "RETRACTION").otherwise("ORIGINAL").alias("record_type"),
        F.concat(F.lit("JOBS_"), F.upper(kind)).alias("sku_name"),
        F.col("value").alias("usage_quantity"),
        ts.alias("usage_start_time"),
    )


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a request log: ts, status_code, input_tokens, output_tokens."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, sf, "events").select(
        "ts",
        F.when(k % 10 == 0, 429).when(k % 10 == 1, 503).when(k % 10 == 2, 400).otherwise(200).alias("status_code"),
        (k * 20).alias("input_tokens"),
        F.floor("value").alias("output_tokens"),
    )


def turns(spark: SparkSession, sf: str) -> DataFrame:
    return turn_profile(table(spark, sf, "conversations"))


def videos(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as videos: a frame per character, 24 to 30 frames per second."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("video_id"), F.col("n_chars").alias("n_frames"),
        (F.lit(24) + F.col("doc_id") % 7).cast("double").alias("video_fps"),
    )


def segments(spark: SparkSession, sf: str) -> DataFrame:
    """Seven seconds of speech in every nine of each video."""
    length = F.floor(F.col("n_frames") / F.col("video_fps") * 1000)
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.floor(length / 9000)))
    return videos(spark, sf).select("video_id", numbers.alias("segment_id")).select(
        "video_id", "segment_id", (F.col("segment_id") * 9000).alias("start_ms"),
        (F.col("segment_id") * 9000 + 7000).alias("end_ms"),
    )


def scored_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with two simple guesses at their quality."""
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", "lang", "source")
    return table(spark, sf, "labels").join(docs, "doc_id").select(
        "doc_id", F.col("quality").alias("y"),
        (F.col("n_chars") >= 1000).cast("int").alias("y_champion"),
        ((F.col("n_chars") >= 400) & (F.col("lang") != "de")).cast("int").alias("y_challenger"),
    )


def question_vectors(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    vectors = table(spark, sf, "embeddings")
    return (
        vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")),
        vectors.select(F.col("vec_id").alias("corpus_id"), F.col("embedding").alias("vector")),
    )


def ranked_shares(shares: DataFrame, k: int = 20) -> DataFrame:
    """Each user's items by share, as the recommender's lists come: mpid, rank, item, score."""
    rows = shares.select("mpid", "item", F.col("proportion_of_orders").alias("score"))
    return top_per_group(rows, ["mpid"], [F.col("score").desc(), "item"], k)
