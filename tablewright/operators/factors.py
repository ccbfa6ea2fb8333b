"""Matrix-factorisation recommender: ids, fit, lists, evaluation and search."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tablewright.functions.columns import l2_normalize
from tablewright.operators import few_items
from tablewright.operators.features import interaction_share
from tablewright.operators.orders import explode_items, hold_out_last
from tablewright.operators.ordered import dense_ids
from tablewright.operators.vectors import nearest
from tablewright.session import shared_dir, write_once

#: Shares of a block that a task of a fit holds; rating blocks are as many as the square of the blocks.
BLOCK_SHARES, MOST_BLOCKS = 2_000_000, 400


@dataclass(frozen=True)
class Matrix:
    """Shares by integer ids, and the id tables ``(mpid, user_id)`` and ``(item, item_id)``."""

    shares: DataFrame
    users: DataFrame
    items: DataFrame


def prepare(orders: DataFrame) -> Matrix:
    """Dense ids and shares. Pairs are counted before they meet the id tables.

    Pass a saved table, as it is read several times.
    """
    pairs = explode_items(orders, "mpid")
    users = dense_ids(pairs, "mpid", "user_id").select("mpid", F.col("user_id").cast("int").alias("user_id"))
    items = dense_ids(pairs, "item", "item_id").select("item", F.col("item_id").cast("int").alias("item_id"))
    shares = interaction_share(pairs, "mpid", "item").join(items, "item").join(users, "mpid")
    return Matrix(
        shares.select("user_id", "item_id", "historical_ordered_amount", "total_orders", "proportion_of_orders"),
        users, items,
    )


def fit(
    shares: DataFrame, rank: int = 10, max_iter: int = 5, seed: int = 42, users: DataFrame | None = None
) -> ALSModel | few_items.Factors:
    """The model. Item factors are written out in every iteration, so that the shuffle files of the one before can go.

    With fewer items than the rank the same factors come from smaller systems; ``users`` may hold the saved rows for these.
    Pass a saved table, as it is read several times. A task sorts a block of users' or items' shares in memory, so many shares
    are cut into more blocks than Spark's ten.
    """
    shared_dir(shares.sparkSession)
    blocks = min(MOST_BLOCKS, max(10, math.ceil(shares.count() / BLOCK_SHARES)))
    als = ALS(
        numUserBlocks=blocks, numItemBlocks=blocks,
        rank=rank, maxIter=max_iter, checkpointInterval=1, userCol="user_id", itemCol="item_id", ratingCol="proportion_of_orders",
        implicitPrefs=True, coldStartStrategy="drop", seed=seed,
    )
    items = few_items.item_ids(shares, rank) if max_iter else None
    if not items:
        return als.fit(shares)
    return few_items.fit(als, shares, write_once(few_items.user_rows(shares), "users") if users is None else users, items)


def link_orders(orders: DataFrame, matrix: Matrix) -> DataFrame:
    """Held-out orders whose user and added item were seen in training."""
    held = hold_out_last(orders, "mpid", "order_id")
    return held.join(matrix.users, "mpid").join(
        matrix.items.select(F.col("item").alias("added"), F.col("item_id").alias("added_item_id")), "added"
    )


def link_report(orders: DataFrame, matrix: Matrix) -> DataFrame:
    """Orders in all, linked, and dropped, counted in one pass."""
    users = matrix.users.select("mpid", F.lit(1).alias("__u"))
    items = matrix.items.select(F.col("item").alias("added"), F.lit(1).alias("__i"))
    held = orders.select(
        "mpid", F.when(F.size("order_product_list") > 1, F.element_at("order_product_list", -1)).alias("added")
    )
    linked = F.col("__u").isNotNull() & F.col("__i").isNotNull()
    return held.join(users, "mpid", "left").join(items, "added", "left").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(linked).alias("linked"), F.count_if(~linked).alias("dropped")
    )


def recommend_users(model: ALSModel | few_items.Factors, k: int, users: DataFrame | None = None) -> DataFrame:
    """Top-k items per user, for all users of the model or those in ``users``.

    Rows of user_id, rank, item_id, score; equal scores by item id. The factors
    are multiplied block by block.
    """
    factors = model.userFactors
    if users is not None:
        factors = factors.join(users.select("user_id"), F.col("id") == F.col("user_id"), "left_semi")
    found = nearest(
        factors.select(F.col("id").alias("query_id"), F.col("features").alias("vector")),
        model.itemFactors.select(F.col("id").alias("corpus_id"), F.col("features").alias("vector")),
        k, "dot",
    )
    return found.select(F.col("query_id").alias("user_id"), "rank", F.col("corpus_id").alias("item_id"), "score")


def with_labels(lists: DataFrame, matrix: Matrix) -> DataFrame:
    """Recommended rows under their original labels: mpid, rank, item, score."""
    return lists.join(matrix.items, "item_id").join(matrix.users, "user_id").select("mpid", "rank", "item", "score")


def publish_lists(ranked: DataFrame, digits: int = 6) -> DataFrame:
    """One row per user with parallel arrays in rank order."""
    packed = ranked.groupBy("mpid").agg(
        F.array_sort(F.collect_list(F.struct("rank", "item", "score"))).alias("__r")
    )
    return packed.select(
        "mpid",
        F.col("__r.item").alias("recommendations"),
        F.transform("__r", lambda r: F.round(r["score"], digits)).alias("scores"),
    )


def lookup_lists(requests: DataFrame, lists: DataFrame, k: int) -> DataFrame:
    """Lists for the asked users; unknown users get empty arrays."""
    return requests.join(lists, "mpid", "left").select(
        *requests.columns,
        F.slice(F.coalesce("recommendations", F.array().cast("array<string>")), 1, k).alias("recommendations"),
        F.slice(F.coalesce("scores", F.array().cast("array<double>")), 1, k).alias("scores"),
    )


def wanted_items(linked: DataFrame) -> DataFrame:
    """A row per user of linked orders with the added items and how many orders added each: user_id, wanted."""
    counts = linked.groupBy("user_id", "added_item_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("user_id").agg(F.collect_list(F.struct("added_item_id", "n")).alias("wanted"))


def listed_share(model: ALSModel | few_items.Factors, wanted: DataFrame, k: int = 5) -> float | None:
    """Share of wanted items, each as often as it was wanted, among the user's k."""
    lists = recommend_users(model, k, wanted).groupBy("user_id").agg(F.collect_set("item_id").alias("listed"))
    orders = lambda x, n: F.aggregate(x, F.lit(0).cast("long"), lambda so_far, one: so_far + one["n"]).alias(n)
    hits = F.filter("wanted", lambda one: F.array_contains(F.coalesce("listed", F.array().cast("array<int>")), one["added_item_id"]))
    found = wanted.join(lists, "user_id", "left").select(orders(hits, "hits"), orders("wanted", "orders"))
    return found.agg(F.sum("hits") / F.sum("orders")).first()[0]


def hit_rate(model: ALSModel | few_items.Factors, linked: DataFrame, k: int = 5) -> float | None:
    """Share of linked orders whose added item is among the user's k."""
    return listed_share(model, wanted_items(linked), k)


@dataclass(frozen=True)
class Search:
    trials: list[dict]
    best: dict


def tune(
    train: Matrix,
    validation: DataFrame,
    trials: int = 20,
    ranks: Sequence[int] = (1, 100),
    iterations: Sequence[int] = (1, 10),
    k: int = 5,
    seed: int = 42,
    at_once: int = 4,
) -> Search:
    """Seeded random search for the hit rate on linked validation orders.

    Settings are drawn first, and ``at_once`` trials run their Spark jobs side by side, so that the stages of one fill
    the cores that another leaves idle. :func:`refit` fits the best setting on all training data.
    """
    draw = random.Random(seed)
    settings = [{"trial": t, "rank": draw.randint(*ranks), "max_iter": draw.randint(*iterations)} for t in range(trials)]
    # a saved table has no more partitions than its rows need, and every fit cuts the shares into blocks anew
    shares = write_once(train.shares, "shares")
    few = few_items.item_ids(shares, max((s["rank"] for s in settings), default=0))
    users = write_once(few_items.user_rows(shares), "users") if few else None
    # once per user, placed by user for all trials
    wanted = wanted_items(validation.repartition("user_id")).persist()

    def run(setting: dict) -> dict:
        model = fit(shares, setting["rank"], setting["max_iter"], seed, users)
        return {**setting, "hit": listed_share(model, wanted, k)}

    try:
        with ThreadPool(at_once) as pool:
            log = pool.map(inheritable_thread_target(shares.sparkSession)(run), settings)
    finally:
        wanted.unpersist()
    return Search(log, max(log, key=lambda t: (t["hit"] or 0.0, -t["trial"])))


def trial_log(spark: SparkSession, search: Search) -> DataFrame:
    """A row per trial: trial, rank, max_iter, hit and whether it is the best."""
    rows = [(t["trial"], t["rank"], t["max_iter"], t["hit"], t == search.best) for t in search.trials]
    return spark.createDataFrame(rows, "trial int, rank int, max_iter int, hit double, best boolean")


def refit(orders: DataFrame, search: Search, seed: int = 42) -> tuple[Matrix, ALSModel | few_items.Factors]:
    """The best setting of a search, fitted on the given orders."""
    matrix = prepare(orders)
    return matrix, fit(write_once(matrix.shares, "shares"), search.best["rank"], search.best["max_iter"], seed)


def unit_vectors(model: ALSModel | few_items.Factors, matrix: Matrix) -> tuple[DataFrame, DataFrame]:
    """User and item vectors of length one: ``(mpid, embedding)``, ``(item_idx, item_name, embedding)``."""
    users = model.userFactors.join(matrix.users, F.col("id") == F.col("user_id")).select(
        "mpid", l2_normalize("features").cast("array<float>").alias("embedding")
    )
    items = model.itemFactors.join(matrix.items, F.col("id") == F.col("item_id")).select(
        F.col("item_id").cast("long").alias("item_idx"), F.col("item").alias("item_name"),
        l2_normalize("features").cast("array<float>").alias("embedding"),
    )
    return users, items
