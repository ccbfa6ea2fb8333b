"""Association rules: mining, matching against carts, ranking and evaluation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.ordered import top_per_group
from tablewright.operators.sizes import broadcast_up_to
from tablewright.session import cut_lineage

METRICS = ("confidence", "lift")


def frequent_itemsets(orders: DataFrame, min_support: float, partitions: int | None = None) -> DataFrame:
    """``(items, freq)`` of all item sets in at least that share of the orders, items sorted.

    Written once, as the trees would otherwise be built again for every use.
    """
    growth = FPGrowth(itemsCol="order_product_list", minSupport=min_support, minConfidence=1.0)
    if partitions:
        growth = growth.setNumPartitions(partitions)
    found = growth.fit(orders.select("order_product_list")).freqItemsets
    return cut_lineage(found.select(F.array_sort("items").alias("items"), "freq"))


def rules_from_itemsets(itemsets: DataFrame, n_orders: int, min_confidence: float = 0.0) -> DataFrame:
    """Every split of an item set into one consequent and the rest, with its measures."""
    splits = itemsets.where(F.size("items") > 1).select(
        "items", "freq", F.explode("items").alias("consequent")
    ).select("freq", "consequent", F.array_remove("items", F.col("consequent")).alias("antecedent"))
    antecedents = itemsets.select(F.col("items").alias("antecedent"), F.col("freq").alias("antecedent_freq"))
    single = itemsets.where(F.size("items") == 1).select(
        F.col("items")[0].alias("consequent"), F.col("freq").alias("consequent_freq")
    )
    confidence = F.col("freq") / F.col("antecedent_freq")
    return (
        splits.join(antecedents, "antecedent")
        .where(confidence >= min_confidence)
        .join(single, "consequent")
        .select(
            "antecedent", "consequent", confidence.alias("confidence"),
            (confidence / (F.col("consequent_freq") / F.lit(n_orders))).alias("lift"),
            (F.col("freq") / F.lit(n_orders)).alias("support"),
        )
    )


def mine_rules(
    orders: DataFrame,
    min_transactions: int | None = None,
    min_support: float | None = None,
    min_confidence: float = 0.0,
    partitions: int | None = None,
) -> DataFrame:
    """FP-growth rules with one consequent item: antecedent, consequent, confidence, lift, support.

    The floor is a number of orders or a share of them. Pass a saved table, as it
    is read several times.
    """
    if (min_transactions is None) == (min_support is None):
        raise ValueError("give either min_transactions or min_support")
    total = orders.count()
    if total == 0:
        raise ValueError("no orders to mine")
    if min_support is None:
        min_support = min(1.0, min_transactions / total)
    return cut_lineage(rules_from_itemsets(frequent_itemsets(orders, min_support, partitions), total, min_confidence))


def with_rule_id(rules: DataFrame) -> DataFrame:
    """Surrogate key that depends only on the rule, so reruns keep it."""
    text = F.concat_ws("\u0001", F.concat_ws("\u0002", "antecedent"), "consequent")
    return rules.withColumn("rule_id", F.sha2(text, 256))


@dataclass(frozen=True)
class RuleIndex:
    """One row per rule and antecedent item, with what is known about its size.

    ``ahead`` counts the rules of the same antecedent whose metric is higher by
    more than rounding could undo.
    """

    rows: DataFrame
    n_rows: int
    longest: int
    rules: DataFrame

    def for_join(self) -> DataFrame:
        return broadcast_up_to(self.rows, self.n_rows)


def index_rules(rules: DataFrame, metric: str = "confidence") -> RuleIndex:
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    ahead = F.expr(
        f"count(1) OVER (PARTITION BY antecedent ORDER BY -ln(greatest({metric}, 1e-300D)) "
        "RANGE BETWEEN UNBOUNDED PRECEDING AND 1e-9D PRECEDING)"
    )
    # a short fixed-width id keeps the rows that go through the join small
    rows = cut_lineage(
        rules.withColumn("ahead", ahead).select(
            F.xxhash64(F.to_json("antecedent"), "consequent").alias("rule"),
            F.size("antecedent").alias("n_antecedent"),
            "consequent",
            F.col(metric).alias("metric"),
            "ahead",
            F.explode("antecedent").alias("item"),
        )
    )
    known = rows.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.max("n_antecedent"), F.lit(0)).alias("longest")
    ).first()
    return RuleIndex(rows, known["n"], known["longest"], rules.select("antecedent", "consequent", F.col(metric).alias("metric")))


def known_items(items: str | Column) -> Column:
    """Distinct items in order; a null is never one that is shared."""
    return F.array_sort(F.array_distinct(F.filter(items, lambda x: x.isNotNull())))


def antecedent_parts(index: RuleIndex) -> DataFrame:
    """A row per part of an antecedent, consequent and rule measures that may give the consequent its best score there.

    A rule is worth as much to a part as its metric over its antecedent's size. For each part and consequent the best
    worth is kept, with all measures that rounding could put before it; ``ahead`` counts the part's consequents that
    are worth more.
    """
    none = F.array().cast("array<array<string>>")
    grow = lambda parts, x: F.concat(parts, F.array(F.array(x)), F.transform(parts, lambda p: F.concat(p, F.array(x))))
    worth = F.col("metric") / F.col("n_antecedent")
    measures = (
        index.rules.where(F.col("consequent").isNotNull())
        .select(
            F.explode(F.aggregate(known_items("antecedent"), none, grow)).alias("part"), "consequent",
            F.size("antecedent").alias("n_antecedent"), "metric",
        )
        .distinct().withColumn("worth", worth)
    )
    best = measures.groupBy("part", "consequent").agg(F.max("worth").alias("best"))
    ahead = F.expr(
        "count(1) OVER (PARTITION BY part ORDER BY -ln(greatest(best, 1e-300D)) "
        "RANGE BETWEEN UNBOUNDED PRECEDING AND 1e-9D PRECEDING)"
    )
    near = F.col("worth") >= F.col("best") - F.abs(F.col("best")) * 1e-9
    return measures.join(best.withColumn("ahead", ahead), ["part", "consequent"]).where(near).select(
        "part", "consequent", "n_antecedent", "metric", "ahead"
    )


def best_by_parts(carts: DataFrame, index: RuleIndex, best: int, partitions: int | None = None) -> DataFrame:
    """Best score of each item that may be among a cart's best and that it does not hold yet, for antecedents of several items.

    A rule's score grows with the items that cart and antecedent share, so its score is the largest over all parts of
    the antecedent that lie in the cart. Carts meet these parts, item by item and only while a part is known, instead of
    all rules that share an item. Each part gives the consequents that can be among the best.
    """
    parts = cut_lineage(antecedent_parts(index))
    known = cut_lineage(parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")))
    sizes = known.agg(F.count(F.lit(1)).alias("parts"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    if partitions is None:
        partitions = int(carts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = carts.select("order_id", "cart").repartition(partitions, "order_id").select(
        "order_id", "cart", F.size("cart").alias("n_cart"), F.array().cast("array<string>").alias("part"),
        known_items("cart").alias("tail"),
    )
    for size in range(index.longest):
        # parts that are as long as they can be stay; the others stay and grow
        grown = F.when(F.size("part") == size, F.sequence(F.lit(0), F.size("tail"))).otherwise(F.array(F.lit(0)))
        met = met.withColumn("at", F.explode(grown))
        met = met.where((F.col("at") > 0) | (F.size("part") > 0)).select(
            "order_id", "cart", "n_cart",
            F.when(F.col("at") > 0, F.concat("part", F.slice("tail", F.col("at"), F.lit(1)))).otherwise(F.col("part")).alias("part"),
            F.when(F.col("at") > 0, F.slice("tail", F.col("at") + 1, F.size("tail"))).otherwise(F.col("tail")).alias("tail"),
        )
        if size + 1 < index.longest:
            met = met.join(broadcast_up_to(known.select("part"), sizes["parts"]), "part", "left_semi")
    owned = F.array_contains("cart", F.col("consequent"))
    hits = met.drop("tail").withColumnRenamed("part", "held").join(
        broadcast_up_to(parts, sizes["rows"]),
        # of the consequents ahead the cart may hold those that are not in the part
        (F.col("held") == F.col("part")) & (F.col("ahead") < F.col("n_cart") - F.size("held") + best),
    ).where(~owned)
    score = match_score(F.size("part"), F.col("n_antecedent"), F.col("n_cart"))
    return hits.groupBy("order_id", "consequent").agg(F.max(F.col("metric") * score).alias("rule_score"))


def match_score(overlap: Column, n_antecedent: Column, n_cart: Column) -> Column:
    return F.pow(overlap, 2) / (n_antecedent * n_cart)


def match_rules(
    carts: DataFrame, index: RuleIndex, best: int | None = None, partitions: int | None = None
) -> DataFrame:
    """Each cart with each rule that shares an item with it, the overlap, and the score.

    An equi-join on single items. Carts are placed by order first, so the count
    per rule and whatever the caller does per order need no further shuffle;
    ``partitions`` sets how finely. It is never coalesced by size, as the rows
    grow by the rules per item.

    With ``best`` only rules that can bring an item into a cart's best so many are
    matched. That loses nothing: all rules of an antecedent share their match
    score, and of the ones ahead of a rule at most as many as the cart has items
    lead to an item that it already holds.
    """
    carts = carts.select("order_id", "cart")
    if partitions is None:
        partitions = int(carts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = carts.repartition(partitions, "order_id")
    items = placed.select(
        "order_id", "cart", F.size("cart").alias("n_cart"), F.explode(F.array_distinct("cart")).alias("item")
    )
    rows = index.for_join()
    shared = items["item"] == rows["item"]
    if best is not None:
        shared = shared & (rows["ahead"] < items["n_cart"] + best)
    hits = items.join(rows, shared).select(
        "order_id", "n_cart", "rule", "n_antecedent", "consequent", "metric",
        F.array_contains("cart", F.col("consequent")).alias("owned"),
    )
    if index.longest > 1:
        # all follow from order and rule; as keys they allow hash aggregation
        hits = hits.groupBy(
            "order_id", "rule", "n_cart", "n_antecedent", "consequent", "metric", "owned"
        ).agg(F.count(F.lit(1)).alias("overlap"))
    else:
        hits = hits.withColumn("overlap", F.lit(1).cast("long"))
    score = match_score(F.col("overlap"), F.col("n_antecedent"), F.col("n_cart"))
    return hits.withColumn("match_score", score).withColumn("rule_score", F.col("metric") * F.col("match_score"))


def best_consequents(matches: DataFrame) -> DataFrame:
    """Best score of each item that the cart does not hold yet."""
    return (
        matches.where(~F.col("owned"))
        .groupBy("order_id", "consequent")
        .agg(F.max("rule_score").alias("rule_score"))
    )


def rank_consequents(carts: DataFrame, index: RuleIndex, k: int = 5) -> DataFrame:
    """Top-k items per cart as rows; equal scores by item."""
    best = best_by_parts(carts, index, k) if index.longest > 1 else best_consequents(match_rules(carts, index, best=k))
    return top_per_group(best, ["order_id"], [F.col("rule_score").desc(), "consequent"], k)


def recommend(
    carts: DataFrame, rules: DataFrame, k: int = 5, metric: str = "confidence", keep_empty: bool = False
) -> DataFrame:
    """Carts with ranked ``recommendations`` and ``scores``.

    A cart without a recommendation is left out, or kept with empty arrays.
    """
    ranked = rank_consequents(carts, index_rules(rules, metric), k)
    lists = ranked.groupBy("order_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "consequent", "rule_score"))).alias("__ranked")
    )
    out = carts.join(lists, "order_id", "left" if keep_empty else "inner")
    return out.select(
        *carts.columns,
        F.coalesce(F.col("__ranked.consequent"), F.array().cast("array<string>")).alias("recommendations"),
        F.coalesce(F.col("__ranked.rule_score"), F.array().cast("array<double>")).alias("scores"),
    )


def relevant_rules(rules: DataFrame, carts: DataFrame) -> DataFrame:
    """Rules whose antecedent shares an item with any of the carts."""
    in_carts = carts.select(F.explode("cart").alias("__item")).distinct()
    keyed = with_rule_id(rules)
    touched = (
        keyed.select("rule_id", F.explode("antecedent").alias("__item"))
        .join(in_carts, "__item", "left_semi")
        .select("rule_id")
        .distinct()
    )
    return keyed.join(touched, "rule_id", "left_semi")


def hit_at_k(carts: DataFrame, ranked: DataFrame, popular: DataFrame) -> DataFrame:
    """Share of carts whose held-out item was recommended, next to a popularity list.

    ``hit_matched`` looks at carts with a recommendation only, ``hit_all`` counts
    the others as misses. ``popular`` is one row with an array.
    """
    per_cart = ranked.groupBy("order_id").agg(F.collect_list("consequent").alias("__items"))
    baseline = popular.select("popular").scalar()
    judged = carts.select("order_id", "added").join(per_cart, "order_id", "left").select(
        F.col("__items").isNotNull().cast("long").alias("matched"),
        F.array_contains("__items", F.col("added")).cast("double").alias("hit"),
        F.array_contains(baseline, F.col("added")).cast("double").alias("hit_baseline"),
    )
    return judged.agg(
        F.count(F.lit(1)).alias("carts"),
        F.sum("matched").alias("matched"),
        F.avg("hit").alias("hit_matched"),
        F.avg(F.coalesce("hit", F.lit(0.0))).alias("hit_all"),
        F.avg("hit_baseline").alias("hit_baseline"),
    )
