"""Queries over orders: cleaning, rules, features, and factor inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions.columns import numbered_key
from tablewright.operators import factors, features, orders, rules
from tablewright.operators.evaluate import hit_and_ndcg
from tablewright.operators.ordered import dense_ids, vocabulary
from tablewright.operators.split import feature_target_split, hash_sample, hash_split, temporal_split
from tablewright.plans import roles
from tablewright.plans.registry import query
from tablewright.session import write_once

LINES = """lines AS (
  SELECT l_orderkey AS order_id, {item} AS item, min(l_linenumber) AS line
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""
BRANDS = LINES.format(item="p_brand")
PARTS = LINES.format(item="CAST(p_partkey AS VARCHAR)")
USERS = """heads AS (
  SELECT o_orderkey AS order_id, o_custkey AS mpid, o_orderdate AS ts FROM orders
  WHERE o_orderkey IN (SELECT order_id FROM lines))"""
SPLIT = """split AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY mpid ORDER BY ts, order_id)
    <= ceil(count(*) OVER (PARTITION BY mpid) * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM heads),
train AS (SELECT l.* FROM lines l JOIN split s ON l.order_id = s.order_id AND s.split = 'train'),
test AS (SELECT l.* FROM lines l JOIN split s ON l.order_id = s.order_id AND s.split = 'test')"""
RULES = """total AS (SELECT count(DISTINCT order_id) AS n FROM {src}),
occ AS (
  SELECT [item] AS items, order_id FROM {src}
  QUALIFY count(*) OVER (PARTITION BY item) >= ceil({support} * (SELECT n FROM total))
  UNION ALL
  SELECT list_append(o.items, l.item), o.order_id FROM occ o JOIN {src} l ON l.order_id = o.order_id AND l.item > o.items[-1]
  QUALIFY count(*) OVER (PARTITION BY list_append(o.items, l.item)) >= ceil({support} * (SELECT n FROM total))),
sets AS (SELECT items, count(*) AS n FROM occ GROUP BY 1),
splits AS (
  SELECT list_filter(items, lambda x: x <> c) AS items, c AS consequent, n
  FROM (SELECT items, n, unnest(items) AS c FROM sets WHERE len(items) > 1)),
rules AS (
  SELECT s.items, array_to_string(s.items, '+') AS antecedent, consequent, s.n::DOUBLE / a.n AS confidence,
    s.n::DOUBLE / a.n / (c.n::DOUBLE / t.n) AS lift, s.n::DOUBLE / t.n AS support
  FROM splits s JOIN sets a ON a.items = s.items JOIN sets c ON c.items = [s.consequent] CROSS JOIN total t)"""
SIZES = "sizes AS (SELECT order_id, count(*) AS n_cart FROM {src} GROUP BY 1)"
MATCHED = """hits AS (
  SELECT c.order_id, r.antecedent, r.consequent, any_value(r.confidence) AS confidence, any_value(r.lift) AS lift,
    (count(*) * count(*))::DOUBLE / (any_value(len(r.items)) * any_value(z.n_cart)) AS match_score
  FROM {src} c JOIN sizes z ON z.order_id = c.order_id
  JOIN (SELECT *, unnest(items) AS item FROM rules) r ON r.item = c.item GROUP BY 1, 2, 3)"""
SCORED = MATCHED + """,
scored AS (
  SELECT h.order_id, consequent, max({metric} * match_score) AS rule_score FROM hits h
  WHERE NOT EXISTS (SELECT 1 FROM {src} o WHERE o.order_id = h.order_id AND o.item = h.consequent)
  GROUP BY 1, 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY rule_score DESC, consequent) AS rank FROM scored)"""
HELD_OUT = """placed AS (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY line DESC, item DESC) AS back,
    count(*) OVER (PARTITION BY order_id) AS n FROM {src}),
cart AS (SELECT order_id, item, line FROM placed WHERE n > 1 AND back > 1),
added AS (SELECT order_id, item FROM placed WHERE n > 1 AND back = 1)"""


def mined_rules(baskets, support=roles.MIN_SUPPORT):
    """All rules at that support, whatever the number of items in their antecedents."""
    return rules.mine_rules(baskets, min_support=support)


def joined(antecedent="antecedent"):
    return F.array_join(antecedent, "+").alias("antecedent")


def as_carts(baskets):
    return baskets.select("order_id", F.col("order_product_list").alias("cart"))


@query("clean_orders", f"""WITH {BRANDS}, {USERS},
kept AS (SELECT * FROM lines WHERE item NOT IN ('Brand#4', 'Brand#9')),
b AS (SELECT order_id, count(*) AS n_items, string_agg(item, ',' ORDER BY line, item) AS items FROM kept GROUP BY 1)
SELECT mpid, b.order_id, n_items, items, strftime(ts, '%Y-%m-%d') AS order_day,
  row_number() OVER (PARTITION BY mpid ORDER BY ts, b.order_id)::INTEGER AS order_number
FROM b JOIN heads h ON h.order_id = b.order_id""")
def _(spark, sf):
    items = F.col("order_product_list")
    return roles.cleaned(spark, sf).select(
        "mpid", "order_id", F.size(items).cast("long").alias("n_items"), F.array_join(items, ",").alias("items"),
        F.date_format("order_timestamp", "yyyy-MM-dd").alias("order_day"), "order_number",
    )


@query("clean_orders_null_keys", f"""WITH {BRANDS}, {USERS},
kept AS (SELECT DISTINCT order_id FROM lines WHERE item NOT IN ('Brand#4', 'Brand#9'))
SELECT nullif(mpid % 50, 0) AS mpid, k.order_id,
  row_number() OVER (PARTITION BY nullif(mpid % 50, 0) ORDER BY ts, k.order_id)::INTEGER AS order_number
FROM kept k JOIN heads h ON h.order_id = k.order_id""")
def _(spark, sf):
    key = F.col("mpid") % 50
    raw = roles.raw_orders(spark, sf).withColumn("mpid", F.when(key != 0, key))
    return orders.clean_orders(raw, roles.REMOVED_BRANDS).select("mpid", "order_id", "order_number")


@query("item_support", f"""WITH {BRANDS}
SELECT item, count(*) AS count, round(count(*)::DOUBLE / (SELECT count(DISTINCT order_id) FROM lines), 6) AS support
FROM lines GROUP BY 1""")
def _(spark, sf):
    return orders.item_support(roles.baskets(spark, sf)).select("item", "count", F.round("support", 6).alias("support"))


@query("popularity_baseline", f"""WITH {BRANDS}, c AS (SELECT item, count(*) AS n FROM lines GROUP BY 1)
SELECT row_number() OVER (ORDER BY n DESC, item)::INTEGER AS rank, item FROM c QUALIFY rank <= 5""")
def _(spark, sf):
    top = orders.popular_items(roles.baskets(spark, sf), 5)
    return top.select(F.posexplode("popular").alias("pos", "item")).select((F.col("pos") + 1).alias("rank"), "item")


@query("assoc_rules", f"""WITH RECURSIVE {BRANDS}, {RULES.format(src='lines', support=roles.MIN_SUPPORT)}
SELECT antecedent, consequent, round(confidence, 6) AS confidence, round(lift, 6) AS lift,
  round(support, 6) AS support FROM rules""")
def _(spark, sf):
    return mined_rules(roles.baskets(spark, sf)).select(
        joined(), "consequent",
        *[F.round(c, 6).alias(c) for c in ("confidence", "lift", "support")],
    )


#: A share of orders that sets of several items reach.
LOW_SUPPORT = 0.002


@query("assoc_rules_deep", f"""WITH RECURSIVE {BRANDS}, {RULES.format(src='lines', support=LOW_SUPPORT)}
SELECT antecedent, consequent, round(confidence, 6) AS confidence, round(support, 6) AS support FROM rules""")
def _(spark, sf):
    return mined_rules(roles.baskets(spark, sf), LOW_SUPPORT).select(
        joined(), "consequent",
        F.round("confidence", 6).alias("confidence"), F.round("support", 6).alias("support"),
    )


@query("mba_topk_deep", f"""WITH RECURSIVE {BRANDS}, {RULES.format(src='lines', support=LOW_SUPPORT)},
{SIZES.format(src='lines')}, {SCORED.format(src='lines', metric='confidence')}
SELECT order_id, rank::INTEGER AS rank, consequent, round(rule_score, 6) AS rule_score FROM ranked WHERE rank <= 5""")
def _(spark, sf):
    baskets = roles.baskets(spark, sf)
    ranked = rules.rank_consequents(as_carts(baskets), rules.index_rules(mined_rules(baskets, LOW_SUPPORT)), 5)
    return ranked.select("order_id", "rank", "consequent", F.round("rule_score", 6).alias("rule_score"))


@query("rule_match", f"""WITH RECURSIVE {BRANDS}, {RULES.format(src='lines', support=roles.MIN_SUPPORT)},
{SIZES.format(src='lines')}, {MATCHED.format(src='lines')}
SELECT antecedent, consequent, count(*) AS carts, round(avg(match_score), 6) AS mean_match FROM hits GROUP BY 1, 2""")
def _(spark, sf):
    baskets = roles.baskets(spark, sf)
    mined = mined_rules(baskets)
    names = mined.select(F.xxhash64(F.to_json("antecedent"), "consequent").alias("rule"), joined())
    matches = rules.match_rules(as_carts(baskets), rules.index_rules(mined))
    per_rule = matches.groupBy("rule", "consequent").agg(
        F.count(F.lit(1)).alias("carts"), F.round(F.avg("match_score"), 6).alias("mean_match")
    )
    return per_rule.join(names, "rule").select("antecedent", "consequent", "carts", "mean_match")


@query("mba_score", f"""WITH RECURSIVE {BRANDS}, {RULES.format(src='lines', support=roles.MIN_SUPPORT)},
{SIZES.format(src='lines')}, {SCORED.format(src='lines', metric='lift')}
SELECT consequent, count(*) AS carts, round(avg(rule_score), 6) AS mean_score, round(max(rule_score), 6) AS best_score
FROM scored GROUP BY 1""")
def _(spark, sf):
    baskets = roles.baskets(spark, sf)
    index = rules.index_rules(mined_rules(baskets), "lift")
    best = rules.best_consequents(rules.match_rules(as_carts(baskets), index))
    return best.groupBy("consequent").agg(
        F.count(F.lit(1)).alias("carts"), F.round(F.avg("rule_score"), 6).alias("mean_score"),
        F.round(F.max("rule_score"), 6).alias("best_score"),
    )


@query("mba_topk", f"""WITH RECURSIVE {BRANDS}, {RULES.format(src='lines', support=roles.MIN_SUPPORT)},
{SIZES.format(src='lines')}, {SCORED.format(src='lines', metric='confidence')}
SELECT order_id, rank::INTEGER AS rank, consequent, round(rule_score, 6) AS rule_score FROM ranked WHERE rank <= 5""")
def _(spark, sf):
    baskets = roles.baskets(spark, sf)
    index = rules.index_rules(mined_rules(baskets))
    ranked = rules.rank_consequents(as_carts(baskets), index, 5)
    return ranked.select("order_id", "rank", "consequent", F.round("rule_score", 6).alias("rule_score"))


@query("mba_keep_empty", f"""WITH RECURSIVE {BRANDS}, {RULES.format(src='lines', support=roles.MIN_SUPPORT)},
{SIZES.format(src='lines')}, {SCORED.format(src='lines', metric='confidence')}
SELECT z.order_id, coalesce(string_agg(consequent, ',' ORDER BY rank), '') AS recommendations,
  coalesce(round(sum(rule_score), 6), 0) AS scores FROM sizes z
LEFT JOIN (SELECT * FROM ranked WHERE rank <= 5) r ON r.order_id = z.order_id GROUP BY 1""")
def _(spark, sf):
    """Lists for all carts, those without a matching rule included."""
    baskets = roles.baskets(spark, sf)
    found = rules.recommend(as_carts(baskets), mined_rules(baskets), 5, keep_empty=True)
    total = F.aggregate("scores", F.lit(0.0), lambda acc, x: acc + x)
    return found.select("order_id", F.array_join("recommendations", ",").alias("recommendations"), F.round(total, 6).alias("scores"))


@query("rules_relevant", f"""WITH RECURSIVE {BRANDS}, {RULES.format(src='lines', support=roles.MIN_SUPPORT)},
wanted AS (SELECT DISTINCT item FROM lines JOIN orders ON o_orderkey = order_id WHERE o_totalprice > 499000)
SELECT antecedent, consequent FROM rules WHERE list_has_any(items, (SELECT list(item) FROM wanted))""")
def _(spark, sf):
    dear = roles.table(spark, sf, "orders").where(F.col("o_totalprice") > 499000)
    baskets = roles.baskets(spark, sf)
    carts = as_carts(baskets).join(dear.select(F.col("o_orderkey").alias("order_id")), "order_id", "left_semi")
    found = rules.relevant_rules(mined_rules(baskets), carts)
    return found.select(joined(), "consequent")


@query("leave_one_out", f"""WITH {BRANDS}, {HELD_OUT.format(src='lines')}
SELECT c.order_id, string_agg(c.item, ',' ORDER BY c.line, c.item) AS cart, any_value(a.item) AS added
FROM cart c JOIN added a ON a.order_id = c.order_id GROUP BY 1""")
def _(spark, sf):
    held = orders.hold_out_last(roles.baskets(spark, sf), "order_id")
    return held.select("order_id", F.array_join("cart", ",").alias("cart"), "added")


@query("hit_at_k", f"""WITH RECURSIVE {BRANDS}, {USERS}, {SPLIT},
{RULES.format(src='train', support=roles.MIN_SUPPORT)}, {HELD_OUT.format(src='test')},
{SIZES.format(src='cart')}, {SCORED.format(src='cart', metric='confidence')},
popular AS (SELECT item FROM train GROUP BY 1 ORDER BY count(*) DESC, item LIMIT 5),
judged AS (SELECT a.order_id,
  EXISTS (SELECT 1 FROM ranked r WHERE r.order_id = a.order_id AND rank <= 5) AS matched,
  EXISTS (SELECT 1 FROM ranked r WHERE r.order_id = a.order_id AND rank <= 5 AND r.consequent = a.item) AS hit,
  a.item IN (SELECT item FROM popular) AS base FROM added a)
SELECT count(*) AS carts, sum(matched::INT)::BIGINT AS matched,
  round(sum((hit AND matched)::INT)::DOUBLE / sum(matched::INT), 6) AS hit_matched,
  round(avg(hit::INT), 6) AS hit_all, round(avg(base::INT), 6) AS hit_baseline FROM judged""")
def _(spark, sf):
    train, test = roles.train_test(spark, sf)
    carts = orders.hold_out_last(test, "order_id")
    ranked = rules.rank_consequents(carts, rules.index_rules(mined_rules(train)), 5)
    report = rules.hit_at_k(carts, ranked, orders.popular_items(train, 5))
    return report.select("carts", "matched", *[F.round(c, 6).alias(c) for c in ("hit_matched", "hit_all", "hit_baseline")])


FEATURES = """newest AS (SELECT max(ts) AS t FROM {heads}),
stats AS (SELECT h.mpid, count(*) AS total_orders, round(avg(n), 2) AS avg_order_size, max(h.ts) AS last_ts
  FROM {heads} h JOIN (SELECT order_id, count(*) AS n FROM {lines} GROUP BY 1) b ON b.order_id = h.order_id GROUP BY 1),
priced AS (SELECT h.mpid, p_type, CAST(p_retailprice AS DECIMAL(18, 2)) AS price FROM {lines} l
  JOIN {heads} h ON h.order_id = l.order_id JOIN part ON CAST(p_partkey AS VARCHAR) = l.item),
spend AS (SELECT mpid, CAST(sum(price) AS DOUBLE) AS lifetime_spend FROM priced GROUP BY 1),
favourite AS (SELECT mpid, p_type AS preferred_category FROM
  (SELECT mpid, p_type, count(*) AS n FROM priced GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY mpid ORDER BY n DESC, p_type) = 1),
users AS (SELECT s.mpid, total_orders, avg_order_size, lifetime_spend, preferred_category,
  date_diff('day', last_ts::DATE, (SELECT t FROM newest)::DATE)::INTEGER AS days_since_last_order, last_ts
  FROM stats s LEFT JOIN spend USING (mpid) LEFT JOIN favourite USING (mpid)),
tiered AS (SELECT *,
  CASE WHEN total_orders >= 8 THEN 'Gold' WHEN total_orders >= 4 THEN 'Silver' ELSE 'Bronze' END AS customer_tier,
  CASE WHEN days_since_last_order <= 30 THEN 'Active' WHEN days_since_last_order <= 90 THEN 'Lapsed'
    ELSE 'Churned' END AS recency_bucket FROM users)"""


@query("user_features", f"""WITH {PARTS}, {USERS}, {FEATURES.format(heads='heads', lines='lines')}
SELECT mpid, total_orders, avg_order_size, lifetime_spend, preferred_category,
  strftime(last_ts, '%Y-%m-%d') AS last_order, days_since_last_order, customer_tier, recency_bucket FROM tiered""")
def _(spark, sf):
    found = features.user_features(roles.user_orders(spark, sf, "p_partkey"), roles.part_catalog(spark, sf))
    return found.withColumn("last_order", F.date_format("last_order_ts", "yyyy-MM-dd")).drop("last_order_ts")


TYPE_CODE = """CASE {c} WHEN 'ECONOMY' THEN 0 WHEN 'STANDARD' THEN 1 WHEN 'PROMO' THEN 2 WHEN 'LARGE' THEN 3
  WHEN 'SMALL' THEN 4 ELSE 0 END"""
USER_CODES = f"""{TYPE_CODE.format(c='preferred_category')}::DOUBLE AS u_pref_cat_enc,
  CASE customer_tier WHEN 'Silver' THEN 1 WHEN 'Gold' THEN 2 ELSE 0 END::DOUBLE AS u_tier_enc,
  CASE recency_bucket WHEN 'Lapsed' THEN 1 WHEN 'Churned' THEN 2 ELSE 0 END::DOUBLE AS u_recency_enc"""
ITEM_CODES = f"""p_retailprice AS i_base_price, (p_name LIKE '%ring%')::INT::DOUBLE AS i_is_vegetarian,
  {TYPE_CODE.format(c='p_type')}::DOUBLE AS i_category_enc,
  CASE WHEN p_size <= 15 THEN 0 WHEN p_size <= 35 THEN 1 ELSE 2 END::DOUBLE AS i_calories_enc"""


@query("label_encode", f"""WITH {PARTS}, {USERS}, {FEATURES.format(heads='heads', lines='lines')}
SELECT 'user' AS side, CAST(mpid AS VARCHAR) AS key, u_pref_cat_enc AS a, u_tier_enc AS b, u_recency_enc AS c
FROM (SELECT mpid, {USER_CODES} FROM tiered)
UNION ALL SELECT 'item', CAST(p_partkey AS VARCHAR), i_category_enc, i_calories_enc, i_is_vegetarian
FROM (SELECT p_partkey, {ITEM_CODES} FROM part)""")
def _(spark, sf):
    catalog = roles.part_catalog(spark, sf)
    found = features.user_features(roles.user_orders(spark, sf, "p_partkey"), catalog)
    users = features.encode_users(found, roles.TYPE_CODES).select(
        F.lit("user").alias("side"), F.col("mpid").cast("string").alias("key"),
        *[F.col(c).cast("double").alias(n) for c, n in zip(("u_pref_cat_enc", "u_tier_enc", "u_recency_enc"), "abc")],
    )
    items = features.encode_items(catalog, roles.TYPE_CODES).select(
        F.lit("item").alias("side"), F.col("item").alias("key"),
        *[F.col(c).cast("double").alias(n) for c, n in zip(("i_category_enc", "i_calories_enc", "i_is_vegetarian"), "abc")],
    )
    return users.unionByName(items)


@query("temporal_split", f"""WITH {BRANDS}, {USERS}, {SPLIT} SELECT mpid, order_id, split FROM split""")
def _(spark, sf):
    split = temporal_split(roles.user_orders(spark, sf), "mpid", "order_timestamp", "order_id")
    return split.select("mpid", "order_id", "split")


@query("hash_split", """SELECT o_custkey, count(*) AS orders, 1 AS parts FROM orders GROUP BY 1""")
def _(spark, sf):
    """Users fall into train, validation or test as a whole, and none is lost."""
    parts = hash_split(roles.table(spark, sf, "orders"), ["o_custkey"], [0.64, 0.16, 0.2])
    tagged = [p.select("o_custkey", F.lit(n).alias("part")) for n, p in zip(("train", "validation", "test"), parts)]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2]).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.count_distinct("part").cast("int").alias("parts")
    )


SLOT = "CAST('0x' || substr(md5('{seed}:' || {key}), 1, 13) AS BIGINT) % 1000000"


@query("hash_sample", f"""SELECT o_orderkey, o_totalprice FROM orders
WHERE {SLOT.format(seed=7, key="o_orderkey")} < 200000""")
def _(spark, sf):
    return hash_sample(roles.table(spark, sf, "orders"), ["o_orderkey"], 0.2, seed=7).select("o_orderkey", "o_totalprice")


@query("feature_target_split", f"""SELECT part, o_orderpriority, count(*) AS rows, round(sum(o_totalprice), 2) AS o_totalprice,
  min(o_orderstatus) AS o_orderstatus FROM (
  SELECT *, CASE WHEN {SLOT.format(seed=42, key="o_orderkey")} < 800000 THEN 'train' ELSE 'test' END AS part FROM orders)
GROUP BY 1, 2""")
def _(spark, sf):
    """Train and test rows of a classifier; the row id places a row and is no feature."""
    rows = roles.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    train, test = feature_target_split(rows, "o_orderkey", "o_orderpriority")
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("o_totalprice"),
        F.min("o_orderstatus").alias("o_orderstatus"),
    )


IDS = """user_ids AS (SELECT mpid, row_number() OVER (ORDER BY mpid)::INTEGER AS user_id
  FROM (SELECT DISTINCT mpid FROM {src} l JOIN heads h ON h.order_id = l.order_id)),
item_ids AS (SELECT item, row_number() OVER (ORDER BY item)::INTEGER AS item_id FROM (SELECT DISTINCT item FROM {src})),
shares AS (SELECT user_id, item_id, mpid, l.item, count(*) AS n, sum(count(*)) OVER (PARTITION BY user_id)::BIGINT AS total
  FROM {src} l JOIN heads h ON h.order_id = l.order_id JOIN user_ids USING (mpid) JOIN item_ids ON item_ids.item = l.item
  GROUP BY 1, 2, 3, 4)"""


@query("als_matrix", f"""WITH {BRANDS}, {USERS}, {IDS.format(src='lines')}
SELECT user_id, item_id, n AS historical_ordered_amount, total AS total_orders,
  round(n::DOUBLE / total, 6) AS proportion_of_orders FROM shares""")
def _(spark, sf):
    matrix = factors.prepare(roles.user_orders(spark, sf))
    return matrix.shares.withColumn("proportion_of_orders", F.round("proportion_of_orders", 6))


@query("als_eval_link", f"""WITH {BRANDS}, {USERS}, {SPLIT}, {IDS.format(src='train')}, {HELD_OUT.format(src='test')}
SELECT a.order_id, user_id, item_id AS added_item_id FROM added a JOIN heads h ON h.order_id = a.order_id
JOIN user_ids USING (mpid) JOIN item_ids ON item_ids.item = a.item""")
def _(spark, sf):
    train, test = roles.train_test(spark, sf)
    return factors.link_orders(test, factors.prepare(train)).select("order_id", "user_id", "added_item_id")


@query("cold_start_report", f"""WITH {PARTS}, {USERS}, {SPLIT}, {IDS.format(src='train')}, {HELD_OUT.format(src='test')},
linked AS (SELECT a.order_id FROM added a JOIN heads h ON h.order_id = a.order_id
  JOIN user_ids USING (mpid) JOIN item_ids ON item_ids.item = a.item)
SELECT total, linked, total - linked AS dropped FROM
  (SELECT (SELECT count(*) FROM split WHERE split = 'test') AS total, (SELECT count(*) FROM linked) AS linked)""")
def _(spark, sf):
    train, test = roles.train_test(spark, sf, "p_partkey")
    return factors.link_report(test, factors.prepare(train))


@query("dense_ids", f"""WITH {PARTS} SELECT item AS label, row_number() OVER (ORDER BY item) AS id
FROM (SELECT DISTINCT item FROM lines)""")
def _(spark, sf):
    lines = roles.item_lines(spark, sf, "p_partkey").withColumnRenamed("item", "label")
    return dense_ids(lines, "label", "id")


@query("vocab", f"""WITH {PARTS} SELECT item, row_number() OVER (ORDER BY n DESC, item) - 1 AS item_idx
FROM (SELECT item, count(*) AS n FROM lines GROUP BY 1)""")
def _(spark, sf):
    return vocabulary(roles.item_lines(spark, sf, "p_partkey"), "item", "item_idx")


@query("interactions", f"""WITH {PARTS}, {USERS}, {SPLIT},
train_heads AS (SELECT order_id, mpid, ts FROM split WHERE split = 'train'),
{FEATURES.format(heads='train_heads', lines='train')},
user_vocab AS (SELECT mpid, row_number() OVER (ORDER BY n DESC, mpid) - 1 AS user_idx FROM
  (SELECT mpid, count(*) AS n FROM train l JOIN heads h ON h.order_id = l.order_id GROUP BY 1)),
item_vocab AS (SELECT item, row_number() OVER (ORDER BY n DESC, item) - 1 AS item_idx FROM
  (SELECT item, count(*) AS n FROM train GROUP BY 1))
SELECT user_idx, item_idx, total_orders::DOUBLE AS u_total_orders, avg_order_size AS u_avg_order_size,
  lifetime_spend AS u_lifetime_spend, days_since_last_order::DOUBLE AS u_days_since_last, {USER_CODES}, {ITEM_CODES}
FROM test l JOIN heads h ON h.order_id = l.order_id JOIN user_vocab USING (mpid) JOIN item_vocab ON item_vocab.item = l.item
JOIN tiered USING (mpid) JOIN part ON CAST(p_partkey AS VARCHAR) = l.item""")
def _(spark, sf):
    train, test = roles.train_test(spark, sf, "p_partkey")
    catalog = roles.part_catalog(spark, sf)
    pairs = orders.explode_items(train, "mpid")
    return features.interactions(
        test,
        vocabulary(pairs, "mpid", "user_idx"),
        vocabulary(pairs, "item", "item_idx"),
        features.encode_users(features.user_features(train, catalog), roles.TYPE_CODES),
        features.encode_items(catalog, roles.TYPE_CODES),
    )


TOP_SHARES = """lists AS (SELECT mpid, item, n::DOUBLE / total AS share,
  row_number() OVER (PARTITION BY mpid ORDER BY n::DOUBLE / total DESC, item)::INTEGER AS rank FROM shares)"""


def lists_of(baskets):
    """Published lists of each user's most bought items."""
    pairs = orders.explode_items(baskets, "mpid")
    return factors.publish_lists(roles.ranked_shares(features.interaction_share(pairs, "mpid", "item")))


def share_lists(spark, sf):
    return lists_of(roles.user_orders(spark, sf))


@query("topk_arrays", f"""WITH {BRANDS}, {USERS}, {IDS.format(src='lines')}, {TOP_SHARES}
SELECT mpid, rank, item, round(share, 6) AS score FROM lists WHERE rank <= 20""")
def _(spark, sf):
    both = F.arrays_zip("recommendations", "scores")
    flat = share_lists(spark, sf).select("mpid", F.posexplode(both).alias("pos", "r"))
    return flat.select(
        "mpid", (F.col("pos") + 1).alias("rank"), F.col("r.recommendations").alias("item"), F.col("r.scores").alias("score")
    )


@query("lookup_recs", f"""WITH {BRANDS}, {USERS}, {IDS.format(src='lines')}, {TOP_SHARES},
asked AS (SELECT c_custkey AS mpid FROM customer UNION ALL SELECT 999999)
SELECT asked.mpid, rank, item, round(share, 6) AS score
FROM asked LEFT JOIN (SELECT * FROM lists WHERE rank <= 5) l ON l.mpid = asked.mpid""")
def _(spark, sf):
    known = roles.table(spark, sf, "customer").select(F.col("c_custkey").alias("mpid"))
    asked = known.unionByName(spark.range(999999, 1000000).withColumnRenamed("id", "mpid"))
    both = F.arrays_zip("recommendations", "scores")
    flat = factors.lookup_lists(asked, share_lists(spark, sf), 5).select("mpid", F.posexplode_outer(both).alias("pos", "r"))
    return flat.select(
        "mpid", (F.col("pos") + 1).alias("rank"), F.col("r.recommendations").alias("item"), F.col("r.scores").alias("score")
    )


@query("ndcg", f"""WITH {BRANDS}, {USERS}, {SPLIT}, {IDS.format(src='train')}, {TOP_SHARES}, {HELD_OUT.format(src='test')},
judged AS (SELECT a.order_id, u.mpid IS NULL AS cold, l.rank FROM added a JOIN heads h ON h.order_id = a.order_id
  LEFT JOIN user_ids u ON u.mpid = h.mpid LEFT JOIN lists l ON l.mpid = h.mpid AND l.item = a.item AND l.rank <= 5)
SELECT count(*) FILTER (NOT cold) AS n, count(*) FILTER (cold) AS cold,
  round(avg((rank IS NOT NULL)::INT) FILTER (NOT cold), 6) AS hit,
  round(avg(CASE WHEN rank IS NULL THEN 0 ELSE 1 / log2(rank + 1) END) FILTER (NOT cold), 6) AS ndcg FROM judged""")
def _(spark, sf):
    """The last items of test orders against lists from training orders; orders of users without a list are counted apart."""
    train, test = roles.train_test(spark, sf)
    held = orders.hold_out_last(test, "mpid", "order_id").join(lists_of(train), "mpid", "left")
    return hit_and_ndcg(held, "recommendations", "added", 5).select(
        "n", "cold", F.round("hit", 6).alias("hit"), F.round("ndcg", 6).alias("ndcg")
    )


@query("als_topk")
def _(spark, sf):
    matrix = factors.prepare(roles.user_orders(spark, sf))
    model = factors.fit(write_once(matrix.shares, "shares"), rank=10, max_iter=5)
    return factors.with_labels(factors.recommend_users(model, 20), matrix)


@query("als_tuned")
def _(spark, sf):
    """Lists of the best setting, fitted again on all orders, beside that setting and its hit rates.

    The search is judged on the last orders of the training part; the test orders are used once, for ``test_hit``.
    """
    train, test = roles.train_test(spark, sf)
    parts = temporal_split(train.drop("split"), "mpid", "order_timestamp", "order_id")
    fitted = factors.prepare(write_once(parts.where(F.col("split") == "train"), "fitted"))
    search = factors.tune(fitted, factors.link_orders(parts.where(F.col("split") == "test"), fitted))
    trained = factors.prepare(train)
    model = factors.fit(write_once(trained.shares, "shares"), search.best["rank"], search.best["max_iter"])
    test_hit = factors.hit_rate(model, factors.link_orders(test, trained))
    whole, model = factors.refit(roles.user_orders(spark, sf), search)
    lists = factors.with_labels(factors.recommend_users(model, 20), whole)
    setting = [F.lit(search.best[c]).cast(t).alias(c) for c, t in (("rank", "int"), ("max_iter", "int"), ("hit", "double"))]
    return lists.withColumnRenamed("rank", "place").select(
        "mpid", "place", "item", "score", *setting, F.lit(test_hit).cast("double").alias("test_hit")
    )


@query("als_trials", "SELECT t::INTEGER AS trial, true AS fits FROM range(20) x(t)")
def _(spark, sf):
    """The log of a search among small settings: every trial once, within its bounds, with a share of hits."""
    train, _ = roles.train_test(spark, sf)
    matrix = factors.prepare(train)
    search = factors.tune(matrix, factors.link_orders(train, matrix), ranks=(1, 8), iterations=(1, 2))
    fits = F.col("rank").between(1, 8) & F.col("max_iter").between(1, 2) & F.col("hit").between(0, 1)
    return factors.trial_log(spark, search).select("trial", fits.alias("fits"))


@query("format_keys", """SELECT p_partkey, 'ORD-' || lpad((p_partkey + 1)::VARCHAR, greatest(6, length((p_partkey + 1)::VARCHAR))::INTEGER, '0') AS order_key,
  'group_' || lpad(p_partkey::VARCHAR, greatest(2, length(p_partkey::VARCHAR))::INTEGER, '0') AS group_key FROM part""")
def _(spark, sf):
    return roles.table(spark, sf, "part").select(
        "p_partkey", numbered_key("ORD-", F.col("p_partkey") + 1, 6).alias("order_key"),
        numbered_key("group_", "p_partkey", 2).alias("group_key"),
    )
