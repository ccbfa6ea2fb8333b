import itertools
import random

import pytest
from pyspark.sql import functions as F

from tablewright.operators import rules
from tablewright.operators.orders import clean_orders, hold_out_last, popular_items
from tablewright.sources import synthetic

RULES = "antecedent array<string>, consequent string, confidence double, lift double, support double"
CARTS = "order_id string, cart array<string>"


def brute_force(rule_rows, cart, k, metric):
    """Scores straight from the definition."""
    best = {}
    for antecedent, consequent, confidence, lift, _ in rule_rows:
        overlap = len(set(antecedent) & set(cart))
        if not overlap or consequent in cart:
            continue
        score = (confidence if metric == "confidence" else lift) * (overlap**2 / (len(antecedent) * len(cart)))
        best[consequent] = max(score, best.get(consequent, 0.0))
    return sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]


def random_rules(rng, items):
    rows = []
    for size in (1, 2, 3):
        for antecedent in itertools.combinations(items, size):
            for consequent in items:
                if consequent not in antecedent and rng.random() < 0.5:
                    rows.append((list(antecedent), consequent, rng.randint(1, 9) / 10, rng.randint(1, 30) / 10, 0.1))
    return rows


@pytest.mark.parametrize("metric", ["confidence", "lift"])
@pytest.mark.parametrize("k", [1, 3])
def test_recommend_as_by_definition(spark, metric, k):
    rng = random.Random(5)
    items = [f"i{i}" for i in range(7)]
    rule_rows = random_rules(rng, items)
    carts = [(f"o{i}", rng.sample(items, rng.randint(1, 5))) for i in range(60)] + [("none", ["other"])]
    got = rules.recommend(
        spark.createDataFrame(carts, CARTS), spark.createDataFrame(rule_rows, RULES), k, metric, keep_empty=True
    ).collect()
    assert len(got) == len(carts)
    for row in got:
        want = brute_force(rule_rows, row.cart, k, metric)
        assert row.recommendations == [c for c, _ in want]
        assert row.scores == pytest.approx([s for _, s in want])


def test_pruning_changes_nothing(spark):
    rng = random.Random(7)
    items = [f"i{i:02d}" for i in range(40)]
    rule_rows = [([a], c, rng.randint(1, 6) / 7, 1.0, 0.1) for a in items for c in items if a != c]
    carts = spark.createDataFrame([(f"o{i}", rng.sample(items, rng.randint(1, 6))) for i in range(80)], CARTS)
    index = rules.index_rules(spark.createDataFrame(rule_rows, RULES))
    pruned, whole = rules.match_rules(carts, index, best=3), rules.match_rules(carts, index)
    assert pruned.count() < whole.count() / 2
    best = rules.top_per_group(rules.best_consequents(whole), ["order_id"], [F.col("rule_score").desc(), "consequent"], 3)
    got = rules.rank_consequents(carts, index, 3)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, best.collect()))


def test_several_items_are_matched_by_parts(spark):
    """Cart rows grow with the parts in the cart, not with the rules that share an item."""
    rng = random.Random(9)
    items = [f"i{i:02d}" for i in range(14)]
    table = spark.createDataFrame(random_rules(rng, items), RULES)
    carts = [(f"o{i}", rng.sample(items, rng.randint(1, 7))) for i in range(60)] + [("gap", ["i01", None]), ("two", ["i03", "i03"])]
    carts = spark.createDataFrame(carts, CARTS)
    index = rules.index_rules(table)
    best = rules.best_consequents(rules.match_rules(carts, index))
    want = rules.top_per_group(best, ["order_id"], [F.col("rule_score").desc(), "consequent"], 4)
    assert sorted(map(tuple, rules.rank_consequents(carts, index, 4).collect())) == sorted(map(tuple, want.collect()))
    assert rules.best_by_parts(carts, index, 4).count() <= best.count()
    parts = rules.antecedent_parts(index)
    met = carts.select(F.explode(rules.known_items("cart")).alias("item")).join(index.rows, "item").count()
    held = carts.crossJoin(parts).where(F.size(F.array_intersect("cart", "part")) == F.size("part"))
    assert held.where(F.col("ahead") < F.size("cart") - F.size("part") + 4).count() < met / 3


def test_without_broadcast(spark, monkeypatch):
    rng = random.Random(5)
    items = [f"i{i}" for i in range(6)]
    table = spark.createDataFrame(random_rules(rng, items), RULES)
    carts = spark.createDataFrame([(f"o{i}", rng.sample(items, 3)) for i in range(30)], CARTS)
    small = sorted(map(tuple, rules.rank_consequents(carts, rules.index_rules(table), 3).collect()))
    monkeypatch.setattr(rules, "broadcast_up_to", lambda df, rows: df)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(tuple, rules.rank_consequents(carts, rules.index_rules(table), 3).collect())) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_empty_carts_are_dropped_unless_kept(spark):
    table = spark.createDataFrame([(["a"], "b", 0.5, 1.0, 0.1)], RULES)
    carts = spark.createDataFrame([("x", ["a", "b"]), ("y", ["z"]), ("z", ["a"])], CARTS)
    assert [r.order_id for r in rules.recommend(carts, table).collect()] == ["z"]
    kept = {r.order_id: r.recommendations for r in rules.recommend(carts, table, keep_empty=True).collect()}
    assert kept == {"x": [], "y": [], "z": ["b"]}


def test_mined_rules_against_counting(spark):
    cleaned = clean_orders(synthetic.synthetic_orders(spark, 50, 800), synthetic.REMOVED_ITEMS).cache()
    baskets = [set(r.order_product_list) for r in cleaned.collect()]
    mined = rules.mine_rules(cleaned, min_transactions=8).collect()

    def count(items):
        return sum(items <= b for b in baskets)

    assert any(len(r.antecedent) > 1 for r in mined)
    for r in mined:
        both, left = count({*r.antecedent, r.consequent}), count(set(r.antecedent))
        right = count({r.consequent}) / len(baskets)
        assert both >= 8
        assert (r.confidence, r.lift, r.support) == pytest.approx((both / left, both / left / right, both / len(baskets)))
    singles = {i for b in baskets for i in b}
    pairs = {(a, b) for a in singles for b in singles if a != b and count({a, b}) >= 8}
    assert {(r.antecedent[0], r.consequent) for r in mined if len(r.antecedent) == 1} == pairs


def test_mining_needs_one_floor(spark):
    with pytest.raises(ValueError):
        rules.mine_rules(spark.createDataFrame([(["a"],)], "order_product_list array<string>"))


def test_relevant_rules_and_ids(spark):
    table = spark.createDataFrame([(["a", "b"], "c", 0.5, 1.0, 0.1), (["d"], "c", 0.5, 1.0, 0.1)], RULES)
    carts = spark.createDataFrame([("x", ["b", "q"])], CARTS)
    assert [r.antecedent for r in rules.relevant_rules(table, carts).collect()] == [["a", "b"]]
    ids = rules.with_rule_id(table)
    assert ids.select("rule_id").distinct().count() == 2


def test_hit_at_k_counts_unmatched_carts(spark):
    carts = spark.createDataFrame([("x", ["a"], "b"), ("y", ["z"], "b"), ("z", ["a"], "q")],
                                  "order_id string, cart array<string>, added string")
    index = rules.index_rules(spark.createDataFrame([(["a"], "b", 0.5, 1.0, 0.1)], RULES))
    popular = spark.createDataFrame([(["b", "q"],)], "popular array<string>")
    report = rules.hit_at_k(carts, rules.rank_consequents(carts, index, 5), popular).first()
    assert tuple(report) == (3, 2, 0.5, pytest.approx(1 / 3), 1.0)


def test_demo_carts_end_to_end(spark):
    cleaned = clean_orders(synthetic.synthetic_orders(spark), synthetic.REMOVED_ITEMS)
    mined = rules.mine_rules(cleaned, min_transactions=500)
    carts = spark.createDataFrame([("DEMO-001", ["pepperoni-pizza", "crazy-bread"]), ("DEMO-002", ["cheese-pizza"])], CARTS)
    got = {r.order_id: r for r in rules.recommend(carts, mined).collect()}
    assert set(got) == {"DEMO-001", "DEMO-002"}
    for r in got.values():
        assert len(r.recommendations) == 5 and not set(r.recommendations) & set(r.cart)
        assert r.scores == sorted(r.scores, reverse=True)
    assert popular_items(cleaned, 5).first().popular and hold_out_last(cleaned, "order_id").count() > 0
