import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablewright.operators import features, orders
from tablewright.operators.split import feature_target_split, hash_sample, hash_split, temporal_split
from tablewright.sources import synthetic

RAW = "mpid string, order_id string, order_products string, order_timestamp string"


def raw(spark):
    return spark.createDataFrame(
        [
            ("u1", "o2", " cheese-pizza ,pepsi,cheese-pizza", "2023-01-02 10:00:00"),
            ("u1", "o1", "pepsi, plastic-fork,, crazy-bread", "2023-01-02 10:00:00"),
            ("u1", "o0", "pepsi", "2023-01-01 00:00:00"),
            ("u2", "o3", "plastic-fork, ranch-dressing", "2023-01-01 00:00:00"),
            ("u2", "o4", "", "2023-01-01 00:00:00"),
            ("u2", "o5", "supreme-pizza", "2023-03-01 00:00:00"),
        ],
        RAW,
    )


def test_clean_orders(spark):
    got = orders.clean_orders(raw(spark), synthetic.REMOVED_ITEMS).collect()
    assert {r.order_id: (r.order_product_list, r.order_number) for r in got} == {
        "o0": (["pepsi"], 1),
        "o1": (["pepsi", "crazy-bread"], 2),
        "o2": (["cheese-pizza", "pepsi"], 3),
        "o5": (["supreme-pizza"], 1),
    }


def test_support_popular_and_hold_out(spark):
    cleaned = orders.clean_orders(raw(spark), synthetic.REMOVED_ITEMS)
    support = {r["item"]: (r["count"], r["support"]) for r in orders.item_support(cleaned).collect()}
    assert support["pepsi"] == (3, 0.75) and support["supreme-pizza"] == (1, 0.25)
    assert orders.popular_items(cleaned, 2).first().popular == ["pepsi", "cheese-pizza"]
    held = {r.order_id: (r.cart, r.added) for r in orders.hold_out_last(cleaned, "order_id").collect()}
    assert held == {"o1": (["pepsi"], "crazy-bread"), "o2": (["cheese-pizza"], "pepsi")}


def basket(user, order, items, day):
    return (user, order, items, dt.datetime(2023, 1, 1) + dt.timedelta(days=day))


BASKETS = "mpid string, order_id string, order_product_list array<string>, order_timestamp timestamp"


def test_user_features_at_the_edges(spark):
    rows = []
    for user, n, last in (("three", 3, 100), ("four", 4, 70), ("seven", 7, 69), ("eight", 8, 10), ("now", 1, 100), ("old", 1, 9)):
        rows += [basket(user, f"{user}{i}", ["pepsi", "unknown"], last - i) for i in range(n)]
    rows += [basket("tie", "t", ["pepsi", "crazy-bread", "pepsi2", "pepsi3"], 100)]
    got = {r.mpid: r for r in features.user_features(
        spark.createDataFrame(rows, BASKETS), synthetic.item_catalog(spark)).collect()}
    assert [got[u].customer_tier for u in ("three", "four", "seven", "eight")] == ["Bronze", "Silver", "Silver", "Gold"]
    assert [(got[u].days_since_last_order, got[u].recency_bucket) for u in ("now", "four", "seven", "eight", "old")] == [
        (0, "Active"), (30, "Active"), (31, "Lapsed"), (90, "Lapsed"), (91, "Churned")]
    assert got["now"].lifetime_spend == 2.49 and got["now"].preferred_category is None
    assert got["tie"].preferred_category is None and got["tie"].avg_order_size == 4.0


def test_encodings_and_interactions(spark):
    rows = [basket("u", "a", ["pepsi", "crazy-bread"], 0), basket("v", "b", ["pepsi"], 1)]
    train = spark.createDataFrame(rows, BASKETS)
    test = spark.createDataFrame([basket("u", "c", ["pepsi", "new-item"], 2), basket("w", "d", ["pepsi"], 2)], BASKETS)
    catalog = synthetic.item_catalog(spark)
    users = features.encode_users(features.user_features(train, catalog).where("mpid = 'v'"))
    pairs = orders.explode_items(train, "mpid")
    from tablewright.operators.ordered import vocabulary

    got = features.interactions(
        test, vocabulary(pairs, "mpid", "user_idx"), vocabulary(pairs, "item", "item_idx"), users,
        features.encode_items(catalog),
    ).collect()
    assert len(got) == 1
    assert (got[0].user_idx, got[0].item_idx) == (0, 0)
    assert got[0].u_total_orders == 0.0 and got[0].i_category_enc == 2.0 and got[0].i_base_price == 2.49


def test_unseen_report_and_share(spark):
    pairs = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 2)], "user_id int, item_id int")
    share = {(r.user_id, r.item_id): r.proportion_of_orders for r in features.interaction_share(pairs).collect()}
    assert share == {(1, 1): 2 / 3, (1, 2): 1 / 3, (2, 2): 1.0}
    known = spark.createDataFrame([(1,)], "user_id int"), spark.createDataFrame([(1,), (2,)], "item_id int")
    report = features.unseen_report(pairs, [("user_id", known[0]), ("item_id", known[1])]).first()
    assert tuple(report) == (4, 3, 1)


def test_hash_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(5000)
    parts = hash_split(df, ["id"], [0.64, 0.16, 0.2])
    ids = [{r.id for r in p.collect()} for p in parts]
    assert sum(map(len, ids)) == 5000 and set.union(*ids) == set(range(5000))
    again = [{r.id for r in p.collect()} for p in hash_split(df.repartition(13), ["id"], [0.64, 0.16, 0.2])]
    assert ids == again
    assert 2900 < len(ids[0]) < 3500
    assert 800 < hash_sample(df, ["id"], 0.2).count() < 1200


def test_feature_target_split_leaves_the_id_out(spark):
    train, test = feature_target_split(synthetic.synthetic_wide(spark, 500, 3, 2), "id", "target")
    assert train.columns == ["r_0", "r_1", "r_2", "target"] and train.count() + test.count() == 500


@pytest.mark.parametrize("n", [1, 2, 5, 9])
def test_temporal_split(spark, n):
    df = spark.range(n).select(
        F.lit("u").alias("u"), F.col("id").alias("o"), F.timestamp_seconds(F.col("id") * 4000).alias("ts"))
    got = {r.o: r.split for r in temporal_split(df, "u", "ts", "o").collect()}
    first = -(-n * 4 // 5)
    assert [got[i] for i in range(n)] == ["train"] * first + ["test"] * (n - first)
