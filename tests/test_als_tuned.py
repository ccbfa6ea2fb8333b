"""The tuned query searches with the defaults and gives lists of the model fitted again."""

import random

from pyspark.sql import functions as F

import __spark_entry__
from tablewright.operators import factors


def test_als_tuned_searches_whole_and_refits(spark, sf, monkeypatch):
    asked, settings = [], []
    tune, refit = factors.tune, factors.refit

    def small(train, validation, **given):
        asked.append(given)
        return tune(train, validation, trials=1, ranks=(2, 3), iterations=(1, 1))

    def noted(orders, search, *rest):
        settings.append(search.best)
        return refit(orders, search, *rest)

    monkeypatch.setattr(factors, "tune", small)
    monkeypatch.setattr(factors, "refit", noted)
    rows = __spark_entry__.queries()["als_tuned"](spark, sf).collect()
    assert asked == [{}] and len(settings) == 1
    assert rows and {(r["rank"], r.max_iter, r.hit) for r in rows} == {tuple(settings[0][c] for c in ("rank", "max_iter", "hit"))}
    assert max(r.place for r in rows) <= 20


def test_each_iteration_lets_go_of_the_last_ones_files(spark, monkeypatch):
    """Factors are written out in every iteration, which changes no number of the model."""
    asked, als = [], factors.ALS
    monkeypatch.setattr(factors, "ALS", lambda **given: asked.append(given) or als(**given))
    rows = [(u, i, 1.0 / (1 + (u * i) % 7)) for u in range(30) for i in range(8) if (u + i) % 3]
    shares = spark.createDataFrame(rows, "user_id int, item_id int, proportion_of_orders double").coalesce(1).persist()
    model = factors.fit(shares, rank=3, max_iter=4)
    assert asked[0]["checkpointInterval"] == 1
    plain = als(**{**asked[0], "checkpointInterval": -1}).fit(shares)
    items = lambda m: {r.id: list(r.features) for r in m.itemFactors.collect()}
    assert items(model) == items(plain)
    shares.unpersist()


def order_pairs(spark):
    draw = random.Random(3)
    shares = [(u, i, 1.0 / (1 + (u * i) % 7)) for u in range(40) for i in range(12) if (u + i) % 3]
    linked = [(draw.randrange(50), draw.randrange(14)) for _ in range(300)] + [(3, 4)] * 20
    return (
        spark.createDataFrame(shares, "user_id int, item_id int, proportion_of_orders double"),
        spark.createDataFrame(linked, "user_id int, added_item_id int"), linked,
    )


def test_hit_rate_counts_every_order(spark):
    """Orders that come several times, of unknown users and of unknown items, beside the lists themselves."""
    shares, asked, linked = order_pairs(spark)
    model = factors.fit(shares, rank=3, max_iter=2)
    lists = {(r.user_id, r.item_id) for r in factors.recommend_users(model, 4).collect()}
    assert len(lists) == 4 * 40
    assert factors.hit_rate(model, asked, 4) == sum(pair in lists for pair in linked) / len(linked)
    assert factors.hit_rate(model, asked.limit(0), 4) is None


def test_trials_read_few_parts_and_a_row_per_user(spark, monkeypatch):
    """Shares reach each fit in no more partitions than they need, and a trial reads users, not orders."""
    shares, asked, linked = order_pairs(spark)
    parts, rows, fit, recommend = [], [], factors.fit, factors.recommend_users
    monkeypatch.setattr(factors, "fit", lambda df, *rest: parts.append(df.rdd.getNumPartitions()) or fit(df, *rest))
    monkeypatch.setattr(factors, "recommend_users", lambda m, k, users: rows.append(users.count()) or recommend(m, k, users))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        matrix = factors.Matrix(shares.groupBy("user_id", "item_id").agg(F.max("proportion_of_orders").alias("proportion_of_orders")), None, None)
        search = factors.tune(matrix, asked, trials=2, ranks=(2, 3), iterations=(1, 1))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert max(parts) <= 2 * spark.sparkContext.defaultParallelism
    assert rows == [len({u for u, _ in linked})] * 2
    assert len(search.trials) == 2 and all(0 < t["hit"] < 1 for t in search.trials)


def test_many_shares_are_cut_into_more_blocks(spark, monkeypatch):
    """Blocks stay of one size, and few shares are cut into as many as before."""
    asked, als = [], factors.ALS
    monkeypatch.setattr(factors, "ALS", lambda **given: asked.append(given) or als(**given))
    shares, _, _ = order_pairs(spark)
    rows = shares.count()
    factors.fit(shares, rank=2, max_iter=1)
    monkeypatch.setattr(factors, "BLOCK_SHARES", rows // 12)
    model = factors.fit(shares, rank=2, max_iter=1)
    assert [(a["numUserBlocks"], a["numItemBlocks"]) for a in asked] == [(10, 10), (13, 13)]
    assert model.userFactors.count() == 40 and model.itemFactors.count() == 12
