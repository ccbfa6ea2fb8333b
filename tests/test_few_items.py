"""Factors of few items come from systems of the items' size and are those of Spark's ALS."""

import random

import numpy as np
import pytest

from tablewright.operators import factors, few_items

SHARES = "user_id int, item_id int, proportion_of_orders double"


def table(model, side):
    rows = sorted(getattr(model, side).collect())
    return [r.id for r in rows], np.array([r.features for r in rows])


@pytest.mark.parametrize("max_iter, twice", [(1, False), (4, False), (3, True)])
def test_factors_are_those_of_spark(spark, monkeypatch, max_iter, twice):
    """Also with users of one item, shares of zero, and pairs that come twice."""
    draw = random.Random(7)
    rows = [(u, 10 * i, draw.random()) for u in range(90) for i in range(6) if draw.random() < 0.4 or i == u % 6]
    rows += [(200, 0, 1.0), (201, 10, 0.0), (201, 20, 0.5)] + rows[:20] * twice
    shares = spark.createDataFrame(rows, SHARES).repartition(3).persist()
    asked, als = [], factors.ALS
    monkeypatch.setattr(factors, "ALS", lambda **given: asked.append(given) or als(**given))
    monkeypatch.setattr(few_items, "VALUES", 3000)
    model = factors.fit(shares, 14, max_iter)
    assert isinstance(model, few_items.Factors) and model.userFactors.dtypes == als(**asked[0]).fit(shares).userFactors.dtypes
    spark_model = als(**asked[0]).fit(shares)
    for side in ("userFactors", "itemFactors"):
        (ids, mine), (wanted_ids, wanted) = table(model, side), table(spark_model, side)
        assert ids == wanted_ids
        assert mine == pytest.approx(wanted, rel=1e-4, abs=1e-6)
    assert factors.recommend_users(model, 3).count() == 3 * 92
    shares.unpersist()


def test_only_ranks_above_the_items_leave_sparks_fit(spark):
    shares = spark.createDataFrame([(u, i, 0.5) for u in range(8) for i in range(4)], SHARES)
    assert few_items.item_ids(shares, 4) is None and few_items.item_ids(shares, 5) == [0, 1, 2, 3]
    assert not isinstance(factors.fit(shares, 4, 1), few_items.Factors)


def test_a_search_groups_the_users_once(spark, monkeypatch):
    shares = spark.createDataFrame([(u, i, 1 / (1 + (u * i) % 3)) for u in range(12) for i in range(4)], SHARES)
    linked = spark.createDataFrame([(u, u % 4) for u in range(12)], "user_id int, added_item_id int")
    grouped, rows = [], few_items.user_rows
    monkeypatch.setattr(few_items, "user_rows", lambda df: grouped.append(1) or rows(df))
    search = factors.tune(factors.Matrix(shares, None, None), linked, trials=3, ranks=(3, 9), iterations=(1, 2), k=2)
    assert len(search.trials) == 3 and max(t["rank"] for t in search.trials) > 4 and len(grouped) == 1
