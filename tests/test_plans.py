"""What the plans must look like to hold at scale."""

import re

from pyspark.sql import functions as F
from pyspark.sql.window import Window

import __spark_entry__
from tablewright.operators import rules
from tablewright.operators.ordered import running_by_bucket
from tablewright.plans import roles
from tests.compare import plan, plan_problems

QUERIES = __spark_entry__.queries()


def test_scan_reads_three_columns_and_pushes_filters(spark, sf):
    text = plan(QUERIES["scan_project"](spark, sf))
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>", text)
    assert "GreaterThanOrEqual(l_quantity,45.0)" in text


def test_ranking_shuffles_only_the_carts(spark, sf):
    baskets = roles.baskets(spark, sf)
    index = rules.index_rules(rules.mine_rules(baskets, min_support=0.01))
    carts = baskets.withColumnRenamed("order_product_list", "cart")
    text = plan(rules.rank_consequents(carts, index, 5))
    operators = text.split("\n\n")[0]
    assert len(re.findall(r"(?<!Broadcast)Exchange \(", operators)) == 1
    assert "WindowGroupLimit" in operators


def test_running_values_never_gather_a_whole_key(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(running_by_bucket(df, ["k"], ["t"], F.floor(F.col("t") / 50), row_number="n", total="all"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    placed = re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]\nArguments: hashpartitioning\((.*), \d+\), ENSURE", text)
    assert len(placed) == text.split("\n\n")[0].count("Exchange (")
    # only the bucket totals, without any t, may be placed by the key alone; whole rows are placed once
    assert all("__rows" in columns and " t#" not in columns for columns, keys in placed if "__bucket" not in keys)
    assert [keys.count("#") for columns, keys in placed if " t#" in columns] == [2]


def test_problems_are_found(spark):
    df = spark.range(10)
    assert plan_problems(df.withColumn("n", F.row_number().over(Window.orderBy("id"))))
    assert plan_problems(df.withColumn("n", F.sum("id").over(Window.partitionBy())))
    assert plan_problems(df.crossJoin(df.withColumnRenamed("id", "other")))
    assert not plan_problems(df.withColumn("n", F.row_number().over(Window.partitionBy(F.col("id") % 3).orderBy("id"))))


def test_baskets_place_their_lines_once(spark, sf):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(roles.basket_lists(spark, sf, "p_brand"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # lines and parts by part, then lines by order
    assert text.split("\n\n")[0].count("Exchange (") == 3
