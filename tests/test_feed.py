"""The feed's joins: what they number and what crosses the network."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starmart.sources.fixtures import orders_feed


@pytest.fixture
def tables(spark, tmp):
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp}/{name}.parquet")
    day = datetime(1996, 3, 1)
    put("region", [(0, "R")], "r_regionkey int, r_name string")
    put("nation", [(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int")
    put("customer", [(1, "a", 0, 1.0, "m"), (1, "b", 0, 1.0, "m"), (2, "c", None, 1.0, "m")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    put("supplier", [(7, "s", 0, 100.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")
    put("part", [(5, "p", "Brand#11", "t", 3, 9.0), (5, "q", "Brand#12", "t", 3, 9.0)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    put("orders", [(10, 1, "F", 5.0, day, "1-URGENT"), (11, 2, "O", 5.0, day, "5-LOW")], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    line = lambda order, part, supp, qty: (order, part, supp, 1, qty, 2.0, 0.1, 0.0, "A", "F", day)
    put("lineitem", [line(10, 5, 7, 1.0), line(10, 6, 7, 2.0), line(10, 6, 7, 2.0), line(11, 6, 8, 1.0), line(12, 6, 7, 1.0)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    return tmp


def test_feed_numbers_lines_once_where_customers_and_parts_share_a_key(spark, tables):
    rows = orders_feed(spark, tables).select("Order Item Id", "Customer Fname", "Product Name", "Order City", "Customer State").collect()
    got = sorted((r[0], r[1] or "", r[2] or "", r[3] or "", r[4] or "") for r in rows)
    first = 10 * 100000 + 10000
    assert got == sorted([(first + 1, c, p, "s", "N") for c in "ab" for p in "pq"] + [(first + i, c, "", "s", "N") for c in "ab" for i in (2, 3)]
                         + [(11 * 100000 + 10001, "c", "", "", ""), (12 * 100000 + 10001, "", "", "s", "")])


def test_feed_shuffles_lines_by_order_and_part_alone(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = orders_feed(spark, tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = sorted(re.findall(r"Exchange hashpartitioning\((\w+)#", plan))
    assert keys == ["c_custkey", "l_orderkey", "l_partkey", "o_custkey", "o_orderkey", "p_partkey"]


def test_feed_numbers_copies_of_an_order_and_sorts_lines_once(spark, tables):
    orders = spark.read.parquet(f"{tables}/orders.parquet")
    extra = orders.where("o_orderkey = 10")
    extra.withColumn("o_custkey", F.lit(2).cast("long")).unionByName(extra).write.mode("append").parquet(f"{tables}/orders.parquet")
    feed = orders_feed(spark, tables)
    rows = feed.where("`Order Id` = 10 AND `Product Card Id` = 6").select("Order Item Id", "Customer Id").collect()
    lone = feed.where("`Order Id` = 11").select("Order Item Id").collect()
    # two equal lines of three orders, of which two have two customers each and one has one
    ids = [r[0] - 1010000 for r in rows]
    assert [r[0] for r in lone] == [1110001]
    assert sorted(set(ids)) == [4, 5, 6, 7, 8, 9]         # 1 to 3 are the line of product 5
    assert sorted(ids.count(i) for i in set(ids)) == [1, 1, 2, 2, 2, 2]
    assert all(ids.count(r[0] - 1010000) == (1 if r[1] == 2 else 2) for r in rows)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = orders_feed(spark, tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sorts = [x for x in re.findall(r"Sort \[(\w+)#", plan) if x == "l_orderkey"]
    assert len(sorts) == 1
