"""Adapter from the TPC-H-style test tables to the raw order-line feed.

The reference's own feed file is not shipped, so the test tables are mapped
onto the raw column names (typed, not text: staging casts either form).

``(l_orderkey, l_linenumber)`` is not unique in the tables, so the line id is
``l_orderkey*100000 + l_linenumber*10000 + seq`` with ``seq`` numbering the
duplicates of one pair by all remaining lineitem columns.  Lines are hashed
by ``l_orderkey``, as the orders join needs them, so the window adds no
exchange of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.operators.marts import sized_dimension

LINE_ORDER_COLUMNS = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
ORDER_COLUMNS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _nation_region(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    # nation (25) and region (5) are fixed-size reference tables: broadcast is
    # bounded by definition.
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    r = spark.read.parquet(f"{sf_dir}/region.parquet")
    return (n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left")
            .select(F.col("n_nationkey").alias(f"{prefix}_nationkey"),
                    F.col("n_name").alias(f"{prefix}_nation"),
                    F.col("r_name").alias(f"{prefix}_region")))


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-named order-line feed built from lineitem and its parents."""
    rd = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    li, o, c, p, s = rd("lineitem"), rd("orders"), rd("customer"), rd("part"), rd("supplier")

    # Lines cross the network twice, by order and then by part: customers join
    # the orders, of which there are fewer, suppliers are broadcast within the
    # bound, and the names of nations and regions come last, so that no shuffle
    # carries them.  Lines are numbered before the joins, in the sort that the
    # join by order needs anyway; the m copies of an order that shares its key
    # take m numbers a line, and customers that share a key none.
    nth = F.row_number().over(Window.partitionBy("c_custkey").orderBy("c_name", "c_nationkey", "c_mktsegment"))
    cust = c.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment").withColumn("c_nth", nth)
    # place of an order among those of its key: equal rows by i, others by what comes before
    same = Window.partitionBy("o_orderkey", *ORDER_COLUMNS)
    one = (F.coalesce("c_nth", F.lit(1)) == 1).cast("int")
    i = F.row_number().over(Window.partitionBy("o_orderkey", *ORDER_COLUMNS, "c_nth").orderBy("c_nth"))
    oc = (o.join(cust, o.o_custkey == cust.c_custkey, "left").repartition("o_orderkey").withColumn("o_nth", i)
          .withColumn("o_nth", F.sum(one).over(Window.partitionBy("o_orderkey").orderBy(*ORDER_COLUMNS)) - F.sum(one).over(same) + F.col("o_nth"))
          .withColumn("o_copies", F.sum(one).over(Window.partitionBy("o_orderkey"))))
    w = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*LINE_ORDER_COLUMNS)
    numbered = li.repartition("l_orderkey").withColumn("l_nth", F.row_number().over(w))
    lo = numbered.join(oc, numbered.l_orderkey == oc.o_orderkey, "left")
    lo = lo.withColumn("seq", (F.col("l_nth") - 1) * F.coalesce("o_copies", F.lit(1)) + F.coalesce("o_nth", F.lit(1)))

    supp = sized_dimension(s.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal"), is_table=True)
    cn, sn = (F.broadcast(_nation_region(spark, sf_dir, x)) for x in ("cn", "sn"))
    feed = (lo.join(p, lo.l_partkey == p.p_partkey, "left")
              .join(supp, lo.l_suppkey == supp.s_suppkey, "left")
              .join(cn, F.col("c_nationkey") == F.col("cn_nationkey"), "left")
              .join(sn, F.col("s_nationkey") == F.col("sn_nationkey"), "left"))

    ship_days = F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date"))
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return feed.select(
        (F.col("l_orderkey") * 100000 + F.col("l_linenumber") * 10000 + F.col("seq")).alias("Order Item Id"),
        F.col("l_orderkey").alias("Order Id"),
        F.col("o_custkey").alias("Customer Id"),
        F.col("l_partkey").alias("Product Card Id"),
        F.col("o_orderdate").alias("order date (DateOrders)"),
        F.col("l_shipdate").alias("shipping date (DateOrders)"),
        F.col("c_name").alias("Customer Fname"),
        F.lit(None).cast("string").alias("Customer Lname"),
        F.col("c_mktsegment").alias("Customer Segment"),
        F.col("cn_region").alias("Customer City"),
        F.col("cn_nation").alias("Customer State"),
        F.col("cn_nation").alias("Customer Country"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")).alias("Customer Street"),
        F.col("c_nationkey").cast("string").alias("Customer Zipcode"),
        F.col("p_name").alias("Product Name"),
        F.col("p_retailprice").alias("Product Price"),
        F.when(F.col("p_size") > 25, 1).otherwise(0).alias("Product Status"),
        F.col("p_size").alias("Category Id"),
        F.col("p_type").alias("Category Name"),
        F.substring(F.col("p_brand"), 7, 10).cast("int").alias("Department Id"),
        F.col("p_brand").alias("Department Name"),
        F.col("o_orderpriority").alias("Type"),
        F.col("l_linestatus").alias("Delivery Status"),
        F.col("o_orderstatus").alias("Order Status"),
        F.when(ship_days > 60, 1).otherwise(0).alias("Late_delivery_risk"),
        ship_days.cast("double").alias("Days for shipping (real)"),
        F.lit(60.0).alias("Days for shipment (scheduled)"),
        F.col("l_returnflag").alias("Shipping Mode"),
        F.col("l_extendedprice").alias("Sales"),
        net.alias("Sales per customer"),
        F.col("o_totalprice").alias("Benefit per order"),
        (F.col("o_totalprice") * 0.25).alias("Order Profit Per Order"),
        net.alias("Order Item Total"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("Order Item Discount"),
        F.col("l_discount").alias("Order Item Discount Rate"),
        F.col("l_tax").alias("Order Item Profit Ratio"),
        F.col("l_quantity").alias("Order Item Quantity"),
        F.col("s_name").alias("Order City"),
        F.col("sn_nation").alias("Order State"),
        F.col("sn_nation").alias("Order Country"),
        F.lit(None).cast("string").alias("Order Zipcode"),
        (F.col("s_acctbal") / 100).alias("Latitude"),
        (F.col("s_nationkey").cast("double") * 7.5 - 90.0).alias("Longitude"),
        F.col("sn_region").alias("Order Region"),
    )
