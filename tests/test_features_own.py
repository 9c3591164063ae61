"""Features from silver with its own dimensions: the rows that the joins give, without shuffling silver."""

import datetime

from pyspark.sql import functions as F

from starmart.operators import features, marts
from starmart.operators.staging import stage_orders
from starmart.schemas import SILVER_COLUMNS
from starmart.session import written


def silver(spark):
    raw = [(1, 10, 1, 5, "A", "x", 1.0), (2, 10, 1, 5, "A", "y", 1.0), (3, 11, 2, 5, "B", "z", 2.0), (4, 12, None, 6, "C", "q", 3.0),
           (5, 12, None, 6, "D", "q", 3.0), (6, 13, 3, None, "E", "r", 4.0), (7, 14, 4, 7, "F", "s", 5.0)]
    df = spark.createDataFrame(raw, "`Order Item Id` long, `Order Id` long, `Customer Id` long, `Product Card Id` long, `Customer Segment` string, `Customer Street` string, `Product Price` double")
    day = datetime.datetime(2020, 1, 4)
    stg = stage_orders(df.withColumn("order date (DateOrders)", F.lit(day).cast("timestamp_ntz")).withColumn("Latitude", F.lit(1.0)))
    assert stg.columns == SILVER_COLUMNS
    return written(stg)


def test_own_dimensions_give_the_rows_of_the_joins_without_a_shuffle_of_silver(spark):
    stg = silver(spark)
    customers, products = written(marts.dim_customers(stg)), written(marts.dim_products(stg))
    joined = features.fraud_features_from_silver(stg, customers, products, audit=False)
    rows = lambda df: sorted(map(str, df.collect()))
    bounds = marts.sized_dimension.__defaults__
    for n in (bounds[0], 0):                    # versions broadcast, and joined by a shuffle
        marts.sized_dimension.__defaults__ = (n, *bounds[1:])
        try:
            own = features.fraud_features_from_silver(stg, customers, products, audit=False, own_dims=True)
        finally:
            marts.sized_dimension.__defaults__ = bounds
        assert own.schema.simpleString() == joined.schema.simpleString()
        # customer 1 has two streets and product 5 two prices: 2 * 2 rows for each of lines 1 and 2, two for line 3
        assert rows(own) == rows(joined)
        plan = own._jdf.queryExecution().executedPlan().toString()
        assert n == 0 or "hashpartitioning" not in plan


def test_features_written_once_have_the_rows_of_the_joins_and_send_no_attributes(spark, monkeypatch):
    stg = silver(spark)
    # the attributes of customer 2 are the same texts, but at other places
    swapped = stg.where("order_item_id = 3").withColumns({"order_item_id": F.lit(8).cast("long"), "customer_street": F.lit(None).cast("string"), "customer_state": F.col("customer_street")})
    for rows in (stg, stg.unionByName(swapped), stg.where("customer_id > 2 and product_card_id > 5"), stg.limit(0)):
        rows = written(rows)
        joined = features.fraud_features_from_silver(rows, marts.dim_customers(rows), marts.dim_products(rows), audit=False)
        bounds = marts.sized_dimension.__defaults__
        for n in (bounds[0], 0):                    # versions broadcast, and joined by a shuffle
            monkeypatch.setattr(marts.sized_dimension, "__defaults__", (n, *bounds[1:]))
            tables = []
            monkeypatch.setattr(features, "written", lambda t: tables.append(t) or written(t))
            own = features.own_features(rows, audit=False)
            assert own.schema.simpleString() == joined.schema.simpleString()
            assert sorted(map(str, own.collect())) == sorted(map(str, joined.collect()))
            # one pass over silver without a shuffle, then keys and two hashes each
            assert [t.columns for t in tables[1:]] == [["customer_id"], ["product_card_id"]]
            plans = [t._jdf.queryExecution().optimizedPlan().toString() for t in tables]
            assert "Aggregate" not in plans[0] and "Join" not in plans[0]
            assert all("Aggregate" in p and "customer_segment" not in p.split("Relation")[0] and "category_name" not in p.split("Relation")[0] for p in plans[1:])
    assert features.own_features(stg).columns == [*joined.columns, "created_at"]
