import datetime as dt

from pyspark.sql import functions as F

from starmart.operators import features, marts
from starmart.operators.staging import stage_orders
from starmart.sources.fixtures import orders_feed

from conftest import SF_SMALL


def _loc(spark, rows):
    return spark.createDataFrame(rows, "order_item_id long, order_city string, order_state string, "
                                       "order_country string, order_zipcode string, latitude double, "
                                       "longitude double, order_region string")


def test_location_null_keeps_row_with_null_key(spark):
    df = _loc(spark, [(1, "c", "s", "k", "z", None, 1.0, "r"), (2, "c", "s", "k", "z", 2.0, 1.0, "r")])
    out = {r["order_item_id"]: r["shipping_location_id"] for r in marts.attach_location_key(df).collect()}
    assert out[1] is None and out[2] is not None


def test_in_place_key_equals_join_on_dimension(spark):
    stg = stage_orders(orders_feed(spark, SF_SMALL))
    stg = stg.withColumn("latitude", F.when(F.col("order_item_quantity") != 7, F.col("latitude")))
    dim = marts.dim_shipping_location(stg)
    a = marts.attach_location_key(stg).select("order_item_id", "shipping_location_id")
    b = marts.attach_location_key(stg, dim).select("order_item_id", "shipping_location_id")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.where(F.col("shipping_location_id").isNull()).count() > 0


def test_not_in_semantics(spark):
    batch = spark.createDataFrame([(1,), (2,), (None,)], "order_item_id long")
    clean = spark.createDataFrame([(1,)], "order_item_id long")
    with_null = spark.createDataFrame([(1,), (None,)], "order_item_id long")
    empty = spark.createDataFrame([], "order_item_id long")
    assert sorted(r[0] for r in marts.not_in_filter(batch, clean, "order_item_id").collect()) == [2]
    assert marts.not_in_filter(batch, with_null, "order_item_id").count() == 0
    assert marts.not_in_filter(batch, empty, "order_item_id").count() == 3


def test_customer_two_addresses(spark):
    cols = ["customer_id", "customer_first_name", "customer_last_name", "customer_segment", "customer_city",
            "customer_state", "customer_country", "customer_street", "customer_zipcode"]
    rows = [(1, "a", "b", "s", "c", "st", "co", "street 1", "z", dt.datetime(2020, 1, 1), 10),
            (1, "a", "b", "s", "c", "st", "co", "street 2", "z", dt.datetime(2021, 1, 1), 11)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" if c != "customer_id" else "customer_id long"
                                                  for c in cols) + ", order_date timestamp, order_item_id long")
    assert marts.dim_customers(df).count() == 2
    latest = marts.dim_customers(df, dedupe="latest").collect()
    assert len(latest) == 1 and latest[0]["customer_street"] == "street 2"


def test_feature_forms_agree(spark):
    stg = stage_orders(orders_feed(spark, SF_SMALL))
    dc, dp = marts.dim_customers(stg), marts.dim_products(stg)
    a = features.fraud_features_from_silver(stg, dc, dp, label_value="P", audit=False)
    b = features.fraud_features(marts.fact_order_items(stg), dc, dp, marts.dim_date(stg),
                                marts.dim_shipping_location(stg), label_value="P", audit=False)
    assert a.columns == b.columns and len(a.columns) == 29
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    f = features.fraud_features_from_silver(stg, dc, dp)
    assert len(f.columns) == 30 and "created_at" in f.columns
    for pii in ("customer_first_name", "customer_street", "customer_zipcode", "delivery_status"):
        assert pii not in f.columns


def test_fact_incremental_merge_updates(spark):
    stg = stage_orders(orders_feed(spark, SF_SMALL))
    fact = marts.fact_order_items(stg)
    old = fact.limit(10).withColumn("sales", F.lit(-1.0))
    merged = marts.fact_incremental(stg, old, mode="merge")
    assert merged.count() == fact.count()
    assert merged.where(F.col("sales") == -1.0).count() == 0
    assert marts.fact_incremental(stg, fact, mode="new_only").count() == 0


def test_sized_dimension_broadcasts_within_bound_only(spark, tmp):
    fact = spark.createDataFrame([(i, i % 4) for i in range(200)] + [(999, None)], "id long, k long")
    dim = spark.createDataFrame([(0, "a"), (1, "b"), (1, "b2"), (3, "d")], "k long, name string")
    dim.write.parquet(f"{tmp}/dim")
    written = spark.read.parquet(f"{tmp}/dim")
    derived = dim.groupBy("k", "name").count().select("k", "name")
    results = []
    for d, bound, table in ((written, 10, True), (derived, 10, False), (written, 0, True)):
        joined = fact.join(marts.sized_dimension(d, max_rows=bound, is_table=table), "k", "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        if bound:
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        results.append(sorted((r["id"], r["k"], r["name"]) for r in joined.collect()))
    over = fact.join(marts.sized_dimension(written, is_table=True, max_bytes=3).hint("merge"), "k", "left")
    assert "BroadcastHashJoin" not in over._jdf.queryExecution().executedPlan().toString()
    # key 1 has two attribute rows and fans out; key 2 and the null key find none
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == 201 + 50
