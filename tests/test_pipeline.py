"""End to end on the smallest tables: land two runs, build, test, train, score, publish."""

from pyspark.sql import functions as F

from starmart.operators import modeling
from starmart.plans import pipeline
from starmart.sources.fixtures import orders_feed

from conftest import SF_SMALL


def test_end_to_end(spark, tmp):
    wh = pipeline.Warehouse(f"{tmp}/wh")
    feed = orders_feed(spark, SF_SMALL).withColumn(
        "Order Status", F.when((F.col("Order Status") == "P") & (F.col("Type") == "1-URGENT"),
                               F.lit("SUSPECTED_FRAUD")).otherwise(F.col("Order Status")))
    early = feed.where(F.col("order date (DateOrders)") < F.lit("1998-01-01").cast("timestamp_ntz"))
    v1 = pipeline.land_and_validate(spark, wh, early, 1).collect()
    v2 = pipeline.land_and_validate(spark, wh, feed, 2).collect()
    assert v1[0]["validation_status"] == "passed" and v2[0]["validation_status"] == "passed"
    raw = wh.read(spark, "raw/orders_raw")
    assert raw.count() == feed.count()                           # second run landed only new rows

    pipeline.build_warehouse(spark, wh)
    tests = pipeline.check_models(spark, wh)
    assert tests.count() == 51
    assert tests.where(~F.col("passed")).count() == 0
    fact = spark.read.parquet(wh.path("warehouse/fact_order_items"))
    assert fact.count() == feed.count() and "month_key" in fact.columns
    assert fact.where("month_key = 199601").count() == fact.where("date_key div 100 = 199601").count()
    pipeline.build_warehouse(spark, wh)                          # incremental rerun adds nothing
    assert spark.read.parquet(wh.path("warehouse/fact_order_items")).count() == feed.count()

    metrics = pipeline.train(spark, wh, forest=modeling.ForestParams(num_trees=10, max_depth=5))
    assert 0.0 <= metrics["roc_auc"] <= 1.0
    assert metrics["tp"] + metrics["fp"] + metrics["fn"] + metrics["tn"] > 0
    d = metrics["at_threshold_0_5"]
    assert d["tp"] + d["fp"] + d["fn"] + d["tn"] == metrics["tp"] + metrics["fp"] + metrics["fn"] + metrics["tn"]

    state = pipeline.predict_new(spark, wh)
    n_orders = spark.read.parquet(wh.path("warehouse/fraud_features")).select("order_id").distinct().count()
    assert state.count() == n_orders
    assert state.select("order_id").distinct().count() == n_orders
    again = pipeline.predict_new(spark, wh)                      # idempotent: nothing new
    assert again.count() == n_orders
    one = spark.createDataFrame([(state.first()["order_id"],)], "order_id long")
    up = pipeline.predict_new(spark, wh, order_ids=one)
    assert up.count() == n_orders

    stats = pipeline.publish(spark, wh, f"{tmp}/serving")
    assert stats.where(F.col("status") != "ok").count() == 0
    stats2 = pipeline.publish(spark, wh, f"{tmp}/serving")
    st = {r["table"]: r for r in stats2.collect()}
    assert st["warehouse.dim_products"]["mode"] == "skip"
    assert st["warehouse.fact_order_items"]["inserted"] == 0
    assert st["warehouse.predictions"]["inserted"] == 0
