"""Medians by rank search, months rebuilt in place, partitions pruned by the days asked for."""

import random
import statistics

from pyspark.sql import functions as F

from starmart.operators import marts, measures


def test_median_of_many_values_hot_groups_and_nulls(spark):
    r = random.Random(1)
    rows = [("hot", None, r.random()) for _ in range(900)] + [("hot", "x", 1.0)] * 4 + [(None, "x", float(i)) for i in range(7)] + [("one", None, 5.0), ("gone", "y", None)]
    df = spark.createDataFrame(rows, "a string, b string, v double").repartition(5)
    want = {}
    for a, b, v in rows:
        if v is not None:
            want.setdefault((a, b), []).append(v)
    got = {(x["a"], x["b"]): x["median_v"] for x in measures.median_by_histogram(df, ["a", "b"], "v").collect()}
    assert got == {k: statistics.median(v) for k, v in want.items()}
    assert measures.median_by_histogram(df.limit(0), ["a"], "v").count() == 0
    both = {(x["a"], x["b"]): (x["avg_v"], x["median_v"]) for x in measures.ship_days_avg_median(df, ["a", "b"], "v").collect()}
    assert both[(None, "x")] == (3.0, 3.0) and both[("gone", "y")] == (None, None)
    plan = measures.median_by_histogram(df, ["a"], "v")._jdf.queryExecution().optimizedPlan().toString()
    assert all("_part" in line for line in plan.splitlines() if "Window [" in line)


def fact(spark, add):
    rows = [(i, 19960000 + 100 * (1 + i % 12) + 1 + i % 28, float(i) + add) for i in range(600)]
    return spark.createDataFrame(rows, "order_item_id long, date_key int, sales double")


def test_rebuild_touches_only_its_months(spark, tmp):
    path = f"{tmp}/fact"
    fact(spark, 0.5).withColumn("month_key", marts.month_key()).write.partitionBy("month_key").parquet(path)
    before = {f for f in spark.read.parquet(path).inputFiles()}
    marts.rebuild_months(fact(spark, 0.0), spark.createDataFrame([(199603,), (199603,), (199607,), (202001,), (None,)], "month_key int"), path)
    table = spark.read.parquet(path)
    assert table.count() == 600
    assert {r["month_key"] for r in table.where("sales = floor(sales)").select("month_key").distinct().collect()} == {199603, 199607}
    changed = set(table.inputFiles()) ^ before
    assert changed and all("month_key=199603" in f or "month_key=199607" in f for f in changed)


def test_days_prune_the_partitions(spark, tmp):
    path = f"{tmp}/fact"
    fact(spark, 0.0).withColumn("month_key", marts.month_key()).write.partitionBy("month_key").parquet(path)
    spark.createDataFrame([(19960000 + 100 * m + d, m) for m in range(1, 13) for d in range(1, 29)], "date_key int, month int").write.parquet(f"{tmp}/days")
    got = marts.sales_of_days(spark.read.parquet(path), spark.read.parquet(f"{tmp}/days").where("month = 4"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    want = fact(spark, 0.0).where("date_key div 100 = 199604").agg(F.count("*"), F.sum("sales")).first()
    assert [tuple(r) for r in got.collect()] == [(199604, *want)]
