import math

from pyspark.sql import functions as F

from starmart.operators import quality
from starmart.operators.staging import stage_orders
from starmart.sources.files import read_feed_csv


def _checks(df):
    return {(r["check"], r["column_name"]): r["failing_rows"] for r in df.collect()}


def test_blank_vs_null_and_csv(spark, tmp):
    path = f"{tmp}/feed.csv"
    # Latin-1 file with padded header names and the capital-S shipping date
    header = ("Order Item Id,Order Id,Customer Lname,Customer Zipcode,order date (DateOrders),"
              "Shipping date (DateOrders)   ,Order Item Quantity,Product Status,Customer City\n")
    body = ("1,10,,,1/31/2018 22:56,2/2/2018 10:00,2,0,Bogot\xe1\n"
            "2,10,  ,NA,1/31/2018 22:56,2/2/2018 10:00,3.0,1,x\n"
            "3,11, Ann ,  , 2/1/2018 0:00,2/3/2018 1:00,1,0,y\n")
    with open(path, "w", encoding="latin-1") as f:
        f.write(header + body)
    raw = read_feed_csv(spark, path)
    stg = stage_orders(raw).orderBy("order_item_id").collect()
    assert [r["customer_last_name"] for r in stg] == ["Unknown", "", "Ann"]
    assert [r["customer_zipcode"] for r in stg] == ["Unknown", "Unknown", ""]
    assert stg[0]["customer_city"] == "Bogotá"
    assert stg[1]["order_item_quantity"] == 3 and stg[0]["date_key"] == 20180131
    assert stg[2]["shipping_date"].day == 3
    assert stg[0]["order_city"] is None and stg[0]["order_zipcode"] == "Unknown"


def _frame(spark, rows):
    schema = ("`Order Id` long, `Order Item Id` long, `Product Card Id` long, `order date (DateOrders)` string, "
              "`Order Item Quantity` double, `Order Status` string, `Sales` double, "
              "`Order Item Discount Rate` double, `Late_delivery_risk` long")
    return spark.createDataFrame(rows, schema)


def test_landing_rules_edge_frames(spark):
    nan = float("nan")
    rows = [
        # id dup 1,1 ; null twice ; late flag 0,1,2,null ; discount -0.1,0,1,1.1,null,NaN
        (1, 1, 1, "d", 1.0, "CANCELED", -5.0, -0.1, 0),
        (1, 1, 1, "d", 1.0, "SUSPECTED_FRAUD", -5.0, 0.0, 1),
        (1, 2, 1, "d", 0.0, "COMPLETE", -5.0, 1.0, 2),
        (1, None, 1, None, 2.0, None, -5.0, 1.1, None),
        (None, None, 1, "d", nan, "COMPLETE", 3.0, None, 1),
        (2, 3, None, "d", 5.0, "COMPLETE", 4.0, nan, 0),
    ]
    res = _checks(quality.landing_checks(_frame(spark, rows)))
    assert res[("duplicates", "Order Item Id")] == 2          # keys 1,1,2,null,null,3
    assert res[("accepted_values_0_1", "Late_delivery_risk")] == 2   # 2 and null
    assert res[("range_0_1", "Order Item Discount Rate")] == 2       # -0.1 and 1.1, not NaN
    assert res[("non_negative_unless_exempt", "Sales")] == 2         # COMPLETE and null status
    assert res[("min_value", "Order Item Quantity")] == 1            # 0.0 (NaN not counted)
    assert res[("not_null", "Order Id")] == 1
    assert res[("not_null", "Order Item Id")] == 2
    assert res[("not_null", "Product Card Id")] == 1
    assert res[("not_null", "order date (DateOrders)")] == 1
    msgs = quality.messages(quality.landing_checks(_frame(spark, rows)))
    assert len(msgs) == 9


def test_landing_checks_per_run(spark):
    rows = [(1, 1, 1, "d", 1.0, "C", 1.0, 0.1, 0, 7), (1, 1, 1, "d", 1.0, "C", 1.0, 0.1, 0, 8),
            (1, 2, 1, "d", 1.0, "C", 1.0, 0.1, 0, 8)]
    df = spark.createDataFrame([r[:9] for r in rows], _frame(spark, []).schema).withColumn("run", F.lit(0))
    df = df.withColumn("run", F.when(F.col("`Order Item Id`") == 1, F.lit(7)).otherwise(F.lit(8)))
    res = quality.landing_checks(df, by=["run"]).where(F.col("check") == "duplicates").collect()
    assert {r["run"]: r["failing_rows"] for r in res} == {7: 1, 8: 0}


def test_unique_relationships_not_null(spark):
    child = spark.createDataFrame([(1,), (2,), (None,), (9,)], "k long")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long")
    assert quality.unique(parent, "k").first()["failing_rows"] == 1
    assert quality.relationships(child, "k", parent, "k").first()["failing_rows"] == 1
    assert quality.not_null(child, ["k"]).first()["failing_rows"] == 1


def test_model_suite_has_51_tests():
    from collections import Counter
    c = Counter(t.test for t in quality.MART_TESTS)
    assert (c["unique"], c["not_null"], c["relationships"]) == (7, 40, 4)


def test_tolerance(spark):
    df = spark.createDataFrame([(None, "A"), (1.0, "B"), (2.0, "Z")] + [(1.0, "A")] * 97, "x double, s string")
    res = {r["check"]: r for r in quality.tolerance_checks(df, ["x"], 0.015, status_column="s",
                                                         allowed=["A", "B"]).collect()}
    assert res["null_fraction"]["passed"] and math.isclose(res["null_fraction"]["fraction"], 0.01)
    assert res["accepted_values"]["failing_rows"] == 1


def test_fused_suite_matches_single_checks_with_hot_key(spark):
    # one key holds a third of the child rows; two child tables, three parents
    child = spark.createDataFrame([(7, "a") if i % 3 == 0 else (i, "b" if i % 5 else None) for i in range(300)],
                                  "k long, s string")
    other = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long")
    p_k = spark.createDataFrame([(i,) for i in range(0, 250)], "k long")
    p_s = spark.createDataFrame([("a",), ("c",)], "s string")
    rel = quality.relationships_many([("child", child, "k", p_k, "k"), ("child", child, "s", p_s, "s"),
                                      ("other", other, "k", p_k, "k")])
    got = {(r["model"], r["column_name"]): r["failing_rows"] for r in rel.collect()}
    assert got == {("child", "k"): sum(1 for i in range(250, 300) if i % 3), ("child", "s"): sum(1 for i in range(300) if i % 3 and i % 5),
                   ("other", "k"): 0}
    for m, df, c, p, f in [("child", child, "k", p_k, "k"), ("child", child, "s", p_s, "s")]:
        assert quality.relationships(df, c, p, f, m).first()["failing_rows"] == got[(m, c)]
    uq = quality.unique_many([("child", child, "k"), ("other", other, "k"), ("p", p_k, "k")])
    got_u = {r["model"]: (r["failing_rows"], r["passed"]) for r in uq.collect()}
    assert got_u == {"child": (1, False), "other": (1, False), "p": (0, True)}
