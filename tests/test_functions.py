import datetime as dt

from pyspark.sql import functions as F

from starmart.functions import dates, keys, numeric


def test_dates_sunday_week53_padding(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 3),), (dt.date(2018, 5, 1),)], "d date")
    rows = df.select(
        F.weekofyear("d").alias("week"), dates.is_weekend(F.col("d")).alias("we"),
        dates.day_of_week_sun0(F.col("d")).alias("dow"), dates.iso_day_of_week(F.col("d")).alias("isodow"),
        dates.month_name_padded(F.col("d")).alias("mn"), dates.date_key(F.col("d")).alias("dk"),
    ).collect()
    assert (rows[0]["week"], rows[0]["we"], rows[0]["dow"], rows[0]["isodow"]) == (53, True, 0, 7)
    assert rows[1]["mn"] == "May      " and len(rows[1]["mn"]) == 9
    assert rows[1]["dk"] == 20180501 and rows[1]["we"] is False


def test_parse_timestamp_text(spark):
    df = spark.createDataFrame([("1/31/2018 22:56",), ("12/1/2017 3:05",)], "s string")
    out = df.select(dates.parse_timestamp(F.col("s"), df.schema["s"].dataType).alias("t")).collect()
    assert out[0]["t"] == dt.datetime(2018, 1, 31, 22, 56)
    assert out[1]["t"] == dt.datetime(2017, 12, 1, 3, 5)


def test_null_weekend_is_false(spark):
    df = spark.createDataFrame([(None,)], "d date")
    assert df.select(dates.is_weekend(F.col("d"))).first()[0] is False


def test_int_rounding_not_truncation(spark):
    df = spark.createDataFrame([(2.7, "2.7"), (1.2, " 3 ")], "x double, s string")
    r = df.select(numeric.to_int_rounded(F.col("x"), df.schema["x"].dataType).alias("a"),
                  numeric.to_int_rounded(F.col("s"), df.schema["s"].dataType).alias("b")).collect()
    assert [(x["a"], x["b"]) for x in r] == [(3, 3), (1, 3)]


def test_surrogate_key_null_token_and_double_text(spark):
    df = spark.createDataFrame([("a", None, 1e10), ("a", "b", 57.5594)], "x string, y string, z double")
    ks = [r[0] for r in df.select(keys.surrogate_key(df, ["x", "y", "z"])).collect()]
    import hashlib
    assert ks[0] == hashlib.md5(b"a-_null_-10000000000.0000000000").hexdigest()
    assert ks[1] == hashlib.md5(b"a-b-57.5594000000").hexdigest()
