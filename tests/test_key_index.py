"""Which landed files an anti join opens, and the skip that notices replaced rows."""

import pytest
from pyspark.sql import functions as F

from starmart.operators import key_index, landing, quality, runs, sync
from starmart.operators.key_index import KeyIndex

SCHEMA = "k long, x string"


def batch(spark, keys, x="b"):
    return spark.createDataFrame([(k, x) for k in keys], SCHEMA).coalesce(1)


@pytest.fixture
def landed(spark, tmp):
    """Three runs: two with ranges of their own, and even keys that overlap both."""
    raw, index = f"{tmp}/raw", KeyIndex(f"{tmp}/index", "k")
    landing.land(spark, batch(spark, range(1, 2000, 2)), raw, 1, "k", index=index)
    landing.land(spark, batch(spark, range(10_001, 12_000, 2)), raw, 2, "k", index=index)
    landing.land(spark, batch(spark, range(0, 20_000, 8)), raw, 3, "k", index=index)
    return raw, index


def opened(spark, raw, index, keys):
    return sorted({f.split("etl_run_id=")[1].split("/")[0] for f in index.candidates(batch(spark, keys), landing.landed_files(spark, raw))})


def test_files_of_disjoint_runs_are_not_opened(spark, landed):
    raw, index = landed
    assert opened(spark, raw, index, [1, 3, 5]) == ["1"]                    # run 3's range has them, its filter doesn't
    assert opened(spark, raw, index, [8, 10_003]) == ["2", "3"]
    assert opened(spark, raw, index, [30_000, -5]) == []
    assert opened(spark, raw, index, []) == []
    assert opened(spark, raw, index, [None]) == []


def test_more_keys_than_probes_open_a_file_unseen(spark, landed, monkeypatch):
    raw, index = landed
    monkeypatch.setattr(key_index, "PROBES", 1)
    assert opened(spark, raw, index, [1, 3, 5]) == ["1", "3"]
    monkeypatch.setattr(key_index, "MAX_FILES", 1)
    assert opened(spark, raw, index, [1, 3, 10_001]) == ["1", "2", "3"]


def test_landing_with_an_index_gives_the_same_rows(spark, landed, tmp):
    raw, index = landed
    new = batch(spark, [1, 2, 8, 10_001, 10_002, 50_000, 50_000, None, None, -1], "new")
    plain = landing.new_rows(new, landing.read_raw(spark, raw), "k")
    got = landing.land(spark, new, raw, 4, "k", index=index)
    assert sorted(map(str, got.select("k", "x").collect())) == sorted(map(str, plain.collect())) and got.count() == 7
    # a file without an entry is always read
    batch(spark, [77_777]).withColumn("etl_run_id", F.lit(5)).write.mode("append").partitionBy("etl_run_id").parquet(raw)
    assert opened(spark, raw, index, [77_777]) == ["5"]
    assert landing.land(spark, batch(spark, [77_777]), raw, 6, "k", index=index).count() == 0
    index.add(landing.read_raw(spark, raw))
    assert opened(spark, raw, index, [40_000]) == ["4"] or opened(spark, raw, index, [40_000]) == []
    empty = KeyIndex(f"{tmp}/none", "k")
    assert landing.land(spark, new, f"{tmp}/fresh", 1, "k", index=empty).count() == 10


def test_row_digest_sees_replaced_rows_not_order(spark, tmp):
    rows = [(1, "a", None), (2, None, "b"), (2, None, "b"), (3, "", "")]
    a = spark.createDataFrame(rows, "k int, v string, w string")
    same = spark.createDataFrame(rows[::-1], "k int, v string, w string").repartition(3).select("w", "k", "v")
    assert runs.same_rows(a, same)
    for other in ([(1, "a", None), (2, "b", None), (2, None, "b"), (3, "", "")], [(1, "a", None), (2, None, "b"), (3, "", ""), (3, "", "")], rows[:3]):
        assert not runs.same_rows(a, spark.createDataFrame(other, "k int, v string, w string"))
    assert not runs.same_rows(a, a.withColumnRenamed("w", "z"))
    assert runs.same_rows(a.limit(0), a.limit(0))
    # landing and sync skip by contents
    raw = f"{tmp}/raw"
    landing.land(spark, a, raw, 1, "k")
    assert landing.land(spark, same, raw, 2, "k", skip_if_same_rows=True).count() == 0
    changed = spark.createDataFrame([(9, "a", None)], "k int, v string, w string").unionByName(a.where("k > 1"))
    assert landing.land(spark, changed, raw, 3, "k", skip_if_same_count=True).count() == 0
    assert landing.land(spark, changed, raw, 3, "k", skip_if_same_rows=True).count() == 1
    stale = a.withColumn("v", F.lit("stale"))
    assert sync.sync_full(a, stale, by_rows=True).state.where("v = 'stale'").count() == 0
    assert sync.sync_full(a, same, by_rows=True).stats.first()["mode"] == "skip"
    store = sync.VersionedTable(f"{tmp}/s")
    spec = sync.TableSpec("w.t", "k", "full")
    sync.publish_table(spec, stale, store, spark)
    assert sync.publish_table(spec, a, store, spark).first()["mode"] == "skip"
    assert sync.publish_table(spec, a, store, spark, by_rows=True).first()["mode"] == "full"
    assert sync.publish_table(spec, a, store, spark, by_rows=True).first()["mode"] == "skip"


def test_tests_of_absent_models_and_columns_fail(spark):
    t = spark.createDataFrame([(1, 2)], "a int, b int")
    tests = [quality.ModelTest("t", "a", "unique"), quality.ModelTest("t", "renamed", "not_null"), quality.ModelTest("gone", "a", "unique"),
             quality.ModelTest("t", "a", "relationships", "gone", "a"), quality.ModelTest("t", "a", "relationships", "t", "renamed")]
    got = {(r["model"], r["check"], r["column_name"]): (r["failing_rows"], r["passed"]) for r in quality.run_model_tests({"t": t}, tests).collect()}
    assert got.pop(("t", "unique", "a")) == (0, True)
    assert set(got.values()) == {(None, False)} and len(got) == 3
