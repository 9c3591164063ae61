import datetime as dt
import time

from pyspark.sql import functions as F

from starmart.operators import landing, runs, sync
from starmart.streaming.landing import start_landing


def _t(h):
    return dt.datetime(2024, 1, 1, h)


def test_watermark_tie_strict_and_inclusive(spark):
    tgt = spark.createDataFrame([(1, 1, "a", _t(5))], "row_id long, id long, v string, m timestamp")
    src = spark.createDataFrame([(9, 1, "a2", _t(5)), (9, 2, "b", _t(5)), (9, 3, "c", _t(6))],
                                "row_id long, id long, v string, m timestamp")
    strict = sync.sync_incremental(src, tgt, "id", "m", ("row_id",)).state.collect()
    assert sorted((r["id"], r["row_id"]) for r in strict) == [(1, 1), (3, 2)]
    incl = {r["id"]: r for r in sync.sync_incremental(src, tgt, "id", "m", ("row_id",), inclusive=True).state.collect()}
    assert incl[1]["v"] == "a2" and incl[1]["row_id"] == 1 and sorted(incl) == [1, 2, 3]


def test_full_same_count_skip_unless_forced(spark):
    src = spark.createDataFrame([(1, "new")], "k long, v string")
    tgt = spark.createDataFrame([(1, "old")], "k long, v string")
    assert sync.sync_full(src, tgt).state.first()["v"] == "old"
    assert sync.sync_full(src, tgt, force=True).state.first()["v"] == "new"
    empty = spark.createDataFrame([], "k long, v string")
    assert sync.sync_full(src.limit(0), empty).state.count() == 0
    st = sync.sync_full(src, tgt).stats.first()
    assert st["mode"] == "skip" and st["skipped"] == 1


def test_insert_only_idempotent(spark):
    src = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    tgt = spark.createDataFrame([(1,)], "k long")
    s1 = sync.sync_insert_only(src, tgt, "k").state
    r2 = sync.sync_insert_only(src, s1, "k")
    assert r2.state.count() == 3 and r2.stats.first()["inserted"] == 0


def test_dispatch_isolates_failures(spark):
    src = spark.createDataFrame([(1,)], "k long")
    specs = [sync.TableSpec("a", "k", "full"), sync.TableSpec("b", "k", "bogus"),
             sync.TableSpec("c", "k", "incremental"), sync.TableSpec("d", "k", "full")]
    _, stats = sync.sync_all(specs, {"a": src, "b": src, "c": src}, {})
    st = {r["table"]: (r["status"], r["reason"]) for r in stats.collect()}
    assert st["a"][0] == "ok" and st["b"] == ("failed", "unknown_mode:bogus")
    assert st["c"] == ("failed", "missing_date_column") and st["d"] == ("skipped", "missing_locally")
    summ = sync.sync_summary(stats).first()
    assert (summ["ok"], summ["failed"], summ["skipped_tables"]) == (1, 2, 1)


def test_force_applies_to_every_mode(spark):
    src = spark.createDataFrame([(1, "new"), (2, "b")], "k long, v string")
    tgt = spark.createDataFrame([(1, "old")], "k long, v string")
    r = sync.sync_table(sync.TableSpec("t", "k", "upsert"), src, tgt, force_full=True)
    assert sorted(x["v"] for x in r.state.collect()) == ["b", "new"]
    r = sync.sync_table(sync.TableSpec("t", "k", "upsert"), src, tgt)
    assert sorted(x["v"] for x in r.state.collect()) == ["b", "old"]


def test_verdict(spark):
    a = spark.createDataFrame([(1,)], "k long")
    b = spark.createDataFrame([], "k long")
    assert sync.verdict(sync.verify({"x": a, "y": a}, {"x": a, "y": a}), 2).first()["sync_verdict"] == "SUCCESS"
    assert sync.verdict(sync.verify({"x": a, "y": a}, {"x": a, "y": b}), 2).first()["sync_verdict"] == "PARTIAL (1/2)"
    assert sync.verdict(sync.verify({"x": a}, {"x": b}), 1).first()["sync_verdict"] == "FAILED"


def test_versioned_table(spark, tmp):
    t = sync.VersionedTable(f"{tmp}/tbl")
    assert t.read(spark) is None
    t.write(spark.createDataFrame([(1,)], "k long"))
    cur = t.read(spark)
    t.write(cur.unionByName(spark.createDataFrame([(2,)], "k long")))
    assert sorted(r["k"] for r in t.read(spark).collect()) == [1, 2]
    assert t.latest_version(spark) == 1
    t.append(spark.createDataFrame([(3,)], "k long"))
    assert sorted(r["k"] for r in t.read(spark).collect()) == [1, 2, 3]
    assert sorted(r["k"] for r in t.read(spark, before=2).collect()) == [1, 2]
    # a read opens the last whole state and what was appended, nothing older
    files = t.read(spark).inputFiles()
    assert files and not any("sm_version=0" in f for f in files)
    assert [p.rsplit("=", 1)[1] for p in t.expired(spark, keep=1)] == ["0"]


def test_publish_appends_skips_and_isolates(spark, tmp):
    spec = sync.TableSpec("w.t", "k", "upsert")
    store = sync.VersionedTable(f"{tmp}/served")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    assert sync.publish_table(spec, first, store, spark).first()["inserted"] == 2
    more = spark.createDataFrame([(1, "changed"), (2, "b"), (3, "c")], "k long, v string")
    stats = sync.publish_table(spec, more, store, spark).first()
    assert (stats["inserted"], stats["skipped"], stats["status"]) == (1, 2, "ok")
    assert spark.read.parquet(f"{tmp}/served/sm_version=1").collect()[0]["k"] == 3       # only the new row was written
    assert {r["k"]: r["v"] for r in store.read(spark).collect()} == {1: "a", 2: "b", 3: "c"}
    assert sync.publish_table(spec, more, store, spark).first()["inserted"] == 0
    assert store.latest_version(spark) == 1
    full = sync.TableSpec("w.f", "k", "full")
    dims = sync.VersionedTable(f"{tmp}/dims")
    sync.publish_table(full, first, dims, spark)
    assert sync.publish_table(full, first, dims, spark).first()["mode"] == "skip" and dims.latest_version(spark) == 0
    bad = first.withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    failed = sync.publish_table(full, bad, dims, spark, force_full=True).first()
    assert failed["status"] == "failed" and failed["inserted"] == 0
    assert dims.latest_version(spark) == 0 and dims.read(spark).count() == 2


def test_landing_dup_null_and_idempotence(spark, tmp):
    schema = "`Order Item Id` long, x string"
    raw = f"{tmp}/raw"
    first = spark.createDataFrame([(5, "landed")], schema)
    landing.land(spark, first, raw, run_id=1)
    batch = spark.createDataFrame([(1, "a"), (1, "b"), (None, "n1"), (None, "n2"), (5, "again")], schema)
    got = landing.land(spark, batch, raw, run_id=2)
    assert sorted(r["x"] for r in got.collect()) == ["a", "b", "n1", "n2"]
    # second landing of the same keyed rows adds only the null-key rows again
    again = landing.land(spark, batch.where(F.col("`Order Item Id`").isNotNull()), raw, run_id=3)
    assert again.count() == 0
    audit = runs.run_audit(landing.read_raw(spark, raw)).collect()
    assert {r["run_id"]: r["rows_loaded"] for r in audit} == {1: 1, 2: 4}


def test_schema_evolution_on_landing(spark, tmp):
    raw = f"{tmp}/raw"
    landing.land(spark, spark.createDataFrame([(1,)], "`Order Item Id` long"), raw, 1)
    landing.land(spark, spark.createDataFrame([(2, "z")], "`Order Item Id` long, extra string"), raw, 2)
    rows = {r["Order Item Id"]: r["extra"] for r in landing.read_raw(spark, raw).collect()}
    assert rows == {1: None, 2: "z"}


def test_streaming_landing_available_now(spark, tmp):
    src, raw, ckpt = f"{tmp}/in", f"{tmp}/raw", f"{tmp}/ckpt"
    schema = "`Order Item Id` long, x string"
    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.parquet(f"{src}/f1")
    st = spark.createDataFrame([], schema).schema
    q = start_landing(spark, f"{src}/*", st, raw, ckpt)
    q.awaitTermination(120)
    spark.createDataFrame([(2, "dup"), (3, "c")], schema).write.parquet(f"{src}/f2")
    q = start_landing(spark, f"{src}/*", st, raw, ckpt)
    q.awaitTermination(120)
    rows = landing.read_raw(spark, raw).collect()
    assert sorted(r["x"] for r in rows) == ["a", "b", "c"]
    assert len({r["etl_run_id"] for r in rows}) == 2


def test_passed_rows_gate(spark):
    raw = spark.createDataFrame([(1, 7), (2, 8)], "k long, etl_run_id long")
    v = spark.createDataFrame([(7, 0, "passed"), (8, 2, "failed")], "etl_run_id long, checks_failed long, validation_status string")
    assert [r["k"] for r in runs.passed_rows(raw, v).collect()] == [1]


def test_cdc_stream_merge(spark, tmp):
    from starmart.streaming.cdc import apply_changes, start_cdc
    schema = "k long, v string, op string, seq long"
    src, base, ckpt = f"{tmp}/cdc", f"{tmp}/table", f"{tmp}/ckpt2"
    spark.createDataFrame([(1, "a", "I", 1), (2, "b", "I", 1), (3, "c", "I", 1)], schema).write.parquet(f"{src}/b1")
    st = spark.createDataFrame([], schema).schema
    start_cdc(spark, f"{src}/*", st, base, "k", ckpt).awaitTermination(120)
    spark.createDataFrame([(2, "b2", "U", 2), (3, None, "D", 2), (4, "d-old", "I", 2), (4, "d", "U", 3)],
                          schema).write.parquet(f"{src}/b2")
    start_cdc(spark, f"{src}/*", st, base, "k", ckpt).awaitTermination(120)
    state = {r["k"]: r["v"] for r in sync.VersionedTable(base).read(spark).collect()}
    assert state == {1: "a", 2: "b2", 4: "d"}
    # applying the same batch again changes nothing
    cur = sync.VersionedTable(base).read(spark)
    again = apply_changes(cur, spark.createDataFrame([(2, "b2", "U", 2), (3, None, "D", 2)], schema), "k")
    assert {r["k"]: r["v"] for r in again.collect()} == state
