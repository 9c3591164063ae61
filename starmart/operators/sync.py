"""Keeping a serving copy in step with the warehouse.

Each mode is a pure function ``(source, target) -> SyncResult`` whose
``state`` is the serving table after the sync and whose ``stats`` is a
one-row DataFrame ``(table, mode, inserted, updated, skipped, status)``.
Both are lazy; decisions that depend on counts (skip a full sync, empty
target) are scalar subqueries inside the plan, not driver round trips; only an
insert looks for new keys of a large target when it is called.
Writing goes to a new version of a ``store.VersionedTable``, never over the
path being read: inserts append their rows, updates write theirs as changes.
"""

from __future__ import annotations

import traceback
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.key_filter import rows_with_new_keys
from starmart.operators.ordering import global_row_number
from starmart.operators.runs import row_digest, same_rows
from starmart.operators.store import VERSION_COL, VersionedTable, one_per_key  # noqa: F401
from starmart.schemas import conform, serving_schema
from starmart.session import written

STATS_SCHEMA = "table string, mode string, inserted long, updated long, skipped long, status string, reason string"


@dataclass(frozen=True)
class TableSpec:
    """One registry entry (schema-qualified name, key, mode and options)."""
    table: str
    pk: str
    sync_mode: str                      # full | upsert | incremental
    date_column: str | None = None
    exclude_columns: tuple[str, ...] = ()


@dataclass
class SyncResult:
    state: DataFrame | None
    stats: DataFrame


# --- fixed values: the reference's sync registry -------------------------------
DEFAULT_REGISTRY = [
    TableSpec("warehouse.dim_customers", "customer_id", "full"),
    TableSpec("warehouse.dim_products", "product_card_id", "full"),
    TableSpec("warehouse.dim_date", "date_key", "full"),
    TableSpec("warehouse.dim_shipping_location", "shipping_location_id", "full"),
    TableSpec("warehouse.fact_order_items", "order_item_id", "upsert"),
    TableSpec("warehouse.predictions", "order_id", "incremental", "modified_at", ("prediction_id",)),
]


def _count(df: DataFrame):
    return df.agg(F.count(F.lit(1))).scalar()


def _stats(spark: SparkSession, table: str, mode: str, inserted, updated, skipped,
           status: str = "ok", reason: str | None = None) -> DataFrame:
    one = spark.range(1)
    return one.select(F.lit(table).alias("table"), F.lit(mode).alias("mode"),
                      F.lit(inserted).cast("long").alias("inserted"), F.lit(updated).cast("long").alias("updated"),
                      F.lit(skipped).cast("long").alias("skipped"), F.lit(status).alias("status"),
                      F.lit(reason).cast("string").alias("reason"))


def sync_full(source: DataFrame, target: DataFrame, table: str = "", force: bool = False, by_rows: bool = False) -> SyncResult:
    """Skip when the target is non-empty and has as many rows as the source,
    otherwise replace it.  ``force`` always replaces; ``by_rows`` skips only if
    the rows are the same (``runs.row_digest``), so replaced rows are synced."""
    n_src, n_tgt = _count(source), _count(target)
    skip = F.lit(False) if force else ((n_src == n_tgt) & (n_tgt > 0))
    if by_rows and not force:
        digest = lambda df: row_digest(df, source.columns).select(F.concat_ws("/", "n", "a", "b")).scalar()
        types = {f.name: f.dataType for f in source.schema}
        skip = skip & (digest(source) == digest(target.select(*[F.col(c).cast(types[c]).alias(c) for c in source.columns])))
    state = source.where(~skip).unionByName(target.select(*source.columns).where(skip))
    spark = source.sparkSession
    stats = _stats(spark, table, "full", 0, 0, 0).select(
        "table", F.when(skip, F.lit("skip")).otherwise(F.lit("full")).alias("mode"),
        F.when(skip, F.lit(0)).otherwise(n_src).cast("long").alias("inserted"), "updated",
        F.when(skip, n_src).otherwise(F.lit(0)).cast("long").alias("skipped"), "status", "reason")
    return SyncResult(state, stats)


def sync_insert_only(source: DataFrame, target: DataFrame, pk: str, table: str = "") -> SyncResult:
    """Append source rows whose key the target lacks (distributed anti join on keys, ``key_filter``).

    Of source rows that share such a key one is inserted, the least by its
    other columns; rows without a key all are.  Which keys are new is found when called.
    """
    new = rows_with_new_keys(source, target, pk)
    state = target.select(*source.columns).unionByName(new)
    n_new, n_src = _count(new), _count(source)
    stats = _stats(source.sparkSession, table, "upsert", 0, 0, 0).select(
        "table", "mode", n_new.cast("long").alias("inserted"), "updated",
        (n_src - n_new).cast("long").alias("skipped"), "status", "reason")
    return SyncResult(state, stats)


def high_water_mark(target: DataFrame, date_column: str):
    """Max of the date column in the target (a scalar subquery)."""
    return target.agg(F.max(date_column)).scalar()


def assign_serial(new_rows: DataFrame, existing: DataFrame, id_col: str, order_by: str) -> DataFrame:
    """Ids continuing after the current max — ``coalesce(max, 0) + row_number()``.

    The row number is exact and distributed (range buckets + offsets).
    """
    start = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long")).scalar()
    numbered = global_row_number(new_rows, [order_by], out="_rn")
    return numbered.withColumn(id_col, (start + F.col("_rn")).cast("long")).drop("_rn")


def incremental_rows(source: DataFrame, target: DataFrame, pk: str, date_column: str,
                     exclude_columns: tuple[str, ...] = (), inclusive: bool = False) -> tuple[DataFrame, DataFrame]:
    """Source rows after the target's high-water mark, and what they make of the target's rows.

    Strict ``>`` by default (rows tied with the mark are not re-sent);
    ``inclusive=True`` re-sends them, which the upsert makes harmless.
    Of rows that share a key the newest counts.  Excluded columns are not
    sent: matched rows keep the target's values, new rows get serial ids after
    the target's max (the first excluded column is taken as the serial id).
    Only the target's key and excluded columns are read.
    """
    hwm = high_water_mark(target, date_column)
    dc = F.col(date_column)
    changed = source.where(hwm.isNull() | ((dc >= hwm) if inclusive else (dc > hwm)))
    send_cols = [c for c in source.columns if c not in exclude_columns]
    batch = one_per_key(changed.select(*send_cols), [pk], newest=date_column)
    types = {f.name: f.dataType for f in target.schema}
    shape = lambda df: df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(types[c]).alias(c) for c in target.columns])
    if not exclude_columns:
        return changed, shape(batch)
    matched = batch.join(target.select(pk, *exclude_columns), pk)
    fresh = assign_serial(batch.join(target.select(pk), pk, "left_anti"), target, exclude_columns[0], pk)
    return changed, shape(matched).unionByName(shape(fresh))


def sync_incremental(source: DataFrame, target: DataFrame, pk: str, date_column: str,
                     exclude_columns: tuple[str, ...] = (), table: str = "",
                     inclusive: bool = False) -> SyncResult:
    """The target with the rows of ``incremental_rows`` upserted on the key."""
    changed, rows = incremental_rows(source, target, pk, date_column, exclude_columns, inclusive)
    state = target.join(changed.select(pk), pk, "left_anti").select(*target.columns).unionByName(rows)
    n_changed, n_src = _count(changed), _count(source)
    stats = _stats(source.sparkSession, table, "incremental", 0, 0, 0).select(
        "table", "mode", n_changed.cast("long").alias("inserted"), "updated",
        (n_src - n_changed).cast("long").alias("skipped"), "status", "reason")
    return SyncResult(state, stats)


def sync_table(spec: TableSpec, source: DataFrame | None, target: DataFrame | None,
               force_full: bool = False, inclusive: bool = False) -> SyncResult:
    """Dispatch one registry entry; errors and missing sources become status rows."""
    if source is not None:
        spark = source.sparkSession
    else:
        spark = target.sparkSession if target is not None else SparkSession.getActiveSession()
    if source is None:
        return SyncResult(None, _stats(spark, spec.table, spec.sync_mode, 0, 0, 0, "skipped", "missing_locally"))
    if target is None:
        target = source.sparkSession.createDataFrame([], source.schema)
    try:
        # a forced sync replaces the serving copy whatever the table's mode
        if spec.sync_mode == "full" or (force_full and spec.sync_mode in ("upsert", "incremental")):
            return sync_full(source, target, spec.table, force_full)
        if spec.sync_mode == "upsert":
            return sync_insert_only(source, target, spec.pk, spec.table)
        if spec.sync_mode == "incremental":
            if not spec.date_column:
                return SyncResult(None, _stats(spark, spec.table, spec.sync_mode, 0, 0, 0, "failed",
                                               "missing_date_column"))
            return sync_incremental(source, target, spec.pk, spec.date_column, spec.exclude_columns,
                                    spec.table, inclusive)
        return SyncResult(None, _stats(spark, spec.table, spec.sync_mode, 0, 0, 0, "failed",
                                       f"unknown_mode:{spec.sync_mode}"))
    except Exception as e:  # noqa: BLE001 — isolate one table's failure
        return SyncResult(None, _stats(spark, spec.table, spec.sync_mode, 0, 0, 0, "failed",
                                       f"{type(e).__name__}: {e}"[:500] or traceback.format_exc()[-500:]))


def sync_all(registry: list[TableSpec], sources: dict[str, DataFrame], targets: dict[str, DataFrame],
             force_full: bool = False) -> tuple[dict[str, DataFrame], DataFrame]:
    """Run every registry entry; returns the new states and the stacked stats."""
    states, stats = {}, []
    for spec in registry:
        r = sync_table(spec, sources.get(spec.table), targets.get(spec.table), force_full)
        if r.state is not None:
            states[spec.table] = r.state
        stats.append(r.stats)
    return states, reduce(DataFrame.unionByName, stats)


def sync_summary(stats: DataFrame) -> DataFrame:
    """Totals over the per-table results."""
    ok = F.col("status") == "ok"
    return stats.agg(
        F.count(F.lit(1)).alias("tables"),
        F.count_if(ok).alias("ok"), F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "skipped").alias("skipped_tables"),
        F.coalesce(F.sum(F.when(ok, F.col("inserted"))), F.lit(0)).cast("long").alias("inserted"),
        F.coalesce(F.sum(F.when(ok, F.col("updated"))), F.lit(0)).cast("long").alias("updated"),
        F.coalesce(F.sum(F.when(ok, F.col("skipped"))), F.lit(0)).cast("long").alias("skipped"))


def table_counts(tables: dict[str, DataFrame], side: str) -> DataFrame:
    """A1: one (table, <side>_count) row per table; each count is one aggregate."""
    parts = [df.agg(F.count(F.lit(1)).alias(f"{side}_count")).select(F.lit(name).alias("table"), f"{side}_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def verify(local: dict[str, DataFrame], remote: dict[str, DataFrame]) -> DataFrame:
    """Local vs serving row count per table, joined on the table name."""
    return (table_counts(local, "local").join(table_counts(remote, "remote"), "table", "inner")
            .withColumn("matched", F.col("local_count") == F.col("remote_count")))


def verdict(comparison: DataFrame, n_configured: int) -> DataFrame:
    """SUCCESS when every configured table matches, FAILED when none, else PARTIAL (m/n)."""
    m = F.count_if(F.col("matched"))
    n = F.count(F.lit(1))
    text = (F.when((m == n) & (n == F.lit(n_configured)), F.lit("SUCCESS"))
             .when(m == 0, F.lit("FAILED"))
             .otherwise(F.concat(F.lit("PARTIAL ("), m.cast("string"), F.lit("/"), n.cast("string"), F.lit(")"))))
    return comparison.agg(m.alias("tables_matched"), n.alias("tables_compared"), text.alias("sync_verdict"))


# --- writes -----------------------------------------------------------------------------

def publish_table(spec: TableSpec, source: DataFrame | None, store: VersionedTable, spark: SparkSession,
                  force_full: bool = False, by_rows: bool = False) -> DataFrame:
    """Sync one table into its serving store and return its stats row.

    A table with nothing to do writes no files; insert-only tables append
    just the new rows, incremental ones write just the changed rows, merged on
    read; ``by_rows`` skips a full table only if its rows are the same, not just
    as many; whatever fails, while planning or running, becomes a ``failed`` row,
    so the other tables go on.
    """
    row = lambda mode, inserted, skipped, status="ok", reason=None: _stats(
        spark, spec.table, mode, inserted, 0, skipped, status, reason)
    try:
        if source is None:
            return row(spec.sync_mode, 0, 0, "skipped", "missing_locally")
        source = conform(source, serving_schema(spec.table.split(".")[-1]))
        target = store.read(spark)
        full = spec.sync_mode == "full" or (force_full and spec.sync_mode in ("upsert", "incremental"))
        if target is None and spec.sync_mode == "upsert" or full:
            n = source.count()
            if full and not force_full and target is not None and 0 < n == target.count() and (not by_rows or same_rows(source, target)):
                return row("skip", 0, n)
            if full:
                store.write(source)
                return row("full", n, 0)
            one = written(one_per_key(source, [spec.pk]))
            store.write(one)
            inserted = one.count()
            return row(spec.sync_mode, inserted, n - inserted)
        if spec.sync_mode == "upsert":
            new, n, n_source = rows_with_new_keys(source, target, spec.pk).select(*target.columns), 0, source.count()
            if not new.isEmpty():
                store.append(new)                                             # its rows are written once, and counted there
                n = store.entries(spark)[-1].rows
            return row("upsert", n, n_source - n)
        if spec.sync_mode == "incremental" and spec.date_column and target is not None:
            changed, rows = incremental_rows(source, target, spec.pk, spec.date_column, spec.exclude_columns)
            n, n_source = changed.count(), source.count()
            if n:
                store.merge(rows, [spec.pk])
                store.compact(spark, max_changes=50, share=0.5)
            return row("incremental", n, n_source - n)
        result = sync_table(spec, source, target, force_full)
        if result.state is None:
            return result.stats
        stats = spark.createDataFrame(result.stats.collect(), STATS_SCHEMA)      # one row, before the store changes
        if target is None or stats.first()["inserted"]:
            store.write(result.state)
        return stats
    except Exception as e:  # noqa: BLE001 - isolate one table's failure
        return row(spec.sync_mode, 0, 0, "failed", f"{type(e).__name__}: {e}"[:500])
