"""Star schema: four dimensions around the order-line fact.

Dimensions are rebuilt from silver each run.  The fact attaches the
shipping-location key by hashing the seven location columns of the row
itself: the location dimension is ``DISTINCT`` over the same columns and
keyed by the same hash, so a left equi-join on all seven columns (``=``
semantics, any null -> no match) gives exactly this key.  Computing it in
place removes a fact-sized shuffle; ``attach_location_key(..., dim=...)``
keeps the join form for a dimension that was built elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.dates import is_weekend, iso_day_of_week, month_name_padded  # noqa: F401
from starmart.functions.keys import surrogate_key
from starmart.schemas import CUSTOMER_COLUMNS, FACT_COLUMNS, LOCATION_COLUMNS, PRODUCT_COLUMNS


# Dimensions shipped to every task at most: rows, and bytes of their values as
# text; dimensions are projected to the key and the few attributes a join
# needs before they are counted.
MAX_BROADCAST_DIM_ROWS = 1_000_000
MAX_BROADCAST_DIM_BYTES = 64 << 20


def sized_dimension(dim: DataFrame, max_rows: int = MAX_BROADCAST_DIM_ROWS, is_table: bool = False,
                    max_bytes: int = MAX_BROADCAST_DIM_BYTES) -> DataFrame:
    """A dimension ready to join with a fact.

    A derived dimension is computed and written once; ``is_table`` says that
    it already is a narrow read of a written table.  Its rows and bytes are
    counted: within both bounds it is marked for broadcast, so the fact side
    of the join runs in its own stage without being shuffled.  A larger
    dimension is left to the planner (sort-merge join, or AQE's runtime
    broadcast); the result is the same.
    """
    from starmart.session import written

    if not is_table:
        dim = written(dim)
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(1)) for c in dim.columns), F.lit(0))
    n, n_bytes = dim.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(dim) if n <= max_rows and n_bytes <= max_bytes else dim


def _latest_per_key(stg: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """Newest attribute set per key (order_date desc, order_item_id desc).

    A max over a struct is a hash aggregate with map-side partial results, so
    a key holding a third of all rows is reduced inside every map task
    instead of being sorted in one window task.
    """
    newest = F.max(F.struct(F.col("order_date").alias("_d"), F.col("order_item_id").alias("_i"),
                            *[F.col(a) for a in attrs])).alias("_m")
    return stg.groupBy(key).agg(newest).select(key, *[F.col(f"_m.{a}").alias(a) for a in attrs])


def dim_customers(stg: DataFrame, dedupe: str = "distinct") -> DataFrame:
    """P7 (reference behaviour: distinct attribute rows) or W4 ``dedupe='latest'``."""
    if dedupe == "latest":
        return _latest_per_key(stg, "customer_id", CUSTOMER_COLUMNS[1:])
    return stg.select(*CUSTOMER_COLUMNS).distinct()


def dim_products(stg: DataFrame, dedupe: str = "distinct") -> DataFrame:
    if dedupe == "latest":
        return _latest_per_key(stg, "product_card_id", PRODUCT_COLUMNS[1:])
    return stg.select(*PRODUCT_COLUMNS).distinct()


def dim_date(stg: DataFrame) -> DataFrame:
    """One row per distinct (date_key, full_date)."""
    d = F.col("full_date")
    return (stg.select("date_key", "full_date").distinct()
            .select("date_key", "full_date",
                    F.year(d).alias("year"), F.quarter(d).alias("quarter"),
                    F.month(d).alias("month"), month_name_padded(d).alias("month_name"),
                    F.weekofyear(d).alias("week"), F.dayofmonth(d).alias("day"),
                    is_weekend(d).alias("is_weekend")))


def location_key(df: DataFrame) -> Column:
    """C11 surrogate key over the seven location columns."""
    return surrogate_key(df, LOCATION_COLUMNS)


def dim_shipping_location(stg: DataFrame) -> DataFrame:
    locs = stg.select(*LOCATION_COLUMNS).distinct()
    return locs.select(location_key(locs).alias("shipping_location_id"), *LOCATION_COLUMNS)


def attach_location_key(stg: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """``stg.*`` plus the location key; null when any location column is null."""
    if dim is not None:
        cond = [stg[c] == dim[c] for c in LOCATION_COLUMNS]
        return stg.join(dim.select("shipping_location_id", *LOCATION_COLUMNS), cond, "left") \
                  .select(stg["*"], dim["shipping_location_id"])
    all_present = F.lit(True)
    for c in LOCATION_COLUMNS:
        all_present = all_present & F.col(c).isNotNull()
    return stg.withColumn("shipping_location_id", F.when(all_present, location_key(stg)))


def fact_order_items(stg: DataFrame, location_dim: DataFrame | None = None) -> DataFrame:
    """P8 + J3: the 24-column order-line fact."""
    return attach_location_key(stg, location_dim).select(*FACT_COLUMNS)


def not_in_filter(batch: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """``WHERE key NOT IN (SELECT key FROM target)`` with full SQL semantics.

    Spark can only run a null-aware NOT IN as a broadcast of the whole target
    key set, which grows with the table.  Instead: a regular (shuffle-able)
    anti join, gated by two scalar subqueries over the target — empty target
    passes every row, a null key in the target passes none, otherwise a null
    batch key fails.
    """
    n_rows = target.agg(F.count(F.lit(1))).scalar()
    n_null = target.agg(F.count_if(F.col(key).isNull())).scalar()
    anti = batch.join(target.select(key).where(F.col(key).isNotNull()), on=key, how="left_anti")
    return anti.where((n_rows == 0) | ((n_null == 0) & F.col(key).isNotNull()))


def merge_by_key(target: DataFrame, batch: DataFrame, key: str | list[str]) -> DataFrame:
    """Upsert — target rows whose key is not in the batch, plus the batch."""
    keys = [key] if isinstance(key, str) else list(key)
    kept = target.join(batch.select(*keys).distinct(), on=keys, how="left_anti")
    return kept.unionByName(batch.select(*target.columns), allowMissingColumns=True)


def fact_incremental(stg: DataFrame, existing: DataFrame, mode: str = "new_only",
                     location_dim: DataFrame | None = None) -> DataFrame:
    """Incremental fact.

    ``new_only`` is the reference behaviour: silver rows whose id is already
    in the fact are filtered out before the merge, so existing rows never
    change; the result is the new rows to append.  ``merge`` upserts every
    silver row and returns the full new fact state.
    """
    if mode == "new_only":
        return fact_order_items(not_in_filter(stg, existing, "order_item_id"), location_dim)
    if mode == "merge":
        return merge_by_key(existing.select(*FACT_COLUMNS), fact_order_items(stg, location_dim), "order_item_id")
    raise ValueError(f"unknown mode {mode!r}")


def daily_snapshots(stg: DataFrame, key: str, attrs: list[str], date_col: str = "full_date",
                    order_cols: tuple[str, ...] = ("order_date", "order_item_id")) -> DataFrame:
    """One row per key and day with the day's latest attributes: a hash aggregate with map-side partials."""
    latest = F.max(F.struct(*[F.col(c) for c in order_cols], *[F.col(a) for a in attrs])).alias("_m")
    return (stg.where(F.col(key).isNotNull() & F.col(date_col).isNotNull())
            .groupBy(key, date_col).agg(latest)
            .select(key, date_col, *[F.col(f"_m.{a}").alias(a) for a in attrs]))


def signature(attrs: list[str]) -> Column:
    return F.md5(F.to_json(F.struct(*[F.col(a) for a in attrs])))


def scd2(stg: DataFrame, key: str, attrs: list[str], date_col: str = "full_date",
         order_cols: tuple[str, ...] = ("order_date", "order_item_id")) -> DataFrame:
    """SCD type 2 history of a dimension: one row per attribute version with
    ``effective_from``, ``effective_to`` (exclusive, null while current) and
    ``is_current``.

    Lines are first reduced to one snapshot per (key, day) — the day's latest
    attributes, a hash aggregate with map-side partials — so the ordered
    window that finds change points runs over at most one row per key and
    day, never over all lines of a hot key.
    """
    daily = daily_snapshots(stg, key, attrs, date_col, order_cols)
    w = Window.partitionBy(key).orderBy(date_col)
    changes = (daily.withColumn("_sig", signature(attrs))
               .withColumn("_prev", F.lag("_sig").over(w))
               .where(F.col("_prev").isNull() | (F.col("_prev") != F.col("_sig"))))
    out = changes.withColumn("effective_to", F.lead(date_col).over(w))
    return out.select(key, *attrs, F.col(date_col).alias("effective_from"), "effective_to",
                      F.col("effective_to").isNull().alias("is_current"))


def month_key(date_key_col: str = "date_key") -> Column:
    """yyyymm partition value of a yyyymmdd date key."""
    return (F.col(date_key_col) / 100).cast("int")


def rebuild_months(fact: DataFrame, touched: DataFrame, path: str) -> None:
    """§2.11: write anew the months of a fact partitioned by month that ``touched`` (column month_key) names.

    ``fact`` is the whole fact as it should be, lazily; only the rows of those
    months are computed and only their partitions replaced, each in one
    commit.  A touched month without rows keeps its partition, as an overwrite by
    partition replaces only what is written.
    """
    months = touched.select("month_key").where(F.col("month_key").isNotNull()).distinct()
    rows = fact.withColumn("month_key", month_key()).join(sized_dimension(months), "month_key", "left_semi")
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month_key").parquet(path))


def sales_of_days(fact: DataFrame, days: DataFrame) -> DataFrame:
    """Lines and sales by month for a selection of days, from a fact partitioned by month.

    The fact joins the days on month and day; the days are the small side, so
    their months reach the fact's scan as a dynamic partition filter.
    """
    chosen = days.select("date_key", month_key().alias("month_key"))
    joined = fact.join(F.broadcast(chosen), ["month_key", "date_key"])        # a row a day
    return joined.groupBy("month_key").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("sales").cast("decimal(38,4)")).cast("double").alias("sum_sales"))
