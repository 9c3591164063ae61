"""Data-quality operators.

Every check returns rows ``(…, check, column_name, failing_rows, passed)``
instead of raising, and checks over one table are fused into a single
aggregate pass.  Duplicate and uniqueness checks are grouped aggregates with
map-side partial counts, so a hot key costs one row per map task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.schemas import STATUS_EXEMPT_FROM_SALES_CHECK

# Logical landing columns -> names in raw (source) and silver layers.
RAW_NAMES = {
    "order_id": "Order Id", "order_item_id": "Order Item Id", "product_card_id": "Product Card Id",
    "order_date": "order date (DateOrders)", "quantity": "Order Item Quantity",
    "order_status": "Order Status", "sales": "Sales", "discount_rate": "Order Item Discount Rate",
    "late_risk": "Late_delivery_risk",
}
SILVER_NAMES = {
    "order_id": "order_id", "order_item_id": "order_item_id", "product_card_id": "product_card_id",
    "order_date": "order_date", "quantity": "order_item_quantity", "order_status": "order_status",
    "sales": "sales", "discount_rate": "order_item_discount_rate", "late_risk": "late_delivery_risk",
}
RESULT_COLUMNS = ["check", "column_name", "failing_rows", "passed"]


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def is_missing(c: Column, dtype: T.DataType) -> Column:
    """pandas ``isna`` — null, and NaN for floating columns."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def as_number(c: Column, dtype: T.DataType) -> Column:
    """Numeric view with NaN mapped to null (pandas comparisons treat NaN as false)."""
    v = c.try_cast("double") if isinstance(dtype, T.StringType) else c.cast("double")
    return F.when(~F.isnan(v), v)


def _stack(df: DataFrame, rows: list[tuple[str, str, str]], keys: list[str]) -> DataFrame:
    """Turn one wide aggregate row (per key) into (check, column_name, failing_rows) rows."""
    structs = [F.struct(F.lit(chk).alias("check"), F.lit(col).alias("column_name"),
                        F.col(alias).cast("long").alias("failing_rows")) for chk, col, alias in rows]
    return df.select(*keys, F.explode(F.array(*structs)).alias("_r")).select(*keys, "_r.*")


def landing_checks(df: DataFrame, names: dict[str, str] | None = None, by: list[str] | None = None,
                   exempt_statuses: list[str] | None = None) -> DataFrame:
    """Q1, A3, Q4-Q7, Q9: the landing suite, optionally per run (``by``).

    * not_null on the four key columns (NaN counts as missing),
    * duplicate ids = rows - distinct ids, where all nulls count as one id,
    * quantity < 1, negative sales outside the exempt statuses (null status
      is not exempt), discount rate outside [0, 1], late flag not in {0, 1}
      (null counts as bad).
    """
    n = RAW_NAMES if names is None else names
    by = by or []
    types = {f.name: f.dataType for f in df.schema.fields}
    exempt = STATUS_EXEMPT_FROM_SALES_CHECK if exempt_statuses is None else exempt_statuses
    num = lambda k: as_number(_c(n[k]), types[n[k]])

    status = _c(n["order_status"])
    not_exempt = status.isNull() | ~status.isin(exempt)
    rate, late = num("discount_rate"), num("late_risk")
    conds: list[tuple[str, str, Column]] = [
        ("not_null", n[k], is_missing(_c(n[k]), types[n[k]]))
        for k in ("order_id", "order_item_id", "product_card_id", "order_date")
    ]
    conds += [
        ("min_value", n["quantity"], num("quantity") < 1),
        ("non_negative_unless_exempt", n["sales"], not_exempt & (num("sales") < 0)),
        ("range_0_1", n["discount_rate"], (rate < 0) | (rate > 1)),
        ("accepted_values_0_1", n["late_risk"], F.coalesce(~late.isin(0.0, 1.0), F.lit(True))),
    ]
    aggs = [F.count_if(F.coalesce(c, F.lit(False))).alias(f"_a{i}") for i, (_, _, c) in enumerate(conds)]
    wide = df.groupBy(*by).agg(*aggs)
    rows = _stack(wide, [(chk, col, f"_a{i}") for i, (chk, col, _) in enumerate(conds)], by)

    # A3: duplicated() count — rows beyond the first per id, nulls forming one id.
    idc = _c(n["order_item_id"])
    per_id = df.groupBy(*by, idc.alias("_id")).agg(F.count(F.lit(1)).alias("_k"))
    dups = per_id.groupBy(*by).agg(F.sum(F.col("_k") - 1).alias("failing_rows")).select(
        *by, F.lit("duplicates").alias("check"), F.lit(n["order_item_id"]).alias("column_name"),
        F.col("failing_rows").cast("long").alias("failing_rows"))
    out = rows.unionByName(dups)
    return out.withColumn("passed", F.col("failing_rows") == 0)


def messages(results: DataFrame) -> list[str]:
    """Q9: the failed checks as messages (collects only the failing check rows)."""
    return [f"{r['column_name']}: {r['failing_rows']} rows fail {r['check']}"
            for r in results.where(~F.col("passed")).collect()]


def not_null(df: DataFrame, columns: list[str], model: str = "") -> DataFrame:
    """Q1/A2: null count of every column in one pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)])
    out = _stack(wide, [("not_null", c, f"_n{i}") for i, c in enumerate(columns)], [])
    return out.select(F.lit(model).alias("model"), *RESULT_COLUMNS[:3]).withColumn(
        "passed", F.col("failing_rows") == 0)


def _tagged_keys(df: DataFrame, tagged_columns: list[tuple[int, str]]) -> DataFrame:
    """(_t, _k) rows: the non-null values of each column as text, tagged by check.

    Several columns of one table are emitted from a single scan.
    """
    pairs = [F.struct(F.lit(t).alias("_t"), F.col(c).cast("string").alias("_k")) for t, c in tagged_columns]
    one = pairs[0] if len(pairs) == 1 else None
    rows = (df.select(one.alias("_r")) if one is not None
            else df.select(F.explode(F.array(*pairs)).alias("_r")))
    return rows.select("_r._t", "_r._k").where(F.col("_k").isNotNull())


def _checks_frame(spark, checks: list[tuple[str, str]], check: str, counts: DataFrame) -> DataFrame:
    """One result row per check (zero when no failing row was counted)."""
    tests = spark.createDataFrame([(i, m, c) for i, (m, c) in enumerate(checks)],
                                  "_t int, model string, column_name string")
    # ``tests`` and ``counts`` both have one row per check: bounded by the suite size.
    res = tests.join(F.broadcast(counts), "_t", "left")
    failing = F.coalesce(F.col("failing_rows"), F.lit(0)).cast("long")
    return res.select("model", F.lit(check).alias("check"), "column_name", failing.alias("failing_rows"),
                      (failing == 0).alias("passed"))


def _by_table(items):
    """Group (index, table, column) by table object, keeping first-seen order."""
    groups: list[tuple[DataFrame, list[tuple[int, str]]]] = []
    for i, df, c in items:
        for g_df, cols in groups:
            if g_df is df:
                cols.append((i, c))
                break
        else:
            groups.append((df, [(i, c)]))
    return groups


def unique_many(checks: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Q2 for many (model, table, column): non-null values appearing more than once.

    All keys, tagged by check, go through one grouped count (map-side
    partial counts, so a hot value costs one row per map task), then the
    duplicated values are counted per check.
    """
    groups = _by_table([(i, df, c) for i, (_, df, c) in enumerate(checks)])
    keys = reduce(DataFrame.unionByName, [_tagged_keys(df, cols) for df, cols in groups])
    dups = (keys.groupBy("_t", "_k").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
            .groupBy("_t").agg(F.count(F.lit(1)).alias("failing_rows")))
    return _checks_frame(groups[0][0].sparkSession, [(m, c) for m, _, c in checks], "unique", dups)


def relationships_many(checks: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Q3/J7 for many (model, child, column, parent, field): child rows whose
    non-null key has no parent row.

    Child keys are first counted per (check, key) — a partial aggregate, so
    a key holding a third of the rows never reaches one reducer as rows —
    then anti-joined with the tagged parent keys, and the counts of the
    orphan keys summed per check.  Foreign keys of one child table come
    from a single scan.
    """
    groups = _by_table([(i, child, c) for i, (_, child, c, _, _) in enumerate(checks)])
    child_keys = reduce(DataFrame.unionByName, [_tagged_keys(df, cols) for df, cols in groups])
    per_key = child_keys.groupBy("_t", "_k").agg(F.count(F.lit(1)).alias("_n"))
    parents = reduce(DataFrame.unionByName, [_tagged_keys(p, [(i, f)]) for i, (_, _, _, p, f) in enumerate(checks)])
    orphans = (per_key.join(parents, ["_t", "_k"], "left_anti")
               .groupBy("_t").agg(F.sum("_n").alias("failing_rows")))
    return _checks_frame(groups[0][0].sparkSession, [(m, c) for m, _, c, _, _ in checks], "relationships",
                         orphans)


def unique(df: DataFrame, column: str, model: str = "") -> DataFrame:
    """Q2: number of non-null values appearing more than once."""
    return unique_many([(model, df, column)])


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str, model: str = "") -> DataFrame:
    """Child rows whose non-null key has no parent row (anti join)."""
    return relationships_many([(model, child, column, parent, field)])


@dataclass(frozen=True)
class ModelTest:
    model: str
    column: str
    test: str                 # not_null | unique | relationships
    to_model: str | None = None
    to_field: str | None = None


def _mart_tests() -> list[ModelTest]:
    """The declared suite: 7 unique, 40 not_null, 4 relationships (51)."""
    from starmart.schemas import FEATURE_COLUMNS, FEATURE_ID_COLUMNS
    t: list[ModelTest] = [ModelTest("stg_orders", "order_item_id", "unique")]
    t += [ModelTest("stg_orders", c, "not_null")
          for c in ("order_item_id", "order_id", "customer_id", "product_card_id", "date_key")]
    for model, key in (("dim_customers", "customer_id"), ("dim_products", "product_card_id"),
                       ("dim_date", "date_key"), ("dim_shipping_location", "shipping_location_id"),
                       ("fact_order_items", "order_item_id")):
        t += [ModelTest(model, key, "unique"), ModelTest(model, key, "not_null")]
    t += [ModelTest("fact_order_items", "customer_id", "relationships", "dim_customers", "customer_id"),
          ModelTest("fact_order_items", "product_card_id", "relationships", "dim_products", "product_card_id"),
          ModelTest("fact_order_items", "date_key", "relationships", "dim_date", "date_key"),
          ModelTest("fact_order_items", "shipping_location_id", "relationships",
                    "dim_shipping_location", "shipping_location_id")]
    t.append(ModelTest("fraud_features", "order_item_id", "unique"))
    t += [ModelTest("fraud_features", c, "not_null")
          for c in FEATURE_ID_COLUMNS + FEATURE_COLUMNS + ["order_status", "target", "created_at"]]
    return t


MART_TESTS = _mart_tests()


def run_model_tests(tables: dict[str, DataFrame], tests: list[ModelTest] | None = None) -> DataFrame:
    """Run a declarative suite: not_null tests of one model share one pass,
    all unique tests one keyed aggregate, all relationships one anti join.

    A test that names an absent model or column fails, with a null count, so
    a renamed column never turns a failing suite green.
    """
    tests = MART_TESTS if tests is None else tests
    parts: list[DataFrame] = []
    by_model: dict[str, list[str]] = {}
    uniq: list[tuple[str, DataFrame, str]] = []
    rels: list[tuple[str, DataFrame, str, DataFrame, str]] = []
    absent: list[tuple[str, str, str]] = []
    for t in tests:
        df = tables.get(t.model)
        parent = tables.get(t.to_model) if t.to_model else None
        if df is None or t.column not in df.columns or t.test == "relationships" and (parent is None or t.to_field not in parent.columns):
            absent.append((t.model, t.test, t.column))
            continue
        if t.test == "not_null":
            by_model.setdefault(t.model, []).append(t.column)
        elif t.test == "unique":
            uniq.append((t.model, df, t.column))
        elif t.test == "relationships":
            rels.append((t.model, df, t.column, parent, t.to_field))
    if uniq:
        parts.append(unique_many(uniq))
    if rels:
        parts.append(relationships_many(rels))
    for model, cols in by_model.items():
        parts.append(not_null(tables[model], cols, model))
    if absent:
        spark = next(iter(tables.values())).sparkSession
        parts.append(spark.createDataFrame([(*a, None, False) for a in absent], "model string, check string, column_name string, failing_rows long, passed boolean"))
    return reduce(DataFrame.unionByName, parts)


def tolerance_checks(df: DataFrame, columns: list[str], max_null_frac: float = 0.015,
                     date_column: str | None = None, date_min=None, date_max=None,
                     status_column: str | None = None, allowed: list[str] | None = None) -> DataFrame:
    """Q10: null fraction below a tolerance, dates inside a range, status in a domain."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    rows: list[tuple[str, str, str]] = []
    for i, c in enumerate(columns):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"_z{i}"))
        rows.append(("null_fraction", c, f"_z{i}"))
    if date_column:
        d = F.col(date_column)
        aggs.append(F.count_if((d < F.lit(date_min)) | (d > F.lit(date_max))).alias("_d"))
        rows.append(("date_range", date_column, "_d"))
    if status_column:
        s = F.col(status_column)
        aggs.append(F.count_if(s.isNull() | ~s.isin(allowed or [])).alias("_s"))
        rows.append(("accepted_values", status_column, "_s"))
    wide = df.agg(*aggs)
    structs = [F.struct(F.lit(chk).alias("check"), F.lit(col).alias("column_name"),
                        F.col(a).cast("long").alias("failing_rows"), F.col("_n").alias("total_rows"))
               for chk, col, a in rows]
    out = wide.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")
    frac = F.round(F.col("failing_rows") / F.col("total_rows"), 6)
    passed = F.when(F.col("check") == "null_fraction", frac < F.lit(max_null_frac)).otherwise(F.col("failing_rows") == 0)
    return out.withColumn("fraction", frac).withColumn("passed", passed)
