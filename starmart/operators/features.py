"""Fraud feature table, preparation and profiling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.dates import day_of_week_sun0, is_weekend
from starmart.operators.marts import sized_dimension
from starmart.schemas import CUSTOMER_COLUMNS, FEATURE_COLUMNS, FEATURE_ID_COLUMNS, LABEL_VALUE, LOCATION_COLUMNS, PRODUCT_COLUMNS
from starmart.session import written

# --- fixed values: the columns that training needs ----------------------------
REQUIRED_COLUMNS = [
    "order_item_id", "order_id", "customer_id", "order_status", "target",
    "payment_type", "sales", "customer_segment", "category_name", "latitude", "longitude",
]


def fraud_features(fact: DataFrame, dim_customers: DataFrame, dim_products: DataFrame,
                   dim_date: DataFrame | None = None, dim_location: DataFrame | None = None,
                   label_value: str = LABEL_VALUE, audit: bool = True) -> DataFrame:
    """M1: fact left-joined to the four dimensions; PII and leakage left out.

    Customer and product dimensions keep the reference's DISTINCT semantics
    (a key with two attribute versions fans out), so they are real joins,
    broadcast when their counted size is within the bound
    (``marts.sized_dimension``), otherwise planned as shuffle joins.  Date and
    location attributes are functions of columns the fact row already
    carries (dim_date is keyed by the date of ``order_date``; the location
    key hashes the location tuple), so when those dimensions are not given
    explicitly they are derived in place — the same values a join on the
    derived dimension returns, without a fact-sized shuffle.
    """
    f = fact.alias("f")
    c = sized_dimension(dim_customers.select("customer_id", "customer_segment")).alias("c")
    p = sized_dimension(dim_products.select("product_card_id", "product_price", "category_name",
                                            "department_name")).alias("p")
    star = (f.join(c, F.col("f.customer_id") == F.col("c.customer_id"), "left")
             .join(p, F.col("f.product_card_id") == F.col("p.product_card_id"), "left"))

    if dim_date is None:
        weekend = F.when(F.col("f.date_key").isNotNull(), is_weekend(F.to_date(F.col("f.order_date"))))
    else:
        d = sized_dimension(dim_date.select("date_key", "is_weekend")).alias("d")
        star = star.join(d, F.col("f.date_key") == F.col("d.date_key"), "left")
        weekend = F.col("d.is_weekend")

    if dim_location is None:
        raise ValueError("pass dim_location, or use fraud_features_from_silver for in-place location")
    s = sized_dimension(dim_location.select("shipping_location_id", "latitude", "longitude", "order_region",
                                            "order_country")).alias("s")
    star = star.join(s, F.col("f.shipping_location_id") == F.col("s.shipping_location_id"), "left")
    return _feature_projection(star, weekend, F.col("s.latitude"), F.col("s.longitude"),
                               F.col("s.order_region"), F.col("s.order_country"), label_value, audit)


def fraud_features_from_silver(stg: DataFrame, dim_customers: DataFrame, dim_products: DataFrame,
                               label_value: str = LABEL_VALUE, audit: bool = True, own_dims: bool = False) -> DataFrame:
    """M1 from silver: location and date attributes taken from the row itself.

    A fact row's location key is non-null exactly when all seven location
    columns are, and then it names the dimension row holding those same
    values — so the location features are the row's own values under that
    condition.  This removes two of the four dimension joins.  ``own_dims``
    says that the dimensions are those of this silver, written: then only keys
    with several rows are joined (``versions``), and all others have their
    row's own attributes, so no shuffle carries the fact where keys are unique.
    """
    from starmart.operators.marts import attach_location_key

    f = attach_location_key(stg).alias("f")
    if own_dims:
        f, customer = _own_or_versions(f, dim_customers, "customer_id", ["customer_segment"])
        f, product = _own_or_versions(f, dim_products, "product_card_id", ["product_price", "category_name", "department_name"])
        return _feature_projection(f, *_own_date_and_location(), label_value=label_value, audit=audit, attrs={**customer, **product})
    c = sized_dimension(dim_customers.select("customer_id", "customer_segment")).alias("c")
    p = sized_dimension(dim_products.select("product_card_id", "product_price", "category_name",
                                            "department_name")).alias("p")
    star = (f.join(c, F.col("f.customer_id") == F.col("c.customer_id"), "left")
             .join(p, F.col("f.product_card_id") == F.col("p.product_card_id"), "left"))
    return _feature_projection(star, *_own_date_and_location(), label_value=label_value, audit=audit)


def own_features(stg: DataFrame, label_value: str = LABEL_VALUE, audit: bool = True) -> DataFrame:
    """M1 from silver that is read once: its features are written, and its own dimensions are looked up in them.

    The rows are those of ``fraud_features_from_silver`` with the customer and
    product dimensions of this silver.  A dimension's DISTINCT only matters for
    a key with several rows in it, and to find those no attribute has to be
    sent: a line keeps a 64-bit hash of them, and a key's smallest and largest
    hash differ where it has several rows.  Keys are spread over all lines, so
    most lines' keys pass the shuffle once a task: with two numbers, not with
    nine texts.  Two rows of one key whose hashes are equal would count as one
    (2^-64 a pair).
    """
    f = stg.alias("f")
    dims = {"customer_id": (CUSTOMER_COLUMNS, ["customer_segment"]), "product_card_id": (PRODUCT_COLUMNS, ["product_price", "category_name", "department_name"])}
    own = {a: F.when(F.col(f"f.{key}").isNotNull(), F.col(f"f.{a}")) for key, (_, attrs) in dims.items() for a in attrs}
    rows = _feature_projection(f, *_own_date_and_location(), label_value=label_value, audit=False, attrs=own,
                               more=[F.col("f.product_card_id"), *[_row_hash(columns).alias(f"_row_{key}") for key, (columns, _) in dims.items()]])
    rows = written(rows)
    out = rows
    for key, (_, attrs) in dims.items():
        h = f"_row_{key}"
        several = written(rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(h).alias("_low"), F.max(h).alias("_high"))
                          .where("_low <> _high").select(key))
        if several.isEmpty():
            continue
        versions = rows.select(key, h, *attrs).distinct().join(sized_dimension(several, is_table=True), key, "left_semi")
        versions = sized_dimension(versions.select(F.col(key).alias("_key"), *[F.col(a).alias(f"_v_{a}") for a in attrs]))
        out = out.join(versions, F.col(key) == F.col("_key"), "left").withColumns(
            {a: F.when(F.col("_key").isNotNull(), F.col(f"_v_{a}")).otherwise(F.col(a)) for a in attrs}).drop("_key", *[f"_v_{a}" for a in attrs])
    out = out.select(*FEATURE_ID_COLUMNS, *FEATURE_COLUMNS, "order_status", "target")
    return out.withColumn("created_at", F.current_timestamp()) if audit else out


def _row_hash(columns: list[str]):
    """64-bit hash of a dimension's row; a hash skips nulls, so where they are goes in as well."""
    return F.xxhash64(*[x for c in columns for x in (F.col(f"f.{c}"), F.col(f"f.{c}").isNull())])


def _own_date_and_location() -> list:
    """Weekend, latitude, longitude, region and country from the row's own values."""
    # where the key is set, without hashing the columns for it
    has_loc = F.lit(True)
    for c in LOCATION_COLUMNS:
        has_loc = has_loc & F.col(f"f.{c}").isNotNull()
    weekend = F.when(F.col("f.date_key").isNotNull(), is_weekend(F.col("f.full_date")))
    return [weekend, *[F.when(has_loc, F.col(f"f.{x}")) for x in ("latitude", "longitude", "order_region", "order_country")]]


def _own_or_versions(f: DataFrame, dim: DataFrame, key: str, attrs: list[str]) -> tuple[DataFrame, dict]:
    """Rows ``f`` fanned out as a left join with their own dimension would, and its attributes.

    A key with one row in the dimension has the row's own values; the rows of
    the other keys, which are few or none in a clean dimension, are joined.  A
    null key matches nothing.
    """
    dim = dim.select(key, *attrs)
    several = dim.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(key)
    versions = sized_dimension(dim.join(several, key, "left_semi").select(F.col(key).alias(f"_v_{key}"), *[F.col(a).alias(f"_v_{a}") for a in attrs]))
    own, other = F.col(f"f.{key}"), F.col(f"_v_{key}")
    star = f.join(versions, own == other, "left")
    return star, {a: F.when(other.isNotNull(), F.col(f"_v_{a}")).when(own.isNotNull(), F.col(f"f.{a}")) for a in attrs}


def _feature_projection(star, weekend, lat, lon, region, country, label_value, audit, attrs=None, more=()):
    attrs = attrs or {"customer_segment": F.col("c.customer_segment"), **{a: F.col(f"p.{a}") for a in ("product_price", "category_name", "department_name")}}
    od = F.col("f.order_date")
    cols = {
        "order_item_id": F.col("f.order_item_id"), "order_id": F.col("f.order_id"),
        "customer_id": F.col("f.customer_id"),
        "payment_type": F.col("f.payment_type"), "order_item_quantity": F.col("f.order_item_quantity"),
        "sales": F.col("f.sales"), "sales_per_customer": F.col("f.sales_per_customer"),
        "benefit_per_order": F.col("f.benefit_per_order"),
        "order_profit_per_order": F.col("f.order_profit_per_order"),
        "order_item_total": F.col("f.order_item_total"), "order_item_discount": F.col("f.order_item_discount"),
        "order_item_discount_rate": F.col("f.order_item_discount_rate"),
        "order_item_profit_ratio": F.col("f.order_item_profit_ratio"),
        "shipping_mode": F.col("f.shipping_mode"),
        "order_month": F.month(od), "order_day": F.dayofmonth(od), "order_hour": F.hour(od),
        "order_day_of_week": day_of_week_sun0(od),
        **attrs,
        "is_weekend": weekend, "latitude": lat, "longitude": lon,
        "order_region": region, "order_country": country,
    }
    out = [cols[c].alias(c) for c in FEATURE_ID_COLUMNS + FEATURE_COLUMNS]
    out += [F.col("f.order_status").alias("order_status"),
            F.when(F.col("f.order_status") == F.lit(label_value), 1).otherwise(0).alias("target")]
    if audit:
        out.append(F.current_timestamp().alias("created_at"))
    return star.select(*out, *more)


def event_time_parts(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Month, day, hour and Sunday-0 day of week of a timestamp."""
    t = F.col(ts)
    return df.select("*", F.month(t).alias("order_month"), F.dayofmonth(t).alias("order_day"),
                     F.hour(t).alias("order_hour"), day_of_week_sun0(t).alias("order_day_of_week"))


def prepare_features(df: DataFrame) -> DataFrame:
    """M2 (training): drop the status and audit columns (P10, missing ones ignored)."""
    return df.drop("order_status", "created_at")


def prepare_for_prediction(df: DataFrame) -> DataFrame:
    """M2 (scoring): drop target, status and audit columns."""
    return df.drop("target", "order_status", "created_at")


def check_frame(df: DataFrame, required: list[str] | None = None, target: str = "target") -> list[str]:
    """Q8: non-empty, required columns present, target never null."""
    required = REQUIRED_COLUMNS if required is None else required
    missing = [c for c in required if c not in df.columns]
    if missing:
        return [f"required columns missing: {missing}"]
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(target).isNull()).alias("n_null")).first()
    errors = []
    if row["n"] == 0:
        errors.append("frame is empty")
    if row["n_null"]:
        errors.append(f"{target} contains {row['n_null']} null values")
    return errors


def frame_checks(df: DataFrame, required: list[str] | None = None, target: str = "target") -> DataFrame:
    """Q8 as a result table ``(check_name, n_failed)``: a required column that is missing, an empty frame, null targets."""
    required = REQUIRED_COLUMNS if required is None else required
    nulls = F.count_if(F.col(target).isNull()) if target in df.columns else F.lit(0)
    found = df.agg((F.count(F.lit(1)) == 0).cast("long").alias("empty"), nulls.cast("long").alias("nulls"))
    rows = [F.struct(F.lit(f"column {c}").alias("check_name"), F.lit(int(c not in df.columns)).cast("long").alias("n_failed")) for c in required]
    rows += [F.struct(F.lit("not empty").alias("check_name"), F.col("empty").alias("n_failed")),
             F.struct(F.lit("target not null").alias("check_name"), F.col("nulls").alias("n_failed"))]
    return found.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def profile_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """A5: min, max, mean, sample std of every numeric column in one pass.

    NaN is treated as missing (pandas semantics).
    """
    aggs = []
    for c in columns:
        v = F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
        aggs += [F.min(v).alias(f"{c}__min"), F.max(v).alias(f"{c}__max"),
                 F.avg(v).alias(f"{c}__mean"), F.stddev_samp(v).alias(f"{c}__std")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max"),
                     F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std")) for c in columns]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value, value_count) for every non-null value of every column.

    One unpivot + one partial hash aggregate, instead of one job per column.
    """
    long = df.select([F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], columns, "column_name", "value")
    return long.where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("value_count"))


def profile_categorical(df: DataFrame, columns: list[str], top: int = 5) -> DataFrame:
    """Distinct count and the ``top`` most frequent values per column.

    Ties on count are broken by value ascending.  The rank filter is planned
    as a WindowGroupLimit, so each task ships at most ``top`` rows per column
    to the final ranking.
    """
    vc = value_counts(df, columns)
    w = Window.partitionBy("column_name").orderBy(F.desc("value_count"), F.asc("value"))
    tops = vc.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    uniq = vc.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_unique"))
    return tops.join(uniq, "column_name")


def profile_boolean(df: DataFrame, columns: list[str]) -> DataFrame:
    """True count and ``rows - true`` per boolean column."""
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count_if(F.col(c)).alias(f"{c}__t") for c in columns]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__t").alias("n_true"),
                     (F.col("_n") - F.col(f"{c}__t")).alias("n_false")) for c in columns]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def class_balance(df: DataFrame, target: str = "target") -> DataFrame:
    """Class counts, percentages and the imbalance ratio n0 / max(n1, 1).

    An empty frame has null percentages.
    """
    n1 = F.count_if(F.col(target) == 1)
    n0 = F.count_if(F.col(target) == 0)
    n = F.count(F.lit(1))
    return df.agg(n.alias("n_rows"), n1.alias("n_fraud"), n0.alias("n_clean"),
                  F.round(F.try_divide(n1 * F.lit(100.0), n.cast("double")), 4).alias("pct_fraud"),
                  F.round(F.try_divide(n0 * F.lit(100.0), n.cast("double")), 4).alias("pct_clean"),
                  F.round(n0 / F.greatest(n1, F.lit(1)), 4).alias("imbalance_ratio"))
