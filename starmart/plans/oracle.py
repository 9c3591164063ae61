"""Independent DuckDB SQL for every catalogued query.

The views ``region nation customer supplier part orders lineitem events``
are registered by the checker.  ``STG`` rebuilds the silver layer straight
from them (fixture mapping + staging casts in one SELECT); every other query
is written on top of it as plain SQL, not generated from the Spark code.
"""

from __future__ import annotations

STG = """
nr AS (
  SELECT n_nationkey, n_name, r_name
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
),
lo AS (
  SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
               l_tax, l_returnflag, l_linestatus, l_shipdate) AS seq
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
),
stg AS (
  SELECT
    l_orderkey * 100000 + l_linenumber * 10000 + seq AS order_item_id,
    l_orderkey AS order_id,
    o_custkey AS customer_id,
    l_partkey AS product_card_id,
    CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER) AS date_key,
    o_orderdate AS order_date,
    CAST(o_orderdate AS DATE) AS full_date,
    l_shipdate AS shipping_date,
    trim(c_name) AS customer_first_name,
    'Unknown' AS customer_last_name,
    trim(c_mktsegment) AS customer_segment,
    trim(cn.r_name) AS customer_city,
    trim(cn.n_name) AS customer_state,
    trim(cn.n_name) AS customer_country,
    trim(' ' || c_name || ' ') AS customer_street,
    trim(coalesce(CAST(c_nationkey AS VARCHAR), 'Unknown')) AS customer_zipcode,
    trim(p_name) AS product_name,
    CAST(p_retailprice AS DOUBLE) AS product_price,
    CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS product_status,
    CAST(p_size AS INTEGER) AS category_id,
    trim(p_type) AS category_name,
    CAST(substring(p_brand, 7, 10) AS INTEGER) AS department_id,
    trim(p_brand) AS department_name,
    trim(o_orderpriority) AS payment_type,
    trim(l_linestatus) AS delivery_status,
    trim(o_orderstatus) AS order_status,
    CASE WHEN CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) > 60 THEN 1 ELSE 0 END AS late_delivery_risk,
    CAST(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS DOUBLE) AS days_for_shipping_real,
    CAST(60 AS DOUBLE) AS days_for_shipment_scheduled,
    trim(l_returnflag) AS shipping_mode,
    l_extendedprice AS sales,
    l_extendedprice * (1 - l_discount) AS sales_per_customer,
    o_totalprice AS benefit_per_order,
    o_totalprice * CAST(0.25 AS DOUBLE) AS order_profit_per_order,
    l_extendedprice * (1 - l_discount) AS order_item_total,
    l_extendedprice * l_discount AS order_item_discount,
    l_discount AS order_item_discount_rate,
    l_tax AS order_item_profit_ratio,
    CAST(l_quantity AS INTEGER) AS order_item_quantity,
    trim(s_name) AS order_city,
    trim(sn.n_name) AS order_state,
    trim(sn.n_name) AS order_country,
    'Unknown' AS order_zipcode,
    s_acctbal / 100 AS latitude,
    CAST(s_nationkey AS DOUBLE) * CAST(7.5 AS DOUBLE) - CAST(90 AS DOUBLE) AS longitude,
    trim(sn.r_name) AS order_region
  FROM lo
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nr cn ON c_nationkey = cn.n_nationkey
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN nr sn ON s_nationkey = sn.n_nationkey
)"""

DIMS = """,
dim_customers AS (
  SELECT DISTINCT customer_id, customer_first_name, customer_last_name, customer_segment,
         customer_city, customer_state, customer_country, customer_street, customer_zipcode
  FROM stg
),
dim_products AS (
  SELECT DISTINCT product_card_id, product_name, product_price, product_status,
         category_id, category_name, department_id, department_name
  FROM stg
),
dim_date AS (
  SELECT date_key, full_date,
         CAST(year(full_date) AS INTEGER) AS year,
         CAST(quarter(full_date) AS INTEGER) AS quarter,
         CAST(month(full_date) AS INTEGER) AS month,
         rpad(monthname(full_date), 9, ' ') AS month_name,
         CAST(weekofyear(full_date) AS INTEGER) AS week,
         CAST(day(full_date) AS INTEGER) AS day,
         CASE WHEN isodow(full_date) IN (6, 7) THEN true ELSE false END AS is_weekend
  FROM (SELECT DISTINCT date_key, full_date FROM stg)
),
loc AS (
  SELECT DISTINCT order_city, order_state, order_country, order_zipcode, latitude, longitude, order_region
  FROM stg
),
dim_shipping_location AS (
  SELECT md5(concat_ws('-',
           coalesce(CAST(order_city AS VARCHAR), '_null_'),
           coalesce(CAST(order_state AS VARCHAR), '_null_'),
           coalesce(CAST(order_country AS VARCHAR), '_null_'),
           coalesce(CAST(order_zipcode AS VARCHAR), '_null_'),
           coalesce(CAST(CAST(latitude AS DECIMAL(38,10)) AS VARCHAR), '_null_'),
           coalesce(CAST(CAST(longitude AS DECIMAL(38,10)) AS VARCHAR), '_null_'),
           coalesce(CAST(order_region AS VARCHAR), '_null_'))) AS shipping_location_id,
         order_city, order_state, order_country, order_zipcode, latitude, longitude, order_region
  FROM loc
),
fact AS (
  SELECT s.order_item_id, s.order_id, s.customer_id, s.product_card_id, s.date_key,
         d.shipping_location_id, s.payment_type, s.delivery_status, s.order_status,
         s.late_delivery_risk, s.shipping_mode, s.order_date, s.shipping_date,
         s.days_for_shipping_real, s.days_for_shipment_scheduled, s.sales,
         s.sales_per_customer, s.benefit_per_order, s.order_profit_per_order,
         s.order_item_total, s.order_item_discount, s.order_item_discount_rate,
         s.order_item_profit_ratio, s.order_item_quantity
  FROM stg s LEFT JOIN dim_shipping_location d
    ON s.order_city = d.order_city AND s.order_state = d.order_state
   AND s.order_country = d.order_country AND s.order_zipcode = d.order_zipcode
   AND s.latitude = d.latitude AND s.longitude = d.longitude
   AND s.order_region = d.order_region
)"""


def with_star(body: str) -> str:
    """Prefix a query body with the silver, dimension and fact CTEs."""
    return "WITH " + STG + DIMS + "\n" + body


def with_stg(body: str) -> str:
    return "WITH " + STG + "\n" + body


ORACLE: dict[str, str] = {}


def oracle(name: str):
    def deco(fn):
        ORACLE[name] = fn()
        return fn
    return deco


@oracle("monthly_category_sales")
def _():
    return with_star("""
SELECT d.year, d.month, p.category_name,
       CAST(round(sum(CAST(f.sales AS DECIMAL(24,4))), 2) AS DOUBLE) AS total_sales, count(*) AS n_lines
FROM fact f
JOIN dim_date d ON f.date_key = d.date_key
JOIN dim_products p ON f.product_card_id = p.product_card_id
GROUP BY d.year, d.month, p.category_name""")


@oracle("stg_orders")
def _():
    return with_stg("SELECT * FROM stg")


@oracle("dim_customers")
def _():
    return with_star("SELECT * FROM dim_customers")


@oracle("dim_products")
def _():
    return with_star("SELECT * FROM dim_products")


@oracle("dim_date")
def _():
    return with_star("SELECT * FROM dim_date")


@oracle("dim_shipping_location")
def _():
    return with_star("SELECT * FROM dim_shipping_location")


@oracle("fact_order_items")
def _():
    return with_star("SELECT * FROM fact")


FEATURES = """,
features AS (
  SELECT f.order_item_id, f.order_id, f.customer_id,
         f.payment_type, f.order_item_quantity, f.sales, f.sales_per_customer,
         f.benefit_per_order, f.order_profit_per_order, f.order_item_total,
         f.order_item_discount, f.order_item_discount_rate, f.order_item_profit_ratio,
         f.shipping_mode,
         CAST(month(f.order_date) AS INTEGER) AS order_month,
         CAST(day(f.order_date) AS INTEGER) AS order_day,
         CAST(hour(f.order_date) AS INTEGER) AS order_hour,
         CAST(dayofweek(f.order_date) AS INTEGER) AS order_day_of_week,
         c.customer_segment, p.product_price, p.category_name, p.department_name,
         d.is_weekend, s.latitude, s.longitude, s.order_region, s.order_country,
         f.order_status,
         CASE WHEN f.order_status = 'P' THEN 1 ELSE 0 END AS target
  FROM fact f
  LEFT JOIN dim_customers c ON f.customer_id = c.customer_id
  LEFT JOIN dim_products p ON f.product_card_id = p.product_card_id
  LEFT JOIN dim_date d ON f.date_key = d.date_key
  LEFT JOIN dim_shipping_location s ON f.shipping_location_id = s.shipping_location_id
)"""


def with_features(body: str) -> str:
    return "WITH " + STG + DIMS + FEATURES + "\n" + body


NUMERIC_PROFILE_COLUMNS = [
    "order_item_quantity", "sales", "sales_per_customer", "benefit_per_order",
    "order_profit_per_order", "order_item_total", "order_item_discount",
    "order_item_discount_rate", "order_item_profit_ratio", "order_month", "order_day",
    "order_hour", "order_day_of_week", "product_price", "latitude", "longitude",
]
CATEGORICAL_PROFILE_COLUMNS = [
    "payment_type", "shipping_mode", "customer_segment", "category_name",
    "department_name", "order_region", "order_country",
]


@oracle("fraud_features")
def _():
    return with_features("SELECT * FROM features")


@oracle("event_time_parts")
def _():
    return """
SELECT *, CAST(month(ts) AS INTEGER) AS order_month, CAST(day(ts) AS INTEGER) AS order_day,
       CAST(hour(ts) AS INTEGER) AS order_hour, CAST(dayofweek(ts) AS INTEGER) AS order_day_of_week
FROM events"""


@oracle("dim_customers_latest")
def _():
    return with_stg("""
, versions AS (
  SELECT customer_id, customer_first_name, customer_last_name, customer_segment, customer_city,
         customer_state, customer_country, customer_street || ' ' || payment_type AS customer_street,
         customer_zipcode, order_date, order_item_id
  FROM stg
)
SELECT customer_id, customer_first_name, customer_last_name, customer_segment, customer_city,
       customer_state, customer_country, customer_street, customer_zipcode
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
        ORDER BY order_date DESC NULLS LAST, order_item_id DESC NULLS LAST) AS rn FROM versions)
WHERE rn = 1""")


@oracle("fact_incremental_new_only")
def _():
    return with_star("""
, existing AS (SELECT * FROM fact WHERE order_date < TIMESTAMP '1998-01-01')
SELECT * FROM fact
WHERE order_date >= TIMESTAMP '1997-01-01'
  AND order_item_id NOT IN (SELECT order_item_id FROM existing)""")


@oracle("fact_incremental_null_target")
def _():
    return with_star("""
, existing AS (
  SELECT CASE WHEN delivery_status = 'F' AND order_date < TIMESTAMP '1995-02-01'
              THEN NULL ELSE order_item_id END AS order_item_id
  FROM fact WHERE order_date < TIMESTAMP '1998-01-01'
)
SELECT * FROM fact
WHERE order_date >= TIMESTAMP '1997-01-01'
  AND order_item_id NOT IN (SELECT order_item_id FROM existing)""")


@oracle("fact_merge")
def _():
    return with_star("""
, existing AS (
  SELECT * REPLACE (sales + 1 AS sales) FROM fact WHERE order_date < TIMESTAMP '1998-01-01'
),
batch AS (SELECT * FROM fact WHERE order_date >= TIMESTAMP '1997-01-01')
SELECT * FROM existing WHERE order_item_id NOT IN (SELECT order_item_id FROM batch)
UNION ALL
SELECT * FROM batch""")


@oracle("profile_numeric")
def _():
    parts = [f"""SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
       round(avg(CAST({c} AS DOUBLE)), 4) AS mean, round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std
FROM features""" for c in NUMERIC_PROFILE_COLUMNS]
    return with_features("\nUNION ALL\n".join(parts))


@oracle("profile_categorical_top5")
def _():
    parts = [f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM features"
             for c in CATEGORICAL_PROFILE_COLUMNS]
    return with_features(f"""
, long AS ({' UNION ALL '.join(parts)}),
vc AS (SELECT column_name, value, count(*) AS value_count FROM long WHERE value IS NOT NULL GROUP BY 1, 2),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY column_name
             ORDER BY value_count DESC, value ASC) AS INTEGER) AS rank FROM vc),
uniq AS (SELECT column_name, count(*) AS n_unique FROM vc GROUP BY 1)
SELECT r.column_name, r.value, r.value_count, r.rank, u.n_unique
FROM ranked r JOIN uniq u ON r.column_name = u.column_name
WHERE r.rank <= 5""")


@oracle("profile_boolean")
def _():
    return with_features("""
SELECT 'is_weekend' AS column_name, CAST(count_if(is_weekend) AS BIGINT) AS n_true,
       CAST(count(*) - count_if(is_weekend) AS BIGINT) AS n_false
FROM features""")


@oracle("class_balance")
def _():
    return with_features("""
SELECT count(*) AS n_rows, CAST(count_if(target = 1) AS BIGINT) AS n_fraud,
       CAST(count_if(target = 0) AS BIGINT) AS n_clean,
       round(CAST(count_if(target = 1) AS DOUBLE) * 100 / count(*), 4) AS pct_fraud,
       round(CAST(count_if(target = 0) AS DOUBLE) * 100 / count(*), 4) AS pct_clean,
       round(CAST(count_if(target = 0) AS DOUBLE) / greatest(count_if(target = 1), 1), 4) AS imbalance_ratio
FROM features""")


DIRTY = """,
dirty AS (
  SELECT * REPLACE (
    CASE WHEN order_item_quantity = 13 THEN NULL WHEN order_item_quantity = 20 THEN 1
         ELSE order_item_id END AS order_item_id,
    CASE WHEN shipping_mode = 'R' AND order_item_quantity < 5 THEN order_item_quantity - 5
         ELSE order_item_quantity END AS order_item_quantity,
    CASE WHEN order_status = 'F' THEN 'CANCELED'
         WHEN payment_type = '5-LOW' AND order_item_quantity > 45 THEN NULL
         ELSE order_status END AS order_status,
    CASE WHEN delivery_status = 'O' AND order_item_quantity < 10 THEN -sales ELSE sales END AS sales,
    CASE WHEN order_item_quantity = 33 THEN CAST('NaN' AS DOUBLE)
         WHEN payment_type = '1-URGENT' THEN order_item_discount_rate * 11
         ELSE order_item_discount_rate END AS order_item_discount_rate,
    CASE WHEN order_item_quantity = 49 THEN 2 WHEN order_item_quantity = 48 THEN NULL
         ELSE late_delivery_risk END AS late_delivery_risk)
  FROM stg
)"""


def _landing_sql(source: str, by: str | None) -> str:
    key = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    rate = "order_item_discount_rate"
    checks = [
        ("not_null", "order_id", "order_id IS NULL"),
        ("not_null", "order_item_id", "order_item_id IS NULL"),
        ("not_null", "product_card_id", "product_card_id IS NULL"),
        ("not_null", "order_date", "order_date IS NULL"),
        ("min_value", "order_item_quantity", "order_item_quantity < 1"),
        ("non_negative_unless_exempt", "sales",
         "(order_status IS NULL OR order_status NOT IN ('CANCELED', 'SUSPECTED_FRAUD')) AND sales < 0"),
        ("range_0_1", rate, f"NOT isnan({rate}) AND ({rate} < 0 OR {rate} > 1)"),
        ("accepted_values_0_1", "late_delivery_risk",
         "late_delivery_risk IS NULL OR late_delivery_risk NOT IN (0, 1)"),
    ]
    parts = [f"SELECT {key}'{chk}' AS \"check\", '{col}' AS column_name, "
             f"CAST(count_if(coalesce({cond}, false)) AS BIGINT) AS failing_rows FROM {source} {group}"
             for chk, col, cond in checks]
    parts.append(f"SELECT {key}'duplicates' AS \"check\", 'order_item_id' AS column_name, "
                 f"CAST(count(*) - count(DISTINCT order_item_id) - max(CASE WHEN order_item_id IS NULL "
                 f"THEN 1 ELSE 0 END) AS BIGINT) AS failing_rows FROM {source} {group}")
    return "SELECT *, failing_rows = 0 AS passed FROM (\n" + "\nUNION ALL\n".join(parts) + "\n)"


@oracle("quality_landing")
def _():
    return with_stg(DIRTY + "\n" + _landing_sql("dirty", None))


@oracle("quality_by_run")
def _():
    return with_stg(DIRTY + ",\nruns AS (SELECT *, CAST(year(order_date) AS BIGINT) AS etl_run_id FROM dirty)\n"
                    + _landing_sql("runs", "etl_run_id"))


FEATURE_NOT_NULL = (["order_item_id", "order_id", "customer_id", "payment_type", "order_item_quantity",
                     "sales", "sales_per_customer", "benefit_per_order", "order_profit_per_order",
                     "order_item_total", "order_item_discount", "order_item_discount_rate",
                     "order_item_profit_ratio", "shipping_mode", "order_month", "order_day", "order_hour",
                     "order_day_of_week", "customer_segment", "product_price", "category_name",
                     "department_name", "is_weekend", "latitude", "longitude", "order_region",
                     "order_country", "order_status", "target"])


def _nn(model: str, table: str, col: str) -> str:
    return (f"SELECT '{model}' AS model, 'not_null' AS \"check\", '{col}' AS column_name, "
            f"CAST(count_if({col} IS NULL) AS BIGINT) AS failing_rows FROM {table}")


def _uq(model: str, table: str, col: str) -> str:
    return (f"SELECT '{model}' AS model, 'unique' AS \"check\", '{col}' AS column_name, "
            f"count(*) AS failing_rows FROM (SELECT {col} FROM {table} WHERE {col} IS NOT NULL "
            f"GROUP BY {col} HAVING count(*) > 1)")


def _rel(model: str, table: str, col: str, parent: str, field: str) -> str:
    return (f"SELECT '{model}' AS model, 'relationships' AS \"check\", '{col}' AS column_name, "
            f"count(*) AS failing_rows FROM {table} c WHERE c.{col} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{field} = c.{col})")


def _suite(parts: list[str]) -> str:
    return "SELECT *, failing_rows = 0 AS passed FROM (\n" + "\nUNION ALL\n".join(parts) + "\n)"


@oracle("quality_suite")
def _():
    parts = [_uq("stg_orders", "stg", "order_item_id")]
    parts += [_nn("stg_orders", "stg", c)
              for c in ("order_item_id", "order_id", "customer_id", "product_card_id", "date_key")]
    for model, key in (("dim_customers", "customer_id"), ("dim_products", "product_card_id"),
                       ("dim_date", "date_key"), ("dim_shipping_location", "shipping_location_id"),
                       ("fact_order_items", "order_item_id")):
        table = "fact" if model == "fact_order_items" else model
        parts += [_uq(model, table, key), _nn(model, table, key)]
    parts += [_rel("fact_order_items", "fact", "customer_id", "dim_customers", "customer_id"),
              _rel("fact_order_items", "fact", "product_card_id", "dim_products", "product_card_id"),
              _rel("fact_order_items", "fact", "date_key", "dim_date", "date_key"),
              _rel("fact_order_items", "fact", "shipping_location_id", "dim_shipping_location",
                   "shipping_location_id")]
    parts.append(_uq("fraud_features", "features", "order_item_id"))
    parts += [_nn("fraud_features", "features", c) for c in FEATURE_NOT_NULL]
    # created_at is now(): never null.
    parts.append("SELECT 'fraud_features' AS model, 'not_null' AS \"check\", 'created_at' AS column_name, "
                 "CAST(0 AS BIGINT) AS failing_rows")
    return with_features(_suite(parts))


@oracle("quality_dirty")
def _():
    body = """,
dc2 AS (SELECT DISTINCT customer_id, customer_first_name, customer_last_name, customer_segment,
          customer_city, customer_state, customer_country, customer_street || ' ' || payment_type AS customer_street,
          customer_zipcode FROM stg),
dp2 AS (SELECT * FROM dim_products WHERE product_status = 0),
f2 AS (SELECT * REPLACE (CASE WHEN shipping_mode <> 'A' THEN latitude END AS latitude) FROM features)
"""
    parts = [_uq("dim_customers", "dc2", "customer_id"), _nn("dim_customers", "dc2", "customer_id"),
             _rel("fact_order_items", "fact", "customer_id", "dc2", "customer_id"),
             _rel("fact_order_items", "fact", "product_card_id", "dp2", "product_card_id"),
             _uq("fraud_features", "f2", "order_item_id")]
    parts += [_nn("fraud_features", "f2", c) for c in FEATURE_NOT_NULL]
    return with_features(body + _suite(parts))


@oracle("quality_tolerance")
def _():
    return with_stg("""
, t AS (SELECT * REPLACE (CASE WHEN order_item_quantity <> 50 THEN sales END AS sales,
        CASE WHEN order_item_quantity <> 1 OR shipping_mode <> 'N' THEN product_price END AS product_price)
        FROM stg),
r AS (
  SELECT 'null_fraction' AS "check", 'sales' AS column_name, CAST(count_if(sales IS NULL) AS BIGINT) AS failing_rows, count(*) AS total_rows FROM t
  UNION ALL SELECT 'null_fraction', 'product_price', CAST(count_if(product_price IS NULL) AS BIGINT), count(*) FROM t
  UNION ALL SELECT 'null_fraction', 'customer_id', CAST(count_if(customer_id IS NULL) AS BIGINT), count(*) FROM t
  UNION ALL SELECT 'date_range', 'order_date', CAST(count_if(order_date < TIMESTAMP '1995-01-01 00:00:00'
        OR order_date > TIMESTAMP '2000-12-31 23:59:59') AS BIGINT), count(*) FROM t
  UNION ALL SELECT 'accepted_values', 'order_status', CAST(count_if(order_status IS NULL
        OR order_status NOT IN ('F', 'O')) AS BIGINT), count(*) FROM t
)
SELECT *, round(CAST(failing_rows AS DOUBLE) / total_rows, 6) AS fraction,
       CASE WHEN "check" = 'null_fraction' THEN round(CAST(failing_rows AS DOUBLE) / total_rows, 6) < 0.015
            ELSE failing_rows = 0 END AS passed
FROM r""")


@oracle("rollup_sales")
def _():
    return with_star("""
SELECT p.department_name, p.category_name,
       CAST(round(sum(CAST(f.sales AS DECIMAL(24,4))), 4) AS DOUBLE) AS sum_sales,
       CAST(round(sum(CAST(f.order_item_total AS DECIMAL(24,4))), 4) AS DOUBLE) AS sum_order_item_total,
       CAST(round(sum(CAST(f.order_item_discount AS DECIMAL(24,4))), 4) AS DOUBLE) AS sum_order_item_discount,
       CAST(sum(CAST(f.order_item_quantity AS DECIMAL(24,4))) AS DOUBLE) AS sum_order_item_quantity, count(*) AS n_lines
FROM fact f JOIN dim_products p ON f.product_card_id = p.product_card_id
GROUP BY ROLLUP (p.department_name, p.category_name)""")


@oracle("sales_per_customer")
def _():
    return with_star("""
SELECT payment_type, round(CAST(sum(CAST(sales AS DECIMAL(24,4))) AS DOUBLE) / count(DISTINCT customer_id), 6) AS sales_per_customer,
       count(DISTINCT customer_id) AS n_customers
FROM fact GROUP BY payment_type""")


@oracle("order_level_once")
def _():
    return with_star("""
SELECT order_status, CAST(round(sum(CAST(v AS DECIMAL(24,4))), 2) AS DOUBLE) AS sum_benefit_per_order, count(*) AS n_orders
FROM (SELECT order_status, order_id, max(benefit_per_order) AS v FROM fact GROUP BY order_status, order_id)
GROUP BY order_status""")


@oracle("weighted_ratio")
def _():
    return with_star("""
SELECT shipping_mode,
       round(sum(order_item_discount_rate * sales) / sum(sales), 6) AS weighted_order_item_discount_rate
FROM fact GROUP BY shipping_mode""")


@oracle("ship_days_avg_median")
def _():
    return with_star("""
SELECT shipping_mode, delivery_status,
       round(avg(days_for_shipping_real), 4) AS avg_days_for_shipping_real,
       quantile_cont(days_for_shipping_real, 0.5) AS median_days_for_shipping_real
FROM fact GROUP BY shipping_mode, delivery_status""")


SCORED = """,
scored AS (
  SELECT order_item_id, order_id, order_date, CAST(order_status = 'P' AS INTEGER) AS label,
         CASE WHEN delivery_status = 'O' THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
           + order_item_discount_rate * 5 AS score
  FROM stg
)"""

GRID = [0.05 + i * 0.05 for i in range(19)]


def _grid_sql() -> str:
    vals = ", ".join(f"(CAST('{t!r}' AS DOUBLE))" for t in GRID)
    return f"grid AS (SELECT * FROM (VALUES {vals}) g(threshold))"


def _sweep_sql() -> str:
    return f""",
{_grid_sql()},
counts AS (
  SELECT threshold,
         CAST(count_if(label = 1 AND score >= threshold) AS BIGINT) AS tp,
         CAST(count_if(label = 0 AND score >= threshold) AS BIGINT) AS fp,
         CAST(count_if(label = 1 AND score < threshold) AS BIGINT) AS fn,
         CAST(count_if(label = 0 AND score < threshold) AS BIGINT) AS tn
  FROM grid, scored GROUP BY threshold
),
sweep AS (
  SELECT round_even(threshold, 2) AS threshold, tp, fp, fn, tn,
         round_even(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 4) AS precision,
         round_even(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 4) AS recall,
         round_even(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 4) AS f1,
         round_even(CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END, 4) AS specificity
  FROM counts
)"""


@oracle("confusion_matrix")
def _():
    return with_stg(SCORED + """
SELECT CAST(count_if(label = 0 AND score < 0.5) AS BIGINT) AS tn,
       CAST(count_if(label = 0 AND score >= 0.5) AS BIGINT) AS fp,
       CAST(count_if(label = 1 AND score < 0.5) AS BIGINT) AS fn,
       CAST(count_if(label = 1 AND score >= 0.5) AS BIGINT) AS tp
FROM scored""")


@oracle("threshold_sweep")
def _():
    return with_stg(SCORED + _sweep_sql() + "\nSELECT * FROM sweep")


@oracle("best_threshold")
def _():
    return with_stg(SCORED + _sweep_sql() + "\nSELECT threshold, f1 FROM sweep ORDER BY f1 DESC, threshold ASC LIMIT 1")


ROC_HIST = """,
h AS (SELECT score, CAST(count_if(label = 1) AS BIGINT) AS pos, CAST(count_if(label = 0) AS BIGINT) AS neg
      FROM scored GROUP BY score),
p AS (SELECT *,
        coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before,
        coalesce(sum(pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_before
      FROM h)"""


@oracle("roc_auc")
def _():
    return with_stg(SCORED + ROC_HIST + """
SELECT round(sum(pos * (neg_before + neg / 2)) / (sum(pos) * sum(neg)), 6) AS roc_auc FROM p""")


@oracle("roc_curve")
def _():
    return with_stg(SCORED + ROC_HIST + """,
t AS (SELECT sum(pos) AS np, sum(neg) AS nn FROM h)
SELECT score AS threshold, round((nn - neg_before) / nn, 6) AS fpr, round((np - pos_before) / np, 6) AS tpr
FROM p, t
UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0""")


@oracle("class_report")
def _():
    return with_stg(SCORED + """,
c AS (SELECT CAST(count_if(label = 0 AND score < 0.5) AS DOUBLE) AS tn,
             CAST(count_if(label = 0 AND score >= 0.5) AS DOUBLE) AS fp,
             CAST(count_if(label = 1 AND score < 0.5) AS DOUBLE) AS fn,
             CAST(count_if(label = 1 AND score >= 0.5) AS DOUBLE) AS tp FROM scored),
m AS (SELECT *, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, 2 * tn / (2 * tn + fn + fp) AS f0,
             tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, 2 * tp / (2 * tp + fp + fn) AS f1,
             tn + fp AS s0, tp + fn AS s1, tn + fp + tp + fn AS n FROM c)
SELECT 'clean' AS class, round_even(p0, 4) AS precision, round_even(r0, 4) AS recall, round_even(f0, 4) AS f1,
       CAST(s0 AS BIGINT) AS support FROM m
UNION ALL SELECT 'fraud', round_even(p1, 4), round_even(r1, 4), round_even(f1, 4), CAST(s1 AS BIGINT) FROM m
UNION ALL SELECT 'accuracy', NULL, NULL, round_even((tp + tn) / n, 4), CAST(n AS BIGINT) FROM m
UNION ALL SELECT 'macro avg', round_even((p0 + p1) / 2, 4), round_even((r0 + r1) / 2, 4),
                 round_even((f0 + f1) / 2, 4), CAST(n AS BIGINT) FROM m
UNION ALL SELECT 'weighted avg', round_even((p0 * s0 + p1 * s1) / n, 4), round_even((r0 * s0 + r1 * s1) / n, 4),
                 round_even((f0 * s0 + f1 * s1) / n, 4), CAST(n AS BIGINT) FROM m""")


SPLIT = """,
class_sizes AS (
  SELECT target, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM features GROUP BY target
),
class_draws AS (
  SELECT target, n, total, (total * 20 + 99) // 100 AS draws FROM class_sizes
),
class_quotas AS (
  SELECT target, (n * draws) // total
         + CASE WHEN row_number() OVER (ORDER BY (n * draws) % total DESC, target)
                     <= draws - sum((n * draws) // total) OVER () THEN 1 ELSE 0 END AS quota
  FROM class_draws
),
split AS (
  SELECT f.*, row_number() OVER (PARTITION BY f.target
                ORDER BY md5(CAST(f.order_item_id AS VARCHAR) || '-42'), f.order_item_id) <= q.quota AS is_test
  FROM features f JOIN class_quotas q ON f.target = q.target
)"""


@oracle("stratified_split")
def _():
    return with_features(SPLIT + "\nSELECT order_item_id, target, is_test FROM split")


def _encoded(columns: str) -> str:
    """``columns`` of the encoded split: s has the split's columns, {c} the codes."""
    cats = CATEGORICAL_PROFILE_COLUMNS
    long = " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM split WHERE NOT is_test"
                              for c in cats)
    joins = "\n".join(f"LEFT JOIN enc m_{c} ON m_{c}.column_name = '{c}' AND m_{c}.value = CAST(s.{c} AS VARCHAR)"
                      for c in cats)
    sel = ", ".join(f"CASE WHEN s.{c} IS NULL THEN NULL ELSE CAST(coalesce(m_{c}.code, -1) AS INTEGER) END AS {c}"
                    for c in cats)
    return SPLIT + f""",
enc AS (
  SELECT column_name, value,
         CAST(dense_rank() OVER (PARTITION BY column_name ORDER BY value) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT column_name, value FROM ({long}) WHERE value IS NOT NULL)
),
encoded AS (SELECT {columns}, {sel}
FROM split s
{joins})"""


@oracle("ordinal_encode")
def _():
    return with_features(_encoded("s.order_item_id, s.is_test") + "\nSELECT * FROM encoded")


RARE_FEATURES = FEATURES.replace(
    "CASE WHEN f.order_status = 'P' THEN 1 ELSE 0 END AS target",
    "CASE WHEN f.order_status = 'P' AND f.payment_type = '1-URGENT' THEN 1 ELSE 0 END AS target")


@oracle("smote_balance")
def _():
    return "WITH " + STG + DIMS + RARE_FEATURES + SPLIT + """
SELECT n_majority, n_minority, CAST(floor(0.5 * n_majority) AS BIGINT) - n_minority AS n_synthetic, CAST(0 AS BIGINT) AS n_outside
FROM (SELECT count(*) FILTER (WHERE target = 0) AS n_majority, count(*) FILTER (WHERE target = 1) AS n_minority
      FROM split WHERE NOT is_test)"""


@oracle("smote_neighbours")
def _():
    from starmart.schemas import CATEGORICAL_FEATURES, FEATURE_COLUMNS

    other = ", ".join(f"s.{c}" for c in FEATURE_COLUMNS if c not in CATEGORICAL_FEATURES)
    x = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS x{i}" for i, c in enumerate(FEATURE_COLUMNS))
    d = " + ".join(f"(a.x{i} - b.x{i}) * (a.x{i} - b.x{i})" for i in range(len(FEATURE_COLUMNS)))
    return "WITH " + STG + DIMS + RARE_FEATURES + _encoded(f"s.order_item_id, s.is_test, s.target, {other}") + f""",
m AS (SELECT order_item_id, {x} FROM encoded WHERE NOT is_test AND target = 1),
p AS (SELECT a.order_item_id, {d} AS d FROM m a JOIN m b ON a.order_item_id <> b.order_item_id)
SELECT order_item_id, CAST(row_number() OVER (PARTITION BY order_item_id ORDER BY d) AS INTEGER) AS place, round(d, 2) AS squared_distance
FROM p QUALIFY place <= 5"""


@oracle("forest_checks")
def _():
    return "WITH " + STG + DIMS + RARE_FEATURES + SPLIT + """
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_out_of_range, CAST(0 AS BIGINT) AS n_wrong_labels,
       count(DISTINCT order_id) AS n_orders
FROM split WHERE is_test"""


@oracle("feature_checks")
def _():
    from starmart.operators.features import REQUIRED_COLUMNS

    rows = " UNION ALL ".join(f"SELECT 'column {c}' AS check_name, CAST({int(c == 'latitude')} AS BIGINT) AS n_failed" for c in REQUIRED_COLUMNS)
    return with_features(f"""
{rows}
UNION ALL SELECT 'not empty', CAST(count(*) = 0 AS BIGINT) FROM features
UNION ALL SELECT 'target not null', count(*) FILTER (WHERE (shipping_mode <> 'A') IS NOT TRUE) FROM features""")


@oracle("stg_orders_text")
def _():
    return with_stg("SELECT * FROM stg")


@oracle("run_scan")
def _():
    return """
SELECT event_id, user_id, event_type, value, CAST(day(ts) AS BIGINT) AS etl_run_id FROM events WHERE day(ts) = 17"""


@oracle("order_lookup")
def _():
    return """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')"""


STORED = """,
existing AS (
  SELECT CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS prediction_id, o_orderkey AS order_id,
         CAST(0.25 AS DOUBLE) AS fraud_probability, false AS predicted_label,
         CAST(0.3 AS DOUBLE) AS threshold_used, 'v0' AS model_version, '1.0.0' AS pipeline_version
  FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'
)"""


def _line_preds(threshold: float) -> str:
    return f""",
lines AS (SELECT order_id, order_item_id, order_date, round_even(score, 6) AS fraud_probability,
                 score >= {threshold} AS predicted_label FROM scored)"""


@oracle("unscored_orders")
def _():
    return with_features(STORED + """
SELECT DISTINCT f.order_id FROM features f LEFT JOIN existing p ON f.order_id = p.order_id
WHERE p.order_id IS NULL""")


@oracle("first_score_per_order")
def _():
    return with_stg(SCORED + STORED + _line_preds(0.3) + """,
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_item_id) AS rn
                          FROM lines) WHERE rn = 1),
fresh AS (SELECT * FROM firsts f WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.order_id = f.order_id))
SELECT CAST((SELECT coalesce(max(prediction_id), 0) FROM existing)
            + row_number() OVER (ORDER BY order_id) AS BIGINT) AS prediction_id,
       order_id, fraud_probability, predicted_label, CAST(0.3 AS DOUBLE) AS threshold_used,
       'v1' AS model_version, '1.0.0' AS pipeline_version
FROM fresh""")


@oracle("upsert_predictions")
def _():
    return with_stg(SCORED + STORED + _line_preds(0.4) + """,
lasts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_item_id DESC) AS rn
                         FROM lines WHERE order_date >= TIMESTAMP '1995-07-01') WHERE rn = 1),
fresh AS (SELECT * FROM lasts l WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.order_id = l.order_id))
SELECT e.prediction_id, e.order_id,
       CASE WHEN l.order_id IS NOT NULL THEN l.fraud_probability ELSE e.fraud_probability END AS fraud_probability,
       CASE WHEN l.order_id IS NOT NULL THEN l.predicted_label ELSE e.predicted_label END AS predicted_label,
       e.threshold_used, e.model_version, e.pipeline_version
FROM existing e LEFT JOIN lasts l ON e.order_id = l.order_id
UNION ALL
SELECT CAST((SELECT coalesce(max(prediction_id), 0) FROM existing)
            + row_number() OVER (ORDER BY order_id) AS BIGINT),
       order_id, fraud_probability, predicted_label, CAST(0.4 AS DOUBLE), 'v2', '1.0.0'
FROM fresh""")


@oracle("sync_full")
def _():
    return with_star("SELECT * FROM dim_products")


@oracle("sync_full_skip")
def _():
    return with_star("SELECT * REPLACE (product_price + 1 AS product_price) FROM dim_products")


FACT_TARGET = """,
fact_target AS (SELECT * REPLACE (sales + 1 AS sales) FROM fact WHERE order_date < TIMESTAMP '1997-01-01')"""


@oracle("sync_insert_only")
def _():
    return with_star(FACT_TARGET + """
SELECT * FROM fact_target
UNION ALL
SELECT * FROM fact f WHERE NOT EXISTS (SELECT 1 FROM fact_target t WHERE t.order_item_id = f.order_item_id)""")


@oracle("publish_new_rows")
def _():
    return with_star(FACT_TARGET + """
SELECT order_item_id, order_id, sales FROM fact f
WHERE NOT EXISTS (SELECT 1 FROM fact_target t WHERE t.order_item_id = f.order_item_id)""")


EVENTS_SYNC = """
src AS (
  SELECT event_id * 10 AS row_id, event_id, ts, user_id, event_type, value, props,
         CASE WHEN event_type = 'purchase' THEN ts + INTERVAL 30 DAY ELSE ts END AS modified_at
  FROM events
),
tgt AS (
  SELECT CAST(row_number() OVER (ORDER BY event_id) AS BIGINT) AS row_id, event_id, ts, user_id, event_type,
         value + 1 AS value, props, ts AS modified_at
  FROM events WHERE ts < TIMESTAMP '2024-01-20'
),
changed AS (SELECT * FROM src WHERE modified_at > (SELECT max(modified_at) FROM tgt)
            OR (SELECT max(modified_at) FROM tgt) IS NULL)"""


@oracle("sync_watermark")
def _():
    return "WITH " + EVENTS_SYNC + """
SELECT t.row_id, t.event_id,
       CASE WHEN c.event_id IS NOT NULL THEN c.ts ELSE t.ts END AS ts,
       CASE WHEN c.event_id IS NOT NULL THEN c.user_id ELSE t.user_id END AS user_id,
       CASE WHEN c.event_id IS NOT NULL THEN c.event_type ELSE t.event_type END AS event_type,
       CASE WHEN c.event_id IS NOT NULL THEN c.value ELSE t.value END AS value,
       CASE WHEN c.event_id IS NOT NULL THEN c.props ELSE t.props END AS props,
       CASE WHEN c.event_id IS NOT NULL THEN c.modified_at ELSE t.modified_at END AS modified_at
FROM tgt t LEFT JOIN changed c ON t.event_id = c.event_id
UNION ALL
SELECT CAST((SELECT coalesce(max(row_id), 0) FROM tgt) + row_number() OVER (ORDER BY event_id) AS BIGINT),
       event_id, ts, user_id, event_type, value, props, modified_at
FROM changed c WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.event_id = c.event_id)"""


VERIFY = FACT_TARGET + """,
cmp AS (
  SELECT 'dim_customers' AS "table", (SELECT count(*) FROM dim_customers) AS local_count,
         (SELECT count(*) FROM dim_customers) AS remote_count
  UNION ALL SELECT 'dim_products', (SELECT count(*) FROM dim_products),
         (SELECT count(*) FROM dim_products WHERE product_status = 0)
  UNION ALL SELECT 'dim_date', (SELECT count(*) FROM dim_date), (SELECT count(*) FROM dim_date)
  UNION ALL SELECT 'fact_order_items', (SELECT count(*) FROM fact), (SELECT count(*) FROM fact_target)
)"""


@oracle("sync_verify")
def _():
    return with_star(VERIFY + "\nSELECT *, local_count = remote_count AS matched FROM cmp")


@oracle("sync_verdict")
def _():
    return with_star(VERIFY + """
SELECT CAST(count_if(local_count = remote_count) AS BIGINT) AS tables_matched, count(*) AS tables_compared,
       CASE WHEN count_if(local_count = remote_count) = count(*) AND count(*) = 4 THEN 'SUCCESS'
            WHEN count_if(local_count = remote_count) = 0 THEN 'FAILED'
            ELSE 'PARTIAL (' || CAST(count_if(local_count = remote_count) AS VARCHAR) || '/'
                 || CAST(count(*) AS VARCHAR) || ')' END AS sync_verdict
FROM cmp""")


@oracle("sync_summary")
def _():
    return with_star(FACT_TARGET + "," + EVENTS_SYNC + """,
st AS (
  -- dim_customers: same count, non-empty target -> skipped
  SELECT 'ok' AS status, CAST(0 AS BIGINT) AS inserted, (SELECT count(*) FROM dim_customers) AS skipped
  -- dim_products: count differs -> replaced
  UNION ALL SELECT 'ok', (SELECT count(*) FROM dim_products), 0
  UNION ALL SELECT 'ok',
    (SELECT count(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM fact_target t WHERE t.order_item_id = f.order_item_id)),
    (SELECT count(*) FROM fact t WHERE EXISTS (SELECT 1 FROM fact_target x WHERE x.order_item_id = t.order_item_id))
  UNION ALL SELECT 'ok', (SELECT count(*) FROM changed), (SELECT count(*) FROM src) - (SELECT count(*) FROM changed)
  UNION ALL SELECT 'skipped', 0, 0
)
SELECT count(*) AS tables, CAST(count_if(status = 'ok') AS BIGINT) AS ok,
       CAST(count_if(status = 'failed') AS BIGINT) AS failed,
       CAST(count_if(status = 'skipped') AS BIGINT) AS skipped_tables,
       CAST(sum(CASE WHEN status = 'ok' THEN inserted END) AS BIGINT) AS inserted,
       CAST(0 AS BIGINT) AS updated,
       CAST(sum(CASE WHEN status = 'ok' THEN skipped END) AS BIGINT) AS skipped
FROM st""")


@oracle("assign_serial_ids")
def _():
    return """
SELECT c_custkey AS customer_id,
       CAST((SELECT count(*) FROM customer WHERE c_nationkey < 10)
            + row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS serial_id
FROM customer WHERE c_nationkey >= 10"""


EVENT_BATCH = """
batch AS (
  SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE ts >= TIMESTAMP '2024-01-10'
  UNION ALL
  SELECT event_id, ts, user_id, event_type, value, props FROM events
  WHERE event_type = 'signup' AND ts >= TIMESTAMP '2024-01-25'
  UNION ALL
  SELECT CAST(NULL AS BIGINT), ts, user_id, event_type, value, props FROM events
  WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-28'
),
landed AS (SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE ts < TIMESTAMP '2024-01-20')"""


@oracle("land_new_rows")
def _():
    return "WITH " + EVENT_BATCH + """
SELECT * FROM batch b WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.event_id = b.event_id)"""


@oracle("land_evolve")
def _():
    return """
SELECT event_id, ts, user_id, event_type, value, CAST(NULL AS VARCHAR) AS props
FROM events WHERE ts < TIMESTAMP '2024-01-20'
UNION ALL
SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE ts >= TIMESTAMP '2024-01-20'"""


RUN_AUDIT = """
runs AS (SELECT range AS etl_run_id FROM range(1, 32)),
agg AS (SELECT CAST(day(ts) AS BIGINT) AS etl_run_id, count(*) AS rows_loaded,
               min(ts) AS start_time, max(ts) AS end_time FROM events GROUP BY 1),
audit AS (
  SELECT r.etl_run_id AS run_id, 'orders_raw' AS pipeline_name, a.start_time, a.end_time,
         CAST((epoch_us(a.end_time) - epoch_us(a.start_time)) // 1000 AS BIGINT) AS duration_ms,
         coalesce(a.rows_loaded, 0) AS rows_loaded, CAST(NULL AS BIGINT) AS rows_failed,
         'in_progress' AS validation_status
  FROM runs r LEFT JOIN agg a ON r.etl_run_id = a.etl_run_id
)"""

EVENT_AUDIT = RUN_AUDIT + """,
audit2 AS (
  SELECT run_id, pipeline_name, start_time, end_time, duration_ms, rows_loaded,
         CASE WHEN run_id <= 20 THEN run_id % 2 ELSE rows_failed END AS rows_failed,
         CASE WHEN run_id <= 20 THEN (CASE WHEN run_id % 2 = 0 THEN 'passed' ELSE 'failed' END)
              ELSE validation_status END AS validation_status
  FROM audit
)"""


@oracle("run_audit")
def _():
    return "WITH " + RUN_AUDIT + "\nSELECT * FROM audit"


@oracle("latest_pending_run")
def _():
    return "WITH " + EVENT_AUDIT + """
SELECT * FROM audit2 WHERE validation_status = 'in_progress' ORDER BY run_id DESC LIMIT 1"""


MIXED_RUNS = DIRTY + """,
mixed AS (
  SELECT *, CAST(year(order_date) AS BIGINT) AS etl_run_id FROM dirty WHERE year(order_date) <= 1996
  UNION ALL
  SELECT *, CAST(year(order_date) AS BIGINT) AS etl_run_id FROM stg
  WHERE year(order_date) > 1996 OR order_date IS NULL
)"""


def _verdict_sql() -> str:
    return f""",
checks AS ({_landing_sql("mixed", "etl_run_id")}),
verdicts AS (
  SELECT etl_run_id, CAST(count_if(NOT passed) AS BIGINT) AS checks_failed,
         CAST(coalesce(sum(CASE WHEN NOT passed THEN failing_rows END), 0) AS BIGINT) AS failing_rows,
         CASE WHEN count_if(NOT passed) = 0 THEN 'passed' ELSE 'failed' END AS validation_status
  FROM checks GROUP BY etl_run_id
)"""


@oracle("run_verdicts")
def _():
    return with_stg(MIXED_RUNS + _verdict_sql() + "\nSELECT * FROM verdicts")


@oracle("gate_passed_runs")
def _():
    return with_stg(MIXED_RUNS + _verdict_sql() + """
SELECT m.order_item_id, m.etl_run_id FROM mixed m
WHERE m.etl_run_id IN (SELECT etl_run_id FROM verdicts WHERE validation_status = 'passed')""")


@oracle("pipeline_snapshot")
def _():
    return with_star(VERIFY + "," + STORED[1:] + "," + EVENT_AUDIT + """
SELECT run_id AS latest_run_id, rows_loaded, validation_status,
       CASE WHEN validation_status = 'passed' THEN rows_loaded END AS rows_validated,
       (SELECT count(*) FROM fact) AS fact_rows, (SELECT count(*) FROM existing) AS prediction_rows,
       (SELECT CASE WHEN count_if(local_count = remote_count) = count(*) AND count(*) = 4 THEN 'SUCCESS'
                    WHEN count_if(local_count = remote_count) = 0 THEN 'FAILED'
                    ELSE 'PARTIAL (' || CAST(count_if(local_count = remote_count) AS VARCHAR) || '/'
                         || CAST(count(*) AS VARCHAR) || ')' END FROM cmp) AS sync_verdict
FROM audit2 ORDER BY run_id DESC LIMIT 1""")


def _scd2(key: str, attrs: list[str], replace: str) -> str:
    a = ", ".join(attrs)
    return with_stg(f"""
, v AS (SELECT * REPLACE ({replace}) FROM stg
        WHERE {key} IS NOT NULL AND full_date IS NOT NULL),
daily AS (
  SELECT {key}, full_date, {a} FROM (
    SELECT *, row_number() OVER (PARTITION BY {key}, full_date
                                 ORDER BY order_date DESC, order_item_id DESC) AS rn FROM v)
  WHERE rn = 1
),
chg AS (
  SELECT *, lag(ROW({a})) OVER (PARTITION BY {key} ORDER BY full_date) AS prev
  FROM daily
),
kept AS (SELECT * FROM chg WHERE prev IS NULL OR prev IS DISTINCT FROM ROW({a}))
SELECT {key}, {a}, CAST(full_date AS TIMESTAMP) AS effective_from,
       CAST(lead(full_date) OVER (PARTITION BY {key} ORDER BY full_date) AS TIMESTAMP) AS effective_to,
       lead(full_date) OVER (PARTITION BY {key} ORDER BY full_date) IS NULL AS is_current
FROM kept""")


@oracle("scd2_customers")
def _():
    return _scd2("customer_id", ["customer_first_name", "customer_last_name", "customer_segment", "customer_city",
                                 "customer_state", "customer_country", "customer_street", "customer_zipcode"],
                 "customer_street || ' ' || payment_type AS customer_street")


ORACLE["scd2_customers_merge"] = ORACLE["scd2_customers"]


@oracle("scd2_products_merge")
def _():
    from starmart.schemas import PRODUCT_COLUMNS

    return _scd2("product_card_id", PRODUCT_COLUMNS[1:], "CASE WHEN shipping_mode = 'A' THEN 1 ELSE 0 END AS product_status")


@oracle("merge_store")
def _():
    return with_star("""
SELECT order_item_id, order_id, order_status, CASE WHEN year(order_date) < 1996 THEN sales + 1 ELSE sales END AS sales
FROM fact WHERE year(order_date) <= 1997 AND NOT (year(order_date) = 1997 AND order_status IS NOT DISTINCT FROM 'O')""")


@oracle("merge_store_writes")
def _():
    return with_star("""
SELECT CAST(0 AS BIGINT) AS version, true AS whole, count(*) AS rows FROM fact WHERE year(order_date) < 1997
UNION ALL SELECT 1, false, count(*) FROM fact WHERE year(order_date) IN (1996, 1997)
UNION ALL SELECT 2, false, count(*) FROM fact WHERE year(order_date) = 1997 AND order_status = 'O'""")


@oracle("cdc_table")
def _():
    return """
SELECT user_id, event_id, event_type, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events WHERE user_id IS NOT NULL)
WHERE n = 1 AND event_type <> 'error'"""


ORACLE["land_indexed"] = ORACLE["land_new_rows"]
ORACLE["sync_full_by_rows"] = ORACLE["dim_products"]


@oracle("same_rows")
def _():
    digest = "(SELECT count(*) FROM (SELECT event_id, user_id, event_type, value, props, count(*) FROM {a} GROUP BY ALL EXCEPT SELECT event_id, user_id, event_type, value, props, count(*) FROM {b} GROUP BY ALL)) = 0"
    case = lambda name, a, b: f"SELECT '{name}' AS \"case\", (SELECT count(*) FROM {a}) = (SELECT count(*) FROM {b}) AS same_count, {digest.format(a=a, b=b)} AND {digest.format(a=b, b=a)} AS same_rows"
    return """WITH e AS (SELECT event_id, user_id, event_type, value, props FROM events),
r AS (SELECT * REPLACE (CASE WHEN event_id = (SELECT max(event_id) FROM e) THEN -1.0 ELSE value END AS value) FROM e),
f AS (SELECT * FROM e WHERE event_id <> (SELECT max(event_id) FROM e)),
x AS (SELECT * FROM e UNION ALL SELECT * FROM e WHERE event_id = (SELECT max(event_id) FROM e)),
y AS (SELECT * FROM e UNION ALL SELECT * FROM e WHERE event_id = 0)
""" + " UNION ALL ".join([case("same", "e", "e"), case("replaced", "e", "r"), case("fewer", "e", "f"), case("repeats", "x", "y")])


@oracle("sales_median")
def _():
    return with_star("SELECT CASE WHEN shipping_mode <> 'A' THEN shipping_mode END AS shipping_mode, round(median(sales), 4) AS median_sales FROM fact GROUP BY 1")


MONTHS = """,
months AS (
  SELECT * REPLACE (CASE WHEN date_key // 100 IN (
           SELECT date_key // 100 FROM fact WHERE payment_type = '1-URGENT' AND order_date >= TIMESTAMP '1996-01-01' AND order_date < TIMESTAMP '1996-04-01')
         THEN sales ELSE sales + 1 END AS sales), CAST(date_key // 100 AS INTEGER) AS month_key FROM fact)"""


@oracle("fact_month_rebuild")
def _():
    return with_star(MONTHS + "\nSELECT order_item_id, order_id, date_key, sales, month_key FROM months")


@oracle("fact_months_pruned")
def _():
    return with_star(MONTHS + """
SELECT m.month_key, count(*) AS n_lines, CAST(sum(CAST(m.sales AS DECIMAL(38, 4))) AS DOUBLE) AS sum_sales
FROM months m JOIN dim_date d ON d.date_key = m.date_key WHERE d.year = 1996 AND d.month <= 3 AND d.is_weekend GROUP BY m.month_key""")


ORACLE["csv_feed"] = ORACLE["stg_orders"]
ORACLE["report_sweep_csv"] = ORACLE["threshold_sweep"]


@oracle("prepared_features")
def _():
    return with_features("SELECT * EXCLUDE (order_status) FROM features")


@oracle("view_scan")
def _():
    return "SELECT event_type, count(*) AS n_events, count(DISTINCT user_id) AS n_users FROM events GROUP BY event_type"


@oracle("land_stamped")
def _():
    return "WITH " + EVENT_BATCH + "\nSELECT event_id, ts, value, CAST(9 AS BIGINT) AS etl_run_id, TIMESTAMP '2024-01-01' AS ingested_at FROM batch"


@oracle("serving_products")
def _():
    return with_star("SELECT * REPLACE (CAST(product_status AS VARCHAR) AS product_status) FROM dim_products")


@oracle("report_metrics_json")
def _():
    return "SELECT 'v9' AS model_version, * FROM (" + ORACLE["confusion_matrix"] + ")"


@oracle("score_new_orders")
def _():
    return with_features(STORED + """
SELECT prediction_id, order_id, threshold_used, model_version, true AS sound FROM existing
UNION ALL
SELECT CAST((SELECT coalesce(max(prediction_id), 0) FROM existing) + row_number() OVER (ORDER BY order_id) AS BIGINT), order_id, CAST(0.3 AS DOUBLE), 'v3', true
FROM (SELECT DISTINCT order_id FROM features) f WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.order_id = f.order_id)""")


@oracle("model_auc")
def _():
    return "WITH " + STG + DIMS + RARE_FEATURES + SPLIT + """
SELECT model, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_out_of_range, true AS beats_chance
FROM split, (VALUES ('random forest'), ('extra trees')) AS m(model) WHERE is_test GROUP BY model"""
