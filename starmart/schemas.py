"""Column specifications and StructType constants for every layer.

The raw feed arrives as text (CSV) or already typed (Parquet / fixture
adapter); silver is produced from ``SILVER_SPEC`` by ``operators.staging``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: raw feed column names, as the source file spells them ---
ORDER_ITEM_ID = "Order Item Id"
ORDER_ID = "Order Id"
CUSTOMER_ID = "Customer Id"
PRODUCT_CARD_ID = "Product Card Id"
ORDER_DATE = "order date (DateOrders)"
SHIPPING_DATE = "shipping date (DateOrders)"

# --- fixed values: silver column spec (raw name, silver name, kind) ---------
# kinds: id (integer key), int, double, str (trimmed), str_default (null ->
# 'Unknown', then trimmed), ts (timestamp).  date_key and full_date derive
# from the order date and are inserted by the staging operator.
SILVER_SPEC: list[tuple[str, str, str]] = [
    ("Order Item Id", "order_item_id", "id"),
    ("Order Id", "order_id", "id"),
    ("Customer Id", "customer_id", "id"),
    ("Product Card Id", "product_card_id", "id"),
    ("order date (DateOrders)", "order_date", "ts"),
    ("shipping date (DateOrders)", "shipping_date", "ts"),
    ("Customer Fname", "customer_first_name", "str"),
    ("Customer Lname", "customer_last_name", "str_default"),
    ("Customer Segment", "customer_segment", "str"),
    ("Customer City", "customer_city", "str"),
    ("Customer State", "customer_state", "str"),
    ("Customer Country", "customer_country", "str"),
    ("Customer Street", "customer_street", "str"),
    ("Customer Zipcode", "customer_zipcode", "str_default"),
    ("Product Name", "product_name", "str"),
    ("Product Price", "product_price", "double"),
    ("Product Status", "product_status", "int"),
    ("Category Id", "category_id", "int"),
    ("Category Name", "category_name", "str"),
    ("Department Id", "department_id", "int"),
    ("Department Name", "department_name", "str"),
    ("Type", "payment_type", "str"),
    ("Delivery Status", "delivery_status", "str"),
    ("Order Status", "order_status", "str"),
    ("Late_delivery_risk", "late_delivery_risk", "int"),
    ("Days for shipping (real)", "days_for_shipping_real", "double"),
    ("Days for shipment (scheduled)", "days_for_shipment_scheduled", "double"),
    ("Shipping Mode", "shipping_mode", "str"),
    ("Sales", "sales", "double"),
    ("Sales per customer", "sales_per_customer", "double"),
    ("Benefit per order", "benefit_per_order", "double"),
    ("Order Profit Per Order", "order_profit_per_order", "double"),
    ("Order Item Total", "order_item_total", "double"),
    ("Order Item Discount", "order_item_discount", "double"),
    ("Order Item Discount Rate", "order_item_discount_rate", "double"),
    ("Order Item Profit Ratio", "order_item_profit_ratio", "double"),
    ("Order Item Quantity", "order_item_quantity", "int"),
    ("Order City", "order_city", "str"),
    ("Order State", "order_state", "str"),
    ("Order Country", "order_country", "str"),
    ("Order Zipcode", "order_zipcode", "str_default"),
    ("Latitude", "latitude", "double"),
    ("Longitude", "longitude", "double"),
    ("Order Region", "order_region", "str"),
]

# Silver column order (46 columns): ids, date key, dates, then the spec order.
SILVER_COLUMNS: list[str] = (
    ["order_item_id", "order_id", "customer_id", "product_card_id", "date_key",
     "order_date", "full_date", "shipping_date"]
    + [s for _, s, k in SILVER_SPEC if k not in ("id", "ts")]
)

# --- fixed values: strings pandas reads as missing (public pandas default) --
PANDAS_NA_VALUES = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# --- fixed values: column lists of the layers, default and status names ------
UNKNOWN = "Unknown"
LOCATION_COLUMNS = [
    "order_city", "order_state", "order_country", "order_zipcode",
    "latitude", "longitude", "order_region",
]
CUSTOMER_COLUMNS = [
    "customer_id", "customer_first_name", "customer_last_name", "customer_segment",
    "customer_city", "customer_state", "customer_country", "customer_street",
    "customer_zipcode",
]
PRODUCT_COLUMNS = [
    "product_card_id", "product_name", "product_price", "product_status",
    "category_id", "category_name", "department_id", "department_name",
]
FACT_COLUMNS = [
    "order_item_id", "order_id", "customer_id", "product_card_id", "date_key",
    "shipping_location_id", "payment_type", "delivery_status", "order_status",
    "late_delivery_risk", "shipping_mode", "order_date", "shipping_date",
    "days_for_shipping_real", "days_for_shipment_scheduled", "sales",
    "sales_per_customer", "benefit_per_order", "order_profit_per_order",
    "order_item_total", "order_item_discount", "order_item_discount_rate",
    "order_item_profit_ratio", "order_item_quantity",
]

# Feature table: 3 ids, 24 features, status, target (+ created_at audit).
FEATURE_ID_COLUMNS = ["order_item_id", "order_id", "customer_id"]
FEATURE_COLUMNS = [
    "payment_type", "order_item_quantity", "sales", "sales_per_customer",
    "benefit_per_order", "order_profit_per_order", "order_item_total",
    "order_item_discount", "order_item_discount_rate", "order_item_profit_ratio",
    "shipping_mode", "order_month", "order_day", "order_hour",
    "order_day_of_week", "customer_segment", "product_price", "category_name",
    "department_name", "is_weekend", "latitude", "longitude", "order_region",
    "order_country",
]
CATEGORICAL_FEATURES = [
    "payment_type", "shipping_mode", "customer_segment", "category_name",
    "department_name", "order_region", "order_country",
]
LABEL_VALUE = "SUSPECTED_FRAUD"
STATUS_EXEMPT_FROM_SALES_CHECK = ["CANCELED", "SUSPECTED_FRAUD"]

# --- serving / warehouse DDL as StructTypes (S25) ---------------------------
DIM_DATE_SCHEMA = T.StructType([
    T.StructField("date_key", T.IntegerType()),
    T.StructField("full_date", T.DateType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("quarter", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("month_name", T.StringType()),
    T.StructField("week", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("is_weekend", T.BooleanType()),
])

PREDICTIONS_SCHEMA = T.StructType([
    T.StructField("prediction_id", T.LongType()),
    T.StructField("order_id", T.LongType(), False),
    T.StructField("fraud_probability", T.DoubleType()),
    T.StructField("predicted_label", T.BooleanType()),
    T.StructField("threshold_used", T.DoubleType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("pipeline_version", T.StringType()),
    T.StructField("predicted_at", T.TimestampType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("modified_at", T.TimestampType()),
])

_KIND_TYPES = {"id": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "str": T.StringType(),
               "str_default": T.StringType(), "ts": T.TimestampNTZType()}
# Types that silver has no rule for, or that the serving copy has otherwise.
_SERVED_TYPES = {
    "date_key": T.IntegerType(), "shipping_location_id": T.StringType(), "product_status": T.StringType(),
    "order_month": T.IntegerType(), "order_day": T.IntegerType(), "order_hour": T.IntegerType(),
    "order_day_of_week": T.IntegerType(), "is_weekend": T.BooleanType(), "target": T.IntegerType(),
}
_SERVED_COLUMNS = {
    "dim_customers": CUSTOMER_COLUMNS,
    "dim_products": PRODUCT_COLUMNS,
    "dim_shipping_location": ["shipping_location_id"] + LOCATION_COLUMNS,
    "fact_order_items": FACT_COLUMNS,
    "fraud_features": FEATURE_ID_COLUMNS + FEATURE_COLUMNS + ["order_status", "target"],
}


def serving_schema(table: str) -> T.StructType | None:
    """The declared schema of a serving table; None for a table without one."""
    known = {"dim_date": DIM_DATE_SCHEMA, "predictions": PREDICTIONS_SCHEMA}
    if table in known:
        return known[table]
    if table not in _SERVED_COLUMNS:
        return None
    types = {silver: _KIND_TYPES[kind] for _, silver, kind in SILVER_SPEC} | _SERVED_TYPES
    return T.StructType([T.StructField(c, types[c]) for c in _SERVED_COLUMNS[table]])


def conform(df: DataFrame, schema: T.StructType | None) -> DataFrame:
    """The columns of the schema, cast to its types; other columns are left out."""
    return df if schema is None else df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
