"""Silver: rename, cast, trim and default the raw feed.

One projection driven by ``SILVER_SPEC``; it fuses into the scan's codegen
stage and never shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.dates import DEFAULT_TS_FORMAT, date_key, parse_timestamp
from starmart.functions.numeric import to_int_rounded
from starmart.schemas import SILVER_COLUMNS, SILVER_SPEC, UNKNOWN


def _resolve(df: DataFrame) -> dict[str, T.StructField]:
    """Raw names matched trimmed and case-insensitively."""
    return {f.name.strip().lower(): f for f in df.schema.fields}


def _silver_column(field: T.StructField | None, kind: str, ts_format: str) -> Column:
    if field is None:  # column absent from this feed: typed null
        dtype = {"id": "long", "int": "int", "double": "double", "ts": "timestamp_ntz"}.get(kind, "string")
        c = F.lit(None).cast(dtype)
        return F.lit(UNKNOWN) if kind == "str_default" else c
    c, dtype = F.col(f"`{field.name}`"), field.dataType
    if kind == "id":
        return to_int_rounded(c, dtype, "long")
    if kind == "int":
        return to_int_rounded(c, dtype, "int")
    if kind == "double":
        return c.cast("double")
    if kind == "ts":
        return parse_timestamp(c, dtype, ts_format)
    if kind == "str":
        return F.trim(c.cast("string"))
    if kind == "str_default":
        # coalesce before trim: a blank string stays blank, only null becomes Unknown
        return F.trim(F.coalesce(c.cast("string"), F.lit(UNKNOWN)))
    raise ValueError(kind)


def stage_orders(raw: DataFrame, ts_format: str = DEFAULT_TS_FORMAT) -> DataFrame:
    """Typed 46-column silver view of the raw order-line feed."""
    fields = _resolve(raw)
    cols = {silver: _silver_column(fields.get(src.strip().lower()), kind, ts_format)
            for src, silver, kind in SILVER_SPEC}
    order_ts = cols["order_date"]
    cols["date_key"] = date_key(order_ts)
    cols["full_date"] = order_ts.cast("date")
    return raw.select([cols[c].alias(c) for c in SILVER_COLUMNS])
