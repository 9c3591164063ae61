"""Date and time helpers with Postgres-compatible results.

Spark's own ``extract(dow)`` returns 1 for Sunday and ``date_format('MMMM')``
does not blank-pad, so the reference's SQL results are rebuilt explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw feed date text, e.g. "1/31/2018 22:56".
DEFAULT_TS_FORMAT = "M/d/yyyy H:mm"


def parse_timestamp(c: Column, dtype: T.DataType, fmt: str = DEFAULT_TS_FORMAT) -> Column:
    """Text -> timestamp with an explicit pattern; typed input passes through."""
    if isinstance(dtype, T.StringType):
        return F.to_timestamp_ntz(F.trim(c), F.lit(fmt))
    if isinstance(dtype, T.DateType):
        return c.cast(T.TimestampNTZType())
    return c


def date_key(ts: Column) -> Column:
    """``to_char(ts, 'YYYYMMDD')::int`` as integer arithmetic (no string per row)."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def month_name_padded(d: Column) -> Column:
    """``to_char(d, 'Month')``: English month name blank-padded to 9 characters."""
    return F.rpad(F.date_format(d, "MMMM"), 9, " ")


def iso_day_of_week(d: Column) -> Column:
    """``extract(isodow)``: Monday = 1 ... Sunday = 7."""
    return F.weekday(d) + 1


def day_of_week_sun0(d: Column) -> Column:
    """``extract(dow)``: Sunday = 0 ... Saturday = 6."""
    return F.dayofweek(d) - 1


def is_weekend(d: Column) -> Column:
    """ISO day 6 or 7; a null date gives false, as the reference's CASE does."""
    return F.coalesce(F.weekday(d) >= 5, F.lit(False))
