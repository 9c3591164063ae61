"""Numeric helpers for the float/int traps between pandas, Postgres and Spark."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_int_rounded(c: Column, dtype: T.DataType, target: str = "int") -> Column:
    """Cast to integer the way Postgres does: fractional values round, not truncate."""
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.rint(c).cast(target)
    if isinstance(dtype, T.StringType):
        return F.rint(F.trim(c).cast("double")).cast(target)
    return c.cast(target)


# Ten decimals hold products of money and rates without rounding any value
# of the feed; 28 digits leave the sum 38 of them.
EXACT = T.DecimalType(28, 10)


def exact_sum(c: Column, places: int | None = None, scale_type: T.DecimalType = EXACT) -> Column:
    """Sum of a decimal measure without floating-point drift.

    A double sum of many large values depends on the summation order (two
    plans, or two engines, disagree in the last digits).  The values are
    summed exactly as decimals of a wide scale; only the result is rounded,
    to ``places``, and returned as double.
    """
    s = F.sum(c.cast(scale_type))
    if places is not None:
        s = F.round(s, places)
    return s.cast("double")
