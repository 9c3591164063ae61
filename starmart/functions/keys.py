"""Deterministic surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: our surrogate-key definition -----------------------------
NULL_TOKEN = "_null_"
SEPARATOR = "-"
# Doubles are rendered through decimal(38,10) so the text is engine-independent
# (Spark prints 1.0E10 where other engines print 10000000000.0); magnitudes
# beyond 1e28 fall back to the plain double text.
DOUBLE_AS_TEXT = T.DecimalType(38, 10)


def _as_text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.coalesce(c.try_cast(DOUBLE_AS_TEXT).cast("string"), c.cast("string"))
    return c.cast("string")


def surrogate_key(df: DataFrame, columns: list[str]) -> Column:
    """md5 over the columns joined by '-', nulls replaced by a token."""
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = [F.coalesce(_as_text(F.col(c), types[c]), F.lit(NULL_TOKEN)) for c in columns]
    return F.md5(F.concat_ws(SEPARATOR, *parts))
