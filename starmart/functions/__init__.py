"""Column -> Column helpers that pin down cross-engine semantics."""

from starmart.functions.dates import (
    date_key,
    day_of_week_sun0,
    iso_day_of_week,
    is_weekend,
    month_name_padded,
    parse_timestamp,
)
from starmart.functions.keys import surrogate_key
from starmart.functions.numeric import to_int_rounded

__all__ = [
    "date_key", "day_of_week_sun0", "iso_day_of_week", "is_weekend",
    "month_name_padded", "parse_timestamp", "surrogate_key",
    "to_int_rounded",
]
