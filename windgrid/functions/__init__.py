"""Column expressions: text keys, lenient casts, time buckets and rounded ratios."""

from windgrid.functions.casting import is_bad_timestamp, is_uncastable, timestamp_column, to_double, to_timestamp
from windgrid.functions.ratios import decimal_sum, percent
from windgrid.functions.text import asset_code, normalize
from windgrid.functions.timing import hour_floor, hour_number, month_label, month_number, period

__all__ = [
    "asset_code",
    "decimal_sum",
    "hour_floor",
    "hour_number",
    "is_bad_timestamp",
    "is_uncastable",
    "month_label",
    "month_number",
    "normalize",
    "percent",
    "period",
    "timestamp_column",
    "to_double",
    "to_timestamp",
]
