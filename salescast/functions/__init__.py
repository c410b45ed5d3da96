"""Column expressions; everything here stays inside the JVM."""

from salescast.functions.calendar import CALENDAR_FEATURES, calendar_columns
from salescast.functions.scalar import (
    clip_at_zero,
    date_text,
    escaped_text,
    is_missing,
    md5_prefix,
    null_if_nan,
    round_half_even,
    row_digest,
)
from salescast.functions.sums import exact_sum

__all__ = [
    "CALENDAR_FEATURES",
    "calendar_columns",
    "clip_at_zero",
    "date_text",
    "escaped_text",
    "exact_sum",
    "is_missing",
    "md5_prefix",
    "null_if_nan",
    "round_half_even",
    "row_digest",
]
