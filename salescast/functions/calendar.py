"""Calendar features of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The names of the calendar features, in output order.
CALENDAR_FEATURES = [
    "day_of_week",
    "day_of_month",
    "week_of_year",
    "month",
    "quarter",
    "year",
    "is_weekend",
    "is_month_start",
    "is_month_end",
]


def calendar_columns(date: Column) -> dict[str, Column]:
    """One INT expression per calendar feature.

    Weeks start on Monday (0), week numbers are ISO weeks (1 to 53) and the
    year is the calendar year.
    """
    weekday = F.weekday(date)
    expressions = [
        weekday,
        F.dayofmonth(date),
        F.weekofyear(date),
        F.month(date),
        F.quarter(date),
        F.year(date),
        (weekday >= 5).cast("int"),
        (F.dayofmonth(date) == 1).cast("int"),
        (date == F.last_day(date)).cast("int"),
    ]
    return dict(zip(CALENDAR_FEATURES, expressions))
