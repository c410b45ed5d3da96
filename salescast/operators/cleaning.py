"""Outlier bounds, capping, median imputation and the cleaning chain.

Cleaning is learned and then applied. Learning needs whole-column quantiles and
ends in a handful of numbers; applying is a narrow expression per column with
those numbers as literals, so it neither shuffles nor joins.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.config import settings
from salescast.functions import is_missing, null_if_nan, round_half_even
from salescast.operators.quantiles import Quantiles, exact_quantiles
from salescast.operators.sketches import approximate_quantiles

MEASURES = ["sales_quantity", "revenue"]
#: capped to whole units
WHOLE_NUMBER_MEASURES = {"sales_quantity"}
SORT_KEYS = ("date", "product_id")


@dataclass(frozen=True)
class Bounds:
    """Interquartile bounds of one column; all NULL when it has no values."""

    q1: float | None
    q3: float | None
    iqr: float | None
    lower: float | None
    upper: float | None
    low: float | None
    high: float | None

    @classmethod
    def of(cls, quantiles: Quantiles, multiplier: float) -> "Bounds":
        q1, q3 = quantiles.q[0], quantiles.q[-1]
        if q1 is None or q3 is None:
            return cls(None, None, None, None, None, None, None)
        iqr = q3 - q1
        lower, upper = q1 - multiplier * iqr, q3 + multiplier * iqr
        return cls(q1, q3, iqr, lower, upper, quantiles.low, quantiles.high)

    @property
    def has_outliers(self) -> bool:
        """Whether any value lies outside; the column's range is enough to tell."""
        if self.lower is None:
            return False
        return self.low < self.lower or self.high > self.upper


def _quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int | None):
    """Exact ones, or with ``accuracy`` those of a sketch: one pass, values that occur."""
    if accuracy is None:
        return exact_quantiles(df, columns, probabilities)
    return approximate_quantiles(df, columns, probabilities, accuracy)


def learn_bounds(
    df: DataFrame, columns: Sequence[str], multiplier: float = 1.5, accuracy: int | None = None
) -> dict[str, Bounds]:
    found = _quantiles(df, columns, [0.25, 0.75], accuracy)
    return {c: Bounds.of(found[c], multiplier) for c in columns}


def is_outlier(x: Column, bounds: Bounds) -> Column:
    """Outside the unrounded bounds; NULL is not an outlier."""
    x = null_if_nan(x.cast("double"))
    outside = (x < F.lit(bounds.lower)) | (x > F.lit(bounds.upper))
    return F.coalesce(outside, F.lit(False))


def iqr_stats(
    df: DataFrame, column: str, multiplier: float = 1.5, accuracy: int | None = None
) -> DataFrame:
    """One row: quartiles, bounds, outlier count and rate over all rows.

    The outliers are counted against unrounded bounds; what is shown is rounded.
    With ``accuracy`` the quartiles come from a sketch of that size, off by
    :func:`~salescast.operators.sketches.rank_error` at most in rank.
    """
    bounds = learn_bounds(df, [column], multiplier, accuracy)[column]
    outlier = is_outlier(F.col(column), bounds)
    counted = df.agg(
        F.count_if(outlier).alias("outlier_count"), F.count(F.lit(1)).alias("rows")
    )

    def shown(value: float | None) -> Column:
        return round_half_even(F.lit(value).cast("double"))

    return counted.select(
        shown(bounds.q1).alias("q1"),
        shown(bounds.q3).alias("q3"),
        shown(bounds.iqr).alias("iqr"),
        shown(bounds.lower).alias("lower_bound"),
        shown(bounds.upper).alias("upper_bound"),
        "outlier_count",
        round_half_even(F.try_divide("outlier_count", "rows"), 4).alias("outlier_rate"),
    )


def flag_outliers(
    df: DataFrame, column: str, multiplier: float = 1.5, flag: str = "is_outlier"
) -> DataFrame:
    """``df`` plus a boolean column that marks the outliers of ``column``."""
    bounds = learn_bounds(df, [column], multiplier)[column]
    return df.withColumn(flag, is_outlier(F.col(column), bounds))


def capped(x: Column, bounds: Bounds, integer: bool) -> Column:
    """``x`` held within the bounds *rounded to 2*.

    Values below the lower bound move to it, but not below zero; the outcome is
    then held against the upper bound. ``integer`` cuts both replacements
    towards zero. Without any outlier nothing is changed.
    """
    x = null_if_nan(x.cast("double"))
    if not bounds.has_outliers:
        return x
    lower = round_half_even(F.lit(bounds.lower))
    upper = round_half_even(F.lit(bounds.upper))
    floor_value = F.greatest(F.lit(0.0), lower)
    ceiling_value = upper
    if integer:
        floor_value = floor_value.cast("bigint").cast("double")
        ceiling_value = ceiling_value.cast("bigint").cast("double")
    raised = F.when(x < lower, floor_value).otherwise(x)
    return F.when(raised > upper, ceiling_value).otherwise(raised)


def winsorize(
    df: DataFrame,
    column: str,
    multiplier: float = 1.5,
    integer: bool = False,
    accuracy: int | None = None,
) -> DataFrame:
    """Cap the outliers of one column."""
    bounds = learn_bounds(df, [column], multiplier, accuracy)[column]
    return df.withColumn(column, capped(F.col(column), bounds, integer))


def medians(
    df: DataFrame, columns: Sequence[str], accuracy: int | None = None
) -> dict[str, float | None]:
    found = _quantiles(df, columns, [0.5], accuracy)
    return {c: found[c].q[0] for c in columns}


def imputed(x: Column, median: float | None) -> Column:
    """Missing values become the median; a column without values stays NULL."""
    return F.coalesce(null_if_nan(x.cast("double")), F.lit(median).cast("double"))


def impute_median(
    df: DataFrame, columns: Sequence[str] = tuple(MEASURES), accuracy: int | None = None
) -> DataFrame:
    """Fill missing values of each column with its unrounded median: exact, or a sketch's."""
    middle = medians(df, list(columns), accuracy)
    return df.withColumns({c: imputed(F.col(c), middle[c]) for c in columns})


@dataclass(frozen=True)
class CleaningRules:
    """All that cleaning learns from the data: a few numbers per column."""

    bounds: Mapping[str, Bounds]
    medians: Mapping[str, float | None]
    sort_keys: tuple[str, ...]


def _cap_columns(df: DataFrame, bounds: Mapping[str, Bounds]) -> DataFrame:
    return df.withColumns(
        {c: capped(F.col(c), b, c in WHOLE_NUMBER_MEASURES) for c, b in bounds.items()}
    )


def learn_cleaning(df: DataFrame, cfg: Mapping[str, Any] | None = None) -> CleaningRules:
    """Bounds of the raw columns, then medians of the capped ones.

    A few passes over the measure columns alone, one search for both where
    capping cannot move the median; rows whose date is NULL still shape both.
    """
    multiplier = settings(cfg, "data_quality")["outlier_iqr_multiplier"]
    columns = [c for c in MEASURES if c in df.columns]
    sort_keys = tuple(c for c in SORT_KEYS if c in df.columns) if "date" in df.columns else ()
    if not columns:
        return CleaningRules({}, {}, sort_keys)
    found = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    bounds = {c: Bounds.of(found[c], multiplier) for c in columns}
    middle = {c: found[c].q[1] for c in columns}
    moved = [c for c in columns if not _median_stays(found[c], bounds[c], c in WHOLE_NUMBER_MEASURES)]
    if moved:
        middle |= medians(_cap_columns(df, bounds), moved)
    return CleaningRules(bounds, middle, sort_keys)


def _replacements(bounds: Bounds, integer: bool) -> tuple[float, float, float, float]:
    """Rounded bounds, and what values beyond them become."""
    lower, upper = (round(x * 100) / 100 for x in (bounds.lower, bounds.upper))  # half to even
    low, high = max(0.0, lower), upper
    return (lower, upper, float(int(low)), float(int(high))) if integer else (lower, upper, low, high)


def _median_stays(quantiles: Quantiles, bounds: Bounds, integer: bool) -> bool:
    """Whether capping leaves the median alone, told from numbers already known.

    It does when both middle values are within the bounds and the replacements
    stay on their own sides of them.
    """
    if not bounds.has_outliers:
        return True
    if not math.isfinite(bounds.lower * 100) or not math.isfinite(bounds.upper * 100):
        return False
    left, right = quantiles.around[1]
    lower, upper, low, high = _replacements(bounds, integer)
    return lower <= left and right <= upper and low <= left and right <= high


def apply_cleaning(df: DataFrame, rules: CleaningRules) -> DataFrame:
    """Cap, impute and drop rows without a date. Narrow: no shuffle, no join."""
    cleaned = _cap_columns(df, rules.bounds)
    cleaned = cleaned.withColumns(
        {c: imputed(F.col(c), m) for c, m in rules.medians.items()}
    )
    return cleaned.na.drop(subset=["date"]) if "date" in df.columns else cleaned


def clean(df: DataFrame, cfg: Mapping[str, Any] | None = None) -> DataFrame:
    """Learn the rules from ``df`` and apply them to it."""
    return apply_cleaning(df, learn_cleaning(df, cfg))


def cleaning_summary(df: DataFrame, rules: CleaningRules) -> DataFrame:
    """One row of counts around cleaning: rows and NULLs before and after.

    ``df`` is the table before cleaning. One pass, nothing but counters.
    """
    kept = F.col("date").isNotNull() if "date" in df.columns else F.lit(True)
    before, after = [], []
    for name in df.columns:
        is_null = is_missing(df, name)
        before.append(F.count_if(is_null))
        filled = rules.medians.get(name) is not None
        after.append(F.lit(0).cast("bigint") if filled else F.count_if(is_null & kept))
    names = F.array(*[F.lit(c) for c in df.columns])
    outliers = [
        F.count_if(is_outlier(F.col(c), b)).alias(f"outliers_{c}")
        for c, b in rules.bounds.items()
    ]
    rows, final = F.count(F.lit(1)), F.count_if(kept)
    return df.agg(
        rows.alias("original_rows"),
        final.alias("final_rows"),
        (rows - final).alias("rows_removed"),
        F.map_from_arrays(names, F.array(*before)).alias("null_before"),
        F.map_from_arrays(names, F.array(*after)).alias("null_after"),
        *outliers,
    )


def cleaning_log(summary: DataFrame, rules: CleaningRules) -> DataFrame:
    """The operations behind a row of :func:`cleaning_summary`, in order.

    An operation that touches no row is not listed; the sort always is.
    """
    steps: list[tuple[str, str, Column, Column, Column]] = []
    none = F.lit(None)
    for name in rules.bounds:
        steps.append(("outlier_capping", name, none, none, F.col(f"outliers_{name}")))
    for name, median in rules.medians.items():
        if median is not None:
            fill = round_half_even(F.lit(median))
            count = F.col("null_before")[name]
            steps.append(("null_imputation", name, F.lit("median"), fill, count))
    steps.append(("null_drop", "date", none, none, F.col("rows_removed")))
    if rules.sort_keys:
        steps.append(("sort", ", ".join(rules.sort_keys), none, none, none))
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(kind).alias("type"),
            F.lit(columns).alias("columns"),
            strategy.cast("string").alias("strategy"),
            fill.cast("double").alias("fill_value"),
            count.cast("bigint").alias("count"),
        )
        for i, (kind, columns, strategy, fill, count) in enumerate(steps)
    ]
    log = summary.select(F.inline(F.array(*rows)))
    return log.where((F.col("type") == "sort") | (F.col("count") > 0))


def sort_rows(df: DataFrame, keys: Sequence[str] = SORT_KEYS) -> DataFrame:
    """Rows in key order, missing keys last.

    The remaining columns break ties, which also lets the range shuffle cut
    through a date or product that holds much of the table. Full copies are told
    apart by the task they come from, so no group of copies lands in one task.
    """
    first = [c for c in keys if c in df.columns]
    rest = [c for c in df.columns if c not in first]
    order = [F.col(f"`{c}`").asc_nulls_last() for c in first + rest]
    return (
        df.withColumn("_task", F.spark_partition_id()).orderBy(*order, "_task").drop("_task")
    )
