"""Data-quality metrics and the gate that acts on them.

All metrics come from one pass: rows are first aggregated per date (partial sums
before the shuffle, at most one row per calendar day after it), and both the
totals and the date gaps are read off that small table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescast.config import settings
from salescast.functions import is_missing

# Check names in the order in which they are made.
CHECKS = ["minimum_records", "null_rate", "no_negative_sales", "date_continuity"]
#: The check on records that a scan of text left out.
REJECTED = "rejected_records"


def _gap(previous: Column, date: Column) -> Column:
    """Sortable gap record: widest first, earliest among equals."""
    return F.when(
        previous.isNotNull() & date.isNotNull(),
        F.struct(
            F.datediff(date, previous).alias("days"),
            (-F.unix_date(date)).alias("recency"),
            previous.alias("start"),
            date.alias("end"),
        ),
    )


def date_gaps(
    df: DataFrame, date: str = "date", series_cols: Sequence[str] = ()
) -> DataFrame:
    """Widest gap between consecutive distinct dates, with its two ends.

    One row, or one row per series. A NULL date counts as one distinct date and
    takes part in no gap.
    """
    keys = list(series_cols)
    days = df.select(*keys, F.to_date(date).alias("day")).distinct()
    w = Window.partitionBy(*keys).orderBy("day")
    widest = F.max("gap")
    return (
        days.withColumn("gap", _gap(F.lag("day").over(w), F.col("day")))
        .groupBy(*keys)
        .agg(
            widest["days"].alias("max_date_gap_days"),
            widest["start"].alias("gap_start"),
            widest["end"].alias("gap_end"),
            F.count(F.lit(1)).alias("num_unique_dates"),
        )
    )


def quality_summary(df: DataFrame) -> DataFrame:
    """One row with the metrics behind every check.

    ``null_counts`` and ``null_rates`` are maps over all columns, extra ones
    included. Metrics of an absent column are NULL.
    """
    columns = df.columns
    has_date, has_quantity = "date" in columns, "sales_quantity" in columns
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(columns):
        aggregates.append(F.count_if(is_missing(df, name)).alias(f"nulls_{i}"))
    if has_quantity:
        aggregates.append(F.count_if(F.col("sales_quantity") < 0).alias("negatives"))

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0).cast("bigint"))

    nulls = [total(f"nulls_{i}") for i in range(len(columns))]
    rows = total("rows")
    counts = F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*nulls))
    overall = F.coalesce(
        F.try_divide(sum(nulls[1:], nulls[0]), rows * len(columns)), F.lit(0.0)
    )
    metrics = [
        rows.alias("record_count"),
        counts.alias("null_counts"),
        overall.alias("overall_null_rate"),
        (total("negatives") if has_quantity else F.lit(None).cast("bigint")).alias(
            "negative_sales_count"
        ),
    ]
    if has_date:
        per_day = df.groupBy(F.to_date("date").alias("date")).agg(*aggregates)
        # at most one row per calendar day, so one task is enough
        w = Window.partitionBy().orderBy(F.asc_nulls_first("date"))
        per_day = per_day.withColumn("gap", _gap(F.lag("date").over(w), F.col("date")))
        widest = F.max("gap")
        metrics += [
            F.count(F.lit(1)).alias("num_unique_dates"),
            widest["days"].alias("max_date_gap_days"),
            widest["start"].alias("gap_start"),
            widest["end"].alias("gap_end"),
        ]
        summary = per_day.agg(*metrics)
    else:
        summary = df.agg(*aggregates).agg(*metrics).select(
            "*",
            F.lit(None).cast("bigint").alias("num_unique_dates"),
            F.lit(None).cast("int").alias("max_date_gap_days"),
            F.lit(None).cast("date").alias("gap_start"),
            F.lit(None).cast("date").alias("gap_end"),
        )
    rates = F.transform_values("null_counts", lambda _, n: F.try_divide(n, F.col("record_count")))
    return summary.withColumn("null_rates", rates)


def null_rates(df: DataFrame) -> DataFrame:
    """NULL count and rate of every column, one row per column."""
    return quality_summary(df).select(
        F.explode("null_counts").alias("column_name", "null_count"), "record_count"
    ).select(
        "column_name",
        "null_count",
        F.coalesce(F.try_divide("null_count", "record_count"), F.lit(0.0)).alias("null_rate"),
    )


def quality_checks(
    summary: DataFrame, cfg: Mapping[str, Any] | None = None, rejected: int | None = None
) -> DataFrame:
    """The four checks made on a row of :func:`quality_summary`.

    With ``rejected``, the number of records that the scan left out, a fifth one:
    their share of all records.
    """
    limits = settings(cfg, "data_quality")
    records, rate = F.col("record_count"), F.col("overall_null_rate")
    negatives, gap = F.col("negative_sales_count"), F.col("max_date_gap_days")
    negative_ok = F.lit(True) if limits["allow_negative_sales"] else negatives == 0
    outcome = [
        (records, float(limits["min_records"]), records >= limits["min_records"]),
        (rate, float(limits["max_null_rate"]), ~(rate > limits["max_null_rate"])),
        (negatives, 0.0, F.when(negatives.isNotNull(), negative_ok)),
        (gap, float(limits["max_date_gap_days"]), ~(gap > limits["max_date_gap_days"])),
    ]
    names = list(CHECKS)
    if rejected is not None:
        share = F.coalesce(F.try_divide(F.lit(rejected), records + rejected), F.lit(0.0))
        names.append(REJECTED)
        outcome.append((share, float(limits["max_rejected_rate"]), ~(share > limits["max_rejected_rate"])))
    no_date = F.lit(None).cast("date")
    rows = []
    for i, (name, (value, threshold, passed)) in enumerate(zip(names, outcome)):
        is_gap = name == "date_continuity"
        rows.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(name).alias("check_name"),
                value.cast("double").alias("value"),
                F.lit(threshold).alias("threshold"),
                F.lit(True).alias("performed"),
                passed.alias("passed"),
                (F.col("gap_start") if is_gap else no_date).alias("gap_start"),
                (F.col("gap_end") if is_gap else no_date).alias("gap_end"),
            )
        )
    return summary.select(F.inline(F.array(*rows)))


def quality_metrics(df: DataFrame, cfg: Mapping[str, Any] | None = None) -> DataFrame:
    """The four checks as rows: value, threshold, performed, passed.

    A value equal to its threshold passes. ``passed`` is NULL when the column is
    missing, or when there are too few dates for a gap.
    """
    return quality_checks(quality_summary(df), cfg)


def first_failed(checks: DataFrame) -> DataFrame:
    """One row: name and message of the first check that did not pass, NULL when all did.

    ``checks`` are rows of :func:`quality_checks`.
    """
    value, limit = F.col("value"), F.col("threshold")
    # The wording that callers match on.
    texts = {
        "minimum_records": F.format_string("Insufficient records: %.0f < %.0f minimum required.", value, limit),
        "null_rate": F.format_string("Null rate %.2f%% exceeds threshold %.2f%%.", value * 100, limit * 100),
        "no_negative_sales": F.format_string("Found %.0f negative sales values.", value),
        "date_continuity": F.format_string(
            "Date gap of %.0f days exceeds threshold of %.0f days. The dates around it are %s and %s.",
            value, limit, F.col("gap_start").cast("string"), F.col("gap_end").cast("string"),
        ),
        REJECTED: F.format_string("Share %.2f%% of malformed records is above %.2f%%.", value * 100, limit * 100),
    }
    message = F.coalesce(*[F.when(F.col("check_name") == name, text) for name, text in texts.items()])
    first = F.min(F.when(~F.col("passed"), F.struct("position", "check_name", message.alias("message"))))
    return checks.agg(first.alias("first")).select("first.check_name", "first.message")


def quality_gate(df: DataFrame, cfg: Mapping[str, Any] | None = None) -> DataFrame:
    """Return ``df`` unchanged, or raise ``ValueError`` for the first failed check.

    Runs one job; one row reaches the driver. Use :func:`quality_metrics` to see
    every outcome without raising.
    """
    message = first_failed(quality_metrics(df, cfg)).first()["message"]
    if message:
        raise ValueError(message)
    return df
