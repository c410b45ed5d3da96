"""Outlier statistics, capping, imputation, the cleaning chain."""

import datetime as dt

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.views import (
    EVENT_SALES,
    MASKED_SALES,
    SALES,
    event_sales,
    masked_sales,
    sales,
)
from salescast.operators import cleaning as op
from salescast.operators import sketches


def _bounds_sql(view: str, column: str, multiplier: float, name: str = "b") -> str:
    """A one-row relation with quartiles and bounds of a column."""
    return f"""
{name} AS (
  SELECT q1, q3, q3 - q1 AS iqr, q1 - {multiplier} * (q3 - q1) AS lo,
         q3 + {multiplier} * (q3 - q1) AS hi
  FROM (SELECT CAST(quantile_cont({column}, 0.25) AS DOUBLE) AS q1,
               CAST(quantile_cont({column}, 0.75) AS DOUBLE) AS q3 FROM {view})
)"""


def _cap_sql(column: str, bounds: str, integer: bool, any_outlier: str) -> str:
    low = f"greatest(0.0, round_even({bounds}.lo, 2))"
    high = f"round_even({bounds}.hi, 2)"
    if integer:
        low, high = f"trunc({low})", f"trunc({high})"
    x = f"CAST({column} AS DOUBLE)"
    raised = f"(CASE WHEN {x} < round_even({bounds}.lo, 2) THEN {low} ELSE {x} END)"
    capped = f"CASE WHEN {raised} > round_even({bounds}.hi, 2) THEN {high} ELSE {raised} END"
    return f"CASE WHEN {any_outlier} THEN {capped} ELSE {x} END"


def _iqr_sql(view: str, text: str, column: str, multiplier: float) -> str:
    return f"""
WITH {text}, {_bounds_sql(view, column, multiplier)}
SELECT round_even(any_value(q1), 2) AS q1, round_even(any_value(q3), 2) AS q3,
       round_even(any_value(iqr), 2) AS iqr, round_even(any_value(lo), 2) AS lower_bound,
       round_even(any_value(hi), 2) AS upper_bound,
       count(*) FILTER ({column} < lo OR {column} > hi) AS outlier_count,
       round_even(count(*) FILTER ({column} < lo OR {column} > hi) / count(*), 4) AS outlier_rate
FROM {view}, b
"""


@query(_iqr_sql("event_sales", EVENT_SALES, "revenue", 1.5))
def iqr_stats(spark, sf_dir):
    return op.iqr_stats(event_sales(spark, sf_dir), "revenue")


@query(_iqr_sql("masked_sales", MASKED_SALES, "revenue", 0.1))
def iqr_stats_with_nulls(spark, sf_dir):
    return op.iqr_stats(masked_sales(spark, sf_dir), "revenue", multiplier=0.1)


@query(
    f"""
WITH {EVENT_SALES}, {_bounds_sql("event_sales", "revenue", 1.5)}
SELECT event_id, revenue, coalesce(revenue < lo OR revenue > hi, false) AS is_outlier
FROM event_sales, b
"""
)
def flag_outliers(spark, sf_dir):
    flagged = op.flag_outliers(event_sales(spark, sf_dir), "revenue")
    return flagged.select("event_id", "revenue", "is_outlier")


@query(
    f"""
WITH {EVENT_SALES}, {_bounds_sql("event_sales", "revenue", 1.5)},
any_out AS (SELECT bool_or(revenue < lo OR revenue > hi) AS yes FROM event_sales, b)
SELECT date, product_id, sales_quantity, event_id,
       {_cap_sql("revenue", "b", False, "any_out.yes")} AS revenue
FROM event_sales, b, any_out
"""
)
def winsorize(spark, sf_dir):
    return op.winsorize(event_sales(spark, sf_dir), "revenue")


@query(
    f"""
WITH {SALES}, {_bounds_sql("sales", "sales_quantity", 0.1)},
any_out AS (SELECT bool_or(sales_quantity < lo OR sales_quantity > hi) AS yes FROM sales, b)
SELECT date, product_id, revenue,
       {_cap_sql("sales_quantity", "b", True, "any_out.yes")} AS sales_quantity
FROM sales, b, any_out
"""
)
def winsorize_whole_numbers(spark, sf_dir):
    return op.winsorize(sales(spark, sf_dir), "sales_quantity", multiplier=0.1, integer=True)


@query(
    f"""
WITH {MASKED_SALES},
m AS (SELECT CAST(median(sales_quantity) AS DOUBLE) AS q, median(revenue) AS r FROM masked_sales)
SELECT date, product_id, note,
       coalesce(CAST(sales_quantity AS DOUBLE), q) AS sales_quantity,
       coalesce(revenue, r) AS revenue
FROM masked_sales, m
"""
)
def impute_median(spark, sf_dir):
    return op.impute_median(masked_sales(spark, sf_dir))


def _clean_sql(view: str, text: str, multiplier: float, extra: str, tail: str) -> str:
    return f"""
WITH {text},
{_bounds_sql(view, "sales_quantity", multiplier, "bq")},
{_bounds_sql(view, "revenue", multiplier, "br")},
any_out AS (
  SELECT coalesce(bool_or(sales_quantity < bq.lo OR sales_quantity > bq.hi), false) AS q,
         coalesce(bool_or(revenue < br.lo OR revenue > br.hi), false) AS r
  FROM {view}, bq, br),
capped AS (
  SELECT date, product_id, {extra},
         {_cap_sql("sales_quantity", "bq", True, "any_out.q")} AS sales_quantity,
         {_cap_sql("revenue", "br", False, "any_out.r")} AS revenue
  FROM {view}, bq, br, any_out),
m AS (SELECT median(sales_quantity) AS q, median(revenue) AS r FROM capped),
cleaned AS (
  SELECT date, product_id, {extra}, coalesce(sales_quantity, q) AS sales_quantity,
         coalesce(revenue, r) AS revenue
  FROM capped, m WHERE date IS NOT NULL)
{tail}
"""


@query(_clean_sql("masked_sales", MASKED_SALES, 0.1, "note", "SELECT * FROM cleaned"))
def clean(spark, sf_dir):
    cfg = {"data_quality": {"outlier_iqr_multiplier": 0.1}}
    return op.clean(masked_sales(spark, sf_dir), cfg)


@query(_clean_sql("event_sales", EVENT_SALES, 1.5, "event_id", "SELECT * FROM cleaned"))
def clean_events(spark, sf_dir):
    return op.clean(event_sales(spark, sf_dir))


_LOG_TAIL = """
, counts AS (
  SELECT count(*) FILTER (sales_quantity < bq.lo OR sales_quantity > bq.hi) AS out_q,
         count(*) FILTER (revenue < br.lo OR revenue > br.hi) AS out_r,
         count(*) FILTER (sales_quantity IS NULL) AS null_q,
         count(*) FILTER (revenue IS NULL) AS null_r,
         count(*) FILTER (date IS NULL) AS null_d
  FROM masked_sales, bq, br)
SELECT * FROM (
  SELECT 0 AS position, 'outlier_capping' AS type, 'sales_quantity' AS columns,
         CAST(NULL AS VARCHAR) AS strategy, CAST(NULL AS DOUBLE) AS fill_value, out_q AS count
  FROM counts
  UNION ALL SELECT 1, 'outlier_capping', 'revenue', NULL, NULL, out_r FROM counts
  UNION ALL SELECT 2, 'null_imputation', 'sales_quantity', 'median', round_even(m.q, 2), null_q
            FROM counts, m
  UNION ALL SELECT 3, 'null_imputation', 'revenue', 'median', round_even(m.r, 2), null_r
            FROM counts, m
  UNION ALL SELECT 4, 'null_drop', 'date', NULL, NULL, null_d FROM counts
  UNION ALL SELECT 5, 'sort', 'date, product_id', NULL, NULL, NULL
) WHERE type = 'sort' OR count > 0
"""


@query(_clean_sql("masked_sales", MASKED_SALES, 0.1, "note", _LOG_TAIL))
def cleaning_log(spark, sf_dir):
    rows = masked_sales(spark, sf_dir)
    rules = op.learn_cleaning(rows, {"data_quality": {"outlier_iqr_multiplier": 0.1}})
    return op.cleaning_log(op.cleaning_summary(rows, rules), rules)


@query(
    f"""
WITH {MASKED_SALES}
SELECT count(*) AS original_rows, count(date) AS final_rows, count(*) - count(date) AS rows_removed,
       count(*) FILTER (sales_quantity IS NULL) AS quantity_nulls_before,
       CAST(0 AS BIGINT) AS quantity_nulls_after,
       count(*) FILTER (product_id IS NULL) AS product_nulls_before,
       count(*) FILTER (product_id IS NULL AND date IS NOT NULL) AS product_nulls_after
FROM masked_sales
"""
)
def cleaning_counts(spark, sf_dir):
    rows = masked_sales(spark, sf_dir)
    summary = op.cleaning_summary(rows, op.learn_cleaning(rows))
    return summary.select(
        "original_rows",
        "final_rows",
        "rows_removed",
        F.col("null_before")["sales_quantity"].alias("quantity_nulls_before"),
        F.col("null_after")["sales_quantity"].alias("quantity_nulls_after"),
        F.col("null_before")["product_id"].alias("product_nulls_before"),
        F.col("null_after")["product_id"].alias("product_nulls_after"),
    )


_RANKS = [0.25, 0.5, 0.75]


def _sketched_sql(name: str, where: str) -> str:
    return f"""
SELECT '{name}' AS column_name, p, count({name}) AS n, CAST(min({name}) AS DOUBLE) AS low,
       CAST(max({name}) AS DOUBLE) AS high, true AS within
FROM masked_sales, (SELECT unnest([0.25, 0.5, 0.75])::DOUBLE AS p) {where} GROUP BY p"""


@query(
    f"""
WITH {MASKED_SALES}
SELECT 'all' AS days, * FROM ({_sketched_sql("revenue", "")} UNION ALL {_sketched_sql("sales_quantity", "")})
UNION ALL
SELECT '1995', * FROM ({_sketched_sql("revenue", "WHERE year(date) = 1995")}
                       UNION ALL {_sketched_sql("sales_quantity", "WHERE year(date) = 1995")})
"""
)
def iqr_rank_error(spark, sf_dir):
    """Whether the true ranks of quartiles from day sketches keep to the stated error, over all days and a year of them."""
    rows = masked_sales(spark, sf_dir)
    columns = ["revenue", "sales_quantity"]
    days = sketches.day_sketches(rows, columns)
    found = None
    for name, start, end in (("all", None, None), ("1995", dt.date(1995, 1, 1), dt.date(1995, 12, 31))):
        quantiles = sketches.sketch_quantiles(days, columns, _RANKS, start, end)
        chosen = rows if start is None else rows.where(F.col("date").between(start, end))
        checks = []
        for c in columns:
            x, n = F.col(c).cast("double"), F.count(c)
            for p, q in zip(_RANKS, quantiles[c].q):
                error = sketches.rank_error(sketches.ACCURACY) * n
                within = (F.count_if(x < q) - error <= p * n) & (F.count_if(x <= q) + error >= p * n)
                values = [F.lit(c).alias("column_name"), F.lit(p).alias("p"), n.alias("n")]
                ends = [F.lit(quantiles[c].low).alias("low"), F.lit(quantiles[c].high).alias("high")]
                checks.append(F.struct(*values, *ends, within.alias("within")))
        result = chosen.agg(F.array(*checks).alias("checks")).select(F.lit(name).alias("days"), F.inline("checks"))
        found = result if found is None else found.union(result)
    return found
