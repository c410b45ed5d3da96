"""Daily series, calendar, rolling, lag and fill features."""

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.views import (
    BRAND_SALES,
    EXACT_BRAND_SALES,
    MASKED_SALES,
    SALES,
    brand_sales,
    exact_brand_sales,
    masked_sales,
    sales,
)
from salescast.functions import round_half_even
from salescast.operators import daily as daily_op
from salescast.operators import ordered as op
from salescast.plans.features import feature_table as build_features

WINDOWS, LAGS = [7, 14, 30], [1, 7, 14]

_DAILY = """
daily AS (
  SELECT '__all__' AS series_id, date,
         CAST(coalesce(sum(sales_quantity), 0) AS DOUBLE) AS sales_quantity,
         CAST(coalesce(sum(revenue), 0) AS DOUBLE) AS revenue
  FROM {view} WHERE date IS NOT NULL GROUP BY date
)"""

_DAILY_BY_PRODUCT = """
daily AS (
  SELECT product_id AS series_id, date,
         CAST(coalesce(sum(sales_quantity), 0) AS DOUBLE) AS sales_quantity,
         CAST(coalesce(sum(revenue), 0) AS DOUBLE) AS revenue
  FROM {view} WHERE date IS NOT NULL GROUP BY product_id, date
)"""

_CALENDAR = """
  CAST(isodow(date) - 1 AS INTEGER) AS day_of_week,
  CAST(day(date) AS INTEGER) AS day_of_month,
  CAST(week(date) AS INTEGER) AS week_of_year,
  CAST(month(date) AS INTEGER) AS month,
  CAST(quarter(date) AS INTEGER) AS quarter,
  CAST(year(date) AS INTEGER) AS year,
  CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend,
  CAST(day(date) = 1 AS INTEGER) AS is_month_start,
  CAST(date = last_day(date) AS INTEGER) AS is_month_end"""


def _rolling_sql(window: str, target: str = "sales_quantity") -> str:
    """Rolling means over a window spec without its closing bracket."""
    return ",\n  ".join(
        f"round_even(avg({target}) OVER ({window} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW),"
        f" 2) AS {target}_rolling_{n}d"
        for n in WINDOWS
    )


def _lag_sql(window: str, target: str = "sales_quantity") -> str:
    return ",\n  ".join(f"lag({target}, {k}) OVER ({window}) AS {target}_lag_{k}d" for k in LAGS)


_NAMES = [f"sales_quantity_rolling_{n}d" for n in WINDOWS]
_NAMES += [f"sales_quantity_lag_{k}d" for k in LAGS]


def _fill_sql(window: str) -> str:
    """Forward then backward fill of every rolling and lag feature."""
    return ",\n  ".join(
        f"coalesce(last_value({c} IGNORE NULLS) OVER ({window} ROWS BETWEEN UNBOUNDED PRECEDING"
        f" AND CURRENT ROW), first_value({c} IGNORE NULLS) OVER ({window} ROWS BETWEEN CURRENT ROW"
        f" AND UNBOUNDED FOLLOWING)) AS {c}"
        for c in _NAMES
    )


_ALL = "ORDER BY date"
_SERIES = "PARTITION BY series_id ORDER BY date"


def _cents(df):
    """Money sums to the cent: the order of a sum shows beyond that."""
    return df.withColumn("revenue", round_half_even(F.col("revenue")))


@query(
    f"WITH {SALES}, {_DAILY.format(view='sales')} "
    "SELECT series_id, date, sales_quantity, round_even(revenue, 2) AS revenue FROM daily"
)
def daily_sales(spark, sf_dir):
    return _cents(daily_op.daily_sales(sales(spark, sf_dir)))


@query(
    f"WITH {MASKED_SALES}, {_DAILY.format(view='masked_sales')} "
    "SELECT series_id, date, sales_quantity, round_even(revenue, 2) AS revenue FROM daily"
)
def daily_sales_with_nulls(spark, sf_dir):
    return _cents(daily_op.daily_sales(masked_sales(spark, sf_dir)))


@query(
    f"WITH {SALES}, {_DAILY_BY_PRODUCT.format(view='sales')} "
    "SELECT series_id, date, sales_quantity, round_even(revenue, 2) AS revenue FROM daily"
)
def daily_sales_by_product(spark, sf_dir):
    return _cents(daily_op.daily_sales(sales(spark, sf_dir), ["product_id"]))


@query(f"WITH {SALES} SELECT date, product_id, sales_quantity, {_CALENDAR} FROM sales")
def time_features(spark, sf_dir):
    return daily_op.add_time_features(sales(spark, sf_dir)).drop("revenue")


@query(
    f"WITH {SALES}, {_DAILY.format(view='sales')} "
    f"SELECT series_id, date, sales_quantity, {_rolling_sql(_ALL)} FROM daily"
)
def rolling(spark, sf_dir):
    rows = daily_op.daily_sales(sales(spark, sf_dir)).drop("revenue")
    return op.add_rolling_features(rows, "sales_quantity", WINDOWS, daily=True)


@query(
    f"WITH {BRAND_SALES}, {_DAILY_BY_PRODUCT.format(view='brand_sales')} "
    f"SELECT series_id, date, sales_quantity, {_rolling_sql(_SERIES)} FROM daily"
)
def rolling_by_product(spark, sf_dir):
    rows = daily_op.daily_sales(brand_sales(spark, sf_dir), ["product_id"]).drop("revenue")
    return op.add_rolling_features(rows, "sales_quantity", WINDOWS, "series_id", daily=True)


@query(
    f"WITH {SALES}, {_DAILY.format(view='sales')} "
    f"SELECT series_id, date, sales_quantity, {_lag_sql(_ALL)} FROM daily"
)
def lag(spark, sf_dir):
    rows = daily_op.daily_sales(sales(spark, sf_dir)).drop("revenue")
    return op.add_lag_features(rows, "sales_quantity", LAGS, daily=True)


@query(
    f"WITH {BRAND_SALES}, {_DAILY_BY_PRODUCT.format(view='brand_sales')} "
    f"SELECT series_id, date, sales_quantity, {_lag_sql(_SERIES)} FROM daily"
)
def lag_by_product(spark, sf_dir):
    rows = daily_op.daily_sales(brand_sales(spark, sf_dir), ["product_id"]).drop("revenue")
    return op.add_lag_features(rows, "sales_quantity", LAGS, "series_id", daily=True)


@query(
    f"""
WITH {SALES}, {_DAILY_BY_PRODUCT.format(view='sales')},
added AS (SELECT series_id, date, sales_quantity, {_rolling_sql(_SERIES)}, {_lag_sql(_SERIES)}
          FROM daily)
SELECT series_id, date, sales_quantity, {_fill_sql(_SERIES)} FROM added
"""
)
def fill(spark, sf_dir):
    rows = daily_op.daily_sales(sales(spark, sf_dir), ["product_id"]).drop("revenue")
    added = op.ordered_features(
        rows, "sales_quantity", WINDOWS, LAGS, group="series_id", daily=True
    )
    return op.fill_features(added, _NAMES, "series_id")


def _digest_sql(order: str) -> str:
    return f"""
keyed AS (
  SELECT *, md5(concat_ws('|', coalesce(CAST(date AS VARCHAR), '\\N'),
                coalesce(product_id, '\\N'), coalesce(CAST(sales_quantity AS VARCHAR), '\\N'),
                coalesce(CAST(revenue AS VARCHAR), '\\N'))) AS digest
  FROM {order}
)"""


_RAW_SERIES = "PARTITION BY product_id ORDER BY date NULLS LAST, digest"


@query(
    f"WITH {EXACT_BRAND_SALES}, {_digest_sql('exact_brand_sales')} "
    f"SELECT date, product_id, sales_quantity, revenue, {_rolling_sql(_RAW_SERIES)} FROM keyed"
)
def rolling_raw_rows(spark, sf_dir):
    rows = exact_brand_sales(spark, sf_dir)
    return op.add_rolling_features(rows, "sales_quantity", WINDOWS, "product_id")


@query(
    f"WITH {EXACT_BRAND_SALES}, {_digest_sql('exact_brand_sales')} "
    f"SELECT date, product_id, sales_quantity, revenue, {_lag_sql(_RAW_SERIES)} FROM keyed"
)
def lag_raw_rows(spark, sf_dir):
    rows = exact_brand_sales(spark, sf_dir)
    return op.add_lag_features(rows, "sales_quantity", LAGS, "product_id")


_NULLABLE = """
nullable AS (SELECT date, product_id, nullif(sales_quantity, 50) AS sales_quantity, revenue
             FROM exact_brand_sales)"""


@query(
    f"""
WITH {EXACT_BRAND_SALES}, {_NULLABLE}, {_digest_sql('nullable')},
added AS (SELECT *, {_rolling_sql(_RAW_SERIES)}, {_lag_sql(_RAW_SERIES)} FROM keyed)
SELECT date, product_id, sales_quantity, revenue, {_fill_sql(_RAW_SERIES)} FROM added
"""
)
def fill_raw_rows(spark, sf_dir):
    rows = exact_brand_sales(spark, sf_dir)
    rows = rows.withColumn("sales_quantity", F.nullif("sales_quantity", F.lit(50)))
    return op.ordered_features(
        rows, "sales_quantity", WINDOWS, LAGS, group="product_id", fill=True
    )


def _feature_sql(text: str, daily: str, window: str) -> str:
    return f"""
WITH {text}, {daily},
added AS (SELECT *, {_rolling_sql(window)}, {_lag_sql(window)} FROM daily)
SELECT series_id, date, sales_quantity, round_even(revenue, 2) AS revenue, {_CALENDAR},
  {_fill_sql(window)}, date AS ds, sales_quantity AS y
FROM added
"""


@query(_feature_sql(SALES, _DAILY.format(view="sales"), _ALL))
def feature_table(spark, sf_dir):
    return _cents(build_features(sales(spark, sf_dir)))


@query(_feature_sql(BRAND_SALES, _DAILY_BY_PRODUCT.format(view="brand_sales"), _SERIES))
def feature_table_by_product(spark, sf_dir):
    return _cents(build_features(brand_sales(spark, sf_dir), series_cols=["product_id"]))


_ONE = "Brand#7"


@query(
    f"""
WITH {EXACT_BRAND_SALES},
one AS (SELECT date, product_id, CAST(sales_quantity AS DOUBLE) AS sales_quantity, revenue
        FROM exact_brand_sales WHERE product_id = '{_ONE}'),
{_digest_sql('one')},
added AS (SELECT *, {_rolling_sql(_RAW_SERIES)}, {_lag_sql(_RAW_SERIES)} FROM keyed)
SELECT product_id AS series_id, date, product_id, sales_quantity, revenue, {_CALENDAR},
  {_fill_sql(_RAW_SERIES)}, date AS ds, sales_quantity AS y
FROM added
"""
)
def feature_table_one_product(spark, sf_dir):
    """The product filter is the feature: one product's rows, not aggregated."""
    return build_features(exact_brand_sales(spark, sf_dir), product_id=_ONE)


@query(f"WITH {BRAND_SALES} SELECT * FROM brand_sales WHERE product_id = '{_ONE}'")
def product_filter(spark, sf_dir):
    return daily_op.filter_product(brand_sales(spark, sf_dir), _ONE)


@query(
    f"WITH {SALES} SELECT *, date AS ds, sales_quantity AS y FROM sales"
)
def training_format(spark, sf_dir):
    return daily_op.to_training_format(sales(spark, sf_dir))


@query(
    f"""
WITH {SALES}, {_DAILY_BY_PRODUCT.format(view='sales')},
ranked AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date DESC) AS place
           FROM daily)
SELECT series_id, date, sales_quantity FROM ranked WHERE place <= 30
"""
)
def last_n(spark, sf_dir):
    rows = daily_op.daily_sales(sales(spark, sf_dir), ["product_id"]).drop("revenue")
    return op.last_rows(rows, 30, "date", "series_id")


