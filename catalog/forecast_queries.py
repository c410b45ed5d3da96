"""Observations, future dates, forecasts and their statistics.

Fitting has no SQL form. Signals of a known form are fitted and compared with
that form, and invariants of real forecasts are rows; formatting and statistics
are checked on stand-in columns.
"""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.views import (
    ACCOUNT_SALES,
    BRAND_SALES,
    MASKED_SALES,
    SALES,
    account_sales,
    brand_sales,
    masked_sales,
    sales,
    table,
)
from salescast.functions import round_half_even
from salescast.operators import forecast as op
from salescast.operators.daily import daily_sales
from salescast.plans.features import feature_table
from salescast.plans.metadata import save_metadata, stored_summary
from salescast.plans.run import run_all
from salescast.plans.stages import (
    extract_data,
    forecast_rows,
    model_rows,
    training_hash,
    validate_and_clean_data,
)
from salescast.sources import (
    discard,
    latest_models as read_latest_models,
    newest_models,
    shared_folder,
    write_models,
    write_table,
)

RUN_DATE = dt.date(2024, 1, 1)
CREATED_AT = dt.datetime(2024, 1, 1)


@query(
    f"""
WITH {MASKED_SALES}
SELECT coalesce(product_id, '?') AS series_id, date AS ds, count(*) AS records,
       count(sales_quantity) AS weight,
       round_even(avg(sales_quantity), 6) AS y,
       round_even(var_pop(sales_quantity) * count(sales_quantity), 6) AS spread,
       CAST(max(abs(sales_quantity)) AS DOUBLE) AS largest
FROM masked_sales WHERE date IS NOT NULL GROUP BY product_id, date
"""
)
def training_observations(spark, sf_dir):
    rows = masked_sales(spark, sf_dir).select(
        F.coalesce("product_id", F.lit("?")).alias("series_id"),
        F.col("date").alias("ds"),
        F.col("sales_quantity").alias("y"),
    )
    return op.daily_observations(rows).withColumns(
        {"y": round_half_even(F.col("y"), 6), "spread": round_half_even(F.col("spread"), 6)}
    )


def _histories(spark, sf_dir):
    """Stand-in model rows: every part's ship dates, as a fitted model keeps them."""
    return (
        sales(spark, sf_dir)
        .groupBy(F.col("product_id").alias("series_id"))
        .agg(F.sort_array(F.collect_set("date")).alias("history_ds"))
    )


_HISTORY = """
history AS (SELECT DISTINCT product_id AS series_id, date AS ds FROM sales),
ends AS (SELECT series_id, max(ds) AS ds_end FROM history GROUP BY series_id)"""


@query(
    f"""
WITH {SALES}, {_HISTORY}
SELECT series_id, ds FROM history
UNION ALL
SELECT series_id, ds_end + CAST(k AS INTEGER) AS ds FROM ends, range(1, 31) AS r(k)
"""
)
def future_frame(spark, sf_dir):
    return op.future_frame(_histories(spark, sf_dir), 30).select("series_id", "ds")


@query(
    f"""
WITH {SALES}, {_HISTORY}
SELECT series_id, ds_end + CAST(8 - isodow(ds_end + 1) + 7 * k AS INTEGER) AS ds
FROM ends, range(0, 8) AS r(k)
"""
)
def future_frame_weekly(spark, sf_dir):
    frame = op.future_frame(_histories(spark, sf_dir), 8, "W", include_history=False)
    return frame.select("series_id", "ds")


@query(
    f"""
WITH {SALES}, {_HISTORY}
SELECT series_id,
       last_day(CAST(date_trunc('month', ds_end + 1) + to_months(CAST(k AS INTEGER)) AS DATE)) AS ds
FROM ends, range(0, 12) AS r(k)
"""
)
def future_frame_monthly(spark, sf_dir):
    frame = op.future_frame(_histories(spark, sf_dir), 12, "M", include_history=False)
    return frame.select("series_id", "ds")


def _stand_in(spark, sf_dir):
    """Account rows dressed as a raw forecast, with negative values."""
    rows = account_sales(spark, sf_dir)
    quantity = F.col("sales_quantity") / 8
    return rows.select(
        F.col("date").alias("ds"),
        quantity.alias("yhat"),
        (quantity - 1.125).alias("yhat_lower"),
        (quantity + 2.375).alias("yhat_upper"),
        (F.col("sales_quantity") / 16).alias("trend"),
        (F.col("sales_quantity") / 32).alias("weekly"),
        F.col("revenue").alias("not_published"),
    )


@query(
    f"""
WITH {ACCOUNT_SALES}
SELECT date AS ds,
       greatest(round_even(sales_quantity / 8, 2), 0.0) AS yhat,
       greatest(round_even(sales_quantity / 8 - 1.125, 2), 0.0) AS yhat_lower,
       round_even(sales_quantity / 8 + 2.375, 2) AS yhat_upper,
       round_even(sales_quantity / 16, 2) AS trend,
       round_even(sales_quantity / 32, 2) AS weekly
FROM account_sales
"""
)
def forecast_format(spark, sf_dir):
    return op.format_forecast(_stand_in(spark, sf_dir))


def _daily_as_forecast(spark, sf_dir, series_cols=()):
    rows = daily_sales(sales(spark, sf_dir), series_cols)
    return rows.select(
        "series_id",
        F.col("date").alias("ds"),
        F.col("sales_quantity").alias("yhat"),
        (F.col("sales_quantity") - 3).alias("yhat_lower"),
        (F.col("sales_quantity") * 1.5).alias("yhat_upper"),
    )


_STATISTICS = """
count(*) AS forecast_days, round_even(avg(yhat), 2) AS mean_forecast,
round_even(min(yhat), 2) AS min_forecast, round_even(max(yhat), 2) AS max_forecast,
round_even(sum(yhat), 2) AS total_forecast,
round_even(avg(yhat * 1.5 - (yhat - 3)), 2) AS avg_confidence_width"""


@query(
    f"""
WITH {SALES},
daily AS (SELECT date AS ds, CAST(sum(sales_quantity) AS DOUBLE) AS yhat
          FROM sales GROUP BY date ORDER BY date DESC LIMIT 30)
SELECT {_STATISTICS} FROM daily
"""
)
def forecast_statistics(spark, sf_dir):
    return op.forecast_statistics(_daily_as_forecast(spark, sf_dir))


@query(
    f"""
WITH {SALES},
daily AS (SELECT date AS ds, CAST(sum(sales_quantity) AS DOUBLE) AS yhat
          FROM sales GROUP BY date)
SELECT {_STATISTICS} FROM daily
"""
)
def forecast_statistics_all_rows(spark, sf_dir):
    return op.forecast_statistics(_daily_as_forecast(spark, sf_dir), future_only=False)


@query(
    f"""
WITH {SALES},
daily AS (SELECT product_id AS series_id, date AS ds, CAST(sum(sales_quantity) AS DOUBLE) AS yhat,
                 row_number() OVER (PARTITION BY product_id ORDER BY date DESC) AS place
          FROM sales GROUP BY product_id, date)
SELECT series_id, {_STATISTICS} FROM daily WHERE place <= 30 GROUP BY series_id
"""
)
def forecast_statistics_by_product(spark, sf_dir):
    rows = _daily_as_forecast(spark, sf_dir, ["product_id"])
    return op.forecast_statistics(rows, series="series_id", per_series=True)


def _signal_sql(kind: str, value: str) -> str:
    """The closed form on the history of each brand and the 30 days after it."""
    return f"""
SELECT '{kind}' AS kind, product_id AS series_id, date AS ds,
       CAST({value} AS BIGINT) AS y
FROM (SELECT DISTINCT product_id, date FROM brand_sales
      UNION ALL
      SELECT product_id, CAST(last + CAST(k AS INTEGER) AS DATE)
      FROM (SELECT product_id, max(date) AS last FROM brand_sales GROUP BY product_id), range(1, 31) r(k))
"""


# Two signals. A line plus a weekday table, and a line times one.
_DAY = "(date - DATE '1995-01-01')"
_WEEKDAY = "[0, 30, -20, 50, 10, -40, -30][isodow(date)]"
_SUM = f"500 + {_DAY} + {_WEEKDAY}"
_PRODUCT = f"(1000 + 10 * {_DAY}) * (10 + [0, 1, -1, 2, 0, -1, -1][isodow(date)]) / 10"


@query(
    f"WITH {BRAND_SALES} "
    + _signal_sql("additive", _SUM)
    + " UNION ALL "
    + _signal_sql("multiplicative", _PRODUCT)
)
def fit_known_signal(spark, sf_dir):
    """Signals of a known form on each brand's ship dates, fitted and forecast 30 days.

    Without noise the fit recovers them to less than half a unit.
    """
    dates = brand_sales(spark, sf_dir).select(F.col("product_id").alias("series_id"), F.col("date").alias("ds")).distinct()
    day, weekday = F.datediff("ds", F.lit(dt.date(1995, 1, 1))), F.weekday("ds") + 1

    def of(values):
        return F.element_at(F.array(*map(F.lit, values)), weekday)

    signals = {
        "additive": 500 + day + of([0, 30, -20, 50, 10, -40, -30]),
        "multiplicative": (1000 + 10 * day) * (10 + of([0, 1, -1, 2, 0, -1, -1])) / 10,
    }
    parts = []
    for kind, y in signals.items():
        cfg = {"model": {"prophet": {"seasonality_mode": kind, "yearly_seasonality": False}}}
        models = model_rows(dates.withColumn("y", y.cast("double")), "00000000", cfg, RUN_DATE, CREATED_AT)
        rows = forecast_rows(models, 30)
        parts.append(rows.select(F.lit(kind).alias("kind"), "series_id", "ds", F.round("yhat").cast("bigint").alias("y")))
    return parts[0].union(parts[1])


@query(
    f"""
WITH {BRAND_SALES}
SELECT product_id AS series_id, count(DISTINCT date) + 30 AS rows, CAST(max(date) + 30 AS DATE) AS last_day,
       true AS ordered, true AS non_negative, true AS covers_most
FROM brand_sales GROUP BY product_id
"""
)
def forecast_checks(spark, sf_dir):
    """Invariants of every brand's forecast: rows, end, ordered intervals, and 70 % of the history inside."""
    brands = brand_sales(spark, sf_dir)
    features = feature_table(brands, series_cols=["product_id"])
    rows = forecast_rows(model_rows(features, "00000000", None, RUN_DATE, CREATED_AT), 30)
    seen = features.select("series_id", "ds", "y")
    inside = F.when(F.col("y").isNotNull(), F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper")).cast("double"))
    return rows.join(seen, ["series_id", "ds"], "left").groupBy("series_id").agg(
        F.count("*").alias("rows"),
        F.max("ds").alias("last_day"),
        F.bool_and((F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))).alias("ordered"),
        (F.min("yhat_lower") >= 0).alias("non_negative"),
        (F.avg(inside) >= 0.7).alias("covers_most"),
    )


_STAND_IN_VERSIONS = """
SELECT DISTINCT CAST(o_custkey % 97 AS {text}) AS series_id, 'v' || CAST(o_orderkey % 7 AS {text}) AS version,
       CAST(o_orderdate AS TIMESTAMP) AS created_at,
       CASE WHEN o_orderkey % 7 < 3 OR o_custkey % 97 = 5 THEN 'error' ELSE 'ok' END AS status
FROM {table}"""


@query(
    f"""
WITH m AS ({_STAND_IN_VERSIONS.format(text="VARCHAR", table="orders")})
SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY status = 'ok' DESC, created_at DESC, version DESC) = 1
"""
)
def latest_models(spark, sf_dir):
    """Stand-in model rows of many versions: the newest fitted one of each series."""
    text = _STAND_IN_VERSIONS.format(text="STRING", table="{orders}")
    return newest_models(spark.sql(text, orders=table(spark, sf_dir, "orders")))


@query(
    f"""
WITH m AS ({_STAND_IN_VERSIONS.format(text="VARCHAR", table="orders")})
SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY status = 'ok' DESC, created_at DESC, version DESC) = 1
"""
)
def stored_latest_models(spark, sf_dir):
    """The same choice from a model table with an index; it has one row of each series and version."""
    text = _STAND_IN_VERSIONS.format(text="STRING", table="{orders}")
    rows = spark.sql(text, orders=table(spark, sf_dir, "orders"))
    path = f"{shared_folder(spark)}/models-{uuid.uuid4().hex}"
    write_models(rows.groupBy("version", "series_id", "status").agg(F.max("created_at").alias("created_at")), path)
    found = read_latest_models(spark, path)
    # at most 97 series, taken out because the table goes
    newest = spark.createDataFrame(found.collect(), found.schema)
    discard(spark, path)
    return newest


@query()
def forecast_all(spark, sf_dir):
    """All products as one series: fit, 30 days ahead, formatted."""
    models = model_rows(feature_table(sales(spark, sf_dir)), "00000000", None, RUN_DATE, CREATED_AT)
    return forecast_rows(models, 30)


@query()
def forecast_by_product(spark, sf_dir):
    """Every brand as its own series, in one job."""
    features = feature_table(brand_sales(spark, sf_dir), series_cols=["product_id"])
    return forecast_rows(model_rows(features, "00000000", None, RUN_DATE, CREATED_AT), 30)


@query(
    f"""
WITH {BRAND_SALES},
daily AS (SELECT product_id AS series_id, date AS ds, CAST(sum(sales_quantity) AS DOUBLE) AS y
          FROM brand_sales GROUP BY product_id, date),
digests AS (
  SELECT CAST('0x' || substr(md5(series_id || '|' || CAST(ds AS VARCHAR) || '|' ||
                                 CAST(y AS VARCHAR)), 1, 15) AS BIGINT) AS number FROM daily),
hashed AS (SELECT substr(md5(CAST(sum(number) AS VARCHAR) || ':' || CAST(count(*) AS VARCHAR)),
                         1, 8) AS data_hash FROM digests)
SELECT 'model_v20240101_' || any_value(data_hash) AS version, series_id,
       any_value(data_hash) AS data_hash, 'piecewise_seasonal' AS model_type,
       30 AS horizon_days, 'ok' AS status, count(*) AS training_records,
       min(ds) AS ds_start, max(ds) AS ds_end, CAST(count(*) AS INTEGER) AS history_days,
       CAST(max(ds) - min(ds) AS DOUBLE) AS span_days, max(y) AS y_scale, 25 AS changepoints,
       CAST(0.05 AS DOUBLE) AS changepoint_prior_scale, CAST(10 AS DOUBLE) AS seasonality_prior_scale,
       'multiplicative' AS seasonality_mode, true AS weekly_seasonality, true AS yearly_seasonality,
       CAST(0.95 AS DOUBLE) AS interval_width
FROM daily, hashed GROUP BY series_id
"""
)
def model_table(spark, sf_dir):
    """Model rows of every brand: version and training metadata."""
    features = feature_table(brand_sales(spark, sf_dir), series_cols=["product_id"])
    models = model_rows(features, training_hash(features), None, RUN_DATE, CREATED_AT)
    return models.select(
        "version",
        "series_id",
        "data_hash",
        "model_type",
        "horizon_days",
        "status",
        "training_records",
        "ds_start",
        "ds_end",
        F.size("history_ds").alias("history_days"),
        "span_days",
        "y_scale",
        "changepoints",
        "parameters.*",
    )


def _stand_in_models(spark, sf_dir):
    """Model rows whose coefficients are plain functions of each brand's sales."""
    daily = daily_sales(brand_sales(spark, sf_dir), ["product_id"])
    steps = F.sequence(F.lit(0), F.lit(25))
    level = F.avg("sales_quantity") / F.max("sales_quantity")
    models = daily.groupBy("series_id").agg(
        F.sort_array(F.collect_list("date")).alias("history_ds"),
        F.min("date").alias("ds_start"),
        F.max("sales_quantity").alias("y_scale"),
        level.alias("level"),
    )
    days = F.datediff(F.element_at("history_ds", -1), "ds_start").cast("double")
    mode = F.when(F.length("series_id") == 7, "additive").otherwise("multiplicative")
    return models.select(
        F.lit("model_v20240101_00000000").alias("version"),
        "series_id",
        F.lit("ok").alias("status"),
        "history_ds",
        "ds_start",
        "y_scale",
        days.alias("span_days"),
        (F.col("level") / 8).alias("sigma"),
        (F.col("level") / 16).alias("slope_change_scale"),
        F.lit(25).alias("changepoints"),
        F.transform(steps, lambda k: F.col("level") - k / 500).alias("trend_offset"),
        F.transform(steps, lambda k: k * F.col("level") / 40).alias("trend_slope"),
        F.transform(F.sequence(F.lit(0), F.lit(6)), lambda d: (d - 3) / 50.0).alias("weekly"),
        F.transform(
            F.sequence(F.lit(1), F.lit(20)), lambda k: F.col("level") / (10.0 * k)
        ).alias("yearly"),
        F.struct(mode.alias("seasonality_mode")).alias("parameters"),
        F.lit(1.96).alias("interval_z"),
    )


@query(
    f"""
WITH {BRAND_SALES},
daily AS (SELECT product_id AS series_id, date, CAST(sum(sales_quantity) AS DOUBLE) AS y
          FROM brand_sales GROUP BY product_id, date),
models AS (
  SELECT series_id, min(date) AS ds_start, max(date) AS ds_end, max(y) AS y_scale,
         avg(y) / max(y) AS level, CAST(max(date) - min(date) AS DOUBLE) AS span,
         length(series_id) <> 7 AS mult
  FROM daily GROUP BY series_id),
dates AS (
  SELECT series_id, date AS ds FROM daily
  UNION ALL
  SELECT series_id, ds_end + CAST(k AS INTEGER) FROM models, range(1, 31) AS r(k)),
placed AS (
  SELECT m.*, d.ds, CAST(d.ds - ds_start AS DOUBLE) / span AS t,
         CAST(d.ds - DATE '1970-01-01' AS DOUBLE) AS days
  FROM dates d JOIN models m USING (series_id)),
cut AS (SELECT *, least(25, CAST(floor(t * (25 / 0.8)) AS INTEGER)) AS seg FROM placed),
terms AS (
  SELECT *, level - seg / 500 + seg * level / 40 * t AS line,
         (isodow(ds) - 4) / 50.0 AS weekly_term,
         list_sum(list_transform(range(1, 11), lambda k:
           cos(days * (2 * pi() * k / 365.25)) * level / (10.0 * k)
           + sin(days * (2 * pi() * k / 365.25)) * level / (10.0 * (10 + k)))) AS yearly_term,
         25 * 2 * (level / 16) ** 2 * greatest(t - 1, 0) ** 3 / 3 AS trend_variance
  FROM cut),
scored AS (
  SELECT *, CASE WHEN mult THEN line * (1 + weekly_term + yearly_term)
                 ELSE line + weekly_term + yearly_term END AS centre,
         1.96 * sqrt((level / 8) ** 2 + (CASE WHEN mult THEN 1 + weekly_term + yearly_term
                                              ELSE 1 END) ** 2 * trend_variance) AS half
  FROM terms)
SELECT series_id, 'model_v20240101_00000000' AS model_version, ds,
       greatest(round_even(y_scale * centre, 2), 0.0) AS yhat,
       greatest(round_even(y_scale * (centre - half), 2), 0.0) AS yhat_lower,
       round_even(y_scale * (centre + half), 2) AS yhat_upper,
       round_even(y_scale * line, 2) AS trend,
       round_even(weekly_term * (CASE WHEN mult THEN 1 ELSE y_scale END), 2) AS weekly,
       round_even(yearly_term * (CASE WHEN mult THEN 1 ELSE y_scale END), 2) AS yearly
FROM scored
"""
)
def predict(spark, sf_dir):
    """History and 30 days of every brand, scored with stand-in models."""
    return forecast_rows(_stand_in_models(spark, sf_dir), 30)


@query(
    f"""
WITH {SALES},
n AS (SELECT count(*) AS rows, count(DISTINCT product_id) AS products,
             count(DISTINCT date) AS days, strftime(min(date), '%Y-%m-%d') AS first,
             strftime(max(date), '%Y-%m-%d') AS last FROM sales)
SELECT 'catalog' AS run_id, stage, position, metric, value FROM (
  SELECT 'extraction' AS stage, 0 AS position, 'records_extracted' AS metric,
         CAST(rows AS VARCHAR) AS value FROM n
  UNION ALL SELECT 'extraction', 1, 'products', CAST(products AS VARCHAR) FROM n
  UNION ALL SELECT 'extraction', 2, 'start_date', first FROM n
  UNION ALL SELECT 'extraction', 3, 'end_date', last FROM n
  UNION ALL SELECT 'validation', 0, 'checks_passed', '4'
  UNION ALL SELECT 'validation', 1, 'null_rate', '0.0'
  UNION ALL SELECT 'validation', 2, 'rows_cleaned', '0'
  UNION ALL SELECT 'feature_engineering', 0, 'features_added', '15'
  UNION ALL SELECT 'feature_engineering', 1, 'records_processed', CAST(days AS VARCHAR) FROM n
  UNION ALL SELECT 'model_training', 2, 'training_records', CAST(days AS VARCHAR) FROM n
  UNION ALL SELECT 'forecasting', 0, 'horizon_days', '30'
  UNION ALL SELECT 'forecasting', 1, 'total_predictions', CAST(days + 30 AS VARCHAR) FROM n
)
"""
)
def run_summary(spark, sf_dir):
    """All five stages over the line items, from files to files.

    Left out are the metrics that depend on the fit or on the clock.
    """
    base = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    write_table(sales(spark, sf_dir), f"{base}/raw")
    run = run_all(spark, f"{base}/raw", base, run_id="catalog", run_date=RUN_DATE)
    discard(spark, base)
    fitted = ["model_version", "training_duration_sec", "mean_forecast", "total_forecast"]
    return run.summary.where(~F.col("metric").isin(*fitted, "avg_confidence_width"))


@query(
    f"""
WITH {SALES},
n AS (SELECT count(*) AS rows, count(DISTINCT product_id) AS products,
             strftime(min(date), '%Y-%m-%d') AS first, strftime(max(date), '%Y-%m-%d') AS last FROM sales)
SELECT 'catalog' AS run_id, stage, position, metric, value FROM (
  SELECT 'extraction' AS stage, 0 AS position, 'records_extracted' AS metric,
         CAST(rows AS VARCHAR) AS value FROM n
  UNION ALL SELECT 'extraction', 1, 'products', CAST(products AS VARCHAR) FROM n
  UNION ALL SELECT 'extraction', 2, 'start_date', first FROM n
  UNION ALL SELECT 'extraction', 3, 'end_date', last FROM n
  UNION ALL SELECT 'validation', 0, 'checks_passed', '4'
  UNION ALL SELECT 'validation', 1, 'null_rate', '0.0'
  UNION ALL SELECT 'validation', 2, 'rows_cleaned', '0'
  UNION ALL SELECT 'feature_engineering', 0, 'features_added', NULL
  UNION ALL SELECT 'feature_engineering', 1, 'records_processed', NULL
  UNION ALL SELECT 'model_training', 0, 'model_version', NULL
  UNION ALL SELECT 'model_training', 1, 'training_duration_sec', NULL
  UNION ALL SELECT 'model_training', 2, 'training_records', NULL
  UNION ALL SELECT 'forecasting', 0, 'horizon_days', NULL
  UNION ALL SELECT 'forecasting', 1, 'total_predictions', NULL
  UNION ALL SELECT 'forecasting', 2, 'mean_forecast', NULL
  UNION ALL SELECT 'forecasting', 3, 'total_forecast', NULL
  UNION ALL SELECT 'forecasting', 4, 'avg_confidence_width', NULL
)
"""
)
def stored_summary_of_two_stages(spark, sf_dir):
    """Two stages run on their own, one of them twice; the summary from their stored metadata."""
    base = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    raw, stored = f"{base}/raw", f"{base}/metadata"
    write_table(sales(spark, sf_dir), raw)
    for run_id in ("another", "catalog", "catalog"):
        save_metadata(extract_data(spark, raw)[1], stored, run_id, "extraction")
    save_metadata(validate_and_clean_data(spark, raw, f"{base}/cleaned"), stored, "catalog", "validation")
    summary = stored_summary(spark, stored, "catalog")
    # one short row for each metric, taken out because the folder goes
    rows = spark.createDataFrame(summary.collect(), summary.schema)
    discard(spark, base)
    return rows
