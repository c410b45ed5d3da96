"""From clean sales rows to the feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.config import settings
from salescast.functions import CALENDAR_FEATURES, calendar_columns
from salescast.operators.daily import daily_sales, filter_product, to_training_format
from salescast.operators.ordered import lag_name, ordered_features, rolling_name
from salescast.schema import ALL_PRODUCTS

TARGET = "sales_quantity"


def feature_names(cfg: Mapping[str, Any] | None = None) -> list[str]:
    """Names of the added features, in output order."""
    chosen = settings(cfg, "features")
    names = list(CALENDAR_FEATURES) if chosen["extract_time_features"] else []
    names += [rolling_name(TARGET, n) for n in chosen["rolling_windows"]]
    return names + [lag_name(TARGET, k) for k in chosen["lag_days"]]


def feature_table(
    df: DataFrame,
    cfg: Mapping[str, Any] | None = None,
    product_id: str | None = None,
    series_cols: Sequence[str] = (),
    staging: str | None = None,
) -> DataFrame:
    """Calendar, rolling and lag features plus ``ds`` and ``y``, per series.

    * By default every product is summed into one row per date.
    * ``series_cols`` computes one such series per key, all in one job.
    * ``product_id`` keeps that product's rows as they are; so does a table
      without a product column.

    Features are filled forward, then backward, within their series. Rows that are
    not aggregated are put in order on the way, in a table at ``staging``.
    """
    chosen = settings(cfg, "features")
    windows, lags = chosen["rolling_windows"], chosen["lag_days"]
    date = F.col("date")
    daily = product_id is None and "product_id" in df.columns
    if daily:
        rows = daily_sales(df, series_cols)
        group = "series_id" if series_cols else None
        filled_date = date
    else:
        rows = df if product_id is None else filter_product(df, product_id)
        rows = rows.withColumn(TARGET, F.col(TARGET).cast("double"))
        group = None
        # forward fill gives a row without a date the features of the last date
        filled_date = F.coalesce(date, rows.agg(F.max("date")).scalar())
    rows = ordered_features(
        rows, TARGET, windows, lags, group=group, fill=True, daily=daily, staging=staging
    )
    if not daily:
        series = F.lit(ALL_PRODUCTS) if product_id is None else F.lit(product_id)
        rows = rows.withColumn("series_id", series)
    if chosen["extract_time_features"]:
        rows = rows.withColumns(calendar_columns(filled_date))
    rows = to_training_format(rows, "date", TARGET)
    names = feature_names(cfg)
    added = {*names, "series_id", "ds", "y"}
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in added]
    return rows.select("series_id", *kept, *names, "ds", "y")
