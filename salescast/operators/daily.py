"""From sales rows to series: product filter, daily totals, ds/y columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.functions import calendar_columns, escaped_text, exact_sum
from salescast.schema import ALL_PRODUCTS


def filter_product(df: DataFrame, product_id: str) -> DataFrame:
    """Rows of one product; the equality reaches a Parquet scan.

    A table without the column has no products to tell apart and stays whole.
    """
    if not product_id:
        raise ValueError("product_id must not be empty")
    if "product_id" not in df.columns:
        return df
    return df.where(F.col("product_id") == product_id)


def series_key(series_cols: Sequence[str]) -> Column:
    """Text key of a series; NULL when a single key column is NULL."""
    if not series_cols:
        return F.lit(ALL_PRODUCTS)
    if len(series_cols) == 1:
        return F.col(series_cols[0]).cast("string")
    return F.concat_ws("|", *[escaped_text(F.col(c)) for c in series_cols])


def daily_sales(df: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    """One row per series and date with summed quantity and revenue.

    Partial sums run before the shuffle, so a busy day or product costs no more
    than any other. Rows without a date are left out; the sum of nothing is 0.
    Sums are the same to the last bit however the rows are dealt out.
    """
    keyed = df.where(F.col("date").isNotNull()).select(
        series_key(series_cols).alias("series_id"),
        F.to_date("date").alias("date"),
        F.col("sales_quantity").cast("double"),
        F.col("revenue").cast("double"),
    )
    return keyed.groupBy("series_id", "date").agg(
        F.coalesce(exact_sum(F.col("sales_quantity")), F.lit(0.0)).alias("sales_quantity"),
        F.coalesce(exact_sum(F.col("revenue")), F.lit(0.0)).alias("revenue"),
    )


def add_time_features(df: DataFrame, date: str = "date") -> DataFrame:
    """Add the nine calendar columns."""
    return df.withColumns(calendar_columns(F.to_date(date)))


def to_training_format(
    df: DataFrame, date: str = "date", target: str = "sales_quantity"
) -> DataFrame:
    """Add ``ds`` and ``y``; everything else is kept."""
    return df.withColumns({"ds": F.to_date(date), "y": F.col(target)})
