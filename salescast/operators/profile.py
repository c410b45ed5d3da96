"""Table profile and content fingerprint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.functions import date_text, exact_sum, md5_prefix, round_half_even, row_digest


def product_list(df: DataFrame) -> DataFrame:
    """Every distinct product id, one per row; NULL is not a product."""
    return df.select("product_id").where(F.col("product_id").isNotNull()).distinct()


def _total(df: DataFrame, name: str) -> Column:
    """Sum of a column; whole numbers and decimals are exact as they are."""
    floating = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return exact_sum(F.col(name)) if floating else F.sum(name)


def profile(df: DataFrame) -> DataFrame:
    """One row of table statistics.

    ``avg_daily_sales`` is the mean per row, not per day. Products are counted
    here; :func:`product_list` has them, as rows. Sums of doubles do not depend on
    the order of the rows.
    """
    quantity, revenue, date = F.col("sales_quantity"), F.col("revenue"), F.col("date")
    # one row per product first: a product with a third of all rows is combined
    # before the shuffle, and the distinct count needs no second pass
    per_product = df.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(date).alias("first"),
        F.max(date).alias("last"),
        _total(df, "sales_quantity").alias("quantity"),
        F.count(quantity).alias("quantities"),
        _total(df, "revenue").alias("revenue"),
        F.count(revenue).alias("revenues"),
    )
    quantity, revenue = _total(per_product, "quantity"), _total(per_product, "revenue")
    return per_product.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("num_records"),
        F.count("product_id").alias("num_products"),
        date_text(F.min("first")).alias("start_date"),
        date_text(F.max("last")).alias("end_date"),
        (F.datediff(F.max("last"), F.min("first")) + 1).alias("num_days"),
        F.coalesce(quantity, F.lit(0)).cast("bigint").alias("total_sales"),
        round_half_even(F.coalesce(revenue, F.lit(0.0))).alias("total_revenue"),
        round_half_even(F.try_divide(quantity, F.sum("quantities"))).alias(
            "avg_daily_sales"
        ),
        round_half_even(F.try_divide(revenue, F.sum("revenues"))).alias("avg_revenue"),
    )


def content_hash(df: DataFrame, by: Sequence[str] = (), length: int = 8) -> DataFrame:
    """One row, ``data_hash``: ``length`` hex digits that change when the content does.

    Row digests are added up, so neither row order nor partitioning matters and
    the work is one pass with a partial sum per task. Column order does matter.
    With ``by`` there is one row for each group, NULL being a group too.
    """
    number = F.conv(F.substring(row_digest(df), 1, 15), 16, 10).cast("decimal(28,0)")
    sums = df.select(*by, number.alias("number")).groupBy(*by).agg(
        F.coalesce(F.sum("number"), F.lit(0).cast("decimal(38,0)")).alias("digest_sum"),
        F.count(F.lit(1)).alias("rows"),
    )
    text = F.concat_ws(":", F.col("digest_sum").cast("string"), F.col("rows").cast("string"))
    return sums.select(*by, md5_prefix(text, length).alias("data_hash"))


def date_range(df: DataFrame, date: str = "ds") -> DataFrame:
    """One row: first and last date as ``yyyy-MM-dd`` text."""
    return df.agg(
        date_text(F.min(date)).alias("start_date"), date_text(F.max(date)).alias("end_date")
    )
