"""The driver's tables seen as sales tables, in Spark and as SQL text.

Every view covers its whole table. The masked view hides some values, the same
ones on both sides, because the tables themselves have no gaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by part."""
    return table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("date"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("sales_quantity"),
        F.col("l_extendedprice").alias("revenue"),
    )


SALES = """
sales AS (
  SELECT CAST(l_shipdate AS DATE) AS date,
         CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(trunc(l_quantity) AS BIGINT) AS sales_quantity,
         l_extendedprice AS revenue
  FROM lineitem
)"""


def brand_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by the brand of their part."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(part, lines.l_partkey == part.p_partkey).select(
        F.to_date("l_shipdate").alias("date"),
        F.col("p_brand").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("sales_quantity"),
        F.col("l_extendedprice").alias("revenue"),
    )


BRAND_SALES = """
brand_sales AS (
  SELECT CAST(l_shipdate AS DATE) AS date,
         p_brand AS product_id,
         CAST(trunc(l_quantity) AS BIGINT) AS sales_quantity,
         l_extendedprice AS revenue
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""


def exact_brand_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`brand_sales` with revenue as decimal, whose text both engines share."""
    rows = brand_sales(spark, sf_dir)
    return rows.withColumn("revenue", F.col("revenue").cast("decimal(18,2)"))


EXACT_BRAND_SALES = f"""{BRAND_SALES},
exact_brand_sales AS (
  SELECT date, product_id, sales_quantity, CAST(revenue AS DECIMAL(18,2)) AS revenue
  FROM brand_sales
)"""


def masked_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with an extra column and with values hidden in every column."""
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_tax") != 0.08, F.to_date("l_shipdate")).alias("date"),
        F.when(F.col("l_linenumber") != 5, F.col("l_partkey").cast("string")).alias("product_id"),
        F.nullif(F.col("l_quantity").cast("bigint"), F.lit(50)).alias("sales_quantity"),
        F.when(F.col("l_discount") != 0.1, F.col("l_extendedprice")).alias("revenue"),
        F.nullif("l_returnflag", F.lit("R")).alias("note"),
    )


MASKED_SALES = """
masked_sales AS (
  SELECT CASE WHEN l_tax <> 0.08 THEN CAST(l_shipdate AS DATE) END AS date,
         CASE WHEN l_linenumber <> 5 THEN CAST(l_partkey AS VARCHAR) END AS product_id,
         nullif(CAST(trunc(l_quantity) AS BIGINT), 50) AS sales_quantity,
         CASE WHEN l_discount <> 0.1 THEN l_extendedprice END AS revenue,
         nullif(l_returnflag, 'R') AS note
  FROM lineitem
)"""


def account_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the customer's balance as quantity, which may be negative."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    orders = table(spark, sf_dir, "orders")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.to_date("o_orderdate").alias("date"),
        F.col("o_custkey").cast("string").alias("product_id"),
        F.col("c_acctbal").cast("bigint").alias("sales_quantity"),
        F.col("o_totalprice").alias("revenue"),
    )


ACCOUNT_SALES = """
account_sales AS (
  SELECT CAST(o_orderdate AS DATE) AS date,
         CAST(o_custkey AS VARCHAR) AS product_id,
         CAST(trunc(c_acctbal) AS BIGINT) AS sales_quantity,
         o_totalprice AS revenue
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""


def event_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by type: a value column with a long tail."""
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("date"),
        F.col("event_type").alias("product_id"),
        F.col("value").cast("bigint").alias("sales_quantity"),
        F.col("value").alias("revenue"),
        "event_id",
    )


EVENT_SALES = """
event_sales AS (
  SELECT CAST(ts AS DATE) AS date,
         event_type AS product_id,
         CAST(trunc(value) AS BIGINT) AS sales_quantity,
         value AS revenue,
         event_id
  FROM events
)"""
