"""Profile, product list, fingerprint."""

from catalog.registry import query
from catalog.views import (
    BRAND_SALES,
    EXACT_BRAND_SALES,
    SALES,
    brand_sales,
    exact_brand_sales,
    sales,
)
from salescast.operators import profile as op


@query(
    f"""
WITH {BRAND_SALES}
SELECT count(*) AS num_records,
       count(DISTINCT product_id) AS num_products,
       strftime(min(date), '%Y-%m-%d') AS start_date,
       strftime(max(date), '%Y-%m-%d') AS end_date,
       CAST(max(date) - min(date) + 1 AS INTEGER) AS num_days,
       CAST(sum(sales_quantity) AS BIGINT) AS total_sales,
       round_even(sum(revenue), 2) AS total_revenue,
       round_even(avg(sales_quantity), 2) AS avg_daily_sales,
       round_even(sum(revenue) / count(revenue), 2) AS avg_revenue
FROM brand_sales
"""
)
def sales_profile(spark, sf_dir):
    return op.profile(brand_sales(spark, sf_dir))


@query(f"WITH {SALES} SELECT DISTINCT product_id FROM sales WHERE product_id IS NOT NULL")
def product_list(spark, sf_dir):
    return op.product_list(sales(spark, sf_dir))


@query(
    f"""
WITH {EXACT_BRAND_SALES},
digests AS (
  SELECT CAST('0x' || substr(md5(concat_ws('|',
           coalesce(CAST(date AS VARCHAR), '\\N'),
           coalesce(replace(replace(product_id, '\\', '\\\\'), '|', '\\|'), '\\N'),
           coalesce(CAST(sales_quantity AS VARCHAR), '\\N'),
           coalesce(CAST(revenue AS VARCHAR), '\\N'))), 1, 15) AS BIGINT) AS number
  FROM exact_brand_sales
)
SELECT substr(md5(CAST(coalesce(sum(number), 0) AS VARCHAR) || ':' || CAST(count(*) AS VARCHAR)),
              1, 8) AS data_hash
FROM digests
"""
)
def content_hash(spark, sf_dir):
    return op.content_hash(exact_brand_sales(spark, sf_dir))


@query(
    f"""
WITH {SALES}
SELECT strftime(min(date), '%Y-%m-%d') AS start_date,
       strftime(max(date), '%Y-%m-%d') AS end_date
FROM sales
"""
)
def date_range(spark, sf_dir):
    return op.date_range(sales(spark, sf_dir), "date")
