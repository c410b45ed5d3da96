"""Quality metrics, NULL rates, date gaps."""

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.views import (
    ACCOUNT_SALES,
    MASKED_SALES,
    SALES,
    account_sales,
    masked_sales,
    sales,
    table,
)
from salescast.operators import quality as op
from salescast.sources.sales import split_records, typed_records, typed_sales
from salescast.sources.tables import discard, new_folder


def _checks_sql(view: str, text: str, columns: list[str], allow_negative: bool) -> str:
    nulls = " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in columns)
    negative_ok = "true" if allow_negative else "negatives = 0"
    return f"""
WITH {text},
days AS (SELECT DISTINCT date FROM {view} WHERE date IS NOT NULL),
gaps AS (SELECT date - lag(date) OVER (ORDER BY date) AS gap,
                lag(date) OVER (ORDER BY date) AS gap_start, date AS gap_end FROM days),
widest AS (SELECT * FROM gaps WHERE gap IS NOT NULL ORDER BY gap DESC, gap_end LIMIT 1),
m AS (SELECT count(*) AS n, ({nulls}) / (count(*) * {len(columns)}) AS rate,
             count(*) FILTER (sales_quantity < 0) AS negatives FROM {view})
SELECT 0 AS position, 'minimum_records' AS check_name, CAST(n AS DOUBLE) AS value,
       CAST(90 AS DOUBLE) AS threshold, true AS performed, n >= 90 AS passed,
       CAST(NULL AS DATE) AS gap_start, CAST(NULL AS DATE) AS gap_end FROM m
UNION ALL
SELECT 1, 'null_rate', rate, 0.05, true, rate <= 0.05, NULL, NULL FROM m
UNION ALL
SELECT 2, 'no_negative_sales', negatives, 0, true, {negative_ok}, NULL, NULL FROM m
UNION ALL
SELECT 3, 'date_continuity', gap, 7, true, gap <= 7, gap_start, gap_end FROM widest
"""


@query(_checks_sql("sales", SALES, ["date", "product_id", "sales_quantity", "revenue"], False))
def quality_metrics(spark, sf_dir):
    return op.quality_metrics(sales(spark, sf_dir))


@query(
    _checks_sql(
        "masked_sales",
        MASKED_SALES,
        ["date", "product_id", "sales_quantity", "revenue", "note"],
        False,
    )
)
def quality_metrics_with_nulls(spark, sf_dir):
    return op.quality_metrics(masked_sales(spark, sf_dir))


@query(
    _checks_sql(
        "account_sales", ACCOUNT_SALES, ["date", "product_id", "sales_quantity", "revenue"], True
    )
)
def quality_metrics_negatives_allowed(spark, sf_dir):
    cfg = {"data_quality": {"allow_negative_sales": True}}
    return op.quality_metrics(account_sales(spark, sf_dir), cfg)


@query(
    f"""
WITH {ACCOUNT_SALES}
SELECT count(*) FILTER (sales_quantity < 0) AS negative_sales_count FROM account_sales
"""
)
def negative_sales(spark, sf_dir):
    return op.quality_summary(account_sales(spark, sf_dir)).select("negative_sales_count")


@query(
    f"WITH {MASKED_SALES}, n AS (SELECT count(*) AS rows FROM masked_sales)"
    + " UNION ALL ".join(
        f"""
SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count,
       count(*) FILTER ({c} IS NULL) / count(*) AS null_rate FROM masked_sales"""
        for c in ["date", "product_id", "sales_quantity", "revenue", "note"]
    )
)
def null_rates(spark, sf_dir):
    return op.null_rates(masked_sales(spark, sf_dir))


@query(
    f"""
WITH {MASKED_SALES},
days AS (SELECT DISTINCT date FROM masked_sales),
gaps AS (SELECT date - lag(date) OVER (ORDER BY date) AS gap,
                lag(date) OVER (ORDER BY date) AS gap_start, date AS gap_end
         FROM days WHERE date IS NOT NULL),
widest AS (SELECT * FROM gaps WHERE gap IS NOT NULL ORDER BY gap DESC, gap_end LIMIT 1)
SELECT CAST(gap AS INTEGER) AS max_date_gap_days, gap_start, gap_end,
       (SELECT count(*) FROM days) AS num_unique_dates
FROM widest
"""
)
def date_gaps(spark, sf_dir):
    return op.date_gaps(masked_sales(spark, sf_dir))


@query(
    f"""
WITH {SALES},
days AS (SELECT DISTINCT product_id, date FROM sales),
gaps AS (SELECT product_id, date - lag(date) OVER w AS gap, lag(date) OVER w AS gap_start,
                date AS gap_end
         FROM days WINDOW w AS (PARTITION BY product_id ORDER BY date)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY product_id
                                        ORDER BY gap DESC NULLS LAST, gap_end) AS place,
                  count(*) OVER (PARTITION BY product_id) AS num_unique_dates
           FROM gaps)
SELECT product_id, CAST(gap AS INTEGER) AS max_date_gap_days, gap_start,
       CASE WHEN gap IS NOT NULL THEN gap_end END AS gap_end, num_unique_dates
FROM ranked WHERE place = 1
"""
)
def date_gaps_by_product(spark, sf_dir):
    return op.date_gaps(sales(spark, sf_dir), series_cols=["product_id"])


@query(
    f"""
WITH {ACCOUNT_SALES}, {MASKED_SALES},
a AS (SELECT count(*) FILTER (sales_quantity < 0) AS n FROM account_sales),
m AS (SELECT (count(*) FILTER (date IS NULL) + count(*) FILTER (product_id IS NULL)
              + count(*) FILTER (sales_quantity IS NULL) + count(*) FILTER (revenue IS NULL)
              + count(*) FILTER (note IS NULL)) / (count(*) * 5) AS rate FROM masked_sales)
SELECT 'account_sales' AS sales, 'no_negative_sales' AS check_name,
       'Found ' || n || ' negative sales values.' AS message FROM a
UNION ALL
SELECT 'masked_sales', 'null_rate', printf('Null rate %.2f%% exceeds threshold 5.00%%.', rate * 100) FROM m
"""
)
def quality_gate_message(spark, sf_dir):
    """What the gate would raise, as rows."""
    views = {"account_sales": account_sales, "masked_sales": masked_sales}
    rows = [
        op.first_failed(op.quality_metrics(view(spark, sf_dir))).select(F.lit(name).alias("sales"), "*")
        for name, view in views.items()
    ]
    return rows[0].union(rows[1])


@query(_checks_sql("sales", SALES, ["date", "product_id", "sales_quantity", "revenue"], False))
def quality_metrics_timestamps(spark, sf_dir):
    """The same checks where dates carry a time of day."""
    late = F.expr("timestampadd(HOUR, 5 + sales_quantity % 9, cast(date AS timestamp))")
    return op.quality_metrics(sales(spark, sf_dir).withColumn("date", late))


_CELLS = """
SELECT CAST(l_orderkey AS {text}) AS l_orderkey, CAST(l_linenumber AS {text}) AS l_linenumber,
       CASE CAST(l_linenumber AS INT) WHEN 3 THEN 'NA' WHEN 4 THEN 'someday' ELSE CAST(CAST(l_shipdate AS DATE) AS {text}) END AS date,
       CASE WHEN l_linenumber = 5 THEN 'null' ELSE CAST(l_partkey AS {text}) END AS product_id,
       CASE l_returnflag WHEN 'R' THEN 'n/a' WHEN 'A' THEN CAST(CAST(l_quantity AS BIGINT) AS {text})
            ELSE 'x' || CAST(CAST(l_quantity AS BIGINT) AS {text}) END AS sales_quantity,
       CASE WHEN l_linenumber = 2 THEN '' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS {text}) END AS revenue
FROM {table}"""


@query(
    f"""
WITH cells AS ({_CELLS.format(text="VARCHAR", table="lineitem")})
SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, TRY_CAST(date AS DATE) AS date, nullif(product_id, 'null') AS product_id,
       TRY_CAST(sales_quantity AS DOUBLE) AS sales_quantity, TRY_CAST(revenue AS DOUBLE) AS revenue
FROM cells
"""
)
def typed_cells(spark, sf_dir):
    """All line items as text with missing and bad cells, typed as a lenient scan does."""
    text = _CELLS.format(text="STRING", table="{lines}")
    raw = spark.sql(text, lines=table(spark, sf_dir, "lineitem"))
    typed = typed_sales(raw, strict=False)
    return typed.withColumns({c: F.col(c).cast("bigint") for c in ("l_orderkey", "l_linenumber")})


_LINES = """
SELECT concat_ws(',', CAST(CAST(l_shipdate AS DATE) AS STRING), concat('"', l_partkey, ', ""', l_linestatus, repeat('"', 3)),
                 CASE WHEN l_linenumber <> 3 THEN CAST(CAST(l_quantity AS BIGINT) AS STRING) END,
                 CASE WHEN l_linenumber < 6 THEN '1.5' END, CASE WHEN l_linenumber = 2 THEN '"surplus, quoted"' END) AS line
FROM {lines}"""


@query(
    """
WITH cells AS (
  SELECT CAST(l_quantity AS BIGINT) AS quantity,
         4 - CAST(l_linenumber = 3 AS INT) - CAST(l_linenumber >= 6 AS INT) + CAST(l_linenumber = 2 AS INT) AS n
  FROM lineitem
)
SELECT CASE WHEN n = 4 THEN 'accepted' WHEN n > 4 THEN 'too many cells: 5 of 4' ELSE 'too few cells: 3 of 4' END AS outcome,
       count(*) AS records, CAST(sum(CASE WHEN n = 4 THEN quantity END) AS DOUBLE) AS quantity
FROM cells GROUP BY outcome
"""
)
def rejected_records(spark, sf_dir):
    """All line items as a text table in which some records have too many or too few cells."""
    path = new_folder(spark) + ".csv"
    lines = spark.sql(_LINES, lines=table(spark, sf_dir, "lineitem"))
    header = "date,product_id,sales_quantity,revenue"
    # one column with its own separators in it: what is written are the lines themselves
    plain = {"header": True, "sep": "\u0001", "quote": "\u0000", "escapeQuotes": False}
    lines.withColumnRenamed("line", header).write.options(**plain).csv(path)
    try:
        accepted, rejected = split_records(typed_records(spark, path, multiline=False))
        quantity = F.sum("sales_quantity").alias("quantity")
        kept = accepted.agg(F.lit("accepted").alias("outcome"), F.count("*").alias("records"), quantity)
        none = F.lit(None).cast("double").alias("quantity")
        found = kept.union(rejected.groupBy("reason").agg(F.count("*"), none))
        return spark.createDataFrame(found.collect(), found.schema)
    finally:
        discard(spark, path)
