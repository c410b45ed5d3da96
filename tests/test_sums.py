import datetime as dt
import math
import random

from pyspark.sql import functions as F

from salescast.functions import exact_sum
from salescast.operators.daily import daily_sales
from salescast.operators.profile import profile
from salescast.plans.stages import extract_data


def total(spark, values, parts=1):
    rows = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
    return rows.agg(exact_sum(F.col("v"))).first()[0]


def spread_values(n=4000, seed=3):
    rng = random.Random(seed)
    return [rng.choice((-1, 1)) * rng.uniform(1, 10) * 10.0 ** rng.randint(-9, 15) for _ in range(n)]


def test_bit_equal_for_every_order_and_number_of_partitions(spark):
    values = spread_values()
    expected = total(spark, values)
    shuffled = random.Random(5).sample(values, len(values))
    assert {total(spark, shuffled, parts) for parts in (1, 7, 64)} == {expected}
    assert abs(expected - math.fsum(values)) <= 2 * math.ulp(math.fsum(values))


def test_small_values_beside_large_ones_that_cancel(spark):
    values = [1e15, 1e-9, -1e15, 2e-9, 0.1, -0.1]
    assert total(spark, values, 3) == math.fsum(values)
    assert total(spark, [0.1] * 10) == 1.0  # a running sum gives 0.9999999999999999
    assert total(spark, [2.0**53, 1.0, 1.0]) == 2.0**53 + 2


def test_missing_and_odd_values(spark):
    assert total(spark, []) is None and total(spark, [None, None]) is None
    assert total(spark, [None, 2.5]) == 2.5
    assert total(spark, [math.inf, 1.0]) == math.inf
    assert math.isnan(total(spark, [math.nan, 1.0])) and math.isnan(total(spark, [math.inf, -math.inf]))
    assert total(spark, [1e300]) == 1e300 and total(spark, [1e300, 3.0]) == 1e300
    assert total(spark, [-0.5, 0.25]) == -0.25 and total(spark, [5e-324]) == 0.0


def test_whole_numbers_and_groups(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id"))
    sums = {r["k"]: r["s"] for r in rows.groupBy("k").agg(exact_sum(F.col("id")).alias("s")).collect()}
    assert sums == {k: float(sum(range(k, 1000, 3))) for k in range(3)}


def test_daily_totals_and_profile_do_not_depend_on_the_order(spark, tmp_path):
    day, values = dt.date(2024, 1, 1), spread_values(600)
    rows = [(day + dt.timedelta(days=i % 3), f"p{i % 5}", i, v) for i, v in enumerate(values)]
    schema = "date date, product_id string, sales_quantity bigint, revenue double"

    def found(data, parts):
        sales = spark.createDataFrame(data, schema).repartition(parts)
        daily = {(r["series_id"], r["date"]): (r["sales_quantity"], r["revenue"]) for r in daily_sales(sales, ["product_id"]).collect()}
        return daily, profile(sales).first()

    assert found(rows, 1) == found(rows[::-1], 33) == found(random.Random(1).sample(rows, len(rows)), 8)
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    first = extract_data(spark, str(tmp_path / "in"))[1].first()
    assert first["total_revenue"] == found(rows, 1)[1]["total_revenue"]
