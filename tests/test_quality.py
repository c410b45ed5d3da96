import datetime as dt

import pytest
from pyspark.sql import functions as F

from salescast.operators import quality

SCHEMA = "date date, product_id string, sales_quantity double, revenue double"
CFG = {"data_quality": {"min_records": 10}}
START = dt.date(2024, 1, 1)


def frame(spark, quantities, dates=None, revenues=None, schema=SCHEMA):
    n = len(quantities)
    dates = dates or [START + dt.timedelta(days=i) for i in range(n)]
    revenues = revenues or [500.0 + i for i in range(n)]
    rows = [(d, "PROD_001", q, r) for d, q, r in zip(dates, quantities, revenues)]
    return spark.createDataFrame(rows, schema)


def plain(n=100):
    return [float(50 + i) for i in range(n)]


def with_values(n, changes):
    values = plain(n)
    for i, v in changes.items():
        values[i] = v
    return values


def checks(df, cfg=CFG):
    return {r["check_name"]: r for r in quality.quality_metrics(df, cfg).collect()}


def test_clean_table_passes_every_check(spark):
    df = frame(spark, plain())
    assert quality.quality_gate(df, CFG) is df
    assert all(c["passed"] for c in checks(df).values())


def test_few_nulls_pass(spark):
    df = frame(spark, with_values(100, {3: None, 60: None}))
    assert checks(df)["null_rate"]["value"] == pytest.approx(2 / 400)
    quality.quality_gate(df, CFG)


def test_null_rate_at_the_limit_passes_and_above_fails(spark):
    quantities = with_values(100, {i: None for i in range(10)})
    revenues = [None if i < 10 else 1.0 for i in range(100)]
    at_limit = frame(spark, quantities, revenues=revenues)
    assert checks(at_limit)["null_rate"]["passed"]
    above = frame(spark, with_values(100, {i: None for i in range(11)}), revenues=revenues)
    with pytest.raises(ValueError, match=r"Null rate 5.25% exceeds threshold 5.00%"):
        quality.quality_gate(above, CFG)


def test_extra_column_counts_towards_the_null_rate(spark):
    df = frame(spark, plain()).withColumn("note", F.lit(None).cast("string"))
    rates = {r["column_name"]: r["null_rate"] for r in quality.null_rates(df).collect()}
    assert rates == {
        "date": 0.0, "product_id": 0.0, "sales_quantity": 0.0, "revenue": 0.0, "note": 1.0,
    }
    assert checks(df)["null_rate"]["value"] == pytest.approx(0.2)


def test_empty_table_fails_on_records_only(spark):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="Insufficient records: 0 < 10"):
        quality.quality_gate(df, CFG)
    found = checks(df)
    assert found["null_rate"]["value"] == 0.0
    assert found["date_continuity"]["passed"] is None


def test_too_few_records_names_both_numbers(spark):
    df = frame(spark, plain(50))
    with pytest.raises(ValueError, match="Insufficient records: 50 < 90"):
        quality.quality_gate(df)
    quality.quality_gate(frame(spark, plain(100)))


def test_negative_values(spark):
    df = frame(spark, with_values(100, {0: -10.0, 5: -25.0}))
    with pytest.raises(ValueError, match="Found 2 negative sales values"):
        quality.quality_gate(df, CFG)
    allowed = {"data_quality": {"min_records": 10, "allow_negative_sales": True}}
    one = frame(spark, with_values(100, {0: -10.0}))
    assert checks(one, allowed)["no_negative_sales"]["value"] == 1
    quality.quality_gate(one, allowed)


def test_zero_is_not_negative(spark):
    quality.quality_gate(frame(spark, with_values(100, {0: 0.0, 5: 0.0})), CFG)


def test_missing_quantity_is_performed_but_not_judged(spark):
    found = checks(frame(spark, plain()).drop("sales_quantity"))
    assert found["no_negative_sales"]["performed"] is True
    assert found["no_negative_sales"]["passed"] is None


def test_missing_date_is_performed_but_not_judged(spark):
    found = checks(frame(spark, plain()).drop("date"))
    assert found["date_continuity"]["performed"] and found["date_continuity"]["passed"] is None
    assert found["minimum_records"]["value"] == 100


def gap_dates(days):
    first = [START + dt.timedelta(days=i) for i in range(50)]
    return first + [first[-1] + dt.timedelta(days=days + i) for i in range(50)]


def test_daily_rows_have_a_gap_of_one(spark):
    assert checks(frame(spark, plain()))["date_continuity"]["value"] == 1


def test_gap_of_five_passes(spark):
    quality.quality_gate(frame(spark, plain(), gap_dates(5)), CFG)


def test_gap_of_eleven_fails_and_names_both_ends(spark):
    with pytest.raises(ValueError, match="Date gap of 11 days.*2024-02-19 and 2024-03-01"):
        quality.quality_gate(frame(spark, plain(), gap_dates(11)), CFG)


def test_earliest_of_equal_gaps_is_reported(spark):
    dates = [START + dt.timedelta(days=10 * i) for i in range(4)]
    row = quality.date_gaps(frame(spark, plain(4), dates)).first()
    assert (row["max_date_gap_days"], row["gap_start"]) == (10, START)


def test_several_products_per_day_and_null_dates(spark):
    dates = [START, START, START + dt.timedelta(days=3), None, None]
    df = frame(spark, plain(5), dates)
    row = quality.quality_summary(df).first()
    assert row["max_date_gap_days"] == 3
    assert row["num_unique_dates"] == 3
    assert row["null_counts"]["date"] == 2
    alone = quality.date_gaps(df).first()
    assert (alone["max_date_gap_days"], alone["num_unique_dates"]) == (3, 3)


def test_first_failure_wins(spark):
    df = frame(spark, with_values(100, {0: -1.0}), gap_dates(30))
    with pytest.raises(ValueError, match="negative"):
        quality.quality_gate(df, CFG)
