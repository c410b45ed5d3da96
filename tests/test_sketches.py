"""Quantile sketches: true ranks, merging by day, missing values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from salescast.operators import cleaning, sketches
from salescast.operators.sketches import day_sketches, rank_error, sketch_quantiles

START = dt.date(2024, 1, 2)


@pytest.fixture(scope="module")
def rows(spark):
    """Skewed and repeated values; a third of the rows on one day, some without a date."""
    day = "CASE WHEN id % 3 = 0 THEN date'2024-02-01' WHEN id % 50 = 1 THEN NULL ELSE date_add(date'2024-01-01', cast(id % 90 AS int)) END"
    x = "CASE WHEN id % 11 = 0 THEN NULL WHEN id % 13 = 0 THEN double('NaN') WHEN id % 5 = 0 THEN 7.0D ELSE exp(pmod(hash(id), 1000) / 50D) END"
    return spark.range(60_000).selectExpr(f"{day} AS date", f"{x} AS x", "cast(null AS double) AS nothing").cache()


def off(df, column, p, q):
    """How far the true rank of ``q`` is from ``p``."""
    x = F.when(~F.isnan(column), F.col(column))
    n, below, upto = df.agg(F.count(x), F.count_if(x < q), F.count_if(x <= q)).first()
    return max(below / n - p, p - upto / n, 0.0)


@pytest.mark.parametrize("accuracy", [100, 400, 3000])
def test_ranks_keep_to_the_stated_error(rows, accuracy):
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    found = sketches.approximate_quantiles(rows, ["x"], probabilities, accuracy)["x"]
    assert max(off(rows, "x", p, q) for p, q in zip(probabilities, found.q)) <= rank_error(accuracy)
    exact = rows.where("x IS NOT NULL AND NOT isnan(x)").agg(F.count("*"), F.min("x"), F.max("x")).first()
    assert (found.n, found.low, found.high) == tuple(exact)


def test_sketches_of_days_merge_over_any_range(rows):
    days = day_sketches(rows, ["x", "nothing"])
    assert days.count() == rows.where("x IS NOT NULL AND NOT isnan(x)").select("date").distinct().count()
    for start, end in ((None, None), (START, START), (dt.date(2024, 1, 20), dt.date(2024, 2, 10)), (dt.date(2024, 2, 1), None)):
        chosen = rows
        chosen = chosen if start is None else chosen.where(F.col("date") >= F.lit(start))
        chosen = chosen if end is None else chosen.where(F.col("date") <= F.lit(end))
        found = sketch_quantiles(days, ["x", "nothing"], [0.25, 0.75], start, end)
        assert max(off(chosen, "x", p, q) for p, q in zip((0.25, 0.75), found["x"].q)) <= rank_error(sketches.ACCURACY)
        assert found["nothing"].q == (None, None)
    assert sketch_quantiles(days, ["x"], [0.5], dt.date(1999, 1, 1), dt.date(1999, 1, 2))["x"].q == (None,)


def test_quantiles_of_a_range_read_the_sketches_only(rows, spark, tmp_path):
    day_sketches(rows, ["x"]).write.parquet(str(tmp_path / "days"))
    days = spark.read.parquet(str(tmp_path / "days"))
    assert days.count() < 100 and days.agg(F.max(F.length("sketch"))).first()[0] < 100_000
    whole = sketches.approximate_quantiles(rows, ["x"], [0.5])["x"].q[0]
    merged = sketch_quantiles(days, ["x"], [0.5])["x"].q[0]
    assert off(rows, "x", 0.5, merged) <= rank_error(sketches.ACCURACY) and off(rows, "x", 0.5, whole) <= rank_error(sketches.ACCURACY)


def test_statistics_capping_and_medians_take_an_accuracy(rows):
    plain = cleaning.iqr_stats(rows, "x").first()
    near = cleaning.iqr_stats(rows, "x", accuracy=4000).first()
    assert near["q3"] == pytest.approx(plain["q3"], rel=0.1) and near["outlier_count"] == pytest.approx(plain["outlier_count"], rel=0.1)
    capped = cleaning.winsorize(rows, "x", accuracy=4000).agg(F.max("x")).first()[0]
    assert capped == pytest.approx(plain["upper_bound"], rel=0.2)
    assert off(rows, "x", 0.5, cleaning.medians(rows, ["x"], accuracy=4000)["x"]) <= rank_error(4000)
    assert cleaning.impute_median(rows.select("x"), ["x"], accuracy=4000).where("x IS NULL").count() == 0


def test_empty_tables(spark):
    df = spark.createDataFrame([], "date date, x double")
    assert day_sketches(df, ["x"]).count() == 0
    assert sketches.approximate_quantiles(df, ["x"], [0.5])["x"].q == (None,)
    assert cleaning.iqr_stats(df, "x", accuracy=100).first()["q1"] is None
