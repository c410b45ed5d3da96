import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salescast.operators import cleaning, quantiles
from salescast.operators.quantiles import exact_quantiles

SCHEMA = "date date, product_id string, sales_quantity double, revenue double"
START = dt.date(2024, 1, 1)


def values(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "value double")


def sales(spark, quantities, revenues=None, dates=None):
    n = len(quantities)
    revenues = revenues or [900.0 + i for i in range(n)]
    dates = dates or [START + dt.timedelta(days=i) for i in range(n)]
    return spark.createDataFrame(
        [(d, "P", q, r) for d, q, r in zip(dates, quantities, revenues)], SCHEMA
    )


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.one_of(
            st.none(),
            st.integers(-5, 5).map(float),
            st.floats(-1e300, 1e300),
            st.floats(1000.0, 1000.001),
            st.just(5e-324),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_quantiles_equal_numpy(spark, xs):
    check_quantiles(spark, xs)


@pytest.mark.parametrize(
    "xs",
    [
        [1e9 + i / 1000 for i in range(500)],
        [-1.7e308, 1.7e308, 1.0, -1.0, 0.0, float("inf"), float("-inf")],
        [5e-324 * i for i in range(50)],
        [1.0 + 2.0**-k for k in range(53)],
        [0.0, -0.0, 1.0, -1.0],
    ],
)
def test_quantiles_when_bins_are_refined_again_and_again(spark, monkeypatch, xs):
    monkeypatch.setattr(quantiles, "SUB_BINS", 4)
    check_quantiles(spark, xs)


def check_quantiles(spark, xs):
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = exact_quantiles(values(spark, xs), ["value"], probabilities)["value"]
    known = [x for x in xs if x is not None]
    assert got.n == len(known)
    if known:
        known.sort()
        for p, q in zip(probabilities, got.q):
            position = p * (len(known) - 1)
            left, right = known[int(position)], known[math.ceil(position)]
            expected = left if left == right else left + (right - left) * (position % 1)
            assert q == expected or math.isclose(q, expected) or (q != q and expected != expected)
        assert (got.low, got.high) == (min(known), max(known))


def test_quantiles_with_one_value_in_a_third_of_the_rows(spark):
    rng = random.Random(1)
    xs = [7.25] * 1000 + [rng.uniform(7.2, 7.3) for _ in range(2000)]
    rng.shuffle(xs)
    got = exact_quantiles(values(spark, xs).repartition(7), ["value"], [0.25, 0.5, 0.75])["value"]
    np.testing.assert_allclose(got.q, np.quantile(xs, [0.25, 0.5, 0.75]), rtol=1e-14)


def test_extremes_are_flagged(spark):
    rng = np.random.default_rng(3)
    xs = [float(x) for x in rng.normal(100, 10, 100)] + [200.0, 250.0, 0.0, -50.0]
    flagged = cleaning.flag_outliers(values(spark, xs), "value")
    out = {r["value"] for r in flagged.where("is_outlier").collect()}
    assert {200.0, 250.0, 0.0, -50.0} <= out
    row = cleaning.iqr_stats(values(spark, xs), "value").first()
    assert row["outlier_count"] == len(out)
    assert row["q1"] == pytest.approx(np.quantile(xs, 0.25), abs=0.005)


def test_wide_multiplier_flags_little(spark):
    rng = np.random.default_rng(4)
    xs = [float(x) for x in rng.normal(100, 5, 100)]
    assert cleaning.iqr_stats(values(spark, xs), "value", 3.0).first()["outlier_count"] <= 5


def test_rate_counts_null_rows(spark):
    row = cleaning.iqr_stats(values(spark, [1.0, 1.0, 1.0, 1.0, 9.0] + [None] * 5), "value").first()
    assert (row["outlier_count"], row["outlier_rate"]) == (1, 0.1)


def test_no_spread_caps_everything_else(spark):
    capped = cleaning.winsorize(values(spark, [5.0] * 10 + [6.0, 4.0]), "value")
    assert {r["value"] for r in capped.collect()} == {5.0}


def test_bounds_are_compared_rounded_but_flagged_unrounded(spark):
    # quartiles 1.0 and 1.003: the upper bound 1.0075 rounds up to 1.01
    xs = [1.0] * 4 + [1.003] * 4 + [1.009]
    df = values(spark, xs)
    assert cleaning.iqr_stats(df, "value").first()["outlier_count"] == 1
    assert max(r["value"] for r in cleaning.winsorize(df, "value").collect()) == 1.009


def test_low_values_are_lifted_to_zero_at_most(spark):
    xs = [float(x) for x in range(-3, 8)] + [-500.0]
    capped = [r["value"] for r in cleaning.winsorize(values(spark, xs), "value").collect()]
    assert -500.0 not in capped and capped.count(0.0) == 2 and -3.0 in capped


def test_all_negative_values_meet_the_upper_bound_after_the_lower(spark):
    xs = [-10.0, -11.0, -12.0, -13.0, -500.0]
    df = values(spark, xs)
    upper = cleaning.iqr_stats(df, "value").first()["upper_bound"]
    capped = [r["value"] for r in cleaning.winsorize(df, "value").collect()]
    assert upper < 0 and max(capped) == upper  # lifted to 0, then capped


def test_whole_number_caps_are_cut(spark):
    quantities = [float(90 + i % 20) for i in range(100)]
    quantities[0], quantities[1] = 500.0, 1.0
    cleaned = cleaning.clean(sales(spark, quantities))
    got = [r["sales_quantity"] for r in cleaned.collect()]
    assert max(got) < 500 and min(got) > 1 and all(x == int(x) for x in got)


def test_missing_values_become_the_median_of_the_capped_column(spark):
    quantities = [float(90 + i % 20) for i in range(100)]
    quantities[0] = quantities[50] = None
    quantities[7] = 900.0
    df = sales(spark, quantities)
    cleaned = cleaning.clean(df)
    assert cleaned.where("sales_quantity is null").count() == 0
    rules = cleaning.learn_cleaning(df)
    capped = cleaning.winsorize(df, "sales_quantity", integer=True).toPandas()
    assert rules.medians["sales_quantity"] == capped["sales_quantity"].median()


def test_column_without_values_stays_null(spark):
    df = sales(spark, [None] * 5)
    cleaned = cleaning.clean(df)
    assert cleaned.where("sales_quantity is null").count() == 5
    rules = cleaning.learn_cleaning(df)
    log = cleaning.cleaning_log(cleaning.cleaning_summary(df, rules), rules)
    assert [r["type"] for r in log.collect()] == ["sort"]


def test_rows_without_a_date_shape_the_median_but_go(spark):
    dates = [START, START, None, None, None]
    df = sales(spark, [1.0, None, 8.0, 8.0, 8.0], dates=dates)
    got = sorted(r["sales_quantity"] for r in cleaning.apply_cleaning(
        df, cleaning.CleaningRules({}, {"sales_quantity": 8.0}, ())).collect())
    assert got == [1.0, 8.0]
    assert cleaning.learn_cleaning(df).medians["sales_quantity"] == 8.0
    summary = cleaning.cleaning_summary(df, cleaning.learn_cleaning(df)).first()
    assert (summary["original_rows"], summary["rows_removed"]) == (5, 3)


def test_other_columns_are_never_filled(spark):
    df = sales(spark, [1.0, 2.0, 3.0]).withColumn("product_id", F.lit(None).cast("string"))
    assert cleaning.clean(df).where("product_id is null").count() == 3


def test_nan_is_missing(spark):
    df = sales(spark, [1.0, 2.0, 3.0, float("nan"), 500.0] * 3)
    cleaned = cleaning.clean(df).toPandas()["sales_quantity"]
    assert cleaned.notna().all() and cleaned.max() < 500 and (cleaned == 2.5).sum() == 3
    summary = cleaning.cleaning_summary(df, cleaning.learn_cleaning(df)).first()
    assert summary["null_before"]["sales_quantity"] == 3
    assert summary["outliers_sales_quantity"] == 3


def test_sorted_with_missing_last_and_copies_spread(spark):
    rows = [(START + dt.timedelta(days=i % 3), f"P{i % 2}", 1.0, 1.0) for i in range(30)]
    rows += [(None, "P0", 1.0, 1.0), (START, None, 1.0, 1.0)] + [(START, "P9", 5.0, 5.0)] * 300
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    ordered = cleaning.sort_rows(df)
    got = [(r["date"] is None, r["date"], r["product_id"] is None, r["product_id"])
           for r in ordered.collect()]
    frame = pd.DataFrame(rows, columns=["date", "product_id", "q", "r"])
    assert len(got) == len(frame)
    key = [(a, b or dt.date.max, c, d or "") for a, b, c, d in got]
    assert key == sorted(key)
    parts = (
        ordered.where("product_id = 'P9'").select(F.spark_partition_id().alias("p")).distinct()
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert parts.count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_median_is_searched_again_only_where_capping_moves_it(spark, monkeypatch):
    searches = []
    search = cleaning.exact_quantiles

    def counted(df, columns, probabilities):
        searches.append((tuple(columns), tuple(probabilities)))
        return search(df, columns, probabilities)

    monkeypatch.setattr(cleaning, "exact_quantiles", counted)
    # more than half of the values are negative outliers' neighbours: capping lifts them to zero
    xs = [-40.0] * 3 + [-12.0 + 0.1 * i for i in range(40)] + [90.0] * 3
    df = spark.createDataFrame([(x, 5.0 + i % 3) for i, x in enumerate(xs)], "revenue double, sales_quantity double")
    rules = cleaning.learn_cleaning(df)
    capped = df.select(cleaning.capped(F.col("revenue"), rules.bounds["revenue"], False).alias("revenue"))
    assert rules.medians["revenue"] == capped.selectExpr("percentile(revenue, 0.5)").first()[0]
    assert searches[0] == (("sales_quantity", "revenue"), (0.25, 0.5, 0.75)) and searches[1:] in ([], [(("revenue",), (0.5,))])
    calm = df.where("revenue between -12 and -8")
    searches.clear()
    cleaning.learn_cleaning(calm)
    assert len(searches) == 1
