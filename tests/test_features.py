import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from salescast.functions import row_digest
from salescast.operators.cleaning import clean, sort_rows
from salescast.operators.daily import add_time_features, daily_sales, filter_product
from salescast.operators.ordered import (
    add_lag_features,
    add_rolling_features,
    last_rows,
    ordered_features,
)
from salescast.plans.features import feature_names, feature_table

START = dt.date(2024, 1, 1)
WINDOWS, LAGS = [2, 5], [1, 3, 7]
FEATURES = [f"y_rolling_{n}d" for n in WINDOWS] + [f"y_lag_{k}d" for k in LAGS]


def raw_rows():
    """Groups of all kinds: copies, missing dates and targets, short, unnamed."""
    rng = random.Random(5)
    rows = []
    plan = [("a", 60, 0.3), ("b", 40, 0.1), ("c", 3, 0), ("d", 9, 0.5), ("e", 12, 1),
            (None, 10, 0.2), ("f", 50, 0.95), ("h", 1, 0), ("i", 8, 0)]
    for group, n, missing in plan:
        for _ in range(n):
            date = None if rng.random() < 0.05 else START + dt.timedelta(days=rng.randrange(6))
            early = group in ("b", "d") and date is not None and date < START + dt.timedelta(days=3)
            y = None if early or rng.random() < missing else rng.randrange(3)
            rows.append((group, date, y))
    return rows + [("z", START, 1)] * 150


def expected(keyed, group, fill):
    keyed = keyed.copy()
    keyed["y"] = keyed["y"].astype(float)
    keyed["order"] = [(d is None, d or dt.date.max, h) for d, h in zip(keyed.date, keyed.digest)]
    parts = []
    for name, part in keyed.groupby("g", dropna=False) if group else [("all", keyed)]:
        part = part.sort_values("order").copy()
        named = isinstance(name, str)
        for n in WINDOWS:
            mean = part.y.rolling(n, min_periods=1).mean().round(2)
            part[f"y_rolling_{n}d"] = mean if named else np.nan
        for k in LAGS:
            part[f"y_lag_{k}d"] = part.y.shift(k) if named else np.nan
        if fill:
            part[FEATURES] = part[FEATURES].ffill().bfill()
        parts.append(part)
    return pd.concat(parts)


def normal(frame, columns):
    def cell(x):
        if x is None or x != x:
            return "-"
        return float(x) if isinstance(x, (int, float)) else str(x)

    rows = [tuple(cell(x) for x in r) for r in frame[columns].itertuples(index=False)]
    return sorted(rows, key=str)


@pytest.mark.parametrize("group", ["g", None])
@pytest.mark.parametrize("fill", [True, False])
@pytest.mark.parametrize("block_rows", [8, 1_000_000])
def test_raw_rows_equal_pandas(spark, group, fill, block_rows):
    df = spark.createDataFrame(raw_rows(), "g string, date date, y bigint").repartition(5)
    keyed = df.withColumn("digest", row_digest(df)).toPandas()
    out = ordered_features(
        df, "y", WINDOWS, LAGS, group=group, fill=fill, block_rows=block_rows
    ).toPandas()
    columns = ["g", "date", "y", *FEATURES]
    assert normal(out, columns) == normal(expected(keyed, group, fill), columns)


def test_both_forms_agree_on_daily_rows(spark):
    rows = [(s, START + dt.timedelta(days=i), float(i * i % 17)) for s in "ab" for i in range(40)]
    df = spark.createDataFrame(rows, "g string, date date, y double")
    forms = [
        ordered_features(df, "y", WINDOWS, LAGS, group="g", fill=True, daily=d, block_rows=9)
        for d in (True, False)
    ]
    columns = ["g", "date", *FEATURES]
    assert normal(forms[0].toPandas(), columns) == normal(forms[1].toPandas(), columns)


def test_blocks_follow_the_reach(spark):
    rows = [(START + dt.timedelta(days=i), float(i)) for i in range(90)]
    df = spark.createDataFrame(rows, "date date, y double")
    out = ordered_features(df, "y", lags=[20], block_rows=4).orderBy("date").collect()
    assert [r["y_lag_20d"] for r in out] == [None] * 20 + [float(i) for i in range(70)]


def test_windows_count_rows_not_days(spark):
    dates = [START, START + dt.timedelta(days=30), START + dt.timedelta(days=60)]
    df = spark.createDataFrame([(d, float(i)) for i, d in enumerate(dates)], "date date, y double")
    out = add_rolling_features(df, "y", [2], daily=True).orderBy("date").toPandas()
    assert out["y_rolling_2d"].tolist() == [0.0, 0.5, 1.5]
    out = add_lag_features(df, "y", [1], daily=True).orderBy("date").toPandas()
    assert out["y_lag_1d"].tolist()[1:] == [0.0, 1.0]


def test_calendar_edges(spark):
    days = [dt.date(2020, 12, 31), dt.date(2021, 1, 1), dt.date(2024, 2, 29), dt.date(2024, 6, 30)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    out = {r["date"]: r for r in add_time_features(df).collect()}
    stamps = pd.Series(pd.to_datetime(days))
    for i, day in enumerate(days):
        row = out[day]
        assert row["day_of_week"] == stamps.dt.dayofweek[i]
        assert row["week_of_year"] == stamps.dt.isocalendar().week[i]
        assert row["quarter"] == stamps.dt.quarter[i] and row["year"] == day.year
        assert row["is_month_end"] == int(stamps.dt.is_month_end[i])
        assert row["is_month_start"] == int(stamps.dt.is_month_start[i])
        assert row["is_weekend"] == int(day.weekday() >= 5)
    assert out[days[0]]["week_of_year"] == 53


SALES = "date date, product_id string, sales_quantity bigint, revenue double"


def sales_rows(days=40):
    rows = []
    for i in range(days):
        for p, scale in (("P1", 1), ("P2", 10), (None, 100)):
            rows.append((START + dt.timedelta(days=i), p, scale * (i % 7 + 1), scale * 1.5))
    return rows + [(None, "P1", 7, 1.0)]


def test_daily_totals(spark):
    df = spark.createDataFrame(sales_rows(2) + [(dt.date(2025, 1, 1), "P1", None, None)], SALES)
    out = {r["date"]: r for r in daily_sales(df).collect()}
    assert set(out) == {START, START + dt.timedelta(days=1), dt.date(2025, 1, 1)}
    assert out[START]["sales_quantity"] == 111 and out[START]["series_id"] == "__all__"
    assert out[dt.date(2025, 1, 1)]["sales_quantity"] == 0.0
    by = daily_sales(df, ["product_id"]).where("series_id = 'P2'").orderBy("date").collect()
    assert [r["sales_quantity"] for r in by] == [10.0, 20.0]


def test_one_job_for_all_series_equals_each_alone(spark):
    df = spark.createDataFrame(sales_rows(), SALES).where("product_id is not null")
    together = feature_table(df, series_cols=["product_id"]).toPandas()
    for product in ("P1", "P2"):
        alone = feature_table(df.where(f"product_id = '{product}'")).toPandas()
        columns = ["date", "sales_quantity", "revenue", *feature_names(), "ds", "y"]
        assert normal(together[together.series_id == product], columns) == normal(alone, columns)


def test_feature_table_columns_and_fill(spark):
    df = spark.createDataFrame(sales_rows(), SALES)
    out = feature_table(df)
    assert len(feature_names()) == 15
    assert out.columns == ["series_id", "date", "sales_quantity", "revenue", *feature_names(),
                           "ds", "y"]
    first = out.orderBy("date").first()
    assert first["sales_quantity_lag_14d"] == first["y"] == 111.0
    plain = feature_table(df, {"features": {"extract_time_features": False}})
    assert "month" not in plain.columns


def test_short_series_keeps_nulls(spark):
    rows = [(START + dt.timedelta(days=i), "P", i, 1.0) for i in range(14)]
    out = feature_table(spark.createDataFrame(rows, SALES))
    assert out.where("sales_quantity_lag_14d is not null").count() == 0
    assert out.where("sales_quantity_lag_7d is null").count() == 0


def test_product_path_keeps_rows_and_fills_the_calendar(spark):
    df = spark.createDataFrame(sales_rows(), SALES)
    out = feature_table(df, product_id="P1")
    assert out.count() == 41
    undated = out.where("date is null").first()
    last = out.where("date = date'2024-02-09'").first()
    assert undated["day_of_week"] == last["day_of_week"] and undated["ds"] is None
    assert {r["series_id"] for r in out.collect()} == {"P1"}


def test_extra_columns_with_odd_names_are_kept(spark):
    df = spark.createDataFrame(sales_rows(3), SALES).withColumn("unit.price", F.lit(1.0))
    out = feature_table(df, product_id="P2")
    assert "unit.price" in out.columns and out.count() == 3
    assert sort_rows(clean(df)).count() == 9


def test_table_without_products_is_not_aggregated(spark):
    df = spark.createDataFrame(sales_rows(3), SALES).drop("product_id").where("date is not null")
    assert feature_table(df).count() == 9


def test_empty_product_is_refused(spark):
    with pytest.raises(ValueError):
        filter_product(spark.createDataFrame(sales_rows(1), SALES), "")


def test_results_do_not_depend_on_partitioning(spark):
    df = spark.createDataFrame(sales_rows(), SALES)
    reference = None
    for shuffles in ("1", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        try:
            got = normal(feature_table(df.repartition(int(shuffles)), product_id="P2").toPandas(),
                         ["date", "y", *feature_names()])
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        reference = reference or got
        assert got == reference


def test_last_rows(spark):
    rows = [(s, START + dt.timedelta(days=i)) for s in "ab" for i in range(5)]
    df = spark.createDataFrame(rows, "series_id string, ds date")
    assert last_rows(df, 3).count() == 3
    per = last_rows(df, 2, series="series_id").collect()
    assert sorted((r["series_id"], r["ds"].day) for r in per) == [
        ("a", 4), ("a", 5), ("b", 4), ("b", 5)]
