import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescast.operators.forecast import (
    fit,
    forecast_statistics,
    format_forecast,
    future_frame,
    predict,
)

START = dt.date(2020, 1, 1)
SCHEMA = "series_id string, ds date, y double"


def series(name, days, f, step=1):
    return [(name, START + dt.timedelta(days=i * step), f(i * step)) for i in range(days)]


def forecast(spark, rows, horizon=30, **params):
    models = fit(spark.createDataFrame(rows, SCHEMA), {"model": {"prophet": params}})
    return predict(future_frame(models, horizon)).orderBy("series_id", "ds").toPandas()


def test_noise_free_line_is_recovered(spark):
    out = forecast(spark, series("a", 300, lambda i: 50.0 + 0.5 * i))
    truth = 50.0 + 0.5 * np.arange(330)
    np.testing.assert_allclose(out.yhat, truth, rtol=2e-3)


@pytest.mark.parametrize("mode", ["multiplicative", "additive"])
def test_weekly_pattern_is_recovered(spark, mode):
    pattern = [1.0, 1.1, 0.9, 1.0, 1.2, 1.5, 0.6]
    out = forecast(
        spark, series("a", 200, lambda i: 100.0 * pattern[i % 7]),
        seasonality_mode=mode, yearly_seasonality=False,
    )
    truth = [100.0 * pattern[i % 7] for i in range(230)]
    np.testing.assert_allclose(out.yhat, truth, rtol=0.02)
    assert out.yearly.isna().all() and out.weekly.notna().all()
    if mode == "multiplicative":
        np.testing.assert_allclose(out.yhat, out.trend * (1 + out.weekly), rtol=1e-9)
    else:
        np.testing.assert_allclose(out.yhat, out.trend + out.weekly, rtol=1e-9)


def test_three_years_with_noise(spark):
    rng = np.random.default_rng(1)

    def truth(i):
        yearly = 0.3 * math.sin(2 * math.pi * i / 365.25)
        return (100 + 0.05 * i) * (1 + yearly + 0.2 * math.cos(2 * math.pi * i / 7))

    rows = series("a", 1095, lambda i: truth(i) * (1 + 0.05 * rng.standard_normal()))
    out = forecast(spark, rows)
    expected = np.array([truth(i) for i in range(1125)])
    error = np.abs(out.yhat - expected) / expected
    assert error[1095:].mean() < 0.08
    actual = np.array([r[2] for r in rows])
    covered = (out.yhat_lower[:1095] <= actual) & (actual <= out.yhat_upper[:1095])
    assert 0.9 < covered.mean() <= 1.0


@pytest.mark.parametrize("value", [0.0, 42.0])
def test_constant_series(spark, value):
    out = forecast(spark, series("a", 60, lambda i: value))
    np.testing.assert_allclose(out.yhat, value, atol=0.05)


def test_bounds_surround_and_widen(spark):
    rng = np.random.default_rng(2)
    out = forecast(spark, series("a", 400, lambda i: 100 + i / 4 + rng.normal()), horizon=60)
    assert (out.yhat_lower <= out.yhat).all() and (out.yhat <= out.yhat_upper).all()
    width = (out.yhat_upper - out.yhat_lower).to_numpy()
    assert width[-1] >= width[410] >= width[100]


def test_many_series_equal_each_alone_and_a_rerun(spark):
    rows = []
    for k in range(10):
        rows += series(f"s{k}", 40 + 20 * k, lambda i, k=k: 10 * k + (i % 7) + 0.1 * i)
    together = forecast(spark, rows)
    again = forecast(spark, rows)
    np.testing.assert_array_equal(together.yhat, again.yhat)
    for k in (0, 5, 9):
        alone = forecast(spark, [r for r in rows if r[0] == f"s{k}"])
        np.testing.assert_allclose(
            together[together.series_id == f"s{k}"].yhat, alone.yhat, rtol=1e-9
        )


def test_rows_of_a_day_may_be_combined_before_fitting(spark):
    rng = np.random.default_rng(3)
    rows = [("a", START + dt.timedelta(days=i // 3), 20 + i / 30 + rng.normal()) for i in range(600)]
    models = fit(spark.createDataFrame(rows, SCHEMA)).first()
    assert models["training_records"] == 600 and len(models["history_ds"]) == 200
    out = forecast(spark, rows)
    fitted = dict(zip(out.ds, out.yhat))
    residual = np.array([y - fitted[d] for _, d, y in rows])
    assert models["sigma"] * models["y_scale"] == pytest.approx(
        math.sqrt((residual**2).mean()), rel=0.02
    )


def test_series_without_enough_values_is_an_error_row(spark):
    rows = series("short", 1, lambda i: 1.0) + series("empty", 9, lambda i: None)
    rows += series("two", 2, lambda i: 5.0 + i) + series("fine", 50, lambda i: 1.0 + i)
    models = fit(spark.createDataFrame(rows, SCHEMA))
    status = {r["series_id"]: r["status"] for r in models.collect()}
    assert status == {"short": "error", "empty": "error", "two": "ok", "fine": "ok"}
    scored = predict(future_frame(models, 5)).groupBy("series_id").count().collect()
    assert {r["series_id"]: r["count"] for r in scored} == {"two": 7, "fine": 55}


def test_missing_targets_are_left_out_but_dated(spark):
    rows = series("a", 100, lambda i: None if i % 10 == 0 else 3.0 + i)
    out = forecast(spark, rows, horizon=3)
    assert len(out) == 103
    np.testing.assert_allclose(out.yhat, 3.0 + np.arange(103), rtol=0.01, atol=0.5)


def test_the_form_does_not_depend_on_the_number_of_rows(spark):
    for n in (2, 3, 26, 27, 200):
        row = fit(spark.createDataFrame(series("a", n, lambda i: 1.0 + i), SCHEMA)).first()
        assert row["status"] == "ok"
        assert row["changepoints"] == 25 and len(row["trend_slope"]) == 26


def test_dates_count_and_targets_have_to_be_finite(spark):
    twice = series("a", 1, float) + series("a", 1, float)
    assert fit(spark.createDataFrame(twice, SCHEMA)).first()["status"] == "error"
    rows = series("a", 30, lambda i: float("inf") if i == 7 else 2.0)
    row = fit(spark.createDataFrame(rows, SCHEMA)).first()
    assert row["status"] == "ok" and abs(row["sigma"]) < 1.0


def test_training_needs_ds_and_y(spark):
    with pytest.raises(ValueError, match="y"):
        fit(spark.range(1).withColumn("ds", F.current_date()))
    with pytest.raises(ValueError, match="seasonality_mode"):
        rows = spark.createDataFrame(series("a", 5, float), SCHEMA)
        fit(rows, {"model": {"prophet": {"seasonality_mode": "odd"}}})


@pytest.mark.parametrize("freq, alias", [("D", "D"), ("W", "W"), ("M", "ME")])
@pytest.mark.parametrize("end", ["2024-01-31", "2024-02-18", "2024-12-30"])
def test_future_dates_equal_pandas(spark, freq, alias, end):
    import pandas as pd

    last = dt.date.fromisoformat(end)
    models = spark.createDataFrame([("a", [last])], "series_id string, history_ds array<date>")
    got = [r["ds"] for r in future_frame(models, 5, freq).collect()]
    ahead = pd.date_range(start=end, periods=6, freq=alias)
    ahead = [d.date() for d in ahead if d.date() > last][:5]
    assert sorted(got) == [last, *ahead]
    assert future_frame(models, 0, freq).count() == 1


def test_format_rounds_then_lifts(spark):
    df = spark.createDataFrame(
        [(START, -0.004, -5.0, -1.239, -2.0, 9)],
        "ds date, yhat double, yhat_lower double, yhat_upper double, trend double, other int",
    )
    row = format_forecast(df).first()
    assert row.asDict() == {
        "ds": START, "yhat": 0.0, "yhat_lower": 0.0, "yhat_upper": -1.24, "trend": -2.0,
    }
    nothing = df.withColumn("yhat", F.lit(None).cast("double"))
    assert format_forecast(nothing).first()["yhat"] is None


def test_statistics_take_the_last_thirty_whatever_the_horizon(spark):
    rows = [("a", START + dt.timedelta(days=i), float(i), i - 1.0, i + 1.0) for i in range(50)]
    df = spark.createDataFrame(
        rows, "series_id string, ds date, yhat double, yhat_lower double, yhat_upper double"
    )
    row = forecast_statistics(df).first()
    assert (row["forecast_days"], row["min_forecast"], row["max_forecast"]) == (30, 20.0, 49.0)
    assert row["avg_confidence_width"] == 2.0
    history = spark.createDataFrame(
        [("a", START + dt.timedelta(days=39))], "series_id string, ds_end date"
    )
    for by in (None, "series_id"):
        row = forecast_statistics(df, tail_rows=None, series=by, history=history).first()
        assert (row["forecast_days"], row["min_forecast"]) == (10, 40.0)
    assert forecast_statistics(df, future_only=False).first()["forecast_days"] == 50
