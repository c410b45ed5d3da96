"""Trend plus weekly and yearly seasonality, fitted per series.

The model form is that of Taylor and Letham, "Forecasting at Scale" (The
American Statistician 72(1), 2018): a piecewise-linear trend with sparse slope
changes and Fourier seasonality, multiplicative or additive. The estimate is a
reweighted ridge solve, not a port of any solver.

Rows are first combined per series and date (count, mean, spread), which leaves
the least-squares problem unchanged and bounds every group by the calendar. One
Python call then fits one series; series scale out over the cluster. Scoring is
column arithmetic on the model row and needs neither Python nor a shuffle.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections.abc import Mapping
from statistics import NormalDist
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.config import settings
from salescast.functions import clip_at_zero, round_half_even
from salescast.operators.ordered import last_rows, shuffle_partitions
from salescast.schema import TRAINING_COLUMNS, validate_schema

# The fit travels to the executors with its helpers, so the package need not be
# installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Shape of the model, from the paper.
CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
WEEKLY_PERIOD, WEEKLY_ORDER = 7.0, 3
YEARLY_PERIOD, YEARLY_ORDER = 365.25, 10

ROUNDS = 10
#: scale of the normal prior on intercept and slope
TREND_PRIOR = 5.0

PARAMETERS = [
    "changepoint_prior_scale",
    "seasonality_prior_scale",
    "seasonality_mode",
    "weekly_seasonality",
    "yearly_seasonality",
    "interval_width",
]

FIT_SCHEMA = """
    series_id string, status string, message string,
    training_records bigint, ds_start date, ds_end date, history_ds array<date>,
    span_days double, y_scale double, sigma double, slope_change_scale double,
    changepoints int, trend_offset array<double>, trend_slope array<double>,
    weekly array<double>, yearly array<double>, coefficients array<double>,
    training_duration_sec double
"""


def daily_observations(features: DataFrame) -> DataFrame:
    """Training rows combined per series and date.

    ``weight`` rows with mean ``y`` and squared spread ``spread`` around it stand
    for the rows themselves: the sum of squared errors differs by the spread
    only. ``records`` counts all rows, those without a target included.
    """
    validate_schema(features, TRAINING_COLUMNS)
    y = F.col("y").cast("double")
    y = F.when(F.abs(y) < float("inf"), y)  # neither NaN nor infinite
    series = F.col("series_id") if "series_id" in features.columns else F.lit("__all__")
    rows = features.select(series.alias("series_id"), F.to_date("ds").alias("ds"), y.alias("y"))
    return (
        rows.where(F.col("ds").isNotNull())
        .groupBy("series_id", "ds")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count("y").alias("weight"),
            F.avg("y").alias("y"),
            (F.var_pop("y") * F.count("y")).alias("spread"),
            F.max(F.abs("y")).alias("largest"),
        )
    )


def _fourier(days: np.ndarray, period: float, order: int) -> np.ndarray:
    angle = 2.0 * np.pi * np.outer(days, np.arange(1, order + 1)) / period
    return np.hstack([np.cos(angle), np.sin(angle)])


def _ridge(x: np.ndarray, y: np.ndarray, w: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """Weighted least squares with a quadratic penalty per coefficient."""
    xw = x * w[:, None]
    gram = xw.T @ x
    gram[np.diag_indices_from(gram)] += penalty + 1e-10 * max(1.0, float(w.sum()))
    return np.linalg.solve(gram, xw.T @ y)


def _estimate(
    t: np.ndarray, days: np.ndarray, y: np.ndarray, w: np.ndarray, spread: float, p: Mapping
) -> dict[str, Any]:
    """Coefficients for scaled time ``t`` and scaled target ``y``."""
    changes = CHANGEPOINTS  # for every series; the penalty keeps a short one straight
    places = CHANGEPOINT_RANGE * np.arange(1, changes + 1) / CHANGEPOINTS
    trend_basis = np.hstack(
        [np.ones((len(t), 1)), t[:, None], np.maximum(t[:, None] - places[None, :], 0.0)]
    )
    weekly_order = WEEKLY_ORDER if p["weekly_seasonality"] else 0
    yearly_order = YEARLY_ORDER if p["yearly_seasonality"] else 0
    season_basis = np.hstack(
        [
            _fourier(days, WEEKLY_PERIOD, weekly_order),
            _fourier(days, YEARLY_PERIOD, yearly_order),
        ]
    )
    multiplicative = p["seasonality_mode"] == "multiplicative"
    seasons = season_basis.shape[1]
    rows = float(w.sum())

    theta = np.zeros(2 + changes)
    beta = np.zeros(seasons)
    variance = max(float(w @ (y - (w @ y) / rows) ** 2) / rows, 1e-12)
    tau = float(p["changepoint_prior_scale"])
    sizes = np.full(changes, tau)
    for _ in range(ROUNDS):
        # |d|/tau is bounded by d^2/(2 tau |d_old|) up to a constant
        trend_penalty = variance * np.concatenate(
            [np.full(2, 1.0 / TREND_PRIOR**2), 1.0 / (tau * np.maximum(sizes, 1e-6))]
        )
        season_penalty = variance * np.full(seasons, 1.0 / p["seasonality_prior_scale"] ** 2)
        if multiplicative:
            factor = 1.0 + season_basis @ beta
            theta = _ridge(trend_basis * factor[:, None], y, w, trend_penalty)
            trend = trend_basis @ theta
            if seasons:
                beta = _ridge(season_basis * trend[:, None], y - trend, w, season_penalty)
            fitted = trend * (1.0 + season_basis @ beta)
        else:
            both = np.hstack([trend_basis, season_basis])
            solved = _ridge(both, y, w, np.concatenate([trend_penalty, season_penalty]))
            theta, beta = solved[: 2 + changes], solved[2 + changes :]
            fitted = both @ solved
        sizes = np.abs(theta[2:])
        variance = max((float(w @ (y - fitted) ** 2) + spread) / rows, 1e-12)

    # the trend as one straight line per segment between changepoints
    steps = np.concatenate([[0.0], theta[2:]])
    slope = theta[1] + np.cumsum(steps)
    offset = theta[0] - np.cumsum(steps * np.concatenate([[0.0], places]))
    weekdays = np.arange(7) - 3.0  # 1970-01-01 was a Thursday
    weekly = _fourier(weekdays, WEEKLY_PERIOD, weekly_order) @ beta[: 2 * weekly_order]
    return {
        "sigma": math.sqrt(variance),
        "slope_change_scale": float(sizes.mean()) if changes else 0.0,
        "changepoints": changes,
        "trend_offset": offset.tolist(),
        "trend_slope": slope.tolist(),
        "weekly": weekly.tolist() if weekly_order else None,
        "yearly": beta[2 * weekly_order :].tolist() if yearly_order else None,
        "coefficients": np.concatenate([theta, beta]).tolist(),
    }


def _fit_series(frame: pd.DataFrame, p: Mapping[str, Any]) -> dict[str, Any]:
    frame = frame.sort_values("ds")
    history = frame["ds"].tolist()
    row: dict[str, Any] = {
        "status": "ok",
        "training_records": int(frame["records"].sum()),
        "ds_start": history[0],
        "ds_end": history[-1],
        "history_ds": history,
    }
    known = frame[frame["weight"] > 0]
    w = known["weight"].to_numpy(dtype=float)
    if len(known) < 2:
        row["status"] = "error"
        row["message"] = "fewer than 2 dates with a target value"
        return row
    days = np.array([d.toordinal() for d in known["ds"]]) - dt.date(1970, 1, 1).toordinal()
    first = days[0]
    span = float(max(days[-1] - first, 1))
    scale = float(known["largest"].max()) or 1.0
    row["ds_start"] = known["ds"].iloc[0]
    row["span_days"] = span
    row["y_scale"] = scale
    y = known["y"].to_numpy(dtype=float) / scale
    spread = float(known["spread"].sum()) / scale**2
    found = _estimate((days - first) / span, days.astype(float), y, w, spread, p)
    if not np.isfinite([found["sigma"], *found["coefficients"]]).all():
        return row | {"status": "error", "message": "the estimate is not finite"}
    return row | found


def fit(features: DataFrame, cfg: Mapping[str, Any] | None = None) -> DataFrame:
    """One model row per series.

    Needs ``ds`` and ``y``; ``series_id`` splits the rows into series. Other
    columns are not looked at. A series that cannot be fitted yields a row with
    status ``error`` and a message, and does not fail the job.
    """
    p = settings(cfg, "model.prophet")
    if p["seasonality_mode"] not in ("multiplicative", "additive"):
        raise ValueError(f"unknown seasonality_mode: {p['seasonality_mode']}")

    def fit_one(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        started = time.perf_counter()
        try:
            row = _fit_series(frame, p)
        except np.linalg.LinAlgError as problem:
            row = {"status": "error", "message": str(problem)}
        row["series_id"] = key[0]
        row["training_duration_sec"] = round(time.perf_counter() - started, 2)
        names = [part.split()[0] for part in FIT_SCHEMA.split(",")]
        return pd.DataFrame({name: [row.get(name)] for name in names})

    observations = daily_observations(features)
    # a fixed number: fitting is slow for its bytes, so adaptive execution must
    # not merge the series of a small table into a few tasks
    observations = observations.repartition(shuffle_partitions(observations), "series_id")
    models = observations.groupBy("series_id").applyInPandas(fit_one, FIT_SCHEMA)
    return models.withColumns(parameter_columns(p))


def parameter_columns(p: Mapping[str, Any]) -> dict[str, Column]:
    """The columns of a model row that come from the configuration alone."""
    parameters = F.struct(*[F.lit(p[name]).alias(name) for name in PARAMETERS])
    interval_z = NormalDist().inv_cdf(0.5 + p["interval_width"] / 2.0)
    return {"parameters": parameters, "interval_z": F.lit(interval_z)}


def future_frame(
    models: DataFrame, periods: int, freq: str = "D", include_history: bool = True
) -> DataFrame:
    """Model rows with ``ds``, one per date to predict.

    History dates come first, then ``periods`` dates after the last one: days
    (``D``), Sundays (``W``) or month ends (``M``). A narrow explode per series.
    """
    end = F.element_at("history_ds", -1)
    if freq == "D":
        ahead = F.sequence(F.date_add(end, 1), F.date_add(end, periods))
    elif freq == "W":
        first = F.next_day(end, "SU")
        ahead = F.sequence(first, F.date_add(first, 7 * (periods - 1)), F.expr("interval 7 days"))
    elif freq == "M":
        month_end = F.last_day(end)
        first = F.when(month_end > end, month_end).otherwise(F.last_day(F.date_add(end, 1)))
        steps = F.sequence(F.lit(0), F.lit(periods - 1))
        ahead = F.transform(
            steps, lambda k: F.last_day(F.add_months(F.date_trunc("month", first).cast("date"), k))
        )
    else:
        raise ValueError(f"unknown freq: {freq}")
    if periods <= 0:
        ahead = F.array().cast("array<date>")
    dates = F.concat("history_ds", ahead) if include_history else ahead
    return models.withColumn("ds", F.explode(dates))


def _yearly(days: Column) -> Column:
    """Sum of the yearly Fourier terms; coefficients are cosines, then sines."""
    terms = []
    for k in range(YEARLY_ORDER):
        angle = days * F.lit(2.0 * math.pi * (k + 1) / YEARLY_PERIOD)
        terms.append(F.cos(angle) * F.col("yearly")[k])
        terms.append(F.sin(angle) * F.col("yearly")[YEARLY_ORDER + k])
    return sum(terms[1:], terms[0])


def predict(frame: DataFrame) -> DataFrame:
    """Score a future frame: trend, seasonality, point forecast and interval.

    In multiplicative mode ``weekly`` and ``yearly`` are fractions of the trend,
    otherwise they are in units of the target; they are NULL when not fitted.
    The interval holds the observation noise plus, beyond the history, the
    variance of slope changes arriving at the historical rate and size.
    """
    scored = frame.where("status = 'ok'")
    days = F.unix_date("ds").cast("double")
    t = F.datediff("ds", "ds_start") / F.col("span_days")
    segment = F.greatest(
        F.lit(0),
        F.least(
            F.col("changepoints"),
            F.floor(F.col("t") * (CHANGEPOINTS / CHANGEPOINT_RANGE)).cast("int"),
        ),
    )
    parameters = F.col("parameters")
    multiplicative = parameters["seasonality_mode"] == "multiplicative"
    ahead = F.greatest(F.col("t") - 1.0, F.lit(0.0))
    rate = F.col("changepoints").cast("double")
    trend_variance = rate * 2.0 * F.col("slope_change_scale") ** 2 * ahead**3 / 3.0
    season = F.coalesce("weekly_term", F.lit(0.0)) + F.coalesce("yearly_term", F.lit(0.0))
    stretch = F.when(multiplicative, 1.0 + season).otherwise(F.lit(1.0))
    half_width = F.col("interval_z") * F.sqrt(F.col("sigma") ** 2 + stretch**2 * trend_variance)
    centre = F.when(multiplicative, F.col("level") * (1.0 + season)).otherwise(
        F.col("level") + season
    )
    unit = F.when(multiplicative, F.lit(1.0)).otherwise(F.col("y_scale"))
    return (
        scored.withColumn("t", t)
        .withColumn("segment", segment)
        .withColumns(
            {
                "level": F.col("trend_offset")[F.col("segment")]
                + F.col("trend_slope")[F.col("segment")] * F.col("t"),
                "weekly_term": F.col("weekly")[F.weekday("ds")],
                "yearly_term": _yearly(days),
            }
        )
        .withColumns({"centre": centre, "half_width": half_width})
        .select(
            *[c for c in ("series_id", "model_version", "version") if c in frame.columns],
            "ds",
            (F.col("y_scale") * F.col("centre")).alias("yhat"),
            (F.col("y_scale") * (F.col("centre") - F.col("half_width"))).alias("yhat_lower"),
            (F.col("y_scale") * (F.col("centre") + F.col("half_width"))).alias("yhat_upper"),
            (F.col("y_scale") * F.col("level")).alias("trend"),
            (F.col("weekly_term") * unit).alias("weekly"),
            (F.col("yearly_term") * unit).alias("yearly"),
        )
    )


def format_forecast(forecast: DataFrame) -> DataFrame:
    """Keep the published columns, round to 2, then lift negative demand to 0.

    Only ``yhat`` and ``yhat_lower`` are lifted. ``weekly`` and ``yearly`` appear
    when the input has them.
    """
    keys = [c for c in ("series_id", "model_version") if c in forecast.columns]
    values = ["yhat", "yhat_lower", "yhat_upper", "trend"]
    values += [c for c in ("weekly", "yearly") if c in forecast.columns]
    rounded = {c: round_half_even(F.col(c)) for c in values}
    for c in ("yhat", "yhat_lower"):
        rounded[c] = clip_at_zero(rounded[c])
    return forecast.select(*keys, "ds", *[rounded[c].alias(c) for c in values])


def forecast_statistics(
    forecast: DataFrame,
    future_only: bool = True,
    tail_rows: int | None = 30,
    series: str | None = None,
    per_series: bool = False,
    history: DataFrame | None = None,
) -> DataFrame:
    """Count, mean, range and sum of ``yhat`` and the mean interval width.

    ``future_only`` keeps the last ``tail_rows`` rows, whatever the horizon was;
    with ``tail_rows=None`` it keeps dates after ``history``'s ``ds_end`` (model
    rows). ``series`` names the series column; ``per_series`` gives a row each.
    """
    if future_only and tail_rows is not None:
        forecast = last_rows(forecast, tail_rows, "ds", series)
    elif future_only:
        if history is None:
            raise ValueError("tail_rows=None needs the model rows as history")
        if series is None:
            end = history.agg(F.max("ds_end")).scalar()
            forecast = forecast.where(F.col("ds") > end)
        else:
            ends = history.groupBy(series).agg(F.max("ds_end").alias("_end"))
            forecast = forecast.join(ends, series).where(F.col("ds") > F.col("_end"))
    yhat = F.col("yhat")
    return forecast.groupBy(*([series] if per_series and series else [])).agg(
        F.count(F.lit(1)).alias("forecast_days"),
        round_half_even(F.avg(yhat)).alias("mean_forecast"),
        round_half_even(F.min(yhat)).alias("min_forecast"),
        round_half_even(F.max(yhat)).alias("max_forecast"),
        round_half_even(F.sum(yhat)).alias("total_forecast"),
        round_half_even(F.avg(F.col("yhat_upper") - F.col("yhat_lower"))).alias(
            "avg_confidence_width"
        ),
    )
