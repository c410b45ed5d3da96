"""The five stages, from path to path, each with a one-row metadata DataFrame.

A stage reads its input from storage and writes its output to storage, so it can
be run, and run again, on its own.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.config import settings
from salescast.functions import date_text, round_half_even
from salescast.operators.cleaning import (
    apply_cleaning,
    cleaning_log,
    cleaning_summary,
    learn_cleaning,
)
from salescast.operators.forecast import (
    fit,
    forecast_statistics,
    format_forecast,
    future_frame,
    parameter_columns,
    predict,
)
from salescast.operators.profile import content_hash, profile
from salescast.operators.quality import first_failed, quality_checks, quality_summary
from salescast.plans.features import feature_names, feature_table
from salescast.schema import ALL_PRODUCTS
from salescast.sources.models import (
    latest_models,
    model_version,
    models_by_version,
    write_models,
)
from salescast.sources.sales import is_csv, read_sales, read_training, split_records, typed_records
from salescast.sources.tables import discard, read_table, shared_folder, stage, write_table

Config = Mapping[str, Any] | None


def _one_row(spark: SparkSession, **values: Any) -> DataFrame:
    """A one-row DataFrame from literals, columns and one-row DataFrames."""
    row = spark.range(1)
    columns: list[Column] = []
    for name, value in values.items():
        if isinstance(value, DataFrame):
            value = value.select(F.struct("*")).scalar()
        elif isinstance(value, (list, tuple)):
            value = F.array(*[F.lit(v) for v in value])
        elif not isinstance(value, Column):
            value = F.lit(value)
        columns.append(value.alias(name))
    return row.select(*columns)


def _kept(one_row: DataFrame) -> DataFrame:
    """The same row, computed once; later readers do not run its jobs again."""
    return one_row.sparkSession.createDataFrame(one_row.collect(), one_row.schema)


def extract_data(
    spark: SparkSession,
    path: str,
    cfg: Config = None,
    fmt: str | None = None,
    staging: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Typed scan, schema check, profile and fingerprint; no output table.

    Returns the sales rows and the metadata row. Text is parsed once, into a
    table at ``staging`` (or in the folder of ``spark.checkpoint.dir``), because
    profile and fingerprint each read the rows. The rows that are returned read
    that table, so it is the caller's to remove.
    """
    sales = read_sales(spark, path, strict=True, fmt=fmt)
    if is_csv(path, fmt):
        sales = stage(sales, staging or f"{shared_folder(spark)}/extracted-{uuid.uuid4().hex}")
    metadata = profile(sales).select(
        F.lit(path).alias("file_path"),
        "*",
        content_hash(sales).scalar().alias("data_hash"),
        F.current_timestamp().alias("extracted_at"),
    )
    return sales, _kept(metadata)


def validate_and_clean_data(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    cfg: Config = None,
    fmt: str | None = None,
    output_fmt: str = "parquet",
) -> DataFrame:
    """Gate the raw table, clean it, write it sorted; returns the metadata row.

    Raises ``ValueError`` with the first failed check before anything is written.
    Text input is staged as Parquet beside the output, because several passes
    read it, and removed at the end. Text records that do not fit their header are
    left out and counted by the gate; they are written to ``{output_path}_rejected``,
    each with its reason, whether the gate passes or not.
    """
    if not is_csv(input_path, fmt):
        sales = read_sales(spark, input_path, fmt=fmt)
        return _validate_and_clean(spark, sales, None, input_path, output_path, cfg, output_fmt)
    staged = f"{output_path}_staged"
    try:
        sales, rejected = split_records(stage(typed_records(spark, input_path, fmt), staged))
        write_table(rejected, f"{output_path}_rejected")
        n = rejected.count()
        return _validate_and_clean(spark, sales, n, input_path, output_path, cfg, output_fmt)
    finally:
        discard(spark, staged)


def _validate_and_clean(
    spark: SparkSession,
    sales: DataFrame,
    rejected: int | None,
    input_path: str,
    output_path: str,
    cfg: Config,
    output_fmt: str,
) -> DataFrame:
    summary = _kept(quality_summary(sales))
    checked = quality_checks(summary, cfg, rejected or None)
    failure = first_failed(checked).first()["message"]
    if failure:
        raise ValueError(failure)
    checks = checked.collect()
    rules = learn_cleaning(sales, cfg)
    write_table(
        apply_cleaning(sales, rules), output_path, output_fmt, sort_by=["date", "product_id"]
    )
    cleaning = _kept(cleaning_summary(sales, rules))
    row = _one_row(
        spark,
        input_path=input_path,
        output_path=output_path,
        checks_performed=[c["check_name"] for c in checks if c["performed"]],
        checks_passed=[c["check_name"] for c in checks if c["passed"]],
        metrics=summary,
        rejected_records=F.lit(rejected).cast("bigint"),
        cleaning=cleaning,
        operations=cleaning_log(cleaning, rules)
        .agg(F.sort_array(F.collect_list(F.struct("*"))).alias("log"))
        .select("log"),
        processed_at=F.current_timestamp(),
    )
    return _kept(row)


def engineer_features(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    cfg: Config = None,
    product_id: str | None = None,
    series_cols: Sequence[str] = (),
    fmt: str | None = None,
    output_fmt: str = "parquet",
) -> DataFrame:
    """Write the feature table in the order of series and date; returns the metadata row.

    Text input is staged beside the output and removed at the end.
    """
    sales = read_sales(spark, input_path, fmt=fmt)
    staged, ordered = f"{output_path}_staged", f"{output_path}_ordered"
    try:
        if is_csv(input_path, fmt):
            sales = stage(sales, staged)
        return _engineer(spark, sales, input_path, output_path, cfg, product_id, series_cols, output_fmt, ordered)
    finally:
        for path in (staged, ordered):
            discard(spark, path)


def _engineer(
    spark: SparkSession,
    sales: DataFrame,
    input_path: str,
    output_path: str,
    cfg: Config,
    product_id: str | None,
    series_cols: Sequence[str],
    output_fmt: str,
    ordered: str,
) -> DataFrame:
    features = feature_table(sales, cfg, product_id, series_cols, staging=ordered)
    write_table(features, output_path, output_fmt, sort_by=["series_id", "date"])
    names = feature_names(cfg)
    chosen = settings(cfg, "features")
    written = read_table(spark, output_path, output_fmt, features.schema)
    counted = written.agg(
        F.count(F.lit(1)).alias("engineered_records"),
        date_text(F.min("ds")).alias("start_date"),
        date_text(F.max("ds")).alias("end_date"),
    )
    row = counted.select(
        F.lit(input_path).alias("input_path"),
        F.lit(output_path).alias("output_path"),
        sales.agg(F.count(F.lit(1))).scalar().alias("original_records"),
        "engineered_records",
        F.lit(product_id).cast("string").alias("product_filter"),
        F.array(*[F.lit(n) for n in names]).alias("features_added"),
        F.lit(len(names)).alias("num_features"),
        F.array(*[F.lit(n) for n in chosen["rolling_windows"]]).alias("rolling_windows"),
        F.array(*[F.lit(n) for n in chosen["lag_days"]]).alias("lag_days"),
        "start_date",
        "end_date",
        F.current_timestamp().alias("processed_at"),
    )
    return _kept(row)


def training_hash(features: DataFrame) -> str:
    """Fingerprint of what training reads: series, date and target.

    Sums of whole quantities are exact, so the same sales give the same text
    however the sums were split; other columns need not be that stable.
    """
    columns = [c for c in ("series_id", "ds", "y") if c in features.columns]
    return content_hash(features.select(*columns)).first()["data_hash"]


def _series(features: DataFrame) -> Column:
    return F.col("series_id") if "series_id" in features.columns else F.lit(ALL_PRODUCTS)


def series_hashes(features: DataFrame) -> DataFrame:
    """(series_id, series_hash): a fingerprint of what each series is trained on."""
    rows = features.select(_series(features).alias("series_id"), "ds", "y").where(F.col("ds").isNotNull())
    return content_hash(rows, by=["series_id"], length=32).withColumnRenamed("data_hash", "series_hash")


def _same_series(left: DataFrame, right: DataFrame) -> Column:
    return left["series_id"].eqNullSafe(right["series_id"])


def _unchanged(models: DataFrame, hashes: DataFrame, cfg: Config) -> DataFrame:
    """Fitted models whose rows, type and parameters are what would be fitted now."""
    model = settings(cfg, "model")
    wanted = parameter_columns(settings(cfg, "model.prophet"))
    same = (F.col("status") == "ok") & (F.col("model_type") == model["type"])
    for name, value in wanted.items():
        same = same & F.col(name).eqNullSafe(value)
    equal = _same_series(models, hashes) & (models["series_hash"] == hashes["series_hash"])
    return models.where(same).join(hashes, equal, "left_semi")


def model_rows(
    features: DataFrame,
    data_hash: str,
    cfg: Config = None,
    run_date: dt.date | None = None,
    created_at: dt.datetime | None = None,
) -> DataFrame:
    """Fitted model rows with version and training metadata."""
    model = settings(cfg, "model")
    version = model_version(data_hash, run_date or dt.date.today())
    created = F.lit(created_at) if created_at else F.current_timestamp()
    return fit(features, cfg).select(
        F.lit(version).alias("version"),
        created.cast("timestamp").alias("created_at"),
        F.lit(data_hash).alias("data_hash"),
        F.lit(model["type"]).alias("model_type"),
        F.lit(model["horizon_days"]).alias("horizon_days"),
        "*",
    )


def train_and_save_model(
    spark: SparkSession,
    data_path: str,
    models_path: str,
    cfg: Config = None,
    run_date: dt.date | None = None,
    created_at: dt.datetime | None = None,
    fmt: str | None = None,
    reuse: bool = False,
) -> DataFrame:
    """Fit every series of a feature table and add the models to the model table.

    Returns the metadata row. Series that could not be fitted are counted there
    and keep their message in the model table. With ``reuse``, series whose training
    rows and parameters are those of their newest model are not fitted again: the
    model is carried into the new version, and ``fitted_version`` says where it is from.
    """
    features = read_training(spark, data_path, fmt)
    data_hash = training_hash(features)
    run_date = run_date or dt.date.today()
    version = model_version(data_hash, run_date)
    hashes = series_hashes(features)
    before = latest_models(spark, models_path, missing="none") if reuse else None
    carried = None
    if before is not None and "series_hash" in before.columns:
        carried = _unchanged(before, hashes, cfg)
        series = carried.select("series_id")
        features = features.withColumn("series_id", _series(features))
        features = features.join(series, _same_series(features, series), "left_anti")
    fitted = model_rows(features, data_hash, cfg, run_date, created_at)
    rows = fitted.join(hashes, _same_series(fitted, hashes), "left").select(
        fitted["*"], "series_hash", F.lit(version).alias("fitted_version")
    )
    if carried is not None:
        # what the version states of itself is that of the new one
        own = {"version": F.lit(version), "data_hash": F.lit(data_hash)}
        own["created_at"] = (F.lit(created_at) if created_at else F.current_timestamp()).cast("timestamp")
        own["horizon_days"] = F.lit(settings(cfg, "model")["horizon_days"])
        rows = rows.unionByName(carried.withColumns(own).select(*rows.columns))
    write_models(rows, models_path, [version])
    written = models_by_version(spark, models_path, version)
    return written.groupBy(
        "version", "data_hash", "model_type", "horizon_days", "parameters"
    ).agg(
        F.max("created_at").alias("created_at"),
        round_half_even(F.sum("training_duration_sec")).alias("training_duration_sec"),
        F.sum("training_records").alias("training_records"),
        F.count(F.lit(1)).alias("series"),
        F.count_if(F.col("status") != "ok").alias("failed_series"),
        F.count_if(F.col("fitted_version") != F.col("version")).alias("reused_series"),
        date_text(F.min(F.element_at("history_ds", 1))).alias("start_date"),
        date_text(F.max(F.element_at("history_ds", -1))).alias("end_date"),
        F.lit(models_path).alias("models_path"),
    )


def forecast_rows(models: DataFrame, horizon_days: int, freq: str = "D") -> DataFrame:
    """Formatted forecast of every fitted series: history, then the horizon."""
    named = models.withColumnRenamed("version", "model_version")
    return format_forecast(predict(future_frame(named, horizon_days, freq)))


def generate_predictions(
    spark: SparkSession,
    models_path: str,
    output_path: str,
    cfg: Config = None,
    version: str | None = None,
    horizon_days: int | None = None,
    output_fmt: str = "parquet",
    freq: str = "D",
) -> DataFrame:
    """Forecast with the latest models, or with one version; returns metadata.

    ``horizon_days`` wins over the configuration; it counts steps of ``freq``: days
    (``D``), Sundays (``W``) or month ends (``M``). The statistics cover the
    horizon of every series. Series without a fitted model get no forecast; the
    metadata counts them, and lists the versions in use.
    """
    horizon = settings(cfg, "model")["horizon_days"] if horizon_days is None else horizon_days
    if version is None:
        models = latest_models(spark, models_path)
    else:
        models = models_by_version(spark, models_path, version)
    forecast = forecast_rows(models, horizon, freq)
    write_table(forecast, output_path, output_fmt, sort_by=["series_id", "ds"])
    written = read_table(spark, output_path, output_fmt, forecast.schema)
    counted = written.agg(
        F.max("model_version").alias("model_version"),
        F.sort_array(F.collect_set("model_version")).alias("model_versions"),
        F.count_distinct("series_id").alias("series"),
        F.count(F.lit(1)).alias("total_predictions"),
        date_text(F.min("ds")).alias("start_date"),
        date_text(F.max("ds")).alias("end_date"),
    )
    statistics = forecast_statistics(written, tail_rows=max(horizon, 1), series="series_id")
    unfitted = models.agg(F.count_if(~F.col("status").eqNullSafe("ok")).alias("unfitted_series"))
    return counted.select(
        "model_version",
        "model_versions",
        "series",
        unfitted.scalar().alias("unfitted_series"),
        F.lit(models_path).alias("models_path"),
        F.lit(output_path).alias("output_path"),
        F.lit(horizon).alias("horizon_days"),
        F.lit(freq).alias("freq"),
        "total_predictions",
        "start_date",
        "end_date",
        statistics.select(F.struct("*")).scalar().alias("forecast_statistics"),
        F.current_timestamp().alias("generated_at"),
    )
