"""The whole job: extract, clean, features, train, forecast, summarise."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from salescast.plans.metadata import save_metadata, stored_summary
from salescast.plans.report import run_summary, text_report
from salescast.plans.stages import (
    engineer_features,
    extract_data,
    generate_predictions,
    train_and_save_model,
    validate_and_clean_data,
)
from salescast.sources.sales import is_csv
from salescast.sources.tables import discard


@dataclass(frozen=True)
class Run:
    """Where the stage tables are, and what the run reported."""

    cleaned_path: str
    features_path: str
    models_path: str
    forecast_path: str
    summary: DataFrame
    report: str


def run_all(
    spark: SparkSession,
    raw_path: str,
    output_path: str,
    cfg: Mapping[str, Any] | None = None,
    run_id: str = "manual",
    run_date: dt.date | None = None,
    product_id: str | None = None,
    series_cols: Sequence[str] = (),
    fmt: str | None = None,
    metadata_path: str | None = None,
) -> Run:
    """Run the five stages in order under ``output_path``, on shared storage.

    Text input is parsed once, into a table there that is removed at the end. With
    ``metadata_path`` the metadata of each stage is stored there as soon as it has
    ended, under ``run_id``, and the summary is read from there.
    """
    run_date = run_date or dt.date.today()
    base = output_path.rstrip("/")
    cleaned, features = f"{base}/cleaned", f"{base}/features"
    models, forecast = f"{base}/models", f"{base}/forecast"
    parsed = f"{base}/parsed" if is_csv(raw_path, fmt) else None
    stages: dict[str, DataFrame] = {}

    def record(stage: str, metadata: DataFrame) -> None:
        stages[stage] = metadata
        if metadata_path is not None:
            save_metadata(metadata, metadata_path, run_id, stage)

    try:
        record("extraction", extract_data(spark, raw_path, cfg, fmt, parsed)[1])
        record("validation", validate_and_clean_data(
            spark, parsed or raw_path, cleaned, cfg, "parquet" if parsed else fmt
        ))
    finally:
        if parsed:
            discard(spark, parsed)
    record("feature_engineering", engineer_features(
        spark, cleaned, features, cfg, product_id, series_cols, fmt="parquet"
    ))
    record("model_training", train_and_save_model(spark, features, models, cfg, run_date))
    record("forecasting", generate_predictions(spark, models, forecast, cfg))
    if metadata_path is None:
        summary = run_summary(spark, stages, run_id)
    else:
        summary = stored_summary(spark, metadata_path, run_id)
    rows = spark.createDataFrame(summary.collect(), summary.schema)
    report = text_report(rows, run_date.isoformat(), cfg)
    return Run(cleaned, features, models, forecast, rows, report)
