"""Run summary over the stage metadata."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce
from itertools import groupby
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.config import settings

# Stages in run order and, per stage, the reported metric with
# the metadata expression it comes from. "rows_cleaned" counts removed rows.
STAGE_METRICS: dict[str, dict[str, str]] = {
    "extraction": {
        "records_extracted": "num_records",
        "products": "num_products",
        "start_date": "start_date",
        "end_date": "end_date",
    },
    "validation": {
        "checks_passed": "size(checks_passed)",
        "null_rate": "rint(metrics.overall_null_rate * 10000) / 10000",
        "rows_cleaned": "cleaning.rows_removed",
    },
    "feature_engineering": {
        "features_added": "num_features",
        "records_processed": "engineered_records",
    },
    "model_training": {
        "model_version": "version",
        "training_duration_sec": "training_duration_sec",
        "training_records": "training_records",
    },
    "forecasting": {
        "horizon_days": "horizon_days",
        "total_predictions": "total_predictions",
        "mean_forecast": "forecast_statistics.mean_forecast",
        "total_forecast": "forecast_statistics.total_forecast",
        "avg_confidence_width": "forecast_statistics.avg_confidence_width",
    },
}


def metric_array(stage: str) -> Column:
    """The reported metrics of one stage as an array of (position, metric, value text)."""

    def entry(position: int, metric: str, value: str) -> Column:
        return F.struct(
            F.lit(position).alias("position"),
            F.lit(metric).alias("metric"),
            F.expr(value).cast("string").alias("value"),
        )

    return F.array(*[entry(i, m, v) for i, (m, v) in enumerate(STAGE_METRICS[stage].items())])


def stage_metrics(metadata: DataFrame, stage: str) -> DataFrame:
    """The reported metrics of one stage: (stage, position, metric, value text)."""
    return metadata.select(F.lit(stage).alias("stage"), F.inline(metric_array(stage)))


def run_summary(
    spark: SparkSession, stages: Mapping[str, DataFrame | None], run_id: str
) -> DataFrame:
    """All stage metrics of a run; a stage that did not run has NULL values."""
    parts = []
    for stage, metrics in STAGE_METRICS.items():
        metadata = stages.get(stage)
        if metadata is None:
            nothing = spark.range(1)
            rows = [
                F.struct(
                    F.lit(stage).alias("stage"),
                    F.lit(i).alias("position"),
                    F.lit(metric).alias("metric"),
                    F.lit(None).cast("string").alias("value"),
                )
                for i, metric in enumerate(metrics)
            ]
            parts.append(nothing.select(F.inline(F.array(*rows))))
        else:
            parts.append(stage_metrics(metadata, stage))
    table = reduce(DataFrame.unionByName, parts)
    return table.select(F.lit(run_id).alias("run_id"), *table.columns)


def text_report(
    summary: DataFrame,
    execution_date: str,
    cfg: Mapping[str, Any] | None = None,
    completed_at: dt.datetime | None = None,
) -> str:
    """The run summary as an aligned text table, a block per stage.

    Whatever metrics the summary has are shown; those without a value are not.
    Reads the summary: one short row per metric.
    """
    rows = sorted(summary.collect(), key=lambda r: (list(STAGE_METRICS).index(r["stage"]), r["position"]))
    job = settings(cfg, "pipeline")
    ended = (completed_at or dt.datetime.now()).isoformat(timespec="seconds")
    run_id = rows[0]["run_id"] if rows else ""
    facts = {"job": f"{job['name']} {job['version']}", "run": run_id, "day": execution_date, "ended": ended}
    blocks = [[(name, value) for name, value in facts.items()]]
    for _, own in groupby(rows, key=lambda r: r["stage"]):
        own = list(own)
        shown = [(r["metric"], r["value"]) for r in own if r["value"] is not None]
        blocks.append([(f"[{own[0]['stage']}]", ""), *(shown or [("nothing reported", "")])])
    width = max(len(name) for block in blocks for name, _ in block)
    return "\n\n".join(
        "\n".join(f"{name:<{width}}  {value}".rstrip() for name, value in block) for block in blocks
    )
