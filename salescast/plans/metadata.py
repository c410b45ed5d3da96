"""Stage metadata on storage, so that stages run on their own can be summarised.

One row per run and stage, in a folder of its own. A row is a single file that is
moved into place when it is complete, so a reader finds a stage whole or not at all,
and a stage that runs again replaces its own row only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.plans.report import STAGE_METRICS, metric_array
from salescast.sources.sales import open_table

#: ``details`` is the whole metadata row as JSON; ``metrics`` are those of the summary.
SCHEMA = (
    "recorded_at timestamp, metrics array<struct<position: int, metric: string, value: string>>, "
    "details string, run_id string, stage string"
)


def save_metadata(metadata: DataFrame, path: str, run_id: str, stage: str) -> None:
    """Store the one metadata row that a stage has returned.

    An earlier row of the same run and stage is replaced; all others stay.
    """
    if stage not in STAGE_METRICS:
        raise ValueError(f"unknown stage: {stage}")
    if not run_id:
        raise ValueError("run_id must not be empty")
    row = metadata.select(
        F.current_timestamp().alias("recorded_at"),
        metric_array(stage).alias("metrics"),
        F.to_json(F.struct("*")).alias("details"),
        F.lit(run_id).alias("run_id"),
        F.lit(stage).alias("stage"),
    )
    (
        row.coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id", "stage")
        .parquet(path)
    )


def load_metadata(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """The stored rows, of one run or of all; only the folders of that run are read."""
    stored = open_table(path, lambda: spark.read.schema(SCHEMA).parquet(path))
    return stored if run_id is None else stored.where(F.col("run_id") == run_id)


def stored_summary(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """As ``run_summary``, from stored rows; a stage without one has NULL values."""
    wanted = [
        F.struct(F.lit(stage).alias("stage"), F.lit(i).alias("position"), F.lit(metric).alias("metric"))
        for stage, metrics in STAGE_METRICS.items()
        for i, metric in enumerate(metrics)
    ]
    found = load_metadata(spark, path, run_id).select("stage", F.inline("metrics"))
    return (
        spark.range(1)
        .select(F.inline(F.array(*wanted)))
        .join(found.select("stage", "metric", "value"), ["stage", "metric"], "left")
        .select(F.lit(run_id).alias("run_id"), "stage", "position", "metric", "value")
    )
