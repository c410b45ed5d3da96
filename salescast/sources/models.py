"""The model table: one row per version and series, partitioned by version.

Inside its folder, hidden from readers of the table, is an index: the narrow columns
of every row. The newest models are found there, and of the wide rows only the
versions in use are read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.sources.sales import open_table

# Fixed value: the start of every version text.
VERSION_PREFIX = "model_v"
#: Folder of the index; a name with this start is passed over by readers of the table.
INDEX = "_series"


def model_version(data_hash: str, run_date: dt.date) -> str:
    """``model_v<yyyymmdd>_<data hash>``: dated, and tied to its training data."""
    return f"{VERSION_PREFIX}{run_date:%Y%m%d}_{data_hash}"


def _replace_versions(rows: DataFrame, path: str) -> None:
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("version")
        .parquet(path)
    )


def _narrow(models: DataFrame) -> DataFrame:
    """What the choice of models looks at."""
    status = F.col("status") if "status" in models.columns else F.lit("ok")
    return models.select(
        "series_id", "created_at", status.alias("status"), F.col("version").cast("string").alias("version")
    )


def write_models(models: DataFrame, path: str, versions: Sequence[str] | None = None) -> None:
    """Add model rows; rows of the same version are replaced, others kept.

    ``versions`` are those in ``models``: then only they are indexed, else all are
    again. The index is read off the rows once they are written. When a write fails
    between the two, new versions are still found; a version that was replaced is
    judged by its earlier status and time until it is written again.
    """
    _replace_versions(models, path)
    names = {"series_id", "created_at", "status", "version"}
    schema = T.StructType([field for field in models.schema if field.name in names])
    written = models.sparkSession.read.schema(schema).parquet(path)
    if versions is not None:
        written = written.where(F.col("version").isin(list(versions)))
    _replace_versions(_narrow(written), f"{path}/{INDEX}")


def _read(spark: SparkSession, path: str) -> DataFrame:
    return open_table(path, lambda: spark.read.parquet(path))


def latest_models(
    spark: SparkSession, path: str, missing: str = "error"
) -> DataFrame | None:
    """The newest fitted model of every series, by creation time and then version.

    A series that was never fitted keeps its newest row, so it can be counted.
    Without any model: ``FileNotFoundError``, or None with ``missing="none"``.
    The choice is made on the index; the wide rows of the versions in use are joined.
    """
    if missing not in ("error", "none"):
        raise ValueError(f"unknown value for missing: {missing}")
    try:
        models = _read(spark, path)
    except FileNotFoundError as problem:
        if missing == "none":
            return None
        raise FileNotFoundError(f"No trained models found in {path}") from problem
    newest = _newest(_indexed(spark, path, models)).withColumnsRenamed(
        {"series_id": "_series_id", "version": "_version"}
    )
    # no more versions than the table has folders, which the driver lists anyway
    used = [r[0] for r in newest.select("_version").distinct().collect()]
    rows = models.where(F.col("version").isin(used))
    same = F.col("series_id").eqNullSafe(F.col("_series_id")) & (F.col("version") == F.col("_version"))
    return rows.join(newest, same, "left_semi")


def _indexed(spark: SparkSession, path: str, models: DataFrame) -> DataFrame:
    """The index, and the narrow columns of versions that were written without one."""
    place, schema = f"{path}/{INDEX}", _narrow(models).schema
    try:
        index = open_table(place, lambda: spark.read.schema(schema).parquet(place))
    except FileNotFoundError:
        return _narrow(models)
    known = [r[0] for r in index.select("version").distinct().collect()]
    return index.unionByName(_narrow(models.where(~F.col("version").isin(known))))


def _newest(models: DataFrame) -> DataFrame:
    """Of every series (series_id, created_at, version) of the model to use."""
    fitted = F.col("status") == "ok"
    return (
        _narrow(models)
        .groupBy("series_id")
        .agg(F.max(F.struct(fitted, "created_at", "version")).alias("newest"))
        .select("series_id", "newest.created_at", "newest.version")
    )


def newest_models(models: DataFrame) -> DataFrame:
    """Of every series the newest fitted model, or its newest row if none was fitted."""
    newest = _newest(models).select(F.struct("series_id", "created_at", "version").alias("_key"))
    # a struct key also matches the series without a name
    keyed = models.withColumn("_key", F.struct("series_id", "created_at", "version"))
    return keyed.join(newest, "_key", "left_semi").drop("_key")


def models_by_version(spark: SparkSession, path: str, version: str) -> DataFrame:
    """All series of one version; ``FileNotFoundError`` when there is none."""
    try:
        models = _read(spark, path)
    except FileNotFoundError as problem:
        raise FileNotFoundError(f"Model file not found: {version}") from problem
    chosen = models.where(F.col("version") == version)
    if chosen.isEmpty():
        raise FileNotFoundError(f"Model file not found: {version}")
    return chosen
