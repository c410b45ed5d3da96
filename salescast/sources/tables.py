"""Stage tables on shared storage."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from salescast.operators.cleaning import sort_rows


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", sort_by: Sequence[str] = ()
) -> None:
    """Replace the table at ``path``; ``sort_by`` gives files in that order."""
    if sort_by:
        df = sort_rows(df, sort_by)
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        # cells as they are, with the white space around them
        kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        writer.options(header=True, escape='"', **kept).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format: {fmt}")


def read_table(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame:
    """Read back what :func:`write_table` wrote; from text, an empty cell is NULL."""
    if fmt == "csv":
        reader = spark.read.options(header=True, escape='"', multiLine=True, maxCharsPerColumn=-1)
        return reader.schema(schema).csv(path)
    return spark.read.parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """A folder that all executors share: that of ``spark.checkpoint.dir``.

    Where the setting is missing it is a folder in the warehouse, which is shared too
    unless it is a local path of the driver; on a cluster such a path is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
        if folder.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def new_folder(spark: SparkSession) -> str:
    """A path in the shared folder that nothing has written to."""
    return f"{shared_folder(spark)}/rows-{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet to ``path`` and read it back.

    For inputs that several passes read: it cuts the lineage, survives lost
    executors, and lets each pass read only its own columns.
    """
    write_table(df, path)
    return df.sparkSession.read.parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table that :func:`stage` wrote."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
