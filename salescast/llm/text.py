"""What the text operators share: word rules, batch slicing, shared-folder checkpoints."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.sources.tables import shared_folder

#: White space of every word rule here: space, tab, line feed, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Text with each run of white space as one space; NULL as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def words(text: Column) -> Column:
    """Array of words; NULL has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def row_key(text: Column, *others: Column) -> Column:
    """One string for rows that agree in their text and in other columns; NULL agrees with NULL.

    Only a NULL text is as an empty one. The length of each value is put before it.
    """
    values = [c.cast("string") for c in others]
    parts = [F.coalesce(F.concat(F.char_length(v), F.lit(" "), v), F.lit("-")) for v in values]
    return F.concat(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256), *parts)


def whole_row(docs: DataFrame) -> Column:
    """All columns as one struct ``row``, out of the way of the names a stage needs."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias("row")


def unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again."""
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def byte_words(raw: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text; ``bytes.split`` cuts at the same six characters."""
    return raw.split() if raw else []


def slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that one column's text stays near ``limit`` bytes.

    A row is never cut: a longer text comes alone.
    """
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            n = n or 0
            if i > start and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < len(sizes):
            yield batch.slice(start)


def raw_texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder, so lost executors cost no recomputation."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """As :func:`cut`, but as a Parquet table: for tables that compress well."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
