"""Scalar expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round_half_even(x: Column, scale: int = 2) -> Column:
    """Round doubles half to even, by scaling to whole numbers as NumPy does.

    Spark's ``round`` goes half-up, and ``bround`` rounds the decimal text: it
    makes 16.72 of 16.725, where NumPy has 1672.5000000000002 and makes 16.73.
    """
    unit = float(10**scale)
    return F.rint(x.cast("double") * unit) / unit


def clip_at_zero(x: Column) -> Column:
    """Negative values become 0; NULL stays NULL."""
    return F.when(x < 0, F.lit(0.0)).otherwise(x)


def null_if_nan(x: Column) -> Column:
    """NaN counts as missing everywhere in this library."""
    return F.when(~F.isnan(x), x)


def is_missing(df: DataFrame, name: str) -> Column:
    """Whether a column of ``df`` is NULL or, for floating point, NaN."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def date_text(x: Column) -> Column:
    return F.date_format(x, "yyyy-MM-dd")


def md5_prefix(text: Column, length: int = 8) -> Column:
    return F.substring(F.md5(text), 1, length)


def escaped_text(x: Column) -> Column:
    """Text of ``x`` that can be joined with ``|``; NULL becomes ``\\N``."""
    text = F.replace(x.cast("string"), F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("|"), F.lit("\\|"))
    return F.coalesce(text, F.lit("\\N"))


def plain_text(x: Column) -> Column:
    """Like :func:`escaped_text`, for types whose text has no ``|`` in it."""
    return F.coalesce(x.cast("string"), F.lit("\\N"))


def row_digest(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """MD5 of a row's values in the given column order.

    The separator is escaped inside strings, so two rows share a digest only
    when they hold the same values.
    """
    parts = []
    for name in columns or df.columns:
        is_string = isinstance(df.schema[name].dataType, T.StringType)
        parts.append((escaped_text if is_string else plain_text)(F.col(f"`{name}`")))
    return F.md5(F.concat_ws("|", *parts))
