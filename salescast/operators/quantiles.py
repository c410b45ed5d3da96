"""Exact quantiles of whole columns without gathering a column in one task.

Spark's ``percentile`` merges one value-to-count map in a single final task,
and that map grows with the number of distinct values. Here values are counted
in bins whose number never decreases as the value grows, an ordinary partial
aggregate over a bounded number of groups. A running count over the bins tells
which bins hold a wanted rank, and only those are looked at again:

* first in bins of equal width on a logarithmic scale, the same for any data;
* then in ``SUB_BINS`` equal parts of each bin that is still open, again and
  again until each wanted rank is in a bin of one distinct value.

A bin with one distinct value settles its ranks at once, so a column of small
whole numbers costs one pass, and each further pass cuts the open rows by the
number of parts. Like ``approxQuantile`` this runs when called and hands plain
numbers to the driver: at most two bins per probability and column and pass,
whatever the size of the data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

# A first bin spans 1.6 % of a value. ln of the smallest double is about -745.
_LOG_SHIFT = 746.0
_BINS_PER_E = 64.0

SUB_BINS = 2048

_OPEN_SCHEMA = """
    name string, bin int, low double, high double, scale double, below bigint, ranks array<bigint>
"""


@dataclass(frozen=True)
class Quantiles:
    """``n`` values seen, their range, one quantile per probability and its two neighbours."""

    n: int
    low: float | None
    high: float | None
    q: tuple[float | None, ...]
    around: tuple[tuple[float, float], ...] = ()


def _log_bin(x: Column) -> Column:
    size = F.floor((F.ln(F.abs(x)) + _LOG_SHIFT) * _BINS_PER_E)
    return F.when(x == 0, F.lit(0).cast("bigint")).when(x < 0, -size).otherwise(size)


def _tall(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per non-missing value: (name, x)."""
    pairs = []
    for name in columns:
        pairs += [F.lit(name), F.col(name).cast("double")]
    values = df.select(F.stack(F.lit(len(columns)), *pairs).alias("name", "x"))
    return values.where(F.col("x").isNotNull() & ~F.isnan("x"))


def _counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows"),
        F.min("x").alias("low"),
        F.max("x").alias("high"),
    ]


def _with_ranks(bins: DataFrame, within: list[str], order: list[str]) -> list[Row]:
    """The bins that hold a wanted rank, with ``below`` = rows before the bin."""
    w = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    bins = bins.withColumn("last", F.col("below") + F.sum("rows").over(w))
    bins = bins.withColumn("below", F.col("last") - F.col("rows"))
    held = F.filter("ranks", lambda r: (r >= F.col("below")) & (r < F.col("last")))
    return bins.withColumn("ranks", held).where(F.size("ranks") > 0).collect()


def _first_pass(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> list[Row]:
    whole = Window.partitionBy("name")
    ranks = []
    for p in probabilities:
        position = F.lit(float(p)) * (F.col("total") - 1)
        ranks += [F.floor(position), F.ceil(position)]
    bins = (
        _tall(df, columns)
        .groupBy("name", _log_bin(F.col("x")).alias("number"))
        .agg(*_counts())
        .withColumn("total", F.sum("rows").over(whole))
        .withColumn("col_low", F.min("low").over(whole))
        .withColumn("col_high", F.max("high").over(whole))
        .withColumn("below", F.lit(0).cast("bigint"))
        .withColumn("ranks", F.array_distinct(F.array(*ranks)))
    )
    return _with_ranks(bins, ["name"], ["number"])


def _refine(df: DataFrame, open_bins: list[Row]) -> list[Row]:
    """Look once more into bins that hold several distinct values.

    Their ranges are filters on the plain columns, so a scan can skip data by
    them. The part number keeps the order of the values.
    """
    in_range = F.lit(False)
    for b in open_bins:
        in_range = in_range | F.col(b["name"]).between(b["low"], b["high"])
    columns = list(dict.fromkeys(b["name"] for b in open_bins))
    table = []
    for i, b in enumerate(open_bins):
        # halved when the width of the bin is beyond the largest double
        scale = 0.5 if math.isinf(b["high"] - b["low"]) else 1.0
        table.append(Row(b["name"], i, b["low"], b["high"], scale, b["below"], b["ranks"]))
    bins = df.sparkSession.createDataFrame(table, _OPEN_SCHEMA)
    bins = bins.withColumnsRenamed({"low": "bin_low", "high": "bin_high"})
    # a literal table of at most two bins per probability and column
    inside = _tall(df.where(in_range), columns).join(F.broadcast(bins), "name")
    inside = inside.where(F.col("x").between(F.col("bin_low"), F.col("bin_high")))
    start, end = F.col("bin_low") * F.col("scale"), F.col("bin_high") * F.col("scale")
    part = F.floor((F.col("x") * F.col("scale") - start) / (end - start) * SUB_BINS)
    counted = (
        inside.withColumn("part", part).groupBy("name", "bin", "below", "ranks", "part").agg(*_counts())
    )
    return _with_ranks(counted, ["bin"], ["part"])


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[str, Quantiles]:
    """Exact quantiles by linear interpolation, NULL and NaN skipped."""
    at: dict[tuple[str, int], float] = {}
    found = _first_pass(df, columns, probabilities)
    spans = {r["name"]: (r["total"], r["col_low"], r["col_high"]) for r in found}
    while found:
        at.update({(r["name"], k): r["low"] for r in found for k in r["ranks"]})
        open_bins = [r for r in found if r["low"] < r["high"]]
        found = _refine(df, open_bins) if open_bins else []

    result = {}
    for name in columns:
        if name not in spans:
            result[name] = Quantiles(0, None, None, tuple(None for _ in probabilities))
            continue
        total, low, high = spans[name]
        q, around = [], []
        for p in probabilities:
            position = float(p) * (total - 1)
            left = at[name, math.floor(position)]
            right = at[name, math.ceil(position)]
            share = position - math.floor(position)
            around.append((left, right))
            q.append(left if left == right else left + (right - left) * share)
        result[name] = Quantiles(total, low, high, tuple(q), tuple(around))
    return result
