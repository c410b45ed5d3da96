"""Row-ordered features: rolling means, lags, fills and last-n rows.

Windows count rows, not calendar days, and every group is ordered by date. Two
physical forms give the same answer:

* ``daily=True``: a group has at most one row per date (the output of
  ``daily_sales``). One window per group is bounded by the calendar, so the
  features are plain window expressions over a single sort.
* ``daily=False``: a group is raw rows and may hold a third of the table. Rows
  are dealt out by range and sorted, so a row's position is the number of rows in
  earlier partitions, a table with one row for each partition and group, and its
  place in its own. They are then cut into blocks of consecutive positions, and
  each block brings along the few rows before it that its windows reach back to.

On raw rows the order within a date is that of the row digest, which makes it
total: rows with equal digests are copies of each other. Copies are told apart by
their place in the source, so a group of copies is spread like any other rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from salescast.functions import round_half_even, row_digest
from salescast.sources.tables import new_folder, stage

BLOCK_ROWS = 1_000_000
_PLACE_BITS = 33  # of a row number: the place in the partition


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _all(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def rolling_name(target: str, window: int) -> str:
    return f"{target}_rolling_{window}d"


def lag_name(target: str, lag: int) -> str:
    return f"{target}_lag_{lag}d"


def _feature_columns(
    target: str, windows: Sequence[int], lags: Sequence[int], w: WindowSpec
) -> dict[str, Column]:
    """Rolling means (rounded to 2, at least one value) and lags over ``w``."""
    columns = {
        rolling_name(target, n): round_half_even(F.avg(target).over(w.rowsBetween(1 - n, 0)))
        for n in windows
    }
    columns.update({lag_name(target, k): F.lag(target, k).over(w) for k in lags})
    return columns


def _masked(columns: dict[str, Column], group: str | None) -> dict[str, Column]:
    """Rows outside every group (NULL key) get NULL features."""
    if group is None:
        return columns
    return {name: F.when(F.col(group).isNotNull(), c) for name, c in columns.items()}


def positioned(df: DataFrame, group: str | None, date: str, staging: str | None = None) -> DataFrame:
    """``df`` with ``_group`` (a struct, so NULL is a group) and ``_position``.

    Positions count from 0 within a group, by date (missing dates last) and then
    digest. The sorted rows are written to ``staging``, a new folder in the shared
    one unless given: from there on every reader sees the same order.
    """
    parts = shuffle_partitions(df)
    # dealt evenly first: the ranges are sampled, which reads and digests all rows once more
    keyed = df.repartition(parts).withColumns(
        {
            "_group": F.struct((F.col(group) if group else F.lit(True)).alias("key")),
            "_no_date": F.col(date).isNull(),
            "_digest": F.unhex(row_digest(df, df.columns)),
        }
    )
    # sorted first: a task that runs again numbers the copies of a row the same way
    numbered = keyed.sortWithinPartitions("_digest").withColumn("_source", F.monotonically_increasing_id())
    order = ["_group", "_no_date", F.col(f"`{date}`"), "_digest", "_source"]
    dealt = numbered.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    rows = dealt.drop("_no_date", "_digest", "_source").withColumn("_number", F.monotonically_increasing_id())
    rows = stage(rows, staging or new_folder(df.sparkSession))
    part = F.shiftright("_number", _PLACE_BITS).alias("_part")
    runs = rows.groupBy("_group", part).agg(F.min("_number").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("_group").orderBy("_part")
    shift = F.sum("_rows").over(earlier) - F.col("_rows") - F.col("_first")
    runs = runs.select("_group", "_part", shift.alias("_shift"))
    rows = rows.withColumn("_part", part).join(runs, ["_group", "_part"])
    return rows.withColumn("_position", F.col("_number") + F.col("_shift")).drop("_number", "_part", "_shift")


def _blocks(rows: DataFrame, reach: int, block_rows: int) -> DataFrame:
    """Rows by block: ``_block`` and ``_own`` (not a carried-in row)."""
    size = F.lit(block_rows)
    own = F.call_function("div", F.col("_position"), size)
    last = F.call_function("div", F.col("_position") + reach, size)
    return (
        rows.withColumn("_block", F.explode(F.sequence(own, last)))
        .withColumn("_own", F.col("_position") >= F.col("_block") * size)
        # a fixed number, as a block's work says little about its bytes
        .repartition(shuffle_partitions(rows), "_group", "_block")
    )


def _known_before(rows: DataFrame, target: str, reach: int, block_rows: int) -> DataFrame:
    """What fills need from beyond a block, one row for each block of a group.

    ``_before``: the last target that is not NULL before the rows carried into the
    block; ``_first_known`` and ``_first_position``: the group's first one;
    ``_group_rows``: the size of the group. Each block is summed up in two parts, the
    rows that the next block sees and those before them.
    """
    size = F.lit(block_rows)
    known = F.when(F.col(target).isNotNull(), F.col("_position"))
    parts = rows.groupBy(
        "_group",
        F.call_function("div", F.col("_position"), size).alias("_block"),
        (F.pmod("_position", size) >= block_rows - reach).alias("_late"),
    ).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.max_by(target, known).alias("_last"),
        F.min_by(F.struct(F.col(target).alias("value"), F.col("_position").alias("at")), known).alias("_first"),
    )
    order = Window.partitionBy("_group").orderBy("_block", "_late")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.first(F.when(F.col("_first.at").isNotNull(), F.col("_first")), True).over(whole)
    found = parts.select(
        "_group",
        "_block",
        "_late",
        # the part just before is what the block carries in
        F.last("_last", True).over(order.rowsBetween(Window.unboundedPreceding, -2)).alias("_before"),
        first.alias("_first"),
        F.sum("_rows").over(whole).alias("_group_rows"),
    )
    columns = ["_group", "_block", "_before", "_group_rows"]
    first_known = [F.col("_first.value").alias("_first_known"), F.col("_first.at").alias("_first_position")]
    return found.where("NOT _late").select(*columns, *first_known)


def _filled_columns(
    target: str, windows: Sequence[int], lags: Sequence[int], w: WindowSpec
) -> dict[str, Column]:
    """Rolling means and lags filled forward, then backward, from known targets.

    A filled lag is the last known target ``k`` rows up. A rolling mean without
    any target in reach repeats the last one that had some, whose only target
    was the last known one. What then remains precedes the first known target
    and takes the first value that the feature has, if it ever gets one.
    """
    plain = _feature_columns(target, windows, lags, w)
    first_known = F.col("_first_known")
    filled = {}
    for n in windows:
        name = rolling_name(target, n)
        filled[name] = F.coalesce(
            plain[name], round_half_even(F.col("_known")), round_half_even(first_known)
        )
    for k in lags:
        has_value = F.col("_first_position") + k < F.col("_group_rows")
        filled[lag_name(target, k)] = F.coalesce(
            F.lag("_known", k).over(w), F.when(has_value, first_known)
        )
    return filled


def ordered_features(
    df: DataFrame,
    target: str,
    windows: Sequence[int] = (),
    lags: Sequence[int] = (),
    group: str | None = None,
    date: str = "date",
    fill: bool = False,
    daily: bool = False,
    block_rows: int = BLOCK_ROWS,
    staging: str | None = None,
) -> DataFrame:
    """``df`` plus rolling means and lags of ``target``, optionally filled.

    ``group`` gives every group its own order; rows with a NULL group get NULL
    features. ``fill`` runs forward then backward over the added columns. Say
    ``daily=True`` only when a group has at most one row per date. Raw rows are
    staged on the way (see :func:`positioned`); whoever names the folder removes it.
    """
    features = [rolling_name(target, n) for n in windows] + [lag_name(target, k) for k in lags]
    if not features:
        return df
    if daily:
        keys = [group] if group else []
        order = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(date))
        added = df.withColumns(_masked(_feature_columns(target, windows, lags, order), group))
        return fill_features(added, features, group, date) if fill else added

    reach = max([n - 1 for n in windows] + [k for k in lags] + [1])
    block_rows = max(block_rows, 2 * reach)
    order = Window.partitionBy("_group", "_block").orderBy("_position")
    placed = positioned(df, group, date, staging)
    rows = _blocks(placed, reach, block_rows)
    if fill:
        rows = rows.join(_known_before(placed, target, reach, block_rows), ["_group", "_block"])
        so_far = order.rowsBetween(Window.unboundedPreceding, 0)
        known = F.coalesce(F.last(target, True).over(so_far), F.col("_before"))
        rows = rows.withColumn("_known", known)
        columns = _filled_columns(target, windows, lags, order)
    else:
        columns = _feature_columns(target, windows, lags, order)
    rows = rows.withColumns(_masked(columns, group)).where("_own")
    return rows.select(*_all(df), *features)


def add_rolling_features(
    df: DataFrame,
    target: str,
    windows: Sequence[int],
    group: str | None = None,
    date: str = "date",
    daily: bool = False,
) -> DataFrame:
    """Mean of the last ``w`` rows as ``{target}_rolling_{w}d``, NULLs skipped."""
    return ordered_features(df, target, windows=windows, group=group, date=date, daily=daily)


def add_lag_features(
    df: DataFrame,
    target: str,
    lags: Sequence[int],
    group: str | None = None,
    date: str = "date",
    daily: bool = False,
) -> DataFrame:
    """Value ``k`` rows earlier as ``{target}_lag_{k}d``."""
    return ordered_features(df, target, lags=lags, group=group, date=date, daily=daily)


def fill_features(
    df: DataFrame, features: Sequence[str], group: str | None = None, date: str = "date"
) -> DataFrame:
    """Forward fill, then backward fill, for groups with one row per date."""
    keys = [group] if group else []
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(date))
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    # what the forward fill leaves open precedes the first known value
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumns(
        {
            c: F.coalesce(F.last(c, True).over(so_far), F.first(c, True).over(whole))
            for c in features
        }
    )


def last_rows(
    df: DataFrame, n: int, date: str = "ds", series: str | None = None
) -> DataFrame:
    """The ``n`` latest rows, of the table or of every series."""
    if series is None:
        return df.orderBy(F.desc_nulls_first(date)).limit(n)
    latest = Window.partitionBy(series).orderBy(F.desc_nulls_first(date))
    return df.withColumn("_rank", F.row_number().over(latest)).where(f"_rank <= {n}").drop("_rank")
