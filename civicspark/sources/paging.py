"""Ordered, bounded reads of a request source.

The page transport of a remote API is not rebuilt; what the pages compute is:
a date-range predicate, newest-first order, page slices and a total limit.
Slices and limits select by rank without sorting the source: rows are counted
per day (where a day is crowded, per second), the counts tell which of them
hold the ranks (:func:`reach`), that bound goes into the scan, and only the rows
within it get their place in the newest-first order, by one range-partitioned
pass (:func:`newest_positions`). So no task holds more than its share of the
rows, whatever the offset or limit.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark.functions.columns import epoch_micros, parse_timestamp
from civicspark.operators.ranking import numbered
from civicspark.schema import KEY_COLUMN, MAX_BATCH_SIZE
from civicspark.session import tuning


def check_batch_size(batch_size: int) -> int:
    """Page size must lie in 1..1000."""
    if not 1 <= batch_size <= MAX_BATCH_SIZE:
        raise ValueError(f"batch_size must be between 1 and {MAX_BATCH_SIZE}, got {batch_size}")
    return batch_size


def _as_timestamp(df: DataFrame, column: str) -> Column:
    return parse_timestamp(F.col(column), df.schema[column].dataType)


def created_between(
    df: DataFrame, start_date: str | None = None, end_date: str | None = None, column: str = "created_date"
) -> DataFrame:
    """Rows created from ``start_date`` 00:00:00 up to ``end_date`` 23:59:59.

    Either bound may be omitted; with a bound, rows without a parseable time
    drop out. A text column is compared as text first: every accepted text
    starts with the ISO date, so these bounds follow from the parsed ones, and
    a Parquet source can skip row groups by them.
    """
    ts = _as_timestamp(df, column)
    is_text = isinstance(df.schema[column].dataType, T.StringType)
    cond = F.lit(True)
    # Bounds are zone-less timestamps built from text: no session or process
    # time zone takes part.
    if start_date:
        first = dt.date.fromisoformat(start_date)
        cond = cond & (ts >= F.lit(f"{first.isoformat()} 00:00:00").cast("timestamp_ntz"))
        if is_text:
            cond = (F.col(column) >= F.lit(first.isoformat())) & cond
    if end_date:
        last = dt.date.fromisoformat(end_date)
        cond = cond & (ts <= F.lit(f"{last.isoformat()} 23:59:59").cast("timestamp_ntz"))
        if is_text and last < dt.date.max:
            cond = (F.col(column) < F.lit((last + dt.timedelta(days=1)).isoformat())) & cond
    return df.where(cond) if (start_date or end_date) else df


POSITION = "_position"


_TIME = "_parsed_time"


def newest_first(df: DataFrame, column: str = "created_date", time: Column | None = None) -> list[Column]:
    """Sort order: newest first, then the key, then every other column.

    The trailing columns make the order total up to identical rows, so page
    slices never overlap or miss a row at a tie. ``time`` is the parsed
    ``column``, where the caller has it.
    """
    rest = [c for c in df.columns if c not in (KEY_COLUMN, column)]
    order = [(_as_timestamp(df, column) if time is None else time).desc_nulls_last()]
    if KEY_COLUMN in df.columns:
        order.append(F.col(KEY_COLUMN).asc_nulls_last())
    return order + [F.col(c).asc_nulls_last() for c in [column, *rest]]


def newest_positions(df: DataFrame, column: str = "created_date") -> DataFrame:
    """``df`` with ``_position`` (1-based) in newest-first order, from one range-partitioned pass.

    The time is parsed once a row: a sort would parse it at every comparison of
    rows of one time.
    """
    timed = df.withColumn(_TIME, _as_timestamp(df, column))
    return numbered(timed, newest_first(df, column, F.col(_TIME)), POSITION).drop(_TIME)


def _page(placed: DataFrame, first: int, last: int) -> DataFrame:
    """Positions first+1 .. last, sorted."""
    return placed.where((F.col(POSITION) > first) & (F.col(POSITION) <= last)).orderBy(POSITION).drop(POSITION)


#: Rows in reach of a slice, beyond its own, up to which they are sorted without a closer look.
SORT_ROWS = 100_000

_DAY_MICROS = 86_400_000_000


@dataclass(frozen=True)
class Reach:
    """Rows that can hold the ranks asked for: a condition, and how many newer rows there are."""

    condition: Column
    newer: int
    #: Condition of those newer rows.
    newer_condition: Column
    found: bool


def _units(ts: Column, micros: int) -> Column:
    """Whole units of time since 1970; rows without a time are null."""
    return F.floor(epoch_micros(ts) / micros).cast("bigint")


def _text_from(column: str, day: int) -> Column:
    return F.col(column) >= F.lit((dt.date(1970, 1, 1) + dt.timedelta(days=day)).isoformat())


def _within_days(df: DataFrame, column: str, first: int | None, last: int | None) -> Column:
    """Rows created on days ``first`` to ``last`` (since 1970); on a text column also as text, which a source can skip row groups by."""
    ts = _as_timestamp(df, column)
    day = _units(ts, _DAY_MICROS)
    cond = F.lit(True)
    is_text = isinstance(df.schema[column].dataType, T.StringType)
    low, high = (dt.date.min - dt.date(1970, 1, 1)).days, (dt.date.max - dt.date(1970, 1, 1)).days
    if first is not None:
        cond = day >= first
        if is_text and low <= first <= high:
            cond = _text_from(column, first) & cond
    if last is not None:
        cond = cond & (day <= last)
        if is_text and low <= last < high:
            cond = ~_text_from(column, last + 1) & cond
    return cond


def _unit_in_reach(counted: DataFrame, first: int, last: int):
    """Of ``(unit, n)``: the newest and oldest unit with a rank in first+1 .. last, rows before and rows in them.

    There is one row per unit of the calendar, so one task sums them up.
    """
    upto = F.sum("n").over(Window.orderBy(F.col("unit").desc_nulls_last()))
    placed = counted.select("unit", "n", upto.alias("upto"))
    inside = placed.where((F.col("upto") > first) & (F.col("upto") - F.col("n") < last))
    return inside.agg(
        F.max("unit").alias("newest"), F.min("unit").alias("oldest"), F.count_if(F.col("unit").isNull()).alias("unknown"),
        F.min(F.col("upto") - F.col("n")).alias("before"), F.sum("n").alias("rows"),
    ).first()


def reach(df: DataFrame, first: int, last: int, column: str = "created_date") -> Reach:
    """Which rows can hold the newest-first ranks first+1 .. last, found by counting.

    Rows are counted per day; the days that hold the ranks bound the rows.
    Where two days or less hold many more rows than asked for, their seconds
    are counted too. Only the creation time is read.
    """
    ts = _as_timestamp(df, column)
    day = _units(ts, _DAY_MICROS)
    found = _unit_in_reach(df.groupBy(day.alias("unit")).agg(F.count(F.lit(1)).alias("n")), first, last)
    if found["before"] is None:
        return Reach(F.lit(False), 0, F.lit(True), False)
    if found["unknown"]:  # rows without a time come last
        newest = found["newest"]
        cond = _within_days(df, column, None, newest) | ts.isNull() if newest is not None else ts.isNull()
        newer = _within_days(df, column, newest + 1, None) if newest is not None else ts.isNotNull()
        return Reach(cond, found["before"], newer, True)
    cond = _within_days(df, column, found["oldest"], found["newest"])
    newer_cond, newer = _within_days(df, column, found["newest"] + 1, None), found["before"]
    spare = found["rows"] - (last - first)
    if found["newest"] - found["oldest"] < 2 and spare > tuning(df.sparkSession, "sliceSortRows", SORT_ROWS):
        second = _units(ts, 1_000_000)
        counted = df.where(cond).groupBy(second.alias("unit")).agg(F.count(F.lit(1)).alias("n"))
        close = _unit_in_reach(counted, first - newer, last - newer)
        newer_cond = newer_cond | (cond & (second > close["newest"]))
        cond = cond & (second >= close["oldest"]) & (second <= close["newest"])
        newer += close["before"]
    return Reach(cond, newer, newer_cond, True)


def page_slice(df: DataFrame, offset: int, limit: int, column: str = "created_date") -> DataFrame:
    """Rows offset+1 .. offset+limit in newest-first order (S3), at most a page, sorted.

    Only the rows in :func:`reach` of the slice are sorted with their other columns.
    """
    check_batch_size(limit)
    if offset < 0:
        raise ValueError(f"offset must be >= 0, got {offset}")
    near = reach(df, offset, offset + limit, column)
    if not near.found:
        return df.limit(0)
    return _page(newest_positions(df.where(near.condition), column), offset - near.newer, offset + limit - near.newer)


def take_newest(df: DataFrame, total_limit: int | None, column: str = "created_date") -> DataFrame:
    """At most ``total_limit`` newest rows, in no particular order; everything when no limit is set.

    Rows newer than those in :func:`reach` of the last rank are taken unsorted.
    """
    if total_limit is None:
        return df
    if total_limit < 0:
        raise ValueError(f"total_limit must be >= 0, got {total_limit}")
    if total_limit == 0:
        return df.limit(0)
    last = reach(df, total_limit - 1, total_limit, column)
    if not last.found:  # there are fewer rows
        return df
    edge = newest_positions(df.where(last.condition), column).where(F.col(POSITION) <= total_limit - last.newer).drop(POSITION)
    return df.where(last.newer_condition).unionByName(edge)


def pages(df: DataFrame, batch_size: int, total_limit: int | None = None, column: str = "created_date"):
    """Yield newest-first pages of at most ``batch_size`` rows (S1 + S3 + S4).

    Ends after the last row or once ``total_limit`` rows were yielded (the last
    page shrinks to fit). The rows within the limit are placed once; a page is
    a filter over the written places. For a bulk read use :func:`take_newest`,
    which returns the union of these pages.
    """
    check_batch_size(batch_size)
    placed = newest_positions(take_newest(df, total_limit, column), column)
    n = placed.count()
    end = n if total_limit is None else min(n, total_limit)
    for offset in range(0, end, batch_size):
        yield _page(placed, offset, min(offset + batch_size, end))
