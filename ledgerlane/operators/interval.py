"""Point-in-interval join, by days or by power-of-two blocks of time, whichever makes fewer rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import Literal, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.conditions import moment

# At most this many (interval, day) rows are broadcast: a handful of short columns each, about 200 bytes, so about 10 MB.
BROADCAST_DAYS = 50_000


class DaySpans(NamedTuple):
    """Valid intervals and the period they cover."""

    intervals: DataFrame
    start: str
    end: str
    earliest: datetime | None
    latest: datetime | None


def day_spans(intervals: DataFrame, start: str, end: str) -> DaySpans:
    """Prepare intervals for :func:`join_intervals`; an interval that ends before it starts contains nothing."""
    valid = intervals.where(F.col(start) <= F.col(end))
    earliest, latest = valid.agg(F.min(start), F.max(end)).first()
    return DaySpans(valid, start, end, earliest, latest)


def join_intervals(
    spans: DaySpans, points: DataFrame, keys: Sequence[str], at: str, by: Literal["auto", "days", "blocks"] = "auto"
) -> DataFrame:
    """Inner join of each point with the intervals of the same ``keys`` that contain it, both ends included.

    ``days`` lists an interval's days (:func:`_by_days`), ``blocks`` covers it with two blocks of time about as long as itself (:func:`_by_blocks`). The
    first makes a row per day of every interval and one per point, the second two per interval and one per point and block length in use.
    ``auto`` counts both and takes the smaller number, days if equal. The result is the same.

    Points outside the intervals' period are cut off at the scan, intervals are cut to the period of the points. All bounds and counts come from one-row
    queries, because the planner's own estimate ignores that a row may become many. No match comes twice.
    """
    near = F.lit(False) if spans.earliest is None else F.col(at).between(moment(spans.earliest), moment(spans.latest))
    dated = points.where(near)
    first, last, count = dated.agg(F.min(at), F.max(at), F.count("*")).first()
    start, end = F.col(spans.start), F.col(spans.end)
    begin, stop = (start, end) if first is None else (F.greatest(start, moment(first)), F.least(end, moment(last)))
    clipped = spans.intervals.where((begin <= stop) & F.lit(first is not None)).withColumns({"_begin": begin, "_stop": stop})
    days, rows, levels = clipped.agg(
        F.sum(F.datediff("_stop", "_begin") + 1), F.count("*"), F.collect_set(_level())
    ).first()
    if by == "auto":
        by = "blocks" if (days or 0) + count > 2 * rows + len(levels) * count else "days"
    if by == "days":
        dated, listed, key, amount = *_by_days(clipped, dated, at), days or 0
    else:
        dated, listed, key, amount = *_by_blocks(clipped, dated, at, sorted(levels)), 2 * rows
    listed = listed.drop("_begin", "_stop")
    listed = F.broadcast(listed) if amount <= BROADCAST_DAYS else listed.hint("merge")
    return dated.join(listed, [*keys, *key]).where(F.col(at).between(start, end)).drop(*key)


def _by_days(intervals: DataFrame, points: DataFrame, at: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """The day is one of the equality keys: a point has one day, so it meets only the intervals of that day, never all intervals of a busy key.

    Where the list is not broadcast it is a sort-merge join, in which the adaptive skew join splits a day of one key that holds a large share of the points.
    """
    days = F.sequence(F.to_date("_begin"), F.to_date("_stop"))
    return points.withColumn("_day", F.to_date(at)), intervals.withColumn("_day", F.explode(days)), ["_day"]


def _seconds(at: Column) -> Column:
    """Whole seconds of a zoneless time since 1970, without any time zone."""
    day = F.datediff(F.to_date(at), F.lit("1970-01-01").cast("date")).cast("long")
    return day * 86_400 + F.hour(at) * 3_600 + F.minute(at) * 60 + F.second(at)


def _level() -> Column:
    """The least n such that 2^n seconds are longer than the interval."""
    return F.length(F.bin(_seconds(F.col("_stop")) - _seconds(F.col("_begin")))).cast("int")


def _by_blocks(intervals: DataFrame, points: DataFrame, at: str, levels: list[int]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Time is cut into blocks of 2^n seconds; an interval touches at most two blocks of the n that suits its length.

    A point looks into its block of every n in use (at most some thirty), so it meets an interval once, and only intervals of its key that lie within
    twice their own length of it. An interval costs two rows whether it lasts seconds or years. Skewed blocks are split as skewed days are.
    """
    level = F.col("_level")

    def block(at: Column, level: Column) -> Column:
        return F.call_function("shiftright", _seconds(at), level)

    blocks = F.array_distinct(F.array(block(F.col("_begin"), level), block(F.col("_stop"), level)))
    covered = intervals.withColumn("_level", _level()).withColumn("_block", F.explode(blocks))
    looked = points.withColumn("_level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).withColumn("_block", block(F.col(at), level))
    return looked, covered, ["_level", "_block"]
