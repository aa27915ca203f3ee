"""Joins of rows, events and intervals within sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stridelake.operators.sequences import Sequence


def frames_in_intervals(frames: DataFrame, intervals: DataFrame, seq: Sequence, start: str = "start", end: str = "end") -> DataFrame:
    """Frames with each interval that holds them (both ends included), as an equi join on the expanded interval.

    An interval becomes one row per frame, so the join shuffles by (keys, frame)
    and no sequence with many frames and intervals meets itself in full.
    """
    places = intervals.withColumn(seq.order, F.explode(F.sequence(start, end)))
    return frames.join(places, [*seq.keys, seq.order])


def first_after(df: DataFrame, seq: Sequence, starts: str, stops: str, out: str = "stop") -> DataFrame:
    """For each row where `starts` holds, the order of the first strictly later row where `stops` holds; none, no row."""
    found = df.withColumn(out, F.min(F.when(F.col(stops), F.col(seq.order))).over(seq.later))
    return found.where(F.col(starts) & F.col(out).isNotNull())


def trailing_run_before(frames: DataFrame, seq: Sequence, marks: str, mask: str, lookback: int, out: str) -> DataFrame:
    """For each row where `marks` holds, how many rows right before it, at most `lookback`, fulfil mask without a break.

    Null for the first row of a sequence, which has nothing before it.
    """
    place = F.last(F.when(~F.coalesce(F.col(mask), F.lit(False)), F.col(seq.order)), ignorenulls=True)
    before = seq.window.rowsBetween(Window.unboundedPreceding, -1)
    broken = place.over(before)
    first = F.min(seq.order).over(Window.partitionBy(*seq.keys))
    run = F.col(seq.order) - F.coalesce(broken + 1, F.col("_first"))
    df = frames.withColumn("_first", first).withColumn(out, F.least(run, F.lit(lookback)))
    df = df.withColumn(out, F.when(F.col(seq.order) > F.col("_first"), F.col(out)))
    return df.where(F.col(marks)).drop("_first")
