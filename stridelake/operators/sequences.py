"""Operators on keyed, ordered rows.

All of them partition by the same keys and order, so a chain of them shares one
shuffle and one sort; a group is one sequence, whose length does not grow with the
number of sequences.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stridelake.functions.scalars import wrap_degrees, wrap_step


@dataclass(frozen=True)
class Sequence:
    """What names a sequence, and the column that orders its rows without ties."""

    keys: tuple[str, ...]
    order: str = "frame_index"

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(self.order)

    @property
    def so_far(self) -> WindowSpec:
        return self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    @property
    def backwards(self) -> WindowSpec:
        """From the end. What lies ahead of a row is taken from here, since a frame that reaches to the end is read anew for every row."""
        return Window.partitionBy(*self.keys).orderBy(F.desc(self.order))

    @property
    def onwards(self) -> WindowSpec:
        """This row and all later ones, the latest first."""
        return self.backwards.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    @property
    def later(self) -> WindowSpec:
        """All later rows, the latest first."""
        return self.backwards.rowsBetween(Window.unboundedPreceding, -1)

    @property
    def whole(self) -> WindowSpec:
        return self.window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def within(self, *more: str) -> Sequence:
        return Sequence((*self.keys, *more), self.order)


def with_frame_index(df: DataFrame, keys: tuple[str, ...], order: list[str], out: str = "frame_index") -> DataFrame:
    """Numbers from 0 in the given order."""
    return df.withColumn(out, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("int"))


def finite_difference(value: Column | str, seq: Sequence, fps: Column | float) -> Column:
    """Central difference per second, one-sided at the ends; 0 for a single row or fps <= 0."""
    value = F.col(value) if isinstance(value, str) else value
    fps = fps if isinstance(fps, Column) else F.lit(float(fps))
    before, after = F.lag(value).over(seq.window), F.lead(value).over(seq.window)
    first, last = F.lag(F.lit(1)).over(seq.window).isNull(), F.lead(F.lit(1)).over(seq.window).isNull()
    return (
        F.when((fps <= 0) | (first & last), F.lit(0.0))
        .when(first, (after - value) * fps)
        .when(last, (value - before) * fps)
        .otherwise((after - before) * fps / 2)
    )


def unwrap_degrees(df: DataFrame, seq: Sequence, value: str, out: str) -> DataFrame:
    """Angles made continuous: steps of half a turn or more are taken the other way round."""
    step = F.col(value) - F.lag(value).over(seq.window)
    df = df.withColumn("_unwrap_step", step)
    fix = F.when(F.abs("_unwrap_step") < 180, F.lit(0.0)).otherwise(wrap_step("_unwrap_step") - F.col("_unwrap_step"))
    df = df.withColumn("_unwrap_fix", F.coalesce(fix, F.lit(0.0)))
    return df.withColumn(out, F.col(value) + F.sum("_unwrap_fix").over(seq.so_far)).drop("_unwrap_step", "_unwrap_fix")


def nearest_valid_fill(
    df: DataFrame, seq: Sequence, values: list[str], valid: str, fallback: list[float] | None = None
) -> DataFrame:
    """Rows that aren't valid take the values of the nearest valid row, the earlier of two; the fallback if there is none."""
    place = F.when(F.col(valid), F.col(seq.order))
    df = df.withColumn("_before", F.last(place, ignorenulls=True).over(seq.so_far))
    df = df.withColumn("_after", F.last(place, ignorenulls=True).over(seq.onwards))
    pack = F.when(F.col(valid), F.struct(*values))
    df = df.withColumn("_left", F.last(pack, ignorenulls=True).over(seq.so_far))
    df = df.withColumn("_right", F.last(pack, ignorenulls=True).over(seq.onwards))
    earlier = F.col("_after").isNull() | (
        F.col(seq.order) - F.col("_before") <= F.col("_after") - F.col(seq.order)
    )
    near = F.when(F.col("_before").isNotNull() & earlier, F.col("_left")).otherwise(F.col("_right"))
    for k, name in enumerate(values):
        other = F.lit(fallback[k]) if fallback else F.lit(None).cast("double")
        df = df.withColumn(f"_v{k}", F.coalesce(near[name], other))
    for k, name in enumerate(values):
        df = df.withColumn(name, F.col(f"_v{k}")).drop(f"_v{k}")
    return df.drop("_before", "_after", "_left", "_right")


def island(df: DataFrame, seq: Sequence, value: str | Column, out: str) -> DataFrame:
    """Numbers runs of equal values (nulls are equal) from 0."""
    value = F.col(value) if isinstance(value, str) else value
    df = df.withColumn("_value", value)
    change = (~F.col("_value").eqNullSafe(F.lag("_value").over(seq.window))) & F.lag(F.lit(1)).over(seq.window).isNotNull()
    df = df.withColumn("_change", change.cast("int"))
    return df.withColumn(out, F.sum("_change").over(seq.so_far).cast("int")).drop("_value", "_change")


def runs(df: DataFrame, seq: Sequence, value: str) -> DataFrame:
    """One row per run of equal values: keys, run, value, start, end (both included) and length."""
    return (
        island(df, seq, value, "run")
        .groupBy(*seq.keys, "run")
        .agg(
            F.first(value).alias(value),
            F.min(seq.order).alias("start"),
            F.max(seq.order).alias("end"),
            F.count("*").alias("length"),
        )
    )


def true_runs(df: DataFrame, seq: Sequence, mask: str) -> DataFrame:
    return runs(df, seq, mask).where(F.col(mask)).drop(mask, "run")


#: Runs of up to so many rows are told from their neighbours alone.
NEAR = 8


def _short(df: DataFrame, seq: Sequence, mask: str, least: Column | int, short: bool, out: str) -> DataFrame:
    hit = F.col(mask) == F.lit(short)
    if isinstance(least, int) and least <= 1:
        return df.withColumn(out, F.col(mask))
    if isinstance(least, int) and least <= NEAR:
        # A row's run is long enough if one of the `least` stretches of that many rows around it lies in the run: rows needn't be sorted by runs.
        df = df.withColumn("_full", F.count(F.when(hit, 1)).over(seq.window.rowsBetween(1 - least, 0)) == least)
        flips = hit & ~F.max("_full").over(seq.window.rowsBetween(0, least - 1))
        return df.withColumn(out, F.when(flips, F.lit(not short)).otherwise(F.col(mask))).drop("_full")
    least = least if isinstance(least, Column) else F.lit(least)
    df = island(df, seq, mask, "_run")
    size = F.count("*").over(Window.partitionBy(*seq.keys, "_run"))
    flips = hit & (size < least)
    return df.withColumn(out, F.when(flips, F.lit(not short)).otherwise(F.col(mask))).drop("_run")


def remove_short_true_runs(df: DataFrame, seq: Sequence, mask: str, least: Column | int, out: str) -> DataFrame:
    return _short(df, seq, mask, least, True, out)


def fill_short_false_runs(df: DataFrame, seq: Sequence, mask: str, least: Column | int, out: str) -> DataFrame:
    return _short(df, seq, mask, least, False, out)


def mask_onsets(mask: str | Column, seq: Sequence) -> Column:
    mask = F.col(mask) if isinstance(mask, str) else mask
    return mask & ~F.coalesce(F.lag(mask).over(seq.window), F.lit(False))


def mask_offsets(mask: str | Column, seq: Sequence) -> Column:
    mask = F.col(mask) if isinstance(mask, str) else mask
    return ~mask & F.coalesce(F.lag(mask).over(seq.window), F.lit(False))


def supplied_or(mask: str | Column, fallback: str | Column, seq: Sequence) -> Column:
    """mask (null as false) in sequences that have one, that is a value in any row; else fallback (null as false)."""
    mask, fallback = (F.col(x) if isinstance(x, str) else x for x in (mask, fallback))
    given = F.count(mask).over(seq.whole) > 0
    return F.coalesce(F.when(given, mask).otherwise(fallback), F.lit(False))


def gaussian_weights(sigma: int, truncate: float = 4.0) -> list[float]:
    radius = int(truncate * sigma + 0.5)
    raw = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-radius, radius + 1)]
    total = sum(raw)
    return [w / total for w in raw]


def gaussian_smooth(value: str | Column, seq: Sequence, sigma: int) -> Column:
    """Gaussian mean over rows with the end values repeated beyond the ends; the value itself for sigma <= 0."""
    value = F.col(value) if isinstance(value, str) else value
    if sigma <= 0:
        return value
    weights = gaussian_weights(sigma)
    radius = len(weights) // 2
    first, last = F.first(value).over(seq.whole), F.last(value).over(seq.whole)
    terms = []
    for k, weight in zip(range(-radius, radius + 1), weights, strict=True):
        if k < 0:
            here = F.coalesce(F.lag(value, -k).over(seq.window), first)
        else:
            here = F.coalesce(F.lead(value, k).over(seq.window), last) if k else value
        terms.append(here * weight)
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def smoothed(df: DataFrame, seq: Sequence, columns: dict[str, tuple[str, int]]) -> DataFrame:
    """df with each named column as the Gaussian mean of another, (column, sigma), like gaussian_smooth.

    A sequence is smoothed in one piece, so wide kernels don't lengthen the plan.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(seq.order)
        for out, (name, sigma) in columns.items():
            values = table.column(name).to_numpy().astype(float)
            if sigma > 0 and len(values):
                weights = np.array(gaussian_weights(sigma))
                values = np.convolve(np.pad(values, len(weights) // 2, mode="edge"), weights, mode="valid")
            table = table.append_column(out, pa.array(values))
        return table

    more = [StructField(out, DoubleType()) for out in columns]
    return df.groupBy(*seq.keys).applyInArrow(run, StructType([*df.schema.fields, *more]))


def moving_average_zero_padded(value: str, seq: Sequence, width: int = 9) -> Column:
    """Sum over the centred box divided by its full width; the value itself in sequences shorter than the box."""
    half = width // 2
    box = F.sum(value).over(seq.window.rowsBetween(-half, half)) / width
    return F.when(F.count(F.lit(1)).over(seq.whole) < width, F.col(value)).otherwise(box)


def crossings(value: str, seq: Sequence, threshold: float, up: bool, allowed: Column | None = None) -> Column:
    """Whether the value passes the threshold at this row (never at the first); only this row must be allowed."""
    before, here = F.lag(value).over(seq.window), F.col(value)
    passed = (before < threshold) & (here >= threshold) if up else (before > threshold) & (here <= threshold)
    passed = F.coalesce(passed, F.lit(False))
    return passed if allowed is None else passed & allowed


def next_true(mask: str, seq: Sequence, strictly: bool = False) -> Column:
    """The order of the next row where mask holds, this one included unless strictly."""
    return F.min(F.when(F.col(mask), F.col(seq.order))).over(seq.later if strictly else seq.onwards)


def monotone_bounds(df: DataFrame, seq: Sequence, value: str, rising: bool, start: str, end: str) -> DataFrame:
    """Where the strictly monotone stretch around each row starts and ends."""
    step = F.col(value) - F.lag(value).over(seq.window)
    goes = F.coalesce(step > 0 if rising else step < 0, F.lit(False))
    df = df.withColumn("_break", (~goes).cast("int"))
    df = df.withColumn("_stretch", F.sum("_break").over(seq.so_far))
    stretch = Window.partitionBy(*seq.keys, "_stretch")
    df = df.withColumn(start, F.min(seq.order).over(stretch)).withColumn(end, F.max(seq.order).over(stretch))
    return df.drop("_break", "_stretch")


def rolling_correlation(left: str, right: str, seq: Sequence, width: int) -> Column:
    """Centred Pearson correlation, clipped at the ends; 0 with too few rows or without variance."""
    half = max(width // 2, 1)
    frame = seq.window.rowsBetween(-half, half)
    n = F.count(F.lit(1)).over(frame)
    total = F.count(F.lit(1)).over(seq.whole)
    least = F.greatest(F.floor(F.least(F.lit(width), total) / 2), F.lit(3))
    mean_l, mean_r = F.avg(left).over(frame), F.avg(right).over(frame)
    cov = F.covar_pop(left, right).over(frame)
    scale = F.stddev_pop(left).over(frame) * F.stddev_pop(right).over(frame)
    usable = (n >= least) & (scale * n > 1e-8) & mean_l.isNotNull() & mean_r.isNotNull()
    return F.coalesce(F.when(usable, F.try_divide(cov, scale)), F.lit(0.0))


def path_step(x: str, y: str, valid: str, seq: Sequence) -> Column:
    """Distance from the row before, null unless both rows are valid."""
    dx, dy = (F.col(c) - F.lag(c).over(seq.window) for c in (x, y))
    return F.when(F.col(valid) & F.lag(valid).over(seq.window), F.sqrt(dx * dx + dy * dy))


def longest_monotone_segment(df: DataFrame, seq: Sequence, value: str) -> DataFrame:
    """Per sequence the stretch of the smoothed value with the largest one-way displacement: start, end, displacement, sign.

    Steps within a quarter of the 20th percentile of step sizes count as level and
    may belong to stretches of either sign. Sequences without a stretch give the whole.
    """
    df = df.withColumn("_s", moving_average_zero_padded(value, seq))
    df = df.withColumn("_d", F.col("_s") - F.lag("_s").over(seq.window))
    eps = F.greatest(
        0.25 * F.percentile(F.abs("_d"), 0.2).over(Window.partitionBy(*seq.keys)), F.lit(1e-6)
    )
    df = df.withColumn("_sign", F.when(F.col("_d") > eps, 1).when(F.col("_d") < -eps, -1).when(F.col("_d").isNotNull(), 0))
    found = None
    for sign in (1, -1):
        # A step joins its row to the one before; stretches are runs of joined rows.
        part = df.withColumn("_cut", (~F.coalesce(F.col("_sign").isin(0, sign), F.lit(False))).cast("int"))
        part = part.withColumn("_no", F.sum("_cut").over(seq.so_far))
        part = part.groupBy(*seq.keys, "_no").agg(
            F.min(seq.order).alias("start"),
            F.max(seq.order).alias("end"),
            F.min_by("_s", seq.order).alias("_a"),
            F.max_by("_s", seq.order).alias("_b"),
        )
        part = part.select(
            *seq.keys, "start", "end", (F.col("_b") - F.col("_a")).alias("displacement"), F.lit(sign).alias("sign")
        ).where("end > start")
        found = part if found is None else found.union(part)
    best = F.max(
        F.struct(
            F.abs("displacement").alias("size"),
            (F.col("end") - F.col("start")).alias("length"),
            (-F.col("start")).alias("early"),
            "start", "end", "displacement", "sign",
        )
    )
    best = found.groupBy(*seq.keys).agg(best.alias("best")).select(*seq.keys, "best.start", "best.end", "best.displacement", "best.sign")
    whole = df.groupBy(*seq.keys).agg(
        F.min(seq.order).alias("_start"), F.max(seq.order).alias("_end"),
        F.min_by("_s", seq.order).alias("_a"), F.max_by("_s", seq.order).alias("_b"),
    )
    net = F.col("_b") - F.col("_a")
    return whole.join(best, list(seq.keys), "left").select(
        *seq.keys,
        F.coalesce("start", "_start").alias("start"),
        F.coalesce("end", "_end").alias("end"),
        F.coalesce("displacement", net).alias("displacement"),
        F.coalesce("sign", F.signum(net).cast("int")).alias("sign"),
    )
