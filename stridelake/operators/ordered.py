"""Numpy over whole sequences, in rows that stay where they are.

A window of Spark copies each row, and one from the end sorts all of them once
more, so a stage of many windows takes longer than what it computes. Here a stage is a
function over the columns of the sequences of a batch, that lie one after
another, and its results are columns beside the others. Rows are numbered by one
window, which deals and sorts them; stages after it find them in that order by
their numbers, without another.

Numbers come as doubles. What isn't known comes as NaN; a sequence that holds
a null in any of the inputs is `absent`, and NaN means null in it, else NaN is
a number above all others, as it is in Spark.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from stridelake.functions import vectors as V
from stridelake.operators.sequences import Sequence, gaussian_weights

#: The number of a row in its sequence, from 1, in rows that lie in order.
PLACE = "_place"


def placed(df: DataFrame, seq: Sequence) -> DataFrame:
    """df in order, with PLACE, which holds until rows are dealt or sorted anew (in_order() raises an error then)."""
    return df if PLACE in df.columns else df.withColumn(PLACE, F.row_number().over(seq.window))


class Rows:
    """Where the sequences of a batch start and end, and what depends on that."""

    def __init__(self, place: np.ndarray, absent: np.ndarray | None = None) -> None:
        starts = np.flatnonzero(place == 1)
        ends = np.append(starts[1:], len(place))
        self.bounds = list(zip(starts.tolist(), ends.tolist(), strict=True))
        sizes = ends - starts
        self.at = np.arange(len(place))
        self.first, self.last = np.repeat(starts, sizes), np.repeat(ends - 1, sizes)
        self.starts, self.ends = self.at == self.first, self.at == self.last
        self.absent = absent if absent is not None else np.zeros(len(place), bool)
        self.whole = not self.absent.any()

    def above(self, x: np.ndarray, y: float) -> np.ndarray:
        return (x > y) | (np.isnan(x) & ~self.absent)

    def at_least(self, x: np.ndarray, y: float) -> np.ndarray:
        return (x >= y) | (np.isnan(x) & ~self.absent)

    def greatest(self, x: np.ndarray, y: float) -> np.ndarray:
        most = np.maximum(x, y)
        return most if self.whole else np.where(self.absent, np.fmax(x, y), most)

    def clip(self, x: np.ndarray, low: float, high: float) -> np.ndarray:
        kept = np.fmin(np.maximum(x, low), high)
        return kept if self.whole else np.where(self.absent & np.isnan(x), np.nan, kept)

    def before(self, x: np.ndarray, first) -> np.ndarray:
        """The value of the row before, `first` in first rows."""
        out = np.concatenate([x[:1], x[:-1]])
        out[self.starts] = first
        return out

    def difference(self, x: np.ndarray, fps: float) -> np.ndarray:
        """As sequences.finite_difference()."""
        if fps <= 0 or not len(x):
            return np.zeros(len(x))
        before, after = np.concatenate([x[:1], x[:-1]]), np.concatenate([x[1:], x[-1:]])
        out = (after - before) * fps / 2
        out = np.where(self.starts, (after - x) * fps, np.where(self.ends, (x - before) * fps, out))
        return np.where(self.starts & self.ends, 0.0, out)

    def norm(self, a: V.Vector) -> np.ndarray:
        return np.sqrt(V.dot(a, a))

    def normalized(self, a: V.Vector, eps: float = 1e-5) -> tuple[V.Vector, np.ndarray]:
        """As vectors.normalized()."""
        size = self.norm(a)
        return V.scaled(a, 1 / self.greatest(size, eps)), self.above(size, eps)

    def filled(self, axis: V.Vector, valid: np.ndarray, order: np.ndarray, other: list[float], eps: float = 1e-5) -> V.Vector:
        """Unit vectors; rows that aren't valid take the nearest valid one's, the earlier of two, or `other` where there is none."""
        if not valid.all():
            before = np.maximum.accumulate(np.where(valid, self.at, -1))
            after = np.minimum.accumulate(np.where(valid, self.at, len(valid))[::-1])[::-1]
            some, more = before >= self.first, after <= self.last
            before, after = np.where(some, before, self.at), np.where(more, after, self.at)
            near = np.where(some & (~more | (order - order[before] <= order[after] - order)), before, after)
            axis = tuple(np.where(some | more, x[near], o) for x, o in zip(axis, other, strict=True))
        if not self.whole:
            axis = tuple(np.where(self.absent & np.isnan(x), o, x) for x, o in zip(axis, other, strict=True))
        return self.normalized(axis, eps)[0]

    def unwrapped(self, x: np.ndarray) -> np.ndarray:
        """As sequences.unwrap_degrees()."""
        step = x - self.before(x, 0.0)
        turn = wrap_degrees(step)
        fix = np.where(np.abs(step) < 180, 0.0, np.where((turn == -180.0) & (step > 0), 180.0, turn) - step)
        fix[self.starts | (np.isnan(fix) & self.absent)] = 0.0
        total = np.zeros(len(x))
        for a, b in self.bounds:
            if fix[a:b].any():
                total[a:b] = np.cumsum(fix[a:b])
        return x + total

    def steady(self, mask: np.ndarray, least: int, short: bool) -> np.ndarray:
        """mask without runs of `short` of fewer than `least` rows."""
        edges = self.starts | (mask != np.concatenate([mask[:1], mask[:-1]]))
        run = np.cumsum(edges) - 1
        return mask ^ ((mask == short) & (np.bincount(run)[run] < least)) if len(mask) else mask

    def smoothed(self, x: np.ndarray, sigma: int) -> np.ndarray:
        """As sequences.gaussian_smooth(), term by term."""
        if sigma <= 0:
            return x
        weights = gaussian_weights(sigma)
        radius, total = len(weights) // 2, 0.0
        for k, weight in zip(range(-radius, radius + 1), weights, strict=True):
            here = x[np.clip(self.at + k, self.first, self.last)]
            if k and not self.whole:
                here = np.where(self.absent & np.isnan(here), x[self.first if k < 0 else self.last], here)
            total = total + here * weight
        return total

    def correlation(self, left: np.ndarray, right: np.ndarray, width: int) -> np.ndarray:
        """As sequences.rolling_correlation()."""
        half = max(width // 2, 1)
        known = [~(self.absent & np.isnan(x)) for x in (left, right)]
        both = known[0] & known[1]
        places = []
        for k in range(-half, half + 1):
            here = self.at + k
            inside = (here >= self.first) & (here <= self.last)
            places.append((np.where(inside, here, self.at), inside))
        total = lambda x, which: sum(np.where(inside & which[here], x[here], 0.0) for here, inside in places)
        rows = sum(inside.astype(int) for _, inside in places)
        n = [rows if self.whole else total(np.ones(len(left)), which) for which in (*known, both)]

        def spread(a: np.ndarray, b: np.ndarray, which: np.ndarray, count: np.ndarray) -> np.ndarray:
            mean_a, mean_b = total(a, which) / count, total(b, which) / count
            return sum(np.where(inside & which[here], (a[here] - mean_a) * (b[here] - mean_b), 0.0) for here, inside in places) / count

        scale = np.sqrt(spread(left, left, known[0], n[0])) * np.sqrt(spread(right, right, known[1], n[1]))
        least = np.maximum(np.minimum(width, self.last - self.first + 1) // 2, 3)
        out = np.where((rows >= least) & self.above(scale * rows, 1e-8), spread(left, right, both, n[2]) / scale, 0.0)
        return np.where(self.absent & np.isnan(out), 0.0, out)

    def percentiles(self, columns: list[np.ndarray], shares: list[float]) -> list[np.ndarray]:
        """For each share the percentile over all columns of a sequence, in each of its rows."""
        out = [np.full(len(self.at), np.nan) for _ in shares]
        for a, b in self.bounds:
            values = np.sort(np.concatenate([c[a:b] for c in columns]))
            if self.absent[a]:
                values = values[~np.isnan(values)]
            for result, share in zip(out, shares, strict=True):
                if len(values):
                    result[a:b] = percentile(values, share)
        return out


def percentile(values: np.ndarray, share: float) -> float:
    """Of sorted values, with linear interpolation as Spark does it."""
    place = (len(values) - 1) * share
    low, high = int(np.floor(place)), int(np.ceil(place))
    if low == high or values[low] == values[high]:
        return float(values[low])
    return float((high - place) * values[low] + (place - low) * values[high])


def wrap_degrees(x: np.ndarray) -> np.ndarray:
    """The same angle in [-180, 180)."""
    rest = np.fmod(x + 180.0, 360.0)
    return np.where(rest < 0, np.fmod(rest + 360.0, 360.0), rest) - 180.0


def heading_degrees(a: V.Vector) -> np.ndarray:
    return wrap_degrees(np.degrees(atan2(a[1], a[0])))


def atan2(y: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.arctan2(y + 0.0, x + 0.0)


def euler_zyx_degrees(rows: Rows, m: V.Matrix) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As vectors.euler_zyx_degrees()."""
    pitch = np.arcsin(rows.clip(-m[2][0], -1.0, 1.0))
    regular = rows.above(np.abs(np.cos(pitch)), 1e-6)
    roll = np.where(regular, atan2(m[2][1], m[2][2]), 0.0)
    yaw = np.where(regular, atan2(m[1][0], m[0][0]), atan2(-m[0][1], m[1][1]))
    return np.degrees(roll), np.degrees(pitch), np.degrees(yaw)


Run = Callable[[Rows, list[np.ndarray]], list]


def in_order(df: DataFrame, seq: Sequence, inputs: list[Column | str], run: Run, out: StructType) -> DataFrame:
    """df with the columns of out, which run makes of the inputs of whole sequences.

    run gets Rows and the inputs as doubles, and gives a numpy or Arrow array for each
    column. A sequence is held in memory while its rows come. PLACE stays if it was there.
    """
    kinds = [to_arrow_type(f.dataType) for f in out.fields]

    def made(parts: list[list[pa.Array]]) -> pa.Array:
        columns = [pa.chunked_array([p[k] for p in parts]) for k in range(len(parts[0]))]
        place = columns[0].to_numpy()
        rows = Rows(place)
        if any(c.null_count for c in columns[1:]):
            missing = np.logical_or.reduce([c.is_null().to_numpy() for c in columns[1:]])
            absent = np.zeros(len(place), bool)
            for a, b in rows.bounds:
                absent[a:b] = missing[a:b].any()
            rows = Rows(place, absent)
        with np.errstate(all="ignore"):
            results = run(rows, [c.to_numpy().astype(float, copy=False) for c in columns[1:]])
        arrays = []
        for result, kind in zip(results, kinds, strict=True):
            if isinstance(result, np.ndarray):
                null = None if rows.whole or kind != pa.float64() else np.isnan(result) & rows.absent
                result = pa.array(result, type=kind, mask=null)
            arrays.append(result)
        return pa.StructArray.from_arrays(arrays, names=out.names)

    def batches(parts: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        held, last = [], 0
        for part in parts:
            place = part[0].to_numpy()
            if not len(place):
                continue
            steps = np.diff(place, prepend=last)
            starts = np.flatnonzero(place == 1)
            if not (steps[place != 1] == 1).all() or (last == 0 and place[0] != 1):
                raise ValueError(f"rows of a sequence have been moved since they were numbered in {PLACE}")
            last = place[-1]
            if len(starts):
                cut = int(starts[-1])
                if cut:
                    held.append([c.slice(0, cut) for c in part])
                if held:
                    yield made(held)
                held = [[c.slice(cut) for c in part]]
            else:
                held.append(list(part))
        if held:
            yield made(held)

    # Not deterministic for the optimizer: a filter on what comes out must not take rows from what goes in.
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")  # that hints are better than a kind; hints of nested functions can't be read
        function = F.arrow_udf(batches, out, ArrowUDFType.SCALAR_ITER).asNondeterministic()
    kept = [c for c in df.columns if c not in out.names]
    df = placed(df, seq)
    values = [(F.col(c) if isinstance(c, str) else c).cast("double") for c in inputs]
    df = df.withColumn("_made", function(F.col(PLACE), *values))
    return df.select(*kept, *[F.col(f"_made.{n}").alias(n) for n in out.names])
