"""Cursor-driven event detection inside one sequence, run by Spark per sequence."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from stridelake.operators.sequences import Sequence


@dataclass(frozen=True)
class Crossings:
    """Frames at which a series passes a threshold; the frame itself must be allowed, the one before need not be."""

    values: np.ndarray
    allowed: np.ndarray | None = None

    def frames(self, threshold: float, up: bool) -> np.ndarray:
        before, here = self.values[:-1], self.values[1:]
        passed = (before < threshold) & (here >= threshold) if up else (before > threshold) & (here <= threshold)
        at = np.flatnonzero(passed) + 1
        return at if self.allowed is None else at[self.allowed[at]]


def following(frames: np.ndarray, start: int) -> int | None:
    """The first of the sorted frames at or after start."""
    k = int(np.searchsorted(frames, start))
    return int(frames[k]) if k < len(frames) else None


def climb(values: np.ndarray, at: int, step: int, rising: bool) -> int:
    """Where a strictly monotone walk from `at` in direction `step` ends; rising says what its values do."""
    while 0 <= at + step < len(values):
        change = values[at + step] - values[at]
        if not (change > 0 if rising else change < 0):
            break
        at += step
    return at


def sit_stand_events(height: np.ndarray, high: float = 0.8, low: float = 0.2) -> list[tuple[str, int, int, int, int]]:
    """(kind, start, end, core start, core end) of descents and rises through both thresholds of normalised height.

    A core runs from one threshold to the other; the event reaches back and on to
    the extremes around it. The search goes on behind each event.
    """
    series = Crossings(height)
    starts = {"stand_to_sit": series.frames(high, False), "sit_to_stand": series.frames(low, True)}
    ends = {"stand_to_sit": series.frames(low, False), "sit_to_stand": series.frames(high, True)}
    found, cursor = [], 1
    while True:
        options = [(f, k) for k, kind in enumerate(starts) if (f := following(starts[kind], cursor)) is not None]
        if not options:
            return found
        core, k = min(options)
        kind = list(starts)[k]
        stop = following(ends[kind], core + 1)
        if stop is None:
            cursor = core + 1
            continue
        falls = kind == "stand_to_sit"
        start, end = climb(height, core, -1, falls), climb(height, stop, 1, not falls)
        found.append((kind, start, end, core, stop))
        cursor = end + 1


def at_turn_boundary(angle: float) -> bool:
    return 0 <= angle <= 5 or 175 <= angle <= 180


def turn_events(
    angle: np.ndarray,
    walk_speed: np.ndarray,
    turn_speed: np.ndarray,
    allowed: np.ndarray,
    near: float = 15.0,
    far: float = 165.0,
    walking: float = 0.05,
    still: float = 10.0,
) -> list[tuple[str, int, int, int, int]]:
    """(kind, start, end, core start, core end) of turns out (near to far) and back (far to near) inside allowed runs.

    A turn out must end in its run; a turn back that doesn't is cut at the run's
    end. The start moves to the nearest earlier frame of the run that walks faster
    than `walking`, the end to the first later one that turns no faster than
    `still` or lies at a boundary angle, if there is one. The search goes on behind
    the core, so events may overlap.
    """
    series = Crossings(angle, allowed)
    out_start, out_end = series.frames(near, True), series.frames(far, True)
    back_start, back_end = series.frames(far, False), series.frames(near, False)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], allowed.astype(np.int8), [0]])))
    found = []
    for first, last in zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True):
        cursor = first
        while cursor <= last:
            options = []
            core = following(out_start, max(cursor, 1))
            if core is not None and (stop := following(out_end, core + 1)) is not None and stop <= last:
                options.append((core, stop, "outward_turn"))
            core = following(back_start, max(cursor, 1))
            if core is not None and core <= last:
                stop = following(back_end, core + 1)
                options.append((core, last if stop is None or stop > last else stop, "return_turn"))
            if not options:
                break
            core, stop, kind = min(options)
            start, end = core, stop
            fast = np.flatnonzero(walk_speed[first:core] > walking)
            if len(fast):
                start = first + int(fast[-1])
            for frame in range(stop + 1, last + 1):
                if turn_speed[frame] <= still or at_turn_boundary(angle[frame]):
                    end = frame
                    break
            found.append((kind, start, end, core, stop))
            cursor = stop + 1
    return found


_EVENTS = "kind string, start int, end int, core_start int, core_end int"


def _frame(keys: pd.DataFrame, found: list[tuple[str, int, int, int, int]]) -> pd.DataFrame:
    out = pd.DataFrame(found, columns=["kind", "start", "end", "core_start", "core_end"])
    for k in reversed(keys.columns):
        out.insert(0, k, keys[k].iloc[0] if len(keys) else None)
    return out


def _kinds(df: DataFrame, seq: Sequence) -> str:
    return ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in seq.keys)


def detect_sit_stand(df: DataFrame, seq: Sequence, height: str) -> DataFrame:
    """Events of sit_stand_events as rows."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(seq.order)
        return _frame(pdf[list(seq.keys)], sit_stand_events(pdf[height].to_numpy(float)))

    return df.select(*seq.keys, seq.order, height).groupBy(*seq.keys).applyInPandas(run, f"{_kinds(df, seq)}, {_EVENTS}")


def detect_turns(df: DataFrame, seq: Sequence, angle: str, walk_speed: str, turn_speed: str, allowed: str) -> DataFrame:
    """Events of turn_events as rows."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(seq.order)
        found = turn_events(
            *(pdf[c].to_numpy(float) for c in (angle, walk_speed, turn_speed)), pdf[allowed].to_numpy(bool)
        )
        return _frame(pdf[list(seq.keys)], found)

    columns = [*seq.keys, seq.order, angle, walk_speed, turn_speed, allowed]
    return df.select(*columns).groupBy(*seq.keys).applyInPandas(run, f"{_kinds(df, seq)}, {_EVENTS}")
