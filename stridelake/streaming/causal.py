"""The part of the sequence operators that needs no later rows, over a stream of frames."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def stream_events(
    frames: DataFrame, keys: list[str], order: str, mask: str, value: str, fps: float, idle_ms: int | None = None
) -> DataFrame:
    """Each frame with onset and offset of mask and the backward difference of value per second.

    The state of a sequence is its last frame. A micro-batch is sorted by `order`
    within a sequence; frames at or before the last one seen are dropped, as late
    ones or repeats. A null mask counts as false, and a difference to or from a
    null value is null. The first frame of a sequence has a difference of 0, and an
    onset if its mask holds. With idle_ms, a sequence without frames for so long
    of processing time is forgotten, and later ones of it start anew; without, its
    state stays.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        pdf = pd.concat(list(batches)).sort_values(order)
        seen = state.exists
        last, was, held = state.get if seen else (None, False, None)
        if seen:
            pdf = pdf[pdf[order] > last]
        pdf = pdf.drop_duplicates(order)
        rows = []
        for at, on, x in zip(pdf[order].tolist(), pdf[mask].fillna(False).tolist(), pdf[value].tolist(), strict=True):
            now = None if pd.isna(x) else float(x)
            rate = 0.0 if last is None else None if now is None or held is None else (now - held) * fps / (at - last)
            rows.append((*key, at, on and not was, was and not on, rate))
            last, was, held = at, bool(on), now
        if rows:
            state.update((last, was, held))
            if idle_ms:
                state.setTimeoutDuration(idle_ms)
            yield pd.DataFrame(rows, columns=[*keys, order, "onset", "offset", "rate"])

    kinds = ", ".join(f"`{k}` {frames.schema[k].dataType.simpleString()}" for k in keys)
    return (
        frames.select(*keys, order, mask, value)
        .groupBy(*keys)
        .applyInPandasWithState(
            run,
            f"{kinds}, `{order}` long, onset boolean, offset boolean, rate double",
            "last long, was boolean, held double",
            "append",
            GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout,
        )
    )
