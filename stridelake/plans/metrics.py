"""Six frame curves of a labelled sequence."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stridelake.functions.scalars import finite, frames_of
from stridelake.operators.ordered import Rows, in_order
from stridelake.operators.sequences import Sequence
from stridelake.plans.represent import MOTION

CURVES = ["stability", "balance", "symmetry", "coordination", "mobility", "control"]


def frame_curves(frames: DataFrame, fps: float, seq: Sequence = MOTION, window_sec: float = 0.8) -> DataFrame:
    """Keys, frame_index, time_s and the six curves; pelvis_roll_deg may be missing, then balance is null."""
    width = max(frames_of(window_sec, fps), 7)

    def run(rows: Rows, columns: list[np.ndarray]) -> list[np.ndarray]:
        left, right, *moved = columns
        return [rows.correlation(left, right, width), rows.norm(tuple(rows.difference(c, fps) for c in moved))]

    moved = ["left_foot_speed_mps", "right_foot_speed_mps", *[f"root_acceleration_mps2.{c}" for c in "xyz"]]
    roll = F.abs("pelvis_roll_deg") if "pelvis_roll_deg" in frames.columns else F.lit(None).cast("double")
    frames = in_order(frames, seq, moved, run, StructType([StructField(n, DoubleType()) for n in ("coordination", "control")]))
    return frames.select(
        *seq.keys,
        "frame_index",
        "time_s",
        F.abs("trunk_lean_angle_deg").alias("stability"),
        roll.alias("balance"),
        F.abs(F.col("left_gait_phase") - F.col("right_gait_phase")).cast("double").alias("symmetry"),
        "coordination",
        F.col("root_speed_xy_mps").alias("mobility"),
        "control",
    )


def curve_summary(curves: DataFrame, seq: Sequence = MOTION) -> DataFrame:
    """Per sequence least, largest and mean finite value of each curve."""
    parts = []
    for name in CURVES:
        value = finite(name)
        parts += [F.min(value).alias(f"{name}_min"), F.max(value).alias(f"{name}_max"), F.avg(value).alias(f"{name}_mean")]
    return curves.groupBy(*seq.keys).agg(*parts)


def scene_bounds(frames: DataFrame, seq: Sequence = MOTION, margin: float = 0.0) -> DataFrame:
    """Per sequence a cube around all joints whose floor isn't below 0."""
    points = frames.select(*seq.keys, F.explode("joints_can").alias("p"))
    box = points.groupBy(*seq.keys).agg(*[f(f"p.{c}").alias(f"{n}_{c}") for c in "xyz" for n, f in (("min", F.min), ("max", F.max))])
    half = F.greatest(*[(F.col(f"max_{c}") - F.col(f"min_{c}")) / 2 for c in "xyz"]) + margin
    out = box.withColumn("half", half)
    for c in "xy":
        mid = (F.col(f"min_{c}") + F.col(f"max_{c}")) / 2
        out = out.withColumn(f"low_{c}", mid - F.col("half")).withColumn(f"high_{c}", mid + F.col("half"))
    out = out.withColumn("low_z", F.greatest(F.col("min_z"), F.lit(0.0))).withColumn("high_z", F.col("low_z") + 2 * F.col("half"))
    return out.select(*seq.keys, *[f"{n}_{c}" for c in "xyz" for n in ("low", "high")])
