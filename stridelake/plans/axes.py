"""Which raw axis of a sequence points forward, to the subject's left and up, and the rotation that follows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.functions import vectors as V
from stridelake.operators import aggregates as A
from stridelake.operators import sequences as S
from stridelake.operators.sequences import Sequence
from stridelake.plans import represent as R
from stridelake.plans.canonicalize import each_joint

AXES = "xyz"


@dataclass(frozen=True)
class AxisConfig:
    low: float = 0.05
    high: float = 0.95
    min_forward_margin: float = 0.05
    min_vertical_alignment: float = 0.55
    min_lateral_alignment: float = 0.55
    min_displacement: float = 0.10
    least_norm: float = 1e-8


def _ordered(values: list[Column]) -> Column:
    """Places of the values, largest first; of equals the later one."""
    pairs = F.array(*[F.struct(v.alias("value"), F.lit(k).alias("place")) for k, v in enumerate(values)])
    return F.transform(F.reverse(F.array_sort(pairs)), lambda p: p["place"])


def _picked(values: list[Column], place: Column) -> Column:
    return F.get(F.array(*values), place)


def _sign(value: Column) -> Column:
    return F.when(value >= 0, F.lit(1.0)).otherwise(F.lit(-1.0))


def axis_semantics(frames: DataFrame, seq: Sequence = R.MOTION, cfg: AxisConfig = AxisConfig()) -> DataFrame:
    """One row per sequence: the axes (0 to 2), their signs, how clear they are, warnings and r_total with rows forward, left, up.

    frames: keys, frame_index, joints_raw (array of 24 structs) and trans_raw
    (struct). Up is the dominant axis of the median from pelvis to head (or neck).
    Forward is the other axis with the larger robust range of the root, in the
    direction of the longest one-way displacement; where that gives a left-handed
    frame it is turned round.
    """
    point = lambda k: V.joint("joints_raw", k)
    lines = {
        "head": V.minus(point(R.HEAD), point(R.PELVIS)), "neck": V.minus(point(R.NECK), point(R.PELVIS)),
        "hips": V.minus(point(R.LEFT_HIP), point(R.RIGHT_HIP)),
    }
    root = V.unpacked("trans_raw")
    spread = frames.groupBy(*seq.keys).agg(
        *[A.robust_range(v, cfg.low, cfg.high).alias(f"robust_range_{c}") for c, v in zip(AXES, root, strict=True)],
        *[(F.max(v) - F.min(v)).alias(f"raw_range_{c}") for c, v in zip(AXES, root, strict=True)],
        *[F.median(v).alias(f"_{n}_{c}") for n, line in lines.items() for c, v in zip(AXES, line, strict=True)],
    )
    ranges = [F.col(f"robust_range_{c}") for c in AXES]
    part = lambda n: tuple(F.col(f"_{n}_{c}") for c in AXES)
    size = V.norm(part("head"))
    clear = F.coalesce((size >= cfg.least_norm) & (size < float("inf")), F.lit(False))
    df = spread.withColumn("vertical_source", F.when(clear, "pelvis_to_head").otherwise("pelvis_to_neck"))
    df = df.withColumn("_up", V.packed(V.chosen(clear, part("head"), part("neck")))).withColumn("_order", _ordered(ranges))
    up = list(V.unpacked("_up"))
    df = df.withColumn("vertical_axis", F.get(_ordered([F.abs(c) for c in up]), F.lit(0)))
    level = F.filter("_order", lambda k: k != F.col("vertical_axis"))
    df = df.withColumns({"forward_axis": F.get(level, F.lit(0)), "lateral_axis": F.get(level, F.lit(1)), "initial_forward_axis": F.get("_order", F.lit(0))})
    height, side = _picked(up, F.col("vertical_axis")), _picked(list(part("hips")), F.col("lateral_axis"))
    norm_up, norm_side = V.norm(tuple(up)), V.norm(part("hips"))
    first, second = _picked(ranges, F.col("forward_axis")), _picked(ranges, F.col("lateral_axis"))
    df = df.withColumns(
        {
            "vertical_sign": _sign(height),
            "vertical_alignment": F.when(norm_up > cfg.least_norm, F.abs(height) / norm_up).otherwise(F.lit(0.0)),
            "lateral_sign": _sign(side),
            "lateral_alignment": F.when(norm_side > cfg.least_norm, F.abs(side) / norm_side).otherwise(F.lit(0.0)),
            "forward_axis_margin": (first - second) / F.greatest(first, F.lit(cfg.least_norm)),
        }
    )
    keys = list(seq.keys)
    along = frames.join(df.select(*keys, "forward_axis").hint("merge"), keys).withColumn("_along", _picked(list(root), F.col("forward_axis")))
    path = S.longest_monotone_segment(along.select(*keys, seq.order, "_along"), seq, "_along")
    path = path.select(*keys, F.col("start").alias("segment_start"), F.col("end").alias("segment_end"), F.col("displacement").alias("segment_displacement"))
    df = df.join(path, keys).withColumn("segment_sign", _sign(F.col("segment_displacement")))
    # The rotation is a signed permutation, so its handedness is that of the permutation times the signs.
    turn = F.pmod(F.col("lateral_axis") - F.col("forward_axis"), F.lit(3)) == 1
    hand = F.when(turn, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.col("lateral_sign") * F.col("vertical_sign")
    df = df.withColumn("forward_sign", hand)
    row = lambda axis, sign: F.array(*[F.when(F.col(axis) == k, F.col(sign)).otherwise(F.lit(0.0)) for k in range(3)])
    flipped = F.col("forward_sign") != F.col("segment_sign")
    tests = [
        ("axis_conflict_resolved_by_vertical_priority", F.col("initial_forward_axis") == F.col("vertical_axis")),
        ("forward_sign_flipped_for_right_handed_frame", flipped),
        ("forward_axis_low_margin", F.col("forward_axis_margin") < cfg.min_forward_margin),
        ("vertical_axis_low_alignment", F.col("vertical_alignment") < cfg.min_vertical_alignment),
        ("lateral_axis_low_alignment", F.col("lateral_alignment") < cfg.min_lateral_alignment),
        ("forward_segment_displacement_small", F.abs("segment_displacement") < cfg.min_displacement),
    ]
    df = df.withColumn("r_total", F.array(row("forward_axis", "forward_sign"), row("lateral_axis", "lateral_sign"), row("vertical_axis", "vertical_sign")))
    df = df.withColumn("warnings", F.array_compact(F.array(*[F.when(t, n) for n, t in tests])))
    return df.drop("_up", "_order", *[f"_{n}_{c}" for n in lines for c in AXES])


def to_semantic_axes(frames: DataFrame, semantics: DataFrame, seq: Sequence = R.MOTION) -> DataFrame:
    """frames with joints_3d and trans_canonical, joints_raw and trans_raw turned by r_total."""
    df = frames.join(semantics.select(*seq.keys, "r_total").hint("merge"), list(seq.keys))
    r = V.matrix_column("r_total")
    moved = lambda p: V.packed(V.times(r, (p["x"], p["y"], p["z"])))
    return each_joint(df, "joints_raw", moved, "joints_3d").withColumn("trans_canonical", moved(F.col("trans_raw")))
