"""Representation: kinematics, heading, contacts, gait events, posture and quality of every frame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from stridelake.functions import vectors as V
from stridelake.functions.scalars import clip, frames_of
from stridelake.operators import sequences as S
from stridelake.operators.ordered import PLACE, Rows, atan2, euler_zyx_degrees, heading_degrees, in_order, placed
from stridelake.operators.sequences import Sequence

# Places of the joints in the skeleton of 24.
PELVIS, LEFT_HIP, RIGHT_HIP, LEFT_KNEE, RIGHT_KNEE, LEFT_ANKLE, RIGHT_ANKLE = 0, 1, 2, 4, 5, 7, 8
SPINE3, LEFT_FOOT, RIGHT_FOOT, NECK, HEAD = 9, 10, 11, 12, 15
LEFT_SHOULDER, RIGHT_SHOULDER, LEFT_WRIST, RIGHT_WRIST = 16, 17, 20, 21

# What a sequence's contacts are warned of; these join the reasons of its segments.
WARNINGS = [
    "At least one foot is missing contact onsets.", "Too few contact onsets were available for stable gait-event proxies.",
    "Low contact stability score (%.3f).",
]

MOTION = Sequence(("subset", "subject_id", "trial_id"))


@dataclass(frozen=True)
class RepresentConfig:
    heading_min_norm: float = 1e-5
    heading_min_speed: float = 0.03
    floor_percentile: float = 0.05
    contact_height: float = 0.08
    contact_speed: float = 0.30
    height_weight: float = 0.60
    speed_weight: float = 0.40
    contact_threshold: float = 0.50
    min_contact_sec: float = 0.08
    min_swing_sec: float = 0.08
    max_root_speed: float = 4.0
    max_foot_speed: float = 8.0


def contact_probability(clear: Column, speed: Column, cfg: RepresentConfig = RepresentConfig()) -> Column:
    """How likely a foot at this height above the floor and this speed bears weight, from 0 to 1."""
    low, slow = (1 - clip(x / most, 0.0, 1.0) for x, most in ((clear, cfg.contact_height), (speed, cfg.contact_speed)))
    return clip(cfg.height_weight * low + cfg.speed_weight * slow, 0.0, 1.0)


def steady_contacts(df: DataFrame, seq: Sequence, prob: Column, out: str, fps: float, cfg: RepresentConfig = RepresentConfig()) -> DataFrame:
    """df with the mask of contact: probable frames without the shortest runs, then without the shortest gaps."""
    df = df.withColumn("_mask", F.coalesce(prob >= cfg.contact_threshold, F.lit(False)))
    df = S.remove_short_true_runs(df, seq, "_mask", frames_of(cfg.min_contact_sec, fps), "_kept")
    return S.fill_short_false_runs(df, seq, "_kept", frames_of(cfg.min_swing_sec, fps), out).drop("_mask", "_kept")


def contact_stability(left: Column, right: Column, alternation: Column, left_strikes: Column, right_strikes: Column) -> Column:
    """Mean of both feet's duty scores, the share of alternating strikes (0 if unknown) and the balance of their numbers."""
    balance = 1 - F.abs(left_strikes - right_strikes) / F.greatest(left_strikes + right_strikes, F.lit(1))
    return (left + right + F.coalesce(alternation, F.lit(0.0)) + balance) / 4


#: Vectors of a frame that the signals are made of.
_POINTS = ["root_pos_m", "left_foot_pos_m", "right_foot_pos_m", "_across", "_trunk_raw", "_shoulders", "_left_support", "_right_support"]
_MOVED = ["root_velocity_mps", "root_acceleration_mps2", "left_foot_velocity_mps", "right_foot_velocity_mps", "heading_axis"]
_NUMBERS = [
    "floor_z", "root_speed_xy_mps", "left_foot_speed_mps", "right_foot_speed_mps", "heading_deg", "heading_unwrapped_deg", "yaw_rate_deg_s",
    "yaw_acceleration_deg_s2", "trunk_forward_flexion_deg", "trunk_lateral_lean_deg", "trunk_lean_angle_deg", "trunk_roll_deg", "trunk_pitch_deg",
    "trunk_yaw_deg", "left_foot_contact_prob", "right_foot_contact_prob",
]
_FLAGS = ["heading_source_valid", *[f"{s}_{n}" for s in ("left", "right") for n in ("foot_contact", "heel_strike", "toe_off")]]
_SIGNALS = StructType([
    *[StructField(f"_{n}_{c}", DoubleType()) for n in _MOVED for c in "xyz"], *[StructField(n, DoubleType()) for n in _NUMBERS],
    *[StructField(n, BooleanType()) for n in _FLAGS],
])


def _signals(fps: float, cfg: RepresentConfig) -> Callable[[Rows, list[np.ndarray]], list[np.ndarray]]:
    """What in_order() runs: _SIGNALS of the order and _POINTS."""

    def run(rows: Rows, columns: list[np.ndarray]) -> list[np.ndarray]:
        order, flat = columns[0], columns[1:]
        at = {n: tuple(flat[3 * k : 3 * k + 3]) for k, n in enumerate(_POINTS)}
        out, none = {}, np.zeros(len(order))
        rate = lambda point: tuple(rows.difference(c, fps) for c in point)
        moved = {"root_velocity_mps": rate(at["root_pos_m"])}
        moved["root_acceleration_mps2"] = rate(moved["root_velocity_mps"])
        vx, vy, _ = moved["root_velocity_mps"]
        out["root_speed_xy_mps"] = np.sqrt(vx * vx + vy * vy)
        for side in ("left", "right"):
            moved[f"{side}_foot_velocity_mps"] = rate(at[f"{side}_foot_pos_m"])
            out[f"{side}_foot_speed_mps"] = rows.norm(moved[f"{side}_foot_velocity_mps"])

        level = V.cross(at["_across"], at["_trunk_raw"])
        body, body_ok = rows.normalized((level[0], level[1], none), cfg.heading_min_norm)
        motion, motion_ok = rows.normalized((vx, vy, none), cfg.heading_min_speed)
        out["heading_source_valid"] = body_ok | motion_ok
        axis = tuple(np.where(~body_ok & motion_ok, m, b) for m, b in zip(motion, body, strict=True))
        heading = rows.filled(axis, out["heading_source_valid"], order, [1.0, 0.0, 0.0], cfg.heading_min_norm)
        moved["heading_axis"] = heading
        out["heading_deg"] = heading_degrees(heading)
        out["heading_unwrapped_deg"] = rows.unwrapped(out["heading_deg"])
        out["yaw_rate_deg_s"] = rows.difference(out["heading_unwrapped_deg"], fps)
        out["yaw_acceleration_deg_s2"] = rows.difference(out["yaw_rate_deg_s"], fps)
        out |= _trunk(rows, order, at["_trunk_raw"], at["_shoulders"], heading)

        supports = [at[f"_{side}_support"] for side in ("left", "right")]
        # The floor is a percentile over both feet's supports.
        (out["floor_z"],) = rows.percentiles([p[2] for p in supports], [cfg.floor_percentile])
        for side, point in zip(("left", "right"), supports, strict=True):
            vx, vy = (rows.difference(c, fps) for c in point[:2])
            clear = rows.greatest(point[2] - out["floor_z"], 0.0)
            low, slow = (1 - rows.clip(x / most, 0.0, 1.0) for x, most in ((clear, cfg.contact_height), (np.sqrt(vx * vx + vy * vy), cfg.contact_speed)))
            prob = rows.clip(cfg.height_weight * low + cfg.speed_weight * slow, 0.0, 1.0)
            mask = rows.steady(rows.at_least(prob, cfg.contact_threshold), frames_of(cfg.min_contact_sec, fps), True)
            mask = rows.steady(mask, frames_of(cfg.min_swing_sec, fps), False)
            before = rows.before(mask, False)
            out |= {f"{side}_foot_contact_prob": prob, f"{side}_foot_contact": mask, f"{side}_heel_strike": mask & ~before, f"{side}_toe_off": ~mask & before}
        return [*[c for n in _MOVED for c in moved[n]], *[out[n] for n in (*_NUMBERS, *_FLAGS)]]

    return run


def _trunk(rows: Rows, order: np.ndarray, raw: V.Vector, shoulders: V.Vector, heading: V.Vector) -> dict[str, np.ndarray]:
    trunk, _ = rows.normalized(raw)
    up = rows.clip(trunk[2], -1.0, 1.0)
    heading_left, _ = rows.normalized((-heading[1], heading[0], np.zeros(len(order))))
    out = {
        "trunk_forward_flexion_deg": np.degrees(atan2(V.dot(trunk, heading), up)),
        "trunk_lateral_lean_deg": np.degrees(atan2(V.dot(trunk, heading_left), up)), "trunk_lean_angle_deg": np.degrees(np.arccos(up)),
    }
    left, ok = rows.normalized(V.minus(shoulders, V.scaled(trunk, V.dot(shoulders, trunk))))
    left = rows.filled(left, ok, order, [0.0, 1.0, 0.0])
    forward, ok = rows.normalized(V.cross(left, trunk))
    forward = rows.filled(forward, ok, order, [1.0, 0.0, 0.0])
    left, _ = rows.normalized(V.cross(trunk, forward))
    angles = euler_zyx_degrees(rows, V.transposed((forward, left, trunk)))
    return out | {f"trunk_{name}_deg": angle for name, angle in zip(("roll", "pitch", "yaw"), angles, strict=True)}


def represent(
    canonical: DataFrame, fps: float, seq: Sequence = MOTION, cfg: RepresentConfig = RepresentConfig(), carry: bool = True, ordered: bool = False
) -> DataFrame:
    """One row per frame with every signal of the frame contract.

    canonical: keys, frame_index, joints_can (array of 24 structs x, y, z),
    trans_can (struct), and, where pelvis angles are wanted, pose_raw (array of 72)
    with r_global and r_total (3 x 3 arrays). All that depends on other frames is made
    by one function over whole sequences; the other columns of canonical stay beside it or are left
    out (carry=False). With ordered, the frames keep the numbers by which stages after this one
    find them in order. Sequences of other rates are handled by another call.
    """
    point = lambda k: V.joint("joints_can", k)
    at = lambda k: F.col("joints_can")[k]
    bad = F.exists("joints_can", lambda p: ~F.coalesce(F.abs(p["x"] + p["y"] + p["z"]) < float("inf"), F.lit(False)))
    shoulders = V.minus(point(LEFT_SHOULDER), point(RIGHT_SHOULDER))
    columns = {
        "time_s": F.col(seq.order) / fps, "root_pos_m": at(PELVIS), "left_foot_pos_m": at(LEFT_FOOT), "right_foot_pos_m": at(RIGHT_FOOT),
        "_across": V.packed(V.plus(V.minus(point(LEFT_HIP), point(RIGHT_HIP)), shoulders)),
        "_trunk_raw": V.packed(V.minus(point(NECK), point(PELVIS))), "_shoulders": V.packed(shoulders),
        "joint_nan_mask": F.coalesce(bad, F.lit(True)),
    }
    for side, foot, ankle in (("left", LEFT_FOOT, LEFT_ANKLE), ("right", RIGHT_FOOT, RIGHT_ANKLE)):
        columns[f"_{side}_support"] = F.when(point(foot)[2] <= point(ankle)[2], at(foot)).otherwise(at(ankle))
    if {"pose_raw", "r_global", "r_total"} <= set(canonical.columns):
        pose = tuple(F.col("pose_raw")[k].cast("double") for k in range(3))
        root = V.product(V.product(V.matrix_column("r_global"), V.matrix_column("r_total")), V.axis_angle_matrix(pose))
        columns |= {f"pelvis_{name}_deg": angle for name, angle in zip(("roll", "pitch", "yaw"), V.euler_zyx_degrees(root), strict=True)}
    place = [*seq.keys, seq.order]
    rest = [c for c in canonical.columns if (carry or c == PLACE) and c not in (*place, *columns, *_NUMBERS, *_FLAGS)]
    df = canonical.select(*place, *[column.alias(name) for name, column in columns.items()], *rest)
    df = placed(df, seq) if ordered else df
    df = in_order(df, seq, [seq.order, *[f"{n}.{c}" for n in _POINTS for c in "xyz"]], _signals(fps, cfg), _SIGNALS)
    df = df.withColumns({n: F.struct(*[F.col(f"_{n}_{c}").alias(c) for c in "xyz"]) for n in _MOVED}).drop(*[f"_{n}_{c}" for n in _MOVED for c in "xyz"])
    df = df.withColumns({"pelvis_height_m": F.col("root_pos_m.z"), "pelvis_vertical_velocity_mps": F.col("root_velocity_mps.z")})
    for side in ("left", "right"):
        sure = clip(2 * F.abs(F.col(f"{side}_foot_contact_prob") - cfg.contact_threshold), 0.0, 1.0)
        df = df.withColumns({
            f"{side}_foot_height_m": F.col(f"{side}_foot_pos_m.z"), f"{side}_gait_phase": F.col(f"{side}_foot_contact").cast("int"),
            f"_{side}_sure": sure,
        })
    df = df.withColumn("gait_phase_global", F.col("left_gait_phase") + 2 * F.col("right_gait_phase"))
    df = df.withColumn("contact_confidence", F.array("_left_sure", "_right_sure"))
    return _quality(df, cfg).drop(*[p for p in _POINTS if p[0] == "_"], "_left_sure", "_right_sure")


def _quality(df: DataFrame, cfg: RepresentConfig) -> DataFrame:
    signals = [
        "heading_deg", "heading_unwrapped_deg", "yaw_rate_deg_s", "yaw_acceleration_deg_s2", "left_foot_contact_prob",
        "right_foot_contact_prob", "trunk_forward_flexion_deg", "trunk_lateral_lean_deg", "trunk_lean_angle_deg",
        "trunk_roll_deg", "trunk_pitch_deg", "trunk_yaw_deg", "root_speed_xy_mps",
        *[c for c in ("pelvis_roll_deg", "pelvis_pitch_deg", "pelvis_yaw_deg") if c in df.columns],
    ]
    whole = ~F.col("joint_nan_mask")
    for name in signals:
        whole = whole & F.coalesce(F.abs(F.col(name)) < float("inf"), F.lit(False))
    outlier = (
        (F.col("root_speed_xy_mps") > cfg.max_root_speed)
        | (F.col("left_foot_speed_mps") > cfg.max_foot_speed)
        | (F.col("right_foot_speed_mps") > cfg.max_foot_speed)
    )
    df = df.withColumn("velocity_outlier_mask", F.coalesce(outlier, F.lit(False))).withColumn("_whole", whole)
    df = df.withColumn("valid_frame_mask", F.col("_whole") & ~F.col("velocity_outlier_mask") & F.col("heading_source_valid"))
    speed = F.least(
        1 - clip(F.col("root_speed_xy_mps") / cfg.max_root_speed, 0.0, 1.0),
        1 - clip(F.col("left_foot_speed_mps") / cfg.max_foot_speed, 0.0, 1.0),
        1 - clip(F.col("right_foot_speed_mps") / cfg.max_foot_speed, 0.0, 1.0),
    )
    score = (
        F.col("_whole").cast("double") + speed + F.col("heading_source_valid").cast("double")
        + (F.col("contact_confidence")[0] + F.col("contact_confidence")[1]) / 2
    ) / 4
    return df.withColumn("representation_quality_score", clip(score, 0.0, 1.0)).drop("_whole")


def gait_summary(frames: DataFrame, fps: float, seq: Sequence = MOTION) -> DataFrame:
    """Per sequence: contact ratios, strike counts, cadence, contact stability and the warnings that follow."""
    from stridelake.operators.aggregates import double_support_score

    left, right = double_support_score("left_foot_contact", "right_foot_contact")
    # Strikes follow each other by frame, left before right; those of a sequence are few, so one aggregate takes them along.
    hits = F.when(F.col("left_heel_strike") | F.col("right_heel_strike"), F.struct(seq.order, *[
        F.coalesce(F.col(f"{s}_heel_strike"), F.lit(False)).alias(s) for s in ("left", "right")
    ]))
    sides = F.flatten(F.transform(F.sort_array(F.collect_list(hits)), lambda h: F.array_compact(F.array(F.when(h["left"], 0), F.when(h["right"], 1)))))
    base = frames.groupBy(*seq.keys).agg(
        F.count("*").alias("frame_count"),
        F.avg(F.col("left_foot_contact").cast("double")).alias("left_contact_ratio"),
        F.avg(F.col("right_foot_contact").cast("double")).alias("right_contact_ratio"),
        F.count_if("left_heel_strike").alias("left_strikes"),
        F.count_if("right_heel_strike").alias("right_strikes"),
        left.alias("_left"),
        right.alias("_right"),
        sides.alias("_sides"),
    )
    known = F.greatest(F.size("_sides") - 1, F.lit(0))
    flips = F.zip_with(F.slice("_sides", F.lit(1), known), F.slice("_sides", F.lit(2), known), lambda a, b: (a != b).cast("int"))
    flips = F.aggregate(flips, F.lit(0), lambda total, x: total + x)
    base = base.withColumn("_alternation", F.try_divide(flips.cast("double"), known.cast("double")))
    steps = F.col("left_strikes") + F.col("right_strikes")
    stability = contact_stability(*(F.col(c) for c in ("_left", "_right", "_alternation", "left_strikes", "right_strikes")))
    base = base.withColumn("step_count", steps).withColumn("contact_stability_score", stability)
    base = base.withColumn("cadence_steps_per_min", steps / F.greatest(F.col("frame_count") / fps, F.lit(1e-6)) * 60)
    warnings = F.array_compact(
        F.array(
            F.when((F.col("left_strikes") < 1) | (F.col("right_strikes") < 1), WARNINGS[0]),
            F.when(steps < 2, WARNINGS[1]),
            F.when(stability < 0.45, F.format_string(WARNINGS[2], stability)),
        )
    )
    return base.withColumn("gait_warnings", warnings).drop("_left", "_right", "_alternation", "_sides")


def quality_metrics(frames: DataFrame, seq: Sequence = MOTION, cfg: RepresentConfig = RepresentConfig()) -> DataFrame:
    """Per sequence the counts, shares, means and extremes that describe how far its frames can be trusted."""
    share = lambda c: F.avg(F.col(c).cast("double")) if isinstance(c, str) else F.avg(c.cast("double"))
    whole = F.coalesce(F.abs(F.col("heading_deg") + F.col("trunk_lean_angle_deg") + F.col("root_speed_xy_mps")) < float("inf"), F.lit(False))
    slow = F.col("velocity_outlier_mask")
    sure = (F.col("contact_confidence")[0] + F.col("contact_confidence")[1]) / 2
    means = {
        "root_speed_xy_mean_mps": "root_speed_xy_mps", "left_foot_speed_mean_mps": "left_foot_speed_mps", "right_foot_speed_mean_mps": "right_foot_speed_mps",
        "trunk_forward_flexion_mean_deg": "trunk_forward_flexion_deg", "trunk_lateral_lean_mean_deg": "trunk_lateral_lean_deg",
        "trunk_lean_mean_deg": "trunk_lean_angle_deg", "representation_quality_score_mean": "representation_quality_score",
    }
    return frames.groupBy(*seq.keys).agg(
        F.count("*").alias("frame_count"), share("valid_frame_mask").alias("valid_frame_ratio"), F.count_if(~F.col("valid_frame_mask")).alias("num_invalid_frames"),
        share(whole & ~F.col("joint_nan_mask")).alias("finite_frame_ratio"), share(~slow).alias("speed_quality_ratio"), F.count_if(slow).alias("velocity_outlier_count"),
        F.count_if("joint_nan_mask").alias("joint_nan_frame_count"), share("heading_source_valid").alias("heading_source_valid_ratio"),
        F.avg(sure).alias("contact_confidence_mean"), F.max("root_speed_xy_mps").alias("root_speed_xy_max_mps"), F.first("floor_z").alias("floor_z_estimate_m"),
        share("left_foot_contact").alias("left_contact_ratio"), share("right_foot_contact").alias("right_contact_ratio"),
        share(F.col("gait_phase_global") == 3).alias("double_support_ratio"), share(F.col("gait_phase_global") == 0).alias("no_contact_ratio"),
        F.count_if("left_toe_off").alias("left_toe_off_count"), F.count_if("right_toe_off").alias("right_toe_off_count"),
        *[F.avg(c).alias(n) for n, c in means.items()],
    )


def strikes(frames: DataFrame, seq: Sequence, event: str = "heel_strike") -> DataFrame:
    """One row per strike (or toe_off): the frame's columns and side."""
    both = F.array_compact(F.array(*[F.when(F.col(f"{s}_{event}"), s) for s in ("left", "right")]))
    return frames.withColumn("side", F.explode(both))


def gait_events(frames: DataFrame, seq: Sequence = MOTION) -> DataFrame:
    """Timeline: keys, frame, side, event."""
    kinds = [(side, event) for event in ("heel_strike", "toe_off") for side in ("left", "right")]
    found = [F.when(F.col(f"{s}_{e}"), F.struct(F.lit(s).alias("side"), F.lit(e).alias("event"))) for s, e in kinds]
    df = frames.select(*seq.keys, F.col("frame_index").alias("frame"), F.explode(F.array_compact(F.array(*found))).alias("_found"))
    return df.select(*seq.keys, "frame", "_found.side", "_found.event")
