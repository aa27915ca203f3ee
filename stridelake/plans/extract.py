"""Extraction: features of walking and turning segments."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from stridelake.functions import vectors as V
from stridelake.functions.scalars import clip, frames_of, mean_of_known, normalized_asymmetry, safe_divide
from stridelake.functions.strings import sequence_stem
from stridelake.operators import ordered
from stridelake.operators.ordered import Rows
from stridelake.operators.sequences import Sequence
from stridelake.plans import represent as R

# Joints on the way from the root to the head.
CHAIN = [0, 3, 6, 9, 12, 15]


@dataclass(frozen=True)
class ExtractConfig:
    slow_speed: float = 0.10
    lookback_sec: float = 1.0
    onset_share: float = 0.10
    min_onset_angle: float = 15.0
    min_radius_angle: float = 5.0


#: Joints of the sagittal angles of a side: hip, knee, ankle, foot, shoulder, wrist.
LIMBS = {
    "left": (R.LEFT_HIP, R.LEFT_KNEE, R.LEFT_ANKLE, R.LEFT_FOOT, R.LEFT_SHOULDER, R.LEFT_WRIST),
    "right": (R.RIGHT_HIP, R.RIGHT_KNEE, R.RIGHT_ANKLE, R.RIGHT_FOOT, R.RIGHT_SHOULDER, R.RIGHT_WRIST),
}
JOINTS = sorted({R.PELVIS, R.NECK, *LIMBS["left"], *LIMBS["right"]})


def joint_angles(points: dict[int, V.Vector], least: float = 1e-8) -> dict[str, np.ndarray]:
    """Sagittal hip, knee, ankle and arm angles of both sides; NaN where they can't be told."""
    sagittal = lambda v: np.degrees(ordered.atan2(v[0], -v[2]))
    relative = lambda a, b: ordered.wrap_degrees(sagittal(a) - sagittal(b))
    between = lambda a, b: V.minus(points[a], points[b])
    norm = lambda v: np.sqrt(V.dot(v, v))
    down, out = between(R.PELVIS, R.NECK), {}
    for side, (hip, knee, ankle, foot, shoulder, wrist) in LIMBS.items():
        thigh, shank = between(hip, knee), between(ankle, knee)
        size = norm(thigh) * norm(shank)
        bend = np.degrees(np.arccos(np.clip(V.dot(thigh, shank) / np.maximum(size, least), -1.0, 1.0)))
        out[f"{side}_hip"] = relative(between(knee, hip), down)
        out[f"{side}_knee"] = 180.0 - np.where(size >= least, bend, np.nan)
        out[f"{side}_ankle"] = relative(between(foot, ankle), between(knee, ankle))
        out[f"{side}_arm"] = relative(between(wrist, shoulder), down)
    return out


def rotations(v: np.ndarray, eps: float = 1e-8) -> np.ndarray:
    """Rotations by |v| radians about each v; the identity for angles up to eps."""
    angle = np.linalg.norm(v, axis=1)
    a = v / np.maximum(angle, eps)[:, None]
    skew = np.zeros((len(v), 3, 3))
    for i, j, k in ((0, 1, 2), (1, 2, 0), (2, 0, 1)):
        skew[:, i, j], skew[:, j, i] = -a[:, k], a[:, k]
    c, s = np.cos(angle)[:, None, None], np.sin(angle)[:, None, None]
    out = a[:, :, None] * a[:, None, :] * (1 - c) + np.eye(3) * c + skew * s
    return np.where((angle > eps)[:, None, None], out, np.eye(3))


def pose_yaws(frames: DataFrame, seq: Sequence = R.MOTION) -> DataFrame:
    """Frames with unwrapped yaw of pelvis, trunk and head in place of pose_raw, r_global and r_total, none of which may be null."""
    names = {0: "pelvis", 9: "trunk", 15: "head"}
    inputs = [F.col("pose_raw")[3 * joint + c] for joint in CHAIN for c in range(3)]
    inputs += [F.col(matrix)[i][k] for matrix in ("r_global", "r_total") for i in range(3) for k in range(3)]

    def run(rows: Rows, columns: list[np.ndarray]) -> list[np.ndarray]:
        pose = np.stack(columns[: 3 * len(CHAIN)], axis=1).reshape(-1, len(CHAIN), 3)
        around, total = (np.stack(columns[k : k + 9], axis=1).reshape(-1, 3, 3) for k in (3 * len(CHAIN), 3 * len(CHAIN) + 9))
        m, yaws = around @ total, []
        for k, joint in enumerate(CHAIN):
            m = m @ rotations(pose[:, k])
            if joint in names:
                level = np.abs(np.cos(np.arcsin(np.clip(-m[:, 2, 0], -1, 1)))) <= 1e-6
                yaw = np.where(level, np.arctan2(-m[:, 0, 1], m[:, 1, 1]), np.arctan2(m[:, 1, 0], m[:, 0, 0]))
                yaws.append(rows.unwrapped(np.degrees(yaw)))
        return yaws

    out = StructType([StructField(f"{n}_yaw_pose_deg", DoubleType()) for n in names.values()])
    return ordered.in_order(frames, seq, inputs, run, out).drop("pose_raw", "r_global", "r_total")


def event_gaps(events: DataFrame, keys: list[str], order: str, fps: float) -> DataFrame:
    """events(keys, order, side) with _t, seconds since the event before if that was of another side, and _s, since the last of its own."""
    everyone = Window.partitionBy(*keys).orderBy(order, "side")
    same = Window.partitionBy(*keys, "side").orderBy(order)
    gap = (F.col(order) - F.lag(order).over(everyone)) / fps
    events = events.withColumn("_t", F.when((F.col("side") != F.lag("side").over(everyone)) & (gap > 0), gap))
    return events.withColumn("_s", (F.col(order) - F.lag(order).over(same)) / fps)


def _range(values: np.ndarray, low: float = 0.05, high: float = 0.95) -> float:
    """As aggregates.robust_range()."""
    values = np.sort(values[np.isfinite(values)])
    return ordered.percentile(values, high) - ordered.percentile(values, low) if len(values) else np.nan


def _mean(values: np.ndarray) -> float:
    return float(values.mean()) if len(values) else np.nan


def _cv(values: np.ndarray) -> float:
    """As aggregates.cv_percent()."""
    values = values[np.isfinite(values)]
    mean = abs(_mean(values))
    return float(values.std()) / mean * 100 if mean >= 1e-8 else np.nan


def _gait(p: dict[str, np.ndarray], fps: float) -> dict[str, float]:
    """Of the frames of a segment: path, steps and how long they take; only frames that are valid count."""
    valid, order, out = p["valid_frame_mask"] > 0, p["order"], {}
    moved = np.sqrt(np.diff(p["x"]) ** 2 + np.diff(p["y"]) ** 2)[valid[1:] & valid[:-1]]
    out["path"] = float(moved.sum()) if len(moved) else np.nan
    pools, times = {n: [] for n in ("stance_sec", "swing_sec", "step_m", "stride_m", "reach_m", "stride_sec")}, {}
    for side, other in (("left", "right"), ("right", "left")):
        at, off = (np.flatnonzero((p[f"{side}_{n}"] > 0) & valid) for n in ("heel_strike", "toe_off"))
        on, up = order[at], order[off]
        later = lambda a, b: np.concatenate([b, [np.nan]])[np.searchsorted(b, a, side="right")] - a
        x, dx, dy = p[f"{side}_foot_x"][at], *(p[f"{side}_foot_{c}"][at] - p[f"{other}_foot_{c}"][at] for c in "xy")
        here = {
            "stance_sec": later(on, up) / fps, "swing_sec": later(up, on) / fps, "step_m": np.abs(dx), "stride_m": np.abs(np.diff(x)),
            "reach_m": np.sqrt(dx * dx + dy * dy), "stride_sec": np.diff(on) / fps,
        }
        for name, values in here.items():
            values = values[~np.isnan(values)]
            pools[name].append(values)
            out[f"{side}_{name}"] = _mean(values)
        times[side] = on
    out |= {name: _mean(np.concatenate(values)) for name, values in pools.items()}
    out["stride_cv"] = _cv(np.concatenate(pools["stride_sec"]))
    when, side = np.concatenate(list(times.values())), np.repeat([0, 1], [len(t) for t in times.values()])
    by = np.lexsort((side, when))
    gaps = np.diff(when[by]) / fps
    gaps = gaps[(np.diff(side[by]) != 0) & (gaps > 0)]
    return out | {"strikes": float(len(when)), "step_sec": _mean(gaps), "step_cv": _cv(gaps)}


def _per_segment(
    frames: DataFrame, chosen: DataFrame, label: str, fps: float, seq: Sequence, inputs: dict[str, Column], measure: Callable, names: list[str]
) -> DataFrame:
    """chosen with the columns that measure(segment's columns, gait, frames before) makes of the frames of its segments; what can't be computed is null.

    A segment's frames lie one after another, so they are measured where they are, and only the row of its start goes on.
    """
    nothing = F.lit(float("nan"))
    own = {
        **{f"{s}_{n}": F.col(f"{s}_{n}") for s in ("left", "right") for n in ("heel_strike", "toe_off")},
        **{f"{s}_foot_{c}": F.col(f"{s}_foot_pos_m.{c}") for s in ("left", "right") for c in "xy"},
        "valid_frame_mask": F.col("valid_frame_mask"), "order": F.col(seq.order), "x": F.col("root_pos_m.x"), "y": F.col("root_pos_m.y"),
        **{n: F.col(n) if n in frames.columns else nothing for n in ("trunk_yaw_deg", "pelvis_yaw_deg")},
    }
    columns = {"segment_no": F.col("segment_no"), "wanted": F.col("label") == label, **own, **inputs}
    read = list(columns)

    def run(rows: Rows, values: list[np.ndarray]) -> list[np.ndarray]:
        p = dict(zip(read, values, strict=True))
        edges = rows.starts | (p["segment_no"] != np.concatenate([p["segment_no"][:1], p["segment_no"][:-1]]))
        starts = np.flatnonzero(edges)
        parts = Rows(rows.at - np.repeat(starts, np.diff(np.append(starts, len(edges)))) + 1, rows.absent)
        for name in ("trunk_yaw_deg", "pelvis_yaw_deg"):
            p[name] = np.where(p["valid_frame_mask"] > 0, parts.unwrapped(p[name]), np.nan)
        out = {n: np.full(len(edges), np.nan) for n in names}
        begins = np.zeros(len(edges), bool)
        for a, b in parts.bounds:
            if p["wanted"][a] > 0:
                begins[a] = True
                part = {n: c[a:b] for n, c in p.items()}
                found = measure(part, _gait(part, fps), {n: c[rows.first[a] : a] for n, c in p.items()})
                for n in names:
                    out[n][a] = found[n]
        return [begins, *[pa.array(c, mask=np.isnan(c)) for c in out.values()]]

    keys = [*seq.keys, "segment_no"]
    made = StructType([StructField("_begins", BooleanType()), *[StructField(f"_{n}", DoubleType()) for n in names]])
    rows = ordered.in_order(frames, seq, list(columns.values()), run, made).where("_begins").select(*keys, *[f"_{n}" for n in names])
    return chosen.join(rows, keys)


_WALK = [
    "path", "strikes", "stance_sec", "swing_sec", "step_m", "stride_m", "step_sec", "step_cv", "stride_sec", "stride_cv", "double_percent", "double_sec",
    *[f"{s}_{n}_m" for n in ("step", "stride") for s in ("left", "right")], *[f"{s}_{n}" for s in ("left", "right") for n in ("hip", "knee", "ankle", "arm")],
    "flexion", "flexion_rom", "pelvis_rom", "sway",
]


def walk_features(frames: DataFrame, segments: DataFrame, fps: float, seq: Sequence = R.MOTION) -> DataFrame:
    """segments labelled walk that are used for extraction, with 38 features; what can't be computed is null.

    frames: representation rows with segment_no and label, and joints_can for the angles of limbs and the sway.
    """
    chosen = segments.where("label = 'walk' AND used_for_extraction")
    inputs = {"flexion": F.col("trunk_forward_flexion_deg"), "phase": F.col("gait_phase_global")}
    if "joints_can" in frames.columns:
        inputs |= {f"{k}{c}": F.col("joints_can")[k][c] for k in JOINTS for c in "xyz"}
    limbs = [f"{s}_{n}" for s in ("left", "right") for n in ("hip", "knee", "ankle", "arm")]

    def measure(p: dict[str, np.ndarray], gait: dict[str, float], before: dict[str, np.ndarray]) -> dict[str, float]:
        valid = p["valid_frame_mask"] > 0
        both = p["phase"] == 3
        edges = np.flatnonzero(np.diff(np.concatenate([[0], both.astype(np.int8), [0]])))
        flexion = p["flexion"][valid]
        out = gait | {
            "double_percent": float((both & valid).mean()) * 100, "double_sec": _mean(edges[1::2] - edges[::2]) / fps, "flexion": _mean(flexion),
            "flexion_rom": _range(flexion), "pelvis_rom": _range(p["pelvis_yaw_deg"]), "sway": np.nan, **dict.fromkeys(limbs, np.nan),
        }
        if f"{R.NECK}x" in p:
            angles = joint_angles({k: tuple(p[f"{k}{c}"] for c in "xyz") for k in JOINTS})
            out |= {n: _range(np.where(valid, angle, np.nan)) for n, angle in angles.items()}
            neck, n = p[f"{R.NECK}y"], len(valid)
            if n >= 2:
                away = neck - (neck[0] + (neck[-1] - neck[0]) * np.arange(n) / (n - 1))
                out["sway"] = float(away[~np.isnan(away)].std()) if not np.isnan(away).all() else np.nan
        return out

    out = _per_segment(frames, chosen, "walk", fps, seq, inputs, measure, _WALK)
    out = out.withColumn("gait_speed_mps", safe_divide("_path", "duration_sec"))
    out = out.withColumn("cadence_steps_per_min", safe_divide("_strikes", "duration_sec") * 60)
    renamed = {
        "step_time_mean_sec": "_step_sec", "stride_time_mean_sec": "_stride_sec", "step_time_variability_cv_percent": "_step_cv",
        "stride_time_variability_cv_percent": "_stride_cv", "stance_time_mean_sec": "_stance_sec", "swing_time_mean_sec": "_swing_sec",
        "double_support_percent": "_double_percent", "double_support_time_mean_sec": "_double_sec", "step_length_mean_m": "_step_m",
        "stride_length_mean_m": "_stride_m", **{f"{s}_{n}_length_mean_m": f"_{s}_{n}_m" for n in ("step", "stride") for s in ("left", "right")},
        "trunk_flexion_mean_deg": "_flexion", "trunk_flexion_rom_deg": "_flexion_rom", "pelvis_rotation_rom_deg": "_pelvis_rom", "trunk_ml_sway_m": "_sway",
    }
    out = out.withColumns({new: F.col(old) for new, old in renamed.items()})
    for name in ("step", "stride"):
        pair = [f"{side}_{name}_length_mean_m" for side in ("left", "right")]
        out = out.withColumn(f"{name}_length_asymmetry_percent", normalized_asymmetry(*pair))
    for name, label in (("hip", "hip_rom"), ("knee", "knee_rom"), ("ankle", "ankle_rom"), ("arm", "arm_swing_amplitude")):
        for side in ("left", "right"):
            out = out.withColumn(f"{side}_{label}_deg", F.col(f"_{side}_{name}"))
        pair = [f"{side}_{label}_deg" for side in ("left", "right")]
        out = out.withColumn(f"{label}_mean_deg", mean_of_known(*pair))
        short = "arm_swing" if name == "arm" else label
        out = out.withColumn(f"{short}_asymmetry_percent", normalized_asymmetry(*pair))
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def has_turned(name: str, part: Sequence, cfg: ExtractConfig = ExtractConfig()) -> Column:
    """Whether a yaw has moved by the given share of its total over a part; never where that is small."""
    first, last = F.first(name).over(part.whole), F.last(name).over(part.whole)
    total = F.abs(last - first)
    return (total >= cfg.min_onset_angle) & (F.abs(F.col(name) - first) >= cfg.onset_share * total)


_TURN = [
    "path", "strikes", "step_sec", "reach_m", "angle", "rate", "rate_max", "rate_cv", "trunk_rom", "pelvis_rom", "pelvis", "trunk", "head", "apart", "lean",
    "aside", "slow",
]


def turn_features(
    frames: DataFrame, segments: DataFrame, fps: float, seq: Sequence = R.MOTION, cfg: ExtractConfig = ExtractConfig()
) -> DataFrame:
    """segments labelled turn that are used for extraction, with 19 features; those of the head need pose_yaws().

    frames: representation rows with segment_no and label.
    """
    chosen = segments.where("label = 'turn' AND used_for_extraction")
    names = ("root_speed_xy_mps", "yaw_rate_deg_s", "heading_unwrapped_deg", "trunk_lateral_lean_deg", "time_s")
    posed = "head_yaw_pose_deg" in frames.columns
    inputs = {n: F.col(n) for n in (*names, *(f"{n}_yaw_pose_deg" for n in ("pelvis", "trunk", "head") if posed))}
    lookback = frames_of(cfg.lookback_sec, fps)

    def measure(p: dict[str, np.ndarray], gait: dict[str, float], before: dict[str, np.ndarray]) -> dict[str, float]:
        valid = p["valid_frame_mask"] > 0
        rate, heading = np.abs(p["yaw_rate_deg_s"][valid]), p["heading_unwrapped_deg"]
        slow = before["root_speed_xy_mps"] < cfg.slow_speed
        run = len(slow) if slow.all() else len(slow) - 1 - np.flatnonzero(~slow)[-1]
        out = gait | {
            "angle": abs(heading[-1] - heading[0]), "rate": _mean(rate), "rate_max": rate.max() if len(rate) else np.nan, "rate_cv": _cv(rate),
            "trunk_rom": _range(p["trunk_yaw_deg"]), "pelvis_rom": _range(p["pelvis_yaw_deg"]), "lean": _mean(np.abs(p["trunk_lateral_lean_deg"][valid])),
            "aside": _range(p["y"][valid]), "slow": min(run, lookback) / fps if len(slow) else np.nan,
            **dict.fromkeys(("pelvis", "trunk", "head", "apart"), np.nan),
        }
        if posed:
            yaws = {n: p[f"{n}_yaw_pose_deg"] for n in ("pelvis", "trunk", "head")}
            for name, yaw in yaws.items():
                total = abs(yaw[-1] - yaw[0])
                on = p["time_s"][(total >= cfg.min_onset_angle) & (np.abs(yaw - yaw[0]) >= cfg.onset_share * total)]
                out[name] = on.min() if len(on) else np.nan
            h, t, q = yaws["head"], yaws["trunk"], yaws["pelvis"]
            out["apart"] = _mean((np.abs(h - t) + np.abs(t - q) + np.abs(h - q)) / 3)
        return out

    out = _per_segment(frames, chosen, "turn", fps, seq, inputs, measure, _TURN)
    renamed = {
        "turn_angle_deg": "_angle", "mean_turn_angular_velocity_deg_s": "_rate", "peak_turn_angular_velocity_deg_s": "_rate_max",
        "turn_angular_velocity_variability_cv_percent": "_rate_cv", "mean_step_length_during_turn_m": "_reach_m", "trunk_yaw_rom_during_turn_deg": "_trunk_rom",
        "pelvis_yaw_rom_during_turn_deg": "_pelvis_rom", "trunk_lateral_lean_during_turn_deg": "_lean", "pelvis_ml_excursion_during_turn_m": "_aside",
        "pre_turn_hesitation_time_sec": "_slow", "turn_duration_sec": "duration_sec", "mean_step_time_during_turn_sec": "_step_sec",
    }
    out = out.withColumns({new: F.col(old) for new, old in renamed.items()}).withColumn("turn_step_count", F.col("_strikes").cast("long"))
    angle, path = F.col("turn_angle_deg"), F.col("_path")
    out = out.withColumn("turn_path_radius_m", F.when(angle >= cfg.min_radius_angle, safe_divide(path, F.radians(angle))))
    out = out.withColumn("turn_path_compactness_deg_per_m", F.when(path > 1e-8, safe_divide(angle, path)))
    out = out.withColumn("head_trunk_pelvis_reorientation_delay_sec", F.col("_head") - F.col("_pelvis"))
    out = out.withColumn("trunk_pelvis_reorientation_delay_sec", F.col("_trunk") - F.col("_pelvis"))
    out = out.withColumn("head_trunk_reorientation_delay_sec", F.col("_head") - F.col("_trunk"))
    bloc = clip(1 - safe_divide("_apart", angle), 0.0, 1.0)
    out = out.withColumn("en_bloc_index", F.when(angle >= cfg.min_onset_angle, bloc))
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def extraction_status(segments: DataFrame) -> DataFrame:
    status = F.when(~F.col("label").isin("walk", "turn"), "skipped_non_target_label").when(
        ~F.col("used_for_extraction"), "skipped_used_for_extraction_false"
    )
    return segments.withColumn("extraction_status", status.otherwise("included"))


# Why a feature is missing, by kind of segment; those of the head have another reason where there is no pose.
WALK_REASONS = {
    "step_time_mean_sec": "insufficient_alternating_heel_strikes",
    "stride_time_mean_sec": "insufficient_ipsilateral_heel_strikes",
    "stance_time_mean_sec": "insufficient_heel_strike_to_toe_off_pairs",
    "swing_time_mean_sec": "insufficient_toe_off_to_heel_strike_pairs",
    "double_support_time_mean_sec": "no_double_support_frames",
    "left_step_length_mean_m": "no_left_heel_strikes",
    "right_step_length_mean_m": "no_right_heel_strikes",
    "left_stride_length_mean_m": "insufficient_left_heel_strikes",
    "right_stride_length_mean_m": "insufficient_right_heel_strikes",
}
TURN_REASONS = {
    "mean_step_time_during_turn_sec": "insufficient_alternating_heel_strikes",
    "turn_path_radius_m": "turn_angle_below_radius_threshold_or_invalid_path",
    "mean_step_length_during_turn_m": "no_valid_heel_strikes",
    "head_trunk_pelvis_reorientation_delay_sec": "insufficient_turn_angle_for_reorientation_onset",
    "trunk_pelvis_reorientation_delay_sec": "insufficient_turn_angle_for_reorientation_onset",
    "head_trunk_reorientation_delay_sec": "insufficient_turn_angle_for_reorientation_onset",
    "en_bloc_index": "insufficient_turn_angle_for_en_bloc_index",
}
POSE_FEATURES = [n for n in TURN_REASONS if "reorientation" in n or n == "en_bloc_index"]
NO_POSE = "missing_pose_orientation_signals"
#: Missing together with another feature, for its reason.
ALONG = {
    "step_time_variability_cv_percent": "step_time_mean_sec",
    "stride_time_variability_cv_percent": "stride_time_mean_sec",
}
COMMON = [
    "sequence_name", "segment_id", "label", "start_frame", "end_frame", "start_time_sec", "end_time_sec", "duration_sec", "source_rule",
    "confidence", "quality_status", "quality_valid_frame_ratio", "quality_representation_score_mean", "quality_hesitation_overlap_ratio",
    "quality_reasons",
]


def missing_features(features: DataFrame, kind: str, posed: bool = True) -> DataFrame:
    """features of walking or turning with a map from those that are null to the reason; posed says whether there was a pose."""
    reasons = dict(WALK_REASONS if kind == "walk" else TURN_REASONS)
    if kind == "turn" and not posed:
        reasons |= dict.fromkeys(POSE_FEATURES, NO_POSE)
    entry = lambda name, test: F.when(F.col(test).isNull(), F.struct(F.lit(name).alias("key"), F.lit(reasons[test]).alias("value")))
    names = [(n, n) for n in reasons] + ([(n, o) for n, o in ALONG.items()] if kind == "walk" else [])
    return features.withColumn("missing_features", F.map_from_entries(F.array_compact(F.array(*[entry(n, t) for n, t in names]))))


def common_columns(features: DataFrame, seq: Sequence = R.MOTION) -> DataFrame:
    """features of segments with the columns that every feature table starts with, under their names."""
    subset, subject, trial = seq.keys
    renamed = {
        "quality_status": "status", "quality_valid_frame_ratio": "valid_frame_ratio",
        "quality_representation_score_mean": "representation_quality_score_mean",
        "quality_hesitation_overlap_ratio": "hesitation_overlap_ratio",
    }
    df = features.withColumns({n: F.col(o) for n, o in renamed.items()})
    df = df.withColumn("sequence_name", sequence_stem(subset, subject, trial)).withColumn("quality_reasons", F.array_join("reasons", "; "))
    rest = [c for c in df.columns if c not in {*seq.keys, *COMMON, *renamed.values(), "reasons"}]
    return df.select(*seq.keys, *COMMON, *rest)
