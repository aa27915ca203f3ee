"""Segmentation: exclusive labels per frame, hesitation, and segments with their quality."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StringType, StructField, StructType

from stridelake.functions.scalars import clip, frames_of, safe_divide
from stridelake.operators import ordered, scanners
from stridelake.operators import sequences as S
from stridelake.operators.aggregates import majority
from stridelake.operators.ordered import Rows
from stridelake.operators.sequences import Sequence
from stridelake.plans.represent import MOTION

# Labels in order of their index, the confidence of each, and the rule that gives it.
LABELS = ["stand_to_sit", "sit", "sit_to_stand", "turn", "walk", "adjust"]
CONFIDENCE = {"stand_to_sit": 0.95, "sit": 0.92, "sit_to_stand": 0.95, "turn": 0.90, "walk": 0.78, "adjust": 0.82}
RULES = {
    "stand_to_sit": "stand_to_sit_rule", "sit": "sit_fill", "sit_to_stand": "sit_to_stand_rule", "turn": "turn_rule",
    "walk": "walk_residual", "adjust": "adjust_relabel",
}


@dataclass(frozen=True)
class SegmentConfig:
    speed_sigma_sec: float = 0.12
    heading_sigma_sec: float = 0.18
    height_low: float = 0.02
    height_high: float = 0.98
    min_height_span: float = 0.16
    hesitation_walk_speed: float = 0.10
    hesitation_turn_speed: float = 10.0
    hesitation_min_sec: float = 0.20
    min_valid_ratio: float = 0.80
    min_quality: float = 0.60
    max_hesitation: float = 0.50


def relabel_between(
    segments: DataFrame, keys: list[str], order: str, label: str, before: str, after: str, new: str
) -> DataFrame:
    """Segments of `label` that lie between one of `before` and one of `after` become `new`."""
    window = Window.partitionBy(*keys).orderBy(order)
    between = (F.lag("label").over(window) == before) & (F.lead("label").over(window) == after)
    return segments.withColumn("label", F.when((F.col("label") == label) & between, new).otherwise(F.col("label")))


_SIGNALS = StructType([
    StructField(n, DoubleType())
    for n in (
        "pelvis_speed_mps", "foot_speed_mean_mps", "pelvis_height_norm", "heading_smooth_deg", "turn_angle_from_start_deg", "turn_speed_deg_s",
        "distance_from_start_m",
    )
])
_LABELLED = StructType([StructField("label", StringType()), StructField("hesitation", BooleanType()), StructField("segment_no", IntegerType())])


def signals(frames: DataFrame, fps: float, seq: Sequence = MOTION, cfg: SegmentConfig = SegmentConfig()) -> DataFrame:
    """Frames with the smoothed speeds, normalised height, turn angle and speed that the rules read."""
    speed, heading = frames_of(cfg.speed_sigma_sec, fps, 0), frames_of(cfg.heading_sigma_sec, fps, 0)
    feet = (F.col("left_foot_speed_mps") + F.col("right_foot_speed_mps")) / 2
    inputs = ["root_speed_xy_mps", feet, "heading_unwrapped_deg", "yaw_rate_deg_s", "pelvis_height_m", "root_pos_m.x", "root_pos_m.y"]

    def run(rows: Rows, columns: list[np.ndarray]) -> list[np.ndarray]:
        *moving, height, x, y = columns
        pelvis, foot, angle, turning = (rows.smoothed(c, sigma) for c, sigma in zip(moving, (speed, speed, heading, heading), strict=True))
        low, high = rows.percentiles([height], [cfg.height_low, cfg.height_high])
        span = rows.greatest(high - low, 1e-4)
        height = np.where(span < cfg.min_height_span, 0.5, rows.clip((height - low) / span, 0.0, 1.0))
        x, y = x - x[rows.first], y - y[rows.first]
        return [pelvis, foot, height, ordered.wrap_degrees(angle), np.abs(ordered.wrap_degrees(angle - angle[rows.first])), np.abs(turning), np.sqrt(x * x + y * y)]

    return ordered.in_order(frames, seq, inputs, run, _SIGNALS)


def with_normalized_height(df: DataFrame, seq: Sequence, height: str, out: str, cfg: SegmentConfig = SegmentConfig()) -> DataFrame:
    """height between two percentiles of its sequence, from 0 to 1; 0.5 throughout where these lie close together."""
    df = df.withColumn("_p", F.percentile(height, [cfg.height_low, cfg.height_high]).over(Window.partitionBy(*seq.keys)))
    low, span = F.col("_p")[0], F.greatest(F.col("_p")[1] - F.col("_p")[0], F.lit(1e-4))
    norm = F.when(span < cfg.min_height_span, F.lit(0.5)).otherwise(clip(safe_divide(F.col(height) - low, span), 0.0, 1.0))
    return df.withColumn(out, norm).drop("_p")


def _spans(values: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each run of equal values."""
    edges = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])
    return [(int(a), int(b) - 1) for a, b in zip(edges[:-1], edges[1:], strict=True)] if len(values) else []


def exclusive_labels(height: np.ndarray, angle: np.ndarray, walking: np.ndarray, turning: np.ndarray) -> np.ndarray:
    """The label's place in LABELS for each frame of one sequence.

    Events paint their frames, standing up over sitting down. Between them sits
    whoever has gone down last and comes up next. Turns are sought in what is left,
    and a run of walking between a turn and sitting down is an adjustment.
    """
    event = np.full(len(height), -1)
    found = scanners.sit_stand_events(height)
    for kind in ("stand_to_sit", "sit_to_stand"):
        for name, start, end, *_ in found:
            if name == kind:
                event[start : end + 1] = LABELS.index(kind)
    down, up = LABELS.index("stand_to_sit"), LABELS.index("sit_to_stand")
    label = event.copy()
    for first, last in _spans(event):
        if event[first] == -1:
            before = event[first - 1] if first else None
            after = event[last + 1] if last + 1 < len(event) else None
            if before in (None, down) and after in (None, up) and (before, after) != (None, None):
                label[first : last + 1] = LABELS.index("sit")
    allowed = label == -1
    for _, start, end, *_ in scanners.turn_events(angle, walking, turning, allowed):
        label[start : end + 1] = LABELS.index("turn")
    label[label == -1] = LABELS.index("walk")
    spans = _spans(label)
    for before, (first, last), after in zip(spans, spans[1:], spans[2:], strict=False):
        names = [LABELS[label[k]] for k in (before[0], first, after[0])]
        if names == ["turn", "walk", "stand_to_sit"]:
            label[first : last + 1] = LABELS.index("adjust")
    return label


def hesitating(label: np.ndarray, walking: np.ndarray, turning: np.ndarray, least: int, cfg: SegmentConfig) -> np.ndarray:
    """Slow frames of walking or turning, in runs of at least so many."""
    slow = (label == LABELS.index("walk")) & (walking < cfg.hesitation_walk_speed)
    slow |= (label == LABELS.index("turn")) & (turning < cfg.hesitation_turn_speed)
    for first, last in _spans(slow):
        if last - first + 1 < least:
            slow[first : last + 1] = False
    return slow


def label_frames(df: DataFrame, fps: float, seq: Sequence = MOTION, cfg: SegmentConfig = SegmentConfig()) -> DataFrame:
    """Frames of signals() with label, source_rule, confidence, hesitation and segment_no, counted from 1, judged a sequence at a time."""
    least = frames_of(cfg.hesitation_min_sec, fps)

    def run(rows: Rows, columns: list[np.ndarray]) -> list:
        label, slow, number = (np.empty(len(rows.at), kind) for kind in (np.int64, bool, np.int32))
        for a, b in rows.bounds:
            height, angle, walking, turning = (c[a:b] for c in columns)
            label[a:b] = exclusive_labels(height, angle, walking, turning)
            slow[a:b] = hesitating(label[a:b], walking, turning, least, cfg)
            # Numbered here, as windows over what comes out would deal all frames anew.
            number[a:b] = np.concatenate([[1], 1 + np.cumsum(label[a + 1 : b] != label[a : b - 1])])
        return [pa.array(LABELS).take(pa.array(label)), slow, number]

    df = ordered.in_order(df, seq, ["pelvis_height_norm", "turn_angle_from_start_deg", "pelvis_speed_mps", "turn_speed_deg_s"], run, _LABELLED)
    for out, table in (("source_rule", RULES), ("confidence", CONFIDENCE)):
        names = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
        df = df.withColumn(out, names[F.col("label")])
    return df


def label_metrics(df: DataFrame, seq: Sequence = MOTION) -> DataFrame:
    """Per sequence of with_segments(): frames, segments and hesitation, frames and share of each label, and mean quality."""
    n = F.count("*")
    parts = []
    for label in LABELS:
        here = F.count_if(F.col("label") == label)
        parts += [here.alias(f"{label}_frame_count"), (here / n).alias(f"{label}_ratio")]
    return df.groupBy(*seq.keys).agg(
        n.alias("frame_count"),
        F.countDistinct("segment_no").alias("segment_count"),
        F.count_if("hesitation").alias("hesitation_frame_count"),
        F.avg(F.col("left_foot_contact").cast("double")).alias("left_contact_ratio"),
        F.avg(F.col("right_foot_contact").cast("double")).alias("right_contact_ratio"),
        F.avg(F.col("valid_frame_mask").cast("double")).alias("valid_frame_ratio"),
        F.avg("representation_quality_score").alias("representation_quality_score_mean"),
        *parts,
        (F.count_if(F.col("hesitation") & ~F.col("label").isin("walk", "turn")) == 0).alias("hesitation_in_locomotion"),
    )


def with_segments(df: DataFrame, seq: Sequence = MOTION) -> DataFrame:
    """Labelled frames with segment_no, counted from 1."""
    return S.island(df, seq, "label", "segment_no").withColumn("segment_no", F.col("segment_no") + 1)


def graded(bad: Column, odd: Column) -> Column:
    return F.when(bad, "bad").when(odd, "warning").otherwise("good")


def segments(
    df: DataFrame, fps: float, warnings: DataFrame | None = None, seq: Sequence = MOTION, cfg: SegmentConfig = SegmentConfig()
) -> DataFrame:
    """One row per segment of with_segments(), with its quality; warnings(keys, gait_warnings) downgrade a sequence's."""
    n = F.count("*")
    out = df.groupBy(*seq.keys, "segment_no").agg(
        F.first("label").alias("label"),
        F.min("frame_index").alias("start_frame"),
        F.max("frame_index").alias("end_frame"),
        (n / fps).alias("duration_sec"),
        majority("source_rule").alias("source_rule"),
        F.avg("confidence").alias("confidence"),
        F.count_if("hesitation").alias("hesitation_overlap_frames"),
        (F.count_if("hesitation") / n).alias("hesitation_overlap_ratio"),
        F.avg(F.col("valid_frame_mask").cast("double")).alias("valid_frame_ratio"),
        F.avg("representation_quality_score").alias("representation_quality_score_mean"),
    )
    out = out.withColumn("start_time_sec", F.col("start_frame") / fps).withColumn("end_time_sec", F.col("end_frame") / fps)
    out = out.withColumn("segment_id", F.format_string("seg_%04d", F.col("segment_no")))
    out = out.withColumn("auxiliary_overlap_labels", F.when(F.col("hesitation_overlap_frames") > 0, "hesitation").otherwise(""))
    more = F.array().cast("array<string>")
    if warnings is not None:
        out = out.join(warnings.select(*seq.keys, "gait_warnings"), list(seq.keys), "left")
        more = F.coalesce("gait_warnings", more)
    invalid = F.col("valid_frame_ratio") < cfg.min_valid_ratio
    poor = F.coalesce(F.col("representation_quality_score_mean"), F.lit(0.0)) < cfg.min_quality
    reasons = F.array_compact(
        F.array(
            F.when(invalid, f"valid_frame_ratio_below_{cfg.min_valid_ratio:.2f}"),
            F.when(poor, f"representation_quality_score_below_{cfg.min_quality:.2f}"),
            F.when(F.col("hesitation_overlap_ratio") > 0, "hesitation_overlap"),
        )
    )
    out = out.withColumn("reasons", F.concat(reasons, more))
    out = out.withColumn("status", graded(invalid | poor, F.size("reasons") > 0))
    used = (F.col("status") != "bad") & (F.col("hesitation_overlap_ratio") < cfg.max_hesitation)
    return out.withColumn("used_for_extraction", used).drop("gait_warnings")
