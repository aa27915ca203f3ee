"""All stages over a table of sequences, written one after another, with a status per sequence and stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.operators.sequences import Sequence
from stridelake.operators.tables import select_sequences, skip_existing
from stridelake.plans import axes, canonicalize, describe, extract, represent, segment
from stridelake.plans.represent import MOTION
from stridelake.sources import checks
from stridelake.sources.contracts import first_failure
from stridelake.sources.stages import written
from stridelake.sources.store import StageStore

STAGES = ("frames", "segments", "walk", "turn", "description", "status")
RAW_STAGES = ("axes", "transforms", "canonical", *STAGES)
POSE = ["pose_raw", "r_global", "r_total"]


def _chosen(frames: DataFrame, store: StageStore, done: DataFrame | None, skip: bool, filters: dict) -> DataFrame:
    """Frames of the sequences to do: those that pass the filters and are neither named in done nor, if asked, described before."""
    frames = frames.withColumns({k: F.col(k).cast("string") for k in store.keys})
    frames = select_sequences(frames, **filters)
    if done is not None:
        frames = skip_existing(frames, done, store.keys)
    before = store.latest() if skip else None
    return frames if before is None else skip_existing(frames, before.where("reason = 'ok'"), store.keys)


def _passed(frames: DataFrame, verdict: DataFrame, keys: list[str]) -> DataFrame:
    return frames.join(verdict.where("reason = 'ok'").select(*keys), keys, "left_semi")


def _short(verdict: DataFrame, fps: float, least_sec: float) -> DataFrame:
    reason = F.when((F.col("reason") == "ok") & (F.col("frame_count") / fps < least_sec), f"duration_lt_{least_sec:g}s")
    return verdict.withColumn("reason", F.coalesce(reason, F.col("reason")))


def _motion(store: StageStore, canonical: DataFrame, verdict: DataFrame, fps: float, seq: Sequence) -> dict[str, DataFrame]:
    """The stages from canonical frames, all of them sound, to the status, which is written last."""
    keys = store.keys
    frames = store.put("represented", represent.represent(canonical, fps, seq, carry=False))
    labelled = store.put("frames", segment.with_segments(segment.label_frames(segment.signals(frames, fps, seq), fps, seq), seq))
    found = store.put("segments", extract.extraction_status(segment.segments(labelled, fps, represent.gait_summary(labelled, fps, seq), seq)))
    posed = set(POSE) <= set(canonical.columns)
    place = [*keys, seq.order]
    moving = labelled.join(canonical.select(*place, "joints_can"), place)
    walk = store.put("walk", extract.missing_features(extract.walk_features(moving, found, fps, seq), "walk"))
    turning = extract.pose_yaws(labelled.join(canonical.select(*place, *POSE), place), seq) if posed else labelled
    turn = store.put("turn", extract.missing_features(extract.turn_features(turning, found, fps, seq), "turn", posed))
    text = store.put("description", describe.describe(walk, turn, walk, turn, seq))
    status = verdict
    for name, df in (("segments", found), ("walk", walk), ("turn", turn)):
        status = status.join(df.groupBy(*keys).agg(F.count("*").alias(f"{name}_count")), keys, "left")
    status = status.join(text.select(*keys, "text_summary_zh"), keys, "left")
    status = status.fillna(0, ["segments_count", "walk_count", "turn_count"])
    state = F.when(F.col("reason") != "ok", "rejected").when(F.col("text_summary_zh").isNull(), "undescribed").otherwise("described")
    status = store.put("status", status.withColumn("status", state).withColumn("stages", _states()))
    return dict(zip(STAGES, (labelled, found, walk, turn, text, status), strict=True))


def _states() -> Column:
    """What became of a sequence in each stage: ok, none (nothing there to extract), or not_run."""
    sound = F.col("reason") == "ok"
    some = lambda c: F.when(~sound, "not_run").when(F.col(c) > 0, "ok").otherwise("none")
    return F.struct(
        F.when(sound, "ok").otherwise("rejected").alias("input"),
        some("segments_count").alias("segmentation"), some("walk_count").alias("walk"), some("turn_count").alias("turn"),
        F.when(~sound, "not_run").when(F.col("text_summary_zh").isNotNull(), "ok").otherwise("none").alias("description"),
    )


def run_stages(
    spark: SparkSession, canonical: DataFrame, folder: str, fps: float, seq: Sequence = MOTION, done: DataFrame | None = None, skip: bool = False, **filters
) -> dict[str, DataFrame]:
    """Tables of each stage under folder, and `status`, as this run gives them; see StageStore for those of all runs.

    Sequences that break a rule of their frames are left out of all stages and keep
    the reason; filters are those of select_sequences; done names sequences to
    pass by, skip those that an earlier run in the folder found sound. Whatever is
    passed by keeps its earlier rows. What one sequence lacks doesn't stop another:
    later stages hold no row of it, which its status tells. Keys are read as text.
    """
    store = StageStore(spark, folder, seq.keys)
    chosen = _chosen(canonical, store, done, skip, filters)
    verdict = checks.frame_failures(chosen, store.keys, seq.order)
    return _motion(store, _passed(chosen, verdict, store.keys), verdict, fps, seq)


def run_raw(
    spark: SparkSession,
    raw: DataFrame,
    folder: str,
    fps: float,
    seq: Sequence = MOTION,
    targets: dict[str, float] | DataFrame | None = None,
    least_sec: float = 3.0,
    done: DataFrame | None = None,
    skip: bool = False,
    **filters,
) -> dict[str, DataFrame]:
    """As run_stages(), from frames in raw axes: keys, frame_index, joints_raw, trans_raw and, for pelvis angles, pose_raw.

    Before the stages there, each sequence is judged by its raw frames and length,
    turned to forward, left and up (`axes`), levelled and moved (`transforms`,
    `canonical`). One whose transform leaves numbers that aren't finite is rejected
    then; the floor's and the path's reasons, which only leave a part of the
    transform out, stand beside the verdict in the status.
    """
    store = StageStore(spark, folder, seq.keys)
    keys = store.keys
    chosen = _chosen(raw, store, done, skip, filters)
    verdict = store.put("verdict", _short(checks.frame_failures(chosen, keys, seq.order, "joints_raw"), fps, least_sec))
    sound = _passed(chosen, verdict, keys)
    semantics = store.put("axes", axes.axis_semantics(sound, seq))
    # Read several times while the transform is sought.
    turned = written(axes.to_semantic_axes(sound, semantics, seq).drop("joints_raw", "trans_raw"))
    transforms = store.put("transforms", canonicalize.solve_transforms(turned, fps, targets, seq))
    moved = canonicalize.transformed(turned, transforms, seq)
    carried = [c for c in POSE if c in moved.columns]
    moved = store.put("canonical", moved.select(*keys, seq.order, "joints_can", "trans_can", *carried))
    whole = F.bool_and(checks.finite_points("joints_can")).alias("_whole")
    notes = transforms.select(*keys, "tilt_before_deg", "floor_reason", "yaw_reason", "scale_reason").join(semantics.select(*keys, "warnings"), keys, "left")
    verdict = verdict.join(moved.groupBy(*keys).agg(whole), keys, "left").join(notes, keys, "left")
    lost = F.col("reason").eqNullSafe("ok") & ~F.coalesce("_whole", F.lit(False))
    reason = F.when(lost, first_failure([("transform is not finite", lost)])).otherwise(F.col("reason"))
    verdict = verdict.withColumn("reason", reason).drop("_whole")
    out = _motion(store, _passed(moved, verdict, keys), verdict, fps, seq)
    return {"axes": semantics, "transforms": transforms, "canonical": moved} | out
