"""Canonicalisation: one similarity transform per sequence, to a level floor and +X along the path."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from stridelake.functions import vectors as V
from stridelake.functions.scalars import clip, frames_of
from stridelake.operators.ordered import Rows, in_order, percentile
from stridelake.operators.sequences import Sequence
from stridelake.plans import represent as R
from stridelake.sources.stages import written

# The joints that can carry weight, in the order that decides ties for the floor and for support_metrics(), and the bones that give the scale.
SUPPORTS = [("left_foot", R.LEFT_FOOT), ("left_ankle", R.LEFT_ANKLE), ("right_foot", R.RIGHT_FOOT), ("right_ankle", R.RIGHT_ANKLE)]
CARRIERS = ("left_ankle", "right_ankle", "left_foot", "right_foot")
BONES = {
    "left_thigh": (R.LEFT_HIP, R.LEFT_KNEE), "left_shank": (R.LEFT_KNEE, R.LEFT_ANKLE),
    "right_thigh": (R.RIGHT_HIP, R.RIGHT_KNEE), "right_shank": (R.RIGHT_KNEE, R.RIGHT_ANKLE),
}


@dataclass(frozen=True)
class CanonicalConfig:
    support_window_sec: float = 0.5
    low_share: float = 0.15
    min_cloud: int = 6
    max_tilt_deg: float = 60.0
    max_residual: float = 0.08
    ground_percentile: float = 0.05
    body_frames: int = 5
    min_variance_share: float = 0.90
    min_range: float = 0.20
    min_net_share: float = 0.15
    min_bones: int = 2
    scale_low: float = 0.75
    scale_high: float = 1.35


def each_joint(df: DataFrame, joints: str, move: Callable[[Column], Column], out: str, count: int = 24) -> DataFrame:
    """df with out, the points that move makes of those of joints; only those are computed that are read, unlike in a transform."""
    place = [(k, c) for k in range(count) for c in "xyz"]
    df = df.withColumns({f"_{out}_{k}": move(F.col(joints)[k]) for k in range(count)})
    df = df.withColumns({f"_{out}_{k}{c}": F.col(f"_{out}_{k}")[c] for k, c in place})
    points = [F.struct(*[F.col(f"_{out}_{k}{c}").alias(c) for c in "xyz"]) for k in range(count)]
    return df.withColumn(out, F.array(*points)).drop(*[f"_{out}_{k}" for k in range(count)], *[f"_{out}_{k}{c}" for k, c in place])


def scale_fit(
    frames: DataFrame, targets: dict[str, float] | DataFrame | None, seq: Sequence = R.MOTION, cfg: CanonicalConfig = CanonicalConfig()
) -> DataFrame:
    """Per sequence the scale that brings its bones to their targets: s_global and how it came about.

    targets: lengths by names in BONES, or a table of bone and length, which may hold
    some of the keys besides and then counts for these alone. A bone's length is the
    median over frames where it is finite and positive; its ratio, target by length,
    counts if it is finite and positive. scale_raw is the median of the ratios,
    s_global that within bounds; scale_flag is ok, clipped, or, as scale_reason is
    then, insufficient_valid_bones, with s_global 1. bones maps each bone asked for to
    its target, length and ratio. Of repeated targets the least counts. Without
    targets s_global is 1 and all else null.
    """
    keys = list(seq.keys)
    point = lambda k: V.joint("joints_3d", k)
    sound = lambda c: F.when((c > 1e-6) & (c < float("inf")), c)
    if targets is None or isinstance(targets, dict):
        names = [n for n in BONES if n in (targets or {})]
    else:
        names = list(BONES)
    lengths = [F.median(sound(V.norm(V.minus(point(b), point(a))))).alias(f"_seen_{n}") for n, (a, b) in BONES.items() if n in names]
    seen = frames.groupBy(*keys).agg(F.count("*").alias("_frames"), *lengths)
    if isinstance(targets, DataFrame):
        own = [k for k in keys if k in targets.columns]
        wide = targets.groupBy(*own).pivot("bone", names).agg(F.min("length")).withColumnsRenamed({n: f"_aim_{n}" for n in names})
        # A table without keys becomes a single row.
        seen = seen.join(wide, own, "left") if own else seen.withColumn("_one", F.lit(1)).join(F.broadcast(wide.withColumn("_one", F.lit(1))), "_one", "left")
    else:
        seen = seen.withColumns({f"_aim_{n}": F.lit(float(targets[n])) for n in names}) if names else seen
    entries = []
    for n in names:
        aim, length = F.col(f"_aim_{n}").cast("double"), F.col(f"_seen_{n}")
        entries += [F.lit(n), F.struct(aim.alias("target"), length.alias("length"), sound(aim / length).alias("ratio"))]
    shape = "map<string, struct<target: double, length: double, ratio: double>>"
    seen = seen.withColumn("bones", F.create_map(*entries) if entries else F.lit(None).cast(shape))
    seen = seen.withColumn("_ratios", F.sort_array(F.filter(F.transform(F.map_values("bones"), lambda b: b["ratio"]), lambda r: r.isNotNull())))
    n = F.size("_ratios")
    low, high = F.get("_ratios", F.floor((n - 1) / 2).cast("int")), F.get("_ratios", F.floor(n / 2).cast("int"))
    enough = n >= min(max(cfg.min_bones, 1), max(len(names), 1))
    seen = seen.withColumn("scale_raw", F.when(enough, (low + high) / 2))
    kept = clip("scale_raw", cfg.scale_low, cfg.scale_high)
    flag = F.when(~enough, "insufficient_valid_bones").when(F.abs(kept - F.col("scale_raw")) > 1e-8 + 1e-5 * F.abs("scale_raw"), "clipped")
    asked = F.col("bones").isNotNull()
    return seen.select(
        *keys, F.coalesce(kept, F.lit(1.0)).alias("s_global"), "scale_raw", F.when(asked, F.coalesce(flag, F.lit("ok"))).alias("scale_flag"),
        F.when(asked & ~enough, "insufficient_valid_bones").alias("scale_reason"), F.when(asked, n).alias("bone_count_valid"), "bones",
    )


def _unit(v: np.ndarray, eps: float = 1e-10) -> np.ndarray:
    return v * (1 / max(np.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2]), eps))


def _moved(m: np.ndarray, point: V.Vector, scale: float) -> V.Vector:
    return V.scaled(V.times(m, point), scale)


def _scale(at: dict[str, V.Vector], aims: dict[str, float], cfg: CanonicalConfig) -> tuple[float, str, str | None]:
    """s_global, scale_flag and scale_reason as in scale_fit()."""
    sound, ratios = lambda c: c[(c > 1e-6) & (c < np.inf)], []
    for bone, aim in aims.items():
        side, part = bone.split("_")
        ends = ("hip", "knee") if part == "thigh" else ("knee", "ankle")
        away = V.minus(at[f"{side}_{ends[1]}"], at[f"{side}_{ends[0]}"])
        lengths = sound(np.sqrt(V.dot(away, away)))
        ratios += list(sound(np.array([aim / np.median(lengths)]))) if len(lengths) else []
    if len(ratios) < min(max(cfg.min_bones, 1), max(len(aims), 1)):
        return 1.0, "insufficient_valid_bones", "insufficient_valid_bones"
    raw = float(np.median(ratios))
    kept = max(min(raw, cfg.scale_high), cfg.scale_low)
    return kept, "clipped" if abs(kept - raw) > 1e-8 + 1e-5 * abs(raw) else "ok", None


def _body(hips: V.Vector, shoulders: V.Vector, up: V.Vector) -> np.ndarray:
    """Rows forward, left and up, from component medians over a sequence's first frames."""
    up = _unit(np.array([np.median(c) for c in up]))
    left = np.array([np.median(np.concatenate(c)) for c in zip(hips, shoulders, strict=True)])
    left = _unit(left - up * V.dot(left, up))
    return np.array([_unit(np.array(V.cross(left, up))), left, up])


def _level(normal: np.ndarray, eps: float = 1e-8) -> np.ndarray:
    """The rotation that takes a unit vector straight up; a half turn about a fixed normal if it points down."""
    v, c, one = np.array(V.cross(normal, (0.0, 0.0, 1.0))), normal[2], np.eye(3)
    if c > -1 + eps:
        k = np.array([[0.0, -v[2], v[1]], [v[2], 0.0, -v[0]], [-v[1], v[0], 0.0]])
        return one + k + k @ k * (1 / max(1 + c, eps))
    n = _unit(np.array(V.cross(normal, (1.0, 0.0, 0.0) if abs(normal[0]) < 0.9 else (0.0, 1.0, 0.0))), eps)
    return 2 * np.outer(n, n) - one


def _lowest(z: np.ndarray, order: np.ndarray, stride: int, share: float) -> np.ndarray:
    """Places of the rows among the lowest ceil(share * n) of their block of `stride` rows, ties by order."""
    block = np.floor(order / stride)
    by = np.lexsort((order, z, block))
    edges = np.flatnonzero(np.concatenate([[True], np.diff(block[by]) != 0]))
    sizes = np.diff(np.append(edges, len(by)))
    rank = np.arange(len(by)) - np.repeat(edges, sizes)
    return by[rank < np.repeat(np.ceil(sizes * share), sizes)]


def _plane(x: np.ndarray, y: np.ndarray, z: np.ndarray) -> tuple[float, float, float]:
    """As aggregates.plane_fit(); NaN without a unique plane."""
    mx, my, mz = x.mean(), y.mean(), z.mean()
    x, y, z = x - mx, y - my, z - mz
    xx, yy, xy, xz, yz = (float((a * b).mean()) for a, b in ((x, x), (y, y), (x, y), (x, z), (y, z)))
    det = xx * yy - xy * xy
    if not det > 1e-12 * max(xx * yy, 1e-300):
        return np.nan, np.nan, np.nan
    a, b = (xz * yy - yz * xy) / det, (yz * xx - xz * xy) / det
    return a, b, mz - a * mx - b * my


def _floor(points: list[V.Vector], order: np.ndarray, fps: float, cfg: CanonicalConfig) -> tuple[np.ndarray, float, str | None, list[float]]:
    """r_floor, tilt, the reason why the plane isn't used, and the plane with its count and how far its points are off."""
    first = np.argmin([np.where(np.isnan(p[2]), np.inf, p[2]) for p in points], axis=0)
    x, y, z = (np.choose(first, c) for c in zip(*points, strict=True))
    low = _lowest(z, order, frames_of(cfg.support_window_sec, fps), cfg.low_share)
    x, y, z = x[low], y[low], z[low]
    a, b, c = _plane(x, y, z)
    off = np.abs(z - (a * x + b * y + c))
    numbers = [float(len(low)), a, b, c, float(np.median(off)), float(off.mean()), float(off.max())]
    normal = _unit(np.array([-a, -b, 1.0]))
    tilt = float(np.degrees(np.arccos(np.clip(normal[2], -1.0, 1.0))))
    if len(low) < cfg.min_cloud or np.isnan(a):
        reason = "floor_estimation_failed"
    elif tilt > cfg.max_tilt_deg:
        reason = "floor_tilt_above_threshold"
    else:
        reason = "floor_median_residual_above_threshold" if numbers[4] > cfg.max_residual else None
    return np.eye(3) if reason else _level(normal), tilt, reason, numbers


def _yaw(x: np.ndarray, y: np.ndarray, ahead: np.ndarray, cfg: CanonicalConfig) -> tuple[np.ndarray, str | None]:
    """r_yaw and the reason why the path's axis isn't used."""
    n, dx, dy = len(x), x - x.mean(), y - y.mean()
    ax, ay, share = 1.0, 0.0, 0.0
    if n > 1:
        xx, yy, xy = (float((a * b).sum()) / (n - 1) for a, b in ((dx, dx), (dy, dy), (dx, dy)))
        half, gap, angle = (xx + yy) / 2, (xx - yy) / 2, 0.5 * np.arctan2(2 * xy, xx - yy)
        ax, ay = float(np.cos(angle)), float(np.sin(angle))
        share = (half + np.sqrt(gap * gap + xy * xy)) / (xx + yy) if xx + yy else 0.0
    along = np.sort(x * ax + y * ay)
    along = along[np.isfinite(along)]
    wide = percentile(along, 0.95) - percentile(along, 0.05) if len(along) else np.nan
    nx, ny, path = x[-1] - x[0], y[-1] - y[0], float(np.sqrt(np.diff(x) ** 2 + np.diff(y) ** 2).sum())
    net = np.sqrt(nx * nx + ny * ny)
    by_net = net / max(path, 1e-10) >= cfg.min_net_share and net > 1e-10
    against = ax * nx + ay * ny if by_net else ax * ahead[0][0] + ay * ahead[1][0]
    sign = -1.0 if against < 0 else 1.0
    reason = "pca_variance_below_threshold" if share < cfg.min_variance_share else "robust_range_below_threshold" if wide < cfg.min_range else None
    c, s = ax * sign, ay * sign
    return np.eye(3) if reason else np.array([[c, s, 0.0], [-s, c, 0.0], [0.0, 0.0, 1.0]]), reason


def support_metrics(frames: DataFrame, seq: Sequence = R.MOTION, joints: str = "joints_3d") -> DataFrame:
    """Per sequence which joint carries the weight: of each frame the lowest of ankles and feet, the first of equals; one aggregate.

    frame_count, finite_ratio (of points whose coordinates are all finite), min_z and
    max_z, for each joint its count and ratio, and warnings. A height that isn't a
    number, or a missing one, is taken before any other, as then nothing is known of
    the frame; min_z and max_z are null with such a frame.
    """
    at = dict(SUPPORTS)
    points = []
    for place, name in enumerate(CARRIERS):
        x, y, z = (F.coalesce(c.cast("double"), F.lit(float("nan"))) for c in V.joint(joints, at[name]))
        points.append(F.struct((~F.isnan(z)).alias("known"), z.alias("z"), F.lit(place).alias("place"), x.alias("x"), y.alias("y")))
    df = frames.select(*seq.keys, F.array_min(F.array(*points)).alias("_low"))
    finite = F.forall(F.array("_low.x", "_low.y", "_low.z"), lambda c: F.abs(c) < float("inf"))
    known = F.bool_and("_low.known")
    counts = [F.count_if(F.col("_low.place") == k).alias(f"{n}_selected_count") for k, n in enumerate(CARRIERS)]
    out = df.groupBy(*seq.keys).agg(
        F.count("*").alias("frame_count"), F.avg(finite.cast("int")).alias("finite_ratio"), F.when(known, F.min("_low.z")).alias("min_z"),
        F.when(known, F.max("_low.z")).alias("max_z"), *counts,
    )
    out = out.withColumns({f"{n}_selected_ratio": F.col(f"{n}_selected_count") / F.col("frame_count") for n in CARRIERS})
    return out.withColumn("warnings", F.array_compact(F.array(F.when(F.col("finite_ratio") < 1, "support_points_nonfinite"))))


_SOLVED = [
    *[f"_{n}{i}{k}" for n in ("r_body", "r_floor", "r_yaw", "r_global") for i in range(3) for k in range(3)], "_tx", "_ty", "_tz", "_tilt", "_cloud",
    *[f"_{n}" for n in ("a", "b", "c", "residual_median_m", "residual_mean_m", "residual_max_m")], "_scale",
]


def solve_transforms(
    frames: DataFrame, fps: float, targets: dict[str, float] | DataFrame | None = None, seq: Sequence = R.MOTION, cfg: CanonicalConfig = CanonicalConfig()
) -> DataFrame:
    """One row per sequence: r_global, s_global, t_global and how they came about.

    frames: keys, frame_index, joints_3d (array of 24 structs) and trans_canonical
    (struct). targets: bone lengths of the model, as scale_fit() takes them, if it
    should be scaled to one.
    """
    keys = list(seq.keys)
    # Tables of a row per sequence are merged with the frames, as these are never to be broadcast or dealt anew.
    fitted = ["s_global", "scale_flag", "scale_reason"]
    if isinstance(targets, DataFrame):
        here = frames.join(written(scale_fit(frames, targets, seq, cfg).select(*keys, *fitted)).hint("merge"), keys)
        aims = None
    else:
        # Lengths that hold for all sequences need no pass of their own.
        here = frames.withColumns({"s_global": F.lit(1.0), **{n: F.lit(None).cast("string") for n in fitted[1:]}})
        aims = {n: float(targets[n]) for n in BONES if n in (targets or {})}
    joints = {"left_hip": R.LEFT_HIP, "right_hip": R.RIGHT_HIP, "left_shoulder": R.LEFT_SHOULDER, "right_shoulder": R.RIGHT_SHOULDER, **dict(SUPPORTS)}
    joints |= {f"{side}_knee": k for side, k in (("left", R.LEFT_KNEE), ("right", R.RIGHT_KNEE)) if aims}
    points = [*[F.col("trans_canonical")[c] for c in "xyz"], *[c for k in joints.values() for c in V.joint("joints_3d", k)]]
    # Rows are sorted without the joints that aren't read.
    here = here.select(*keys, seq.order, *fitted, *[c.alias(f"_p{k}") for k, c in enumerate(points)])
    inputs, names = [seq.order, "s_global", *[f"_p{k}" for k in range(len(points))]], list(joints)

    told = ["floor_reason", "yaw_reason", "_scale_flag", "_scale_reason"]

    def run(rows: Rows, columns: list[np.ndarray]) -> list:
        out = {n: np.full(len(rows.at), np.nan) for n in _SOLVED}
        begins, reasons = np.zeros(len(rows.at), bool), {n: [None] * len(rows.at) for n in told}
        for a, b in rows.bounds:
            order, scale, *flat = (c[a:b] for c in columns)
            if rows.absent[a]:
                # A frame of which a point is missing tells nothing.
                sound = ~np.isnan(flat).any(axis=0)
                order, scale, *flat = (c[sound] for c in (order, scale, *flat))
            if not (order < cfg.body_frames).any():
                continue
            root = tuple(flat[:3])
            at = {n: tuple(flat[3 * k + 3 : 3 * k + 6]) for k, n in enumerate(names)}
            scale, scale_flag, scale_reason = _scale(at, aims, cfg) if aims else (float(scale[0]), None, None)
            start = {n: tuple(c[order < cfg.body_frames] for c in p) for n, p in at.items() if "hip" in n or "shoulder" in n}
            mid = lambda n, p: V.scaled(V.plus(p[f"left_{n}"], p[f"right_{n}"]), 0.5)
            across = lambda n, p: V.minus(p[f"left_{n}"], p[f"right_{n}"])
            body = _body(across("hip", start), across("shoulder", start), V.minus(mid("shoulder", start), mid("hip", start)))
            supports = [at[n] for n, _ in SUPPORTS]
            floor, tilt, floor_reason, numbers = _floor([_moved(body, p, scale) for p in supports], order, fps, cfg)
            level = np.array([[V.dot(row, c) for c in body.T] for row in floor])
            x, y, _ = _moved(level, root, scale)
            yaw, yaw_reason = _yaw(x, y, floor, cfg)
            turn = np.array([[V.dot(row, c) for c in level.T] for row in yaw])
            first = _moved(turn, tuple(float(c[0]) for c in root), scale)
            heights = np.sort(np.concatenate([_moved(turn, p, scale)[2] for p in supports]))
            ground = percentile(heights, cfg.ground_percentile)
            found = [*body.flat, *floor.flat, *yaw.flat, *turn.flat, -first[0], -first[1], -ground, tilt, *numbers, scale]
            begins[a] = True
            for n, why in zip(told, (floor_reason, yaw_reason, scale_flag, scale_reason), strict=True):
                reasons[n][a] = why
            for n, value in zip(_SOLVED, found, strict=True):
                out[n][a] = value
        return [begins, *[pa.array(c, type=pa.string()) for c in reasons.values()], *[pa.array(c, mask=np.isnan(c)) for c in out.values()]]

    kinds = [StructField("_begins", BooleanType()), *[StructField(n, StringType()) for n in told]]
    made = StructType([*kinds, *[StructField(n, DoubleType()) for n in _SOLVED]])
    solved = in_order(here, seq, inputs, run, made).where("_begins")
    matrix = lambda n: V.packed_matrix(tuple(tuple(F.col(f"_{n}{i}{k}") for k in range(3)) for i in range(3))).alias(n)
    numbers = ["a", "b", "c", "residual_median_m", "residual_mean_m", "residual_max_m"]
    floor = F.struct(F.col("_cloud").cast("long").alias("cloud_count"), *[F.col(f"_{n}").alias(n) for n in numbers])
    return written(solved.select(
        *keys, matrix("r_global"), F.col("_scale").alias("s_global"), F.struct(*[F.col(f"_t{c}").alias(c) for c in "xyz"]).alias("t_global"), matrix("r_body"), matrix("r_floor"),
        matrix("r_yaw"), F.col("_tilt").alias("tilt_before_deg"), "floor_reason", "yaw_reason",
        *[F.coalesce(f"_{n}", n).alias(n) for n in fitted[1:]], floor.alias("floor"),
    ))


def transformed(frames: DataFrame, transforms: DataFrame, seq: Sequence = R.MOTION) -> DataFrame:
    """frames with joints_can and trans_can, s R p + t of joints_3d and trans_canonical, and the columns of solve_transforms()."""
    df = frames.join(transforms.hint("merge"), list(seq.keys))
    r, t, s = V.matrix_column("r_global"), V.unpacked("t_global"), F.col("s_global")

    def moved(p: Column) -> Column:
        return V.packed(V.plus(V.scaled(V.times(r, (p["x"], p["y"], p["z"])), s), t))

    return each_joint(df, "joints_3d", moved, "joints_can").withColumn("trans_can", moved(F.col("trans_canonical")))


def canonicalize(
    frames: DataFrame, fps: float, targets: dict[str, float] | DataFrame | None = None, seq: Sequence = R.MOTION, cfg: CanonicalConfig = CanonicalConfig()
) -> DataFrame:
    """frames as transformed() by what solve_transforms() finds."""
    return transformed(frames, solve_transforms(frames, fps, targets, seq, cfg), seq)


def facing_angle(frames: DataFrame, seq: Sequence = R.MOTION, joints: str = "joints_can") -> DataFrame:
    """Angle of the body to +X on the first frame of each sequence."""
    point = lambda k: V.joint(joints, k)
    left = V.plus(V.minus(point(R.LEFT_HIP), point(R.RIGHT_HIP)), V.minus(point(R.LEFT_SHOULDER), point(R.RIGHT_SHOULDER)))
    forward = V.cross(left, V.minus(point(R.NECK), point(R.PELVIS)))
    order = Window.partitionBy(*seq.keys).orderBy(seq.order)
    first = frames.withColumn("_n", F.row_number().over(order)).where("_n = 1")
    return first.select(*seq.keys, V.heading_degrees(V.horizontal(forward)).alias("facing_deg"))


def transform_checks(canonical: DataFrame, seq: Sequence = R.MOTION, cfg: CanonicalConfig = CanonicalConfig()) -> DataFrame:
    """Per sequence of canonicalize(): finiteness, scale, where the first root lies, the ground's height, and what is left of tilt."""
    heights = F.array(*[F.col("joints_can")[k]["z"] for _, k in SUPPORTS])
    finite = F.forall("joints_can", lambda p: F.abs(p["x"] + p["y"] + p["z"]) < float("inf")) & (F.abs(V.norm(V.unpacked("trans_can"))) < float("inf"))
    first = F.min_by("trans_can", seq.order)
    # In one pass: a frame stands here once for each support, which changes neither what is first nor whether all are finite.
    rows = canonical.select(
        *seq.keys, seq.order, finite.alias("_finite"), "trans_can", "s_global", "r_global", "r_body", "tilt_before_deg", "floor_reason", F.explode(heights).alias("_z")
    )
    out = rows.groupBy(*seq.keys).agg(
        F.percentile("_z", cfg.ground_percentile).alias("ground_z_percentile_m"), F.bool_and(F.coalesce("_finite", F.lit(False))).alias("all_outputs_finite"), F.first("s_global").alias("s_global"), first.alias("_root"),
        F.first("r_global").alias("_r"), F.first("r_body").alias("_b"), F.first("tilt_before_deg").alias("floor_tilt_before_deg"),
        F.first("floor_reason").isNull().alias("floor_alignment_enabled"),
    )
    up = V.times(V.matrix_column("_r"), V.matrix_column("_b")[2])
    out = out.withColumn("_up", V.packed(up))
    up = V.unpacked("_up")
    apart = V.norm(V.minus(up, V.vector(0, 0, 1)))
    angle = F.degrees(F.acos(clip(up[2] / F.greatest(V.norm(up), F.lit(1e-10)), -1.0, 1.0)))
    out = out.withColumns(
        {
            "first_root_xy_norm_m": F.sqrt(F.col("_root.x") * F.col("_root.x") + F.col("_root.y") * F.col("_root.y")),
            "det_r_global": V.determinant(V.matrix_column("_r")), "body_up_after_error": apart, "body_up_after_angle_deg": angle,
        }
    )
    return out.drop("_root", "_r", "_b", "_up")
