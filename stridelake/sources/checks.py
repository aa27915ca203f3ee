"""Checks of stage tables: one row per sequence with the first rule it breaks, `ok` otherwise."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, MapType, StructType

from stridelake.functions import vectors as V
from stridelake.sources.contracts import first_failure

JOINTS, POSE = 24, 72


def _finite(x: Column) -> Column:
    return F.coalesce(~F.isnan(x) & (F.abs(x) < math.inf), F.lit(False))


def finite_points(points: str, size: int = JOINTS) -> Column:
    """Whether an array holds `size` points of finite coordinates."""
    whole = F.forall(points, lambda p: _finite(p["x"]) & _finite(p["y"]) & _finite(p["z"]))
    return F.coalesce((F.size(points) == size) & whole, F.lit(False))


def frame_failures(frames: DataFrame, keys: list[str], order: str = "frame_index", joints: str = "joints_can", pose: str | None = None) -> DataFrame:
    """Per sequence frame_count and reason: joints of the right number and finite, poses too if named, frames from 0 without gaps, two at least."""
    sizes = F.bool_and(F.coalesce(F.size(joints) == JOINTS, F.lit(False)))
    posed = F.bool_and(F.coalesce((F.size(pose) == POSE) & F.forall(pose, _finite), F.lit(False))) if pose else F.lit(True)
    found = frames.groupBy(*keys).agg(
        F.count("*").alias("frame_count"), F.countDistinct(order).alias("_distinct"), F.min(order).alias("_first"), F.max(order).alias("_last"),
        sizes.alias("_sizes"), F.bool_and(finite_points(joints)).alias("_finite"), posed.alias("_posed"),
    )
    rules = [
        ("joints must have 24 points", ~F.col("_sizes")),
        ("joints are not finite", ~F.col("_finite")),
        ("pose must have 72 finite values", ~F.col("_posed")),
        ("fewer than two frames", F.col("frame_count") < 2),
        ("frames must count from 0 without gaps", (F.col("_first") != 0) | (F.col("_last") + 1 != F.col("frame_count")) | (F.col("_distinct") != F.col("frame_count"))),
    ]
    return found.select(*keys, "frame_count", first_failure(rules).alias("reason"))


def rotation_failure(matrix: str, tolerance: float = 1e-5) -> Column:
    """Why a matrix is no rotation: missing, of the wrong shape, not finite, not orthonormal, or a reflection; ok otherwise."""
    m = V.matrix_column(matrix)
    square = F.coalesce((F.size(matrix) == 3) & F.forall(matrix, lambda r: F.size(r) == 3), F.lit(False))
    gram = V.product(m, V.transposed(m))
    apart = F.greatest(*[F.abs(gram[i][k] - (1.0 if i == k else 0.0)) for i in range(3) for k in range(3)])
    return first_failure(
        [
            ("rotation is missing", F.col(matrix).isNull()),
            ("rotation must have shape (3, 3)", ~square),
            ("rotation is not finite", ~F.forall(matrix, lambda r: F.forall(r, _finite))),
            ("rotation is not orthonormal", apart > tolerance),
            ("rotation must have determinant 1", F.abs(V.determinant(m) - 1) > tolerance),
        ]
    )


def segment_failures(segments: DataFrame, counts: DataFrame, keys: list[str], labels: list[str], start: str = "start_frame", end: str = "end_frame") -> DataFrame:
    """Per sequence of counts(keys, frame_count) whether its segments have known labels and follow each other from the first to the last frame."""
    order = Window.partitionBy(*keys).orderBy(start, end)
    df = segments.withColumn("_cursor", F.coalesce(F.lag(end).over(order) + 1, F.lit(0)))
    found = df.groupBy(*keys).agg(
        F.bool_and(F.coalesce(F.col("label").isin(labels), F.lit(False))).alias("_known"),
        F.bool_and(F.coalesce(F.col(start) == F.col("_cursor"), F.lit(False))).alias("_joined"),
        F.bool_and(F.coalesce((F.col(start) >= 0) & (F.col(end) >= F.col(start)), F.lit(False))).alias("_spans"),
        F.max(end).alias("_last"),
    )
    rules = [
        ("no segments", F.col("_last").isNull() & F.col("_known").isNull()),
        ("unsupported label", ~F.col("_known")),
        ("segments are not contiguous from frame 0", ~F.col("_joined")),
        ("invalid frame span", ~F.col("_spans") | (F.col("_last") >= F.col("frame_count"))),
        ("segments do not cover the sequence", F.col("_last") + 1 != F.col("frame_count")),
    ]
    return counts.join(found, keys, "left").select(*keys, "frame_count", first_failure(rules).alias("reason"))


def frame_labels(segments: DataFrame, keys: list[str], start: str = "start_frame", end: str = "end_frame") -> DataFrame:
    """One row per frame of a segment: keys, frame_index and label."""
    return segments.select(*keys, F.explode(F.sequence(F.col(start).cast("int"), F.col(end).cast("int"))).alias("frame_index"), "label")


def event_failures(events: DataFrame, counts: DataFrame, keys: list[str], frame: str = "frame", position: str | None = None) -> DataFrame:
    """Per sequence whether its events lie in it and, in order of position, don't go back."""
    inside = F.coalesce((F.col(frame) >= 0) & (F.col(frame) < F.col("frame_count")), F.lit(False))
    df = events.join(counts.select(*keys, "frame_count"), keys).withColumn("_inside", inside)
    if position:
        before = F.lag(frame).over(Window.partitionBy(*keys, "side", "event").orderBy(position))
        df = df.withColumn("_onward", F.coalesce(F.col(frame) >= before, F.lit(True)))
    else:
        df = df.withColumn("_onward", F.lit(True))
    found = df.groupBy(*keys).agg(F.bool_and("_inside").alias("_inside"), F.bool_and("_onward").alias("_onward"))
    rules = [("event outside the sequence", ~F.col("_inside")), ("events go back", ~F.col("_onward"))]
    return counts.join(found, keys, "left").select(*keys, first_failure(rules).alias("reason"))


def stage_alignment(stages: dict[str, DataFrame], keys: list[str], tolerance: float = 1e-6) -> DataFrame:
    """Every sequence of any stage(keys, frame_count, fps) with the first reason why its stages don't belong together, or ok.

    The first stage sets frame count and rate; a stage may lack either column.
    """
    names = list(stages)
    out = None
    for name, df in stages.items():
        part = df.select(*keys, F.lit(True).alias(f"_{name}"), *[
            (F.col(c) if c in df.columns else F.lit(None)).cast("double").alias(f"_{name}_{c}") for c in ("frame_count", "fps")
        ])
        out = part if out is None else out.join(part, keys, "full")
    first = names[0]
    rules = [(f"missing in {n}", F.col(f"_{n}").isNull()) for n in names]
    rules += [(f"frame count differs in {n}", F.col(f"_{n}_frame_count") != F.col(f"_{first}_frame_count")) for n in names[1:]]
    rules += [(f"rate differs in {n}", F.abs(F.col(f"_{n}_fps") - F.col(f"_{first}_fps")) > tolerance) for n in names[1:]]
    return out.select(*keys, first_failure(rules).alias("reason"))


def finite_values(df: DataFrame) -> DataFrame:
    """df with null for NaN and infinities, in nested structs, arrays and map values too."""

    def clean(x: Column, kind: DataType) -> Column:
        if isinstance(kind, (DoubleType, FloatType)):
            return F.when(_finite(x), x)
        if isinstance(kind, ArrayType) and _numbers(kind):
            return F.transform(x, lambda e: clean(e, kind.elementType))
        if isinstance(kind, MapType) and _numbers(kind):
            return F.transform_values(x, lambda k, v: clean(v, kind.valueType))
        if isinstance(kind, StructType) and _numbers(kind):
            return F.when(x.isNotNull(), F.struct(*[clean(x[f.name], f.dataType).alias(f.name) for f in kind.fields]))
        return x

    return df.select(*[clean(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def _numbers(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _numbers(kind.elementType)
    if isinstance(kind, MapType):
        return _numbers(kind.valueType)
    if isinstance(kind, StructType):
        return any(_numbers(f.dataType) for f in kind.fields)
    return isinstance(kind, (DoubleType, FloatType))


def with_units(df: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """df whose columns carry unit and description as metadata, which Parquet keeps."""
    for name, (unit, description) in fields.items():
        if name in df.columns:
            df = df.withMetadata(name, {"unit": unit, "description": description})
    return df


def data_dictionary(df: DataFrame) -> list[tuple[str, str, str, str]]:
    """Name, type, unit and description of each column."""
    return [(f.name, f.dataType.simpleString(), f.metadata.get("unit", ""), f.metadata.get("description", "")) for f in df.schema.fields]
