"""Stage tables joined for the next stage, and identity from metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stridelake.functions.strings import first_known, identity_from_stem
from stridelake.sources.checks import POSE, finite_values


def first_path(json: str | Column, *paths: str) -> Column:
    """The first value that isn't blank under these paths of a JSON text."""
    json = F.col(json) if isinstance(json, str) else json
    return first_known(*[F.get_json_object(json, p) for p in paths])


def identity_from_metadata(metadata: str, stem: str, folder: str) -> tuple[Column, Column, Column]:
    """Subset, subject and trial: from basic_info, else from metadata, else from the stem; the folder is the subset of the first two by default.

    A pair of subject and trial counts only where both are known.
    """
    parts = []
    for section in ("basic_info", "metadata"):
        get = lambda name, s=section: first_path(metadata, f"$.{s}.{name}")
        whole = get("subject_id").isNotNull() & get("trial_id").isNotNull()
        parts.append([F.when(whole, F.coalesce(get("subset"), F.col(folder))), *[F.when(whole, get(n)) for n in ("subject_id", "trial_id")]])
    return tuple(F.coalesce(a, b, c) for a, b, c in zip(*parts, identity_from_stem(stem), strict=True))


def single_sequence(flat: DataFrame) -> DataFrame:
    """flat, if it holds exactly one sequence; a ValueError that says how many otherwise."""
    n = flat.limit(2).count()
    if n != 1:
        raise ValueError(f"expected exactly one sequence, found {'none' if n == 0 else 'several'}")
    return flat


def extraction_input(frames: DataFrame, segments: DataFrame, poses: DataFrame | None, keys: list[str], order: str = "frame_index") -> DataFrame:
    """Represented frames of sequences that have segments, with pose_raw where a pose of the right size and finite values exists."""
    df = frames.join(segments.select(*keys).distinct(), keys, "left_semi")
    if poses is None:
        return df.withColumn("pose_raw", F.lit(None).cast("array<double>"))
    good = F.coalesce((F.size("pose_raw") == POSE) & F.forall("pose_raw", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    broken = poses.where(~good).select(*keys).distinct()
    usable = poses.join(broken, keys, "left_anti").select(*keys, order, "pose_raw")
    return df.join(usable, [*keys, order], "left")


def included_features(features: DataFrame, label: str) -> DataFrame:
    """Segments of a label that were extracted, their reasons joined, ready for description."""
    df = features.where((F.col("label") == label) & (F.col("extraction_status") == "included"))
    return df.withColumn("reasons", F.array_join("reasons", ";")) if dict(df.dtypes).get("reasons", "").startswith("array") else df


def reference_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A CSV with a header as a table of the schema, empty where there is none."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.csv(path, header=True, schema=schema)


def segment_intervals(segments: DataFrame, fps: float, keys: list[str]) -> DataFrame:
    """Segments as half-open intervals of seconds."""
    return segments.select(*keys, "label", (F.col("start_frame") / fps).alias("start_sec"), ((F.col("end_frame") + 1) / fps).alias("end_sec"))


def rate(*candidates: Column) -> Column:
    """The first positive finite rate."""
    return F.coalesce(*[F.when((c > 0) & (c < float("inf")), c) for c in candidates])


def as_json(df: DataFrame, keys: list[str], name: str = "payload") -> DataFrame:
    """keys and a JSON text of all other columns; NaN and infinities are null in it."""
    rest = [c for c in df.columns if c not in keys]
    return finite_values(df).select(*keys, F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}).alias(name))
