"""Stage tables joined into one row per sequence, and into the frames that drawing or analysis reads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelake.sources.checks import frame_labels
from stridelake.sources.contracts import first_failure, require_columns


def merge_stages(
    stages: dict[str, DataFrame], keys: list[str], known: dict[str, list[str]] | None = None, why: DataFrame | None = None, tolerance: float = 1e-6
) -> DataFrame:
    """Every sequence of any stage, one row: a struct of each stage's columns (null where it has none), present, missing and reason.

    present lists the stages that hold the sequence; missing maps each other one to
    its reason in why(keys, stage, reason) - the first in order, of several - or to
    `absent`. reason is the first rule that is broken, `ok` otherwise: a stage is
    missing, holds the sequence more than once, or differs from the first stage in
    frame_count or, by more than tolerance, in fps; a stage that lacks or doesn't
    know either passes that rule. Columns of a stage beyond those named in known
    are a ValueError.

    All stages meet in one exchange by the keys, whatever their number, each side
    reduced to its sequences before. Of a repeated sequence the struct is the least
    one; null keys are a sequence like another.
    """
    for name, columns in (known or {}).items():
        require_columns(stages[name], [*keys, *columns], exactly=True)
    parts = []
    for name, df in stages.items():
        rest = [c for c in df.columns if c not in keys]
        parts.append(df.select(*keys, F.struct(F.lit(True).alias("here"), *rest).alias(f"_{name}")))
    if why is not None:
        parts.append(why.select(*keys, F.struct("stage", "reason").alias("_why")))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    names = list(stages)
    told = F.sort_array(F.collect_set("_why")) if why is not None else F.array().cast("array<struct<stage: string, reason: string>>")
    merged = rows.groupBy(*keys).agg(
        *[F.min(f"_{n}").alias(n) for n in names], *[F.count(f"_{n}").alias(f"_{n}_rows") for n in names], told.alias("_told")
    )
    merged = merged.where(F.greatest(*[F.col(f"_{n}_rows") for n in names], F.lit(0)) > 0)
    held = lambda n: F.col(f"_{n}_rows") > 0
    first = names[0]
    has = lambda n, c: c in stages[n].columns and c in stages[first].columns
    rules = [(f"missing in {n}", ~held(n)) for n in names] + [(f"repeated in {n}", F.col(f"_{n}_rows") > 1) for n in names]
    rules += [(f"frame count differs in {n}", F.col(f"{n}.frame_count") != F.col(f"{first}.frame_count")) for n in names[1:] if has(n, "frame_count")]
    rules += [(f"rate differs in {n}", F.abs(F.col(f"{n}.fps") - F.col(f"{first}.fps")) > tolerance) for n in names[1:] if has(n, "fps")]
    lacking = F.array_compact(F.array(*[F.when(~held(n), F.lit(n)) for n in names]))

    def reason(stage):
        mine = F.filter("_told", lambda t: t["stage"] == stage)
        return F.struct(stage.alias("key"), F.coalesce(F.get(mine, F.lit(0))["reason"], F.lit("absent")).alias("value"))

    return merged.select(
        *keys, *[F.when(held(n), F.col(n).dropFields("here") if len(stages[n].columns) > len(keys) else F.col(n)).alias(n) for n in names],
        F.array_compact(F.array(*[F.when(held(n), F.lit(n)) for n in names])).alias("present"),
        F.map_from_entries(F.transform(lacking, reason)).alias("missing"), first_failure(rules).alias("reason"),
    )


def joined_frames(merged: DataFrame, canonical: DataFrame, represented: DataFrame, segments: DataFrame, keys: list[str], order: str = "frame_index") -> DataFrame:
    """Frames of the sequences that merge_stages() found sound: canonical and represented columns, and the label of the segment around each.

    A frame that either table lacks is left out; one outside all segments has a null label.
    """
    sound = merged.where("reason = 'ok'").select(*keys)
    place = [*keys, order]
    extra = [c for c in represented.columns if c not in canonical.columns]
    df = canonical.join(sound, keys, "left_semi").join(represented.select(*place, *extra), place)
    labels = frame_labels(segments, keys).withColumnRenamed("frame_index", order)
    return df.drop("label").join(labels, place, "left")
