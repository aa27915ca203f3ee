"""One record per sequence of all that the stages found: rows of each grain nested in each other, with a state and warnings per stage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.plans.represent import MOTION
from stridelake.sources.store import StageStore

# Stages by place, each with the warnings of the status table that are its own.
STAGES = ("input", "canonicalization", "segmentation", "walk", "turn", "description")
NOTES = {"floor_reason": "canonicalization", "yaw_reason": "canonicalization", "scale_reason": "canonicalization"}


def _least(name: str) -> Column:
    """Of the structs in a group the one whose JSON is least, as maps have no order of their own."""
    return F.min_by(name, F.to_json(name)).alias(name)


def _all(name: str) -> Column:
    return F.array_distinct(F.flatten(F.collect_list(name))).alias(name)


def sequence_records(
    singles: dict[str, DataFrame],
    segments: DataFrame,
    features: dict[str, DataFrame],
    warnings: DataFrame,
    states: DataFrame,
    keys: list[str],
    segment: str = "segment_id",
    order: str = "start_frame",
) -> DataFrame:
    """Every sequence of any table, one row.

    singles are tables of one row per sequence, each a struct of its name. segments
    is an array, by order and then name, of structs: segment, the columns of the
    segment's row, and for each kind of features those of its row there. stages is an
    array of stage, state and warnings by the place in states(place, stage, state);
    warnings(place, stage, text) gives the texts, repeated ones once, as it gives the
    array warnings of the record. counts maps each kind to its number of rows.

    A struct is null where a table has no row. Of repeated rows that differ the one
    whose JSON is least counts, and only it. Features whose segment isn't in the
    table stand last, beside a null segment; a warning of a stage that has no state
    is in the record's warnings only. Null keys are a sequence like another, a null
    segment is none: its rows are left out.

    All rows meet in one exchange by the keys, after which segments, then
    sequences, are put together where they are.
    """
    here = F.lit(True).alias("here")

    def packed(df: DataFrame, name: str, *more: Column) -> DataFrame:
        rest = [c for c in df.columns if c not in (*keys, segment if more else None)]
        return df.select(*keys, *more, F.struct(here, *rest).alias(name))

    def shown(df: DataFrame, name: str, *more: str) -> Column:
        # A struct needs a field: `here` stays where the table has no column but those it is joined by.
        return F.col(name).dropFields("here") if set(df.columns) - {*keys, *more} else F.col(name)

    place = F.col(segment).cast("string").alias("_id")
    rows = [packed(df, f"_1{n}") for n, df in singles.items()]
    rows.append(packed(segments.where(F.col(segment).isNotNull()), "_segment", place))
    rows += [packed(df.where(F.col(segment).isNotNull()), f"_2{n}", place) for n, df in features.items()]
    rows.append(warnings.select(*keys, F.array(F.struct("place", "stage", "text")).alias("_warnings")))
    rows.append(states.select(*keys, F.array(F.struct("place", "stage", "state")).alias("_states")))
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows).repartition(*keys)

    kinds, names = [f"_2{n}" for n in features], [f"_1{n}" for n in singles]
    parts = together.groupBy(*keys, "_id").agg(*map(_least, [*names, "_segment", *kinds]), _all("_warnings"), _all("_states"))
    entry = F.struct(
        F.col(f"_segment.{order}").alias("at"), F.col("_id").alias("id"), shown(segments, "_segment", segment).alias("segment"),
        *[shown(df, f"_2{n}", segment).alias(n) for n, df in features.items()],
    )
    parts = parts.withColumn("_entry", F.when(F.col("_id").isNotNull(), entry))
    record = parts.groupBy(*keys).agg(
        *map(_least, names), F.collect_list("_entry").alias("_entries"), *[F.count(k).alias(k) for k in kinds], _all("_warnings"), _all("_states")
    )

    def before(a: Column, b: Column) -> Column:
        by = lambda x, y: F.when(x < y, -1).when(x > y, 1).when(x.isNull() & y.isNotNull(), 1).when(x.isNotNull() & y.isNull(), -1)
        return F.coalesce(by(a["at"], b["at"]), by(a["id"], b["id"]), F.lit(0))

    told = F.array_sort("_warnings")
    texts = lambda found: F.array_distinct(F.transform(found, lambda w: w["text"]))
    mine = lambda s: texts(F.filter(told, lambda w: w["stage"].eqNullSafe(s["stage"])))
    stages = F.transform(F.array_sort("_states"), lambda s: F.struct(s["stage"].alias("stage"), s["state"].alias("state"), mine(s).alias("warnings")))
    nested = F.transform(F.array_sort("_entries", before), lambda e: e.dropFields("at", "id"))
    counts = [c for n in features for c in (F.lit(n), F.col(f"_2{n}"))]
    return record.select(
        *keys, *[F.when(F.col(f"_1{n}").isNotNull(), shown(df, f"_1{n}")).alias(n) for n, df in singles.items()], nested.alias("segments"),
        stages.alias("stages"), texts(told).alias("warnings"), (F.create_map(*counts) if counts else F.create_map()).alias("counts"),
    )


def stored_records(spark: SparkSession, folder: str, fps: float, reference: str, keys: tuple[str, ...] = MOTION.keys) -> DataFrame | None:
    """sequence_records() of what the runs of run_raw() or run_stages() in a folder hold of each sequence; None before the first has ended.

    Singles are sequence (frame_count, fps, duration_sec, reason, status),
    reference (the name of the library that ranked it) and description; features are
    walk and turn. Rejected sequences have a record as well.
    """
    store = StageStore(spark, folder, keys)
    status = store.latest()
    if status is None:
        return None
    names = store.keys
    sequence = status.select(
        *names, "frame_count", F.lit(fps).alias("fps"), (F.col("frame_count") / fps).alias("duration_sec"), "reason", "status",
        F.lit(reference).alias("reference_library"),
    )
    place = {n: i for i, n in enumerate(STAGES)}
    seen = [f.name for f in status.schema["stages"].dataType]
    state = F.explode(F.array(*[F.struct(F.lit(place[n]).alias("place"), F.lit(n).alias("stage"), F.col(f"stages.{n}").alias("state")) for n in seen]))
    states = status.select(*names, state.alias("_s")).select(*names, "_s.*")
    notes = [F.struct(F.lit(place[s]).alias("place"), F.lit(s).alias("stage"), F.col(n).alias("text")) for n, s in NOTES.items() if n in status.columns]
    notes.append(F.struct(F.lit(0).alias("place"), F.lit("input").alias("stage"), F.when(F.col("reason") != "ok", F.col("reason")).alias("text")))
    listed = F.array(*notes)
    if "warnings" in status.columns:
        first = lambda w: F.struct(F.lit(0).alias("place"), F.lit("input").alias("stage"), w.alias("text"))
        listed = F.concat(F.coalesce(F.transform("warnings", first), F.array().cast("array<struct<place: int, stage: string, text: string>>")), listed)
    warnings = status.select(*names, F.explode(listed).alias("_w")).select(*names, "_w.*").where("text IS NOT NULL")
    if {"floor_reason", "yaw_reason"} & set(status.columns):
        solved = F.when(F.col("stages.input") != "ok", "not_run").when(F.coalesce("floor_reason", "yaw_reason").isNotNull(), "partial").otherwise("ok")
        more = status.select(*names, F.lit(place["canonicalization"]).alias("place"), F.lit("canonicalization").alias("stage"), solved.alias("state"))
        states = states.unionByName(more)
    # A stage that never had a row has no table.
    bare = status.limit(0).select(*names, F.lit("").alias("segment_id"), F.lit(0).alias("start_frame"), F.lit("").alias("text_summary_zh"))
    without = {"segments": "text_summary_zh", "description": ("segment_id", "start_frame")}
    tables = {}
    for n in ("segments", "walk", "turn", "description"):
        found = store.current(n)
        dropped = without.get(n, ("text_summary_zh", "start_frame"))
        tables[n] = found if found is not None else bare.drop(*([dropped] if isinstance(dropped, str) else dropped))
    features = {}
    for kind in ("walk", "turn"):
        common = [c for c in tables[kind].columns if c in tables["segments"].columns and c not in (*names, "segment_id")]
        features[kind] = tables[kind].drop(*common)
    return sequence_records({"sequence": sequence, "description": tables["description"]}, tables["segments"], features, warnings, states, names)
