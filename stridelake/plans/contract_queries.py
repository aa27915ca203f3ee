"""Named queries of checks, loaders and stage metrics, with their SQL; faults are planted by the keys of the tables."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.functions import scalars
from stridelake.operators import sequences as S
from stridelake.operators import tables
from stridelake.plans import canonicalize as C
from stridelake.plans import catalog, represent, segment
from stridelake.plans import motion_queries as M
from stridelake.sources import checks, joined, loaders
from stridelake.sources import tables as raw_tables

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def query(sql: str, prefix: str = ""):
    def register(function):
        text = sql.strip()
        if prefix:
            text = f"WITH RECURSIVE {prefix.strip()}" + (f", {text[5:]}" if text.startswith("WITH ") else f"\n{text}")
        _QUERIES[function.__name__] = function
        _SQL[function.__name__] = M._text(text)
        return function

    return register


FRAMES = catalog.FRAMES_SQL


@query("""WITH g AS (SELECT * FROM fr WHERE NOT (seq % 5 = 0 AND frame_index = 0)),
c AS (SELECT seq, count(*) AS n, min(frame_index) AS a, bool_or(frame_index = 3) AS third FROM g GROUP BY seq)
SELECT seq, n AS frame_count, CASE WHEN seq % 7 = 0 THEN 'joints must have 24 points' WHEN seq % 11 = 0 AND third THEN 'joints are not finite'
WHEN n < 2 THEN 'fewer than two frames' WHEN a <> 0 THEN 'frames must count from 0 without gaps' ELSE 'ok' END AS reason FROM c""", FRAMES)
def frame_failures(spark, sf_dir):
    df = catalog.frames(spark, sf_dir).where("NOT (seq % 5 = 0 AND frame_index = 0)")
    x = F.when((F.col("seq") % 11 == 0) & (F.col("frame_index") == 3), F.lit(math.nan)).otherwise(F.col("x"))
    size = F.when(F.col("seq") % 7 == 0, 23).otherwise(24)
    df = df.withColumn("joints", F.array_repeat(F.struct(x.alias("x"), F.col("y"), F.lit(0.0).alias("z")), size))
    return checks.frame_failures(df, ["seq"], joints="joints")


_RUNS = catalog._RUNS.format("event_type")


@query(f"""WITH {_RUNS}, s AS (SELECT seq, run, CASE WHEN seq % 9 = 0 AND run = 0 THEN 'other' ELSE any_value(event_type) END AS label, min(frame_index) AS a, max(frame_index) AS b FROM i GROUP BY seq, run),
k AS (SELECT *, lag(b) OVER (PARTITION BY seq ORDER BY a) AS p FROM s WHERE NOT (seq % 4 = 0 AND run = 1) AND seq % 13 <> 0),
t AS (SELECT seq, count(*) + (seq % 10 = 3)::INT AS n FROM fr GROUP BY seq),
v AS (SELECT seq, bool_or(label = 'other') AS odd, bool_or(coalesce(p + 1, 0) <> a) AS apart, max(b) AS last FROM k GROUP BY seq)
SELECT seq, n AS frame_count, CASE WHEN last IS NULL THEN 'no segments' WHEN odd THEN 'unsupported label' WHEN apart THEN 'segments are not contiguous from frame 0'
WHEN last >= n THEN 'invalid frame span' WHEN last + 1 <> n THEN 'segments do not cover the sequence' ELSE 'ok' END AS reason FROM t LEFT JOIN v USING (seq)""", FRAMES)
def segment_failures(spark, sf_dir):
    df = catalog.frames(spark, sf_dir)
    found = S.runs(df, catalog.SEQ, "event_type").where("NOT (seq % 4 = 0 AND run = 1) AND seq % 13 <> 0")
    found = found.withColumn("label", F.when((F.col("seq") % 9 == 0) & (F.col("run") == 0), "other").otherwise(F.col("event_type")))
    counts = df.groupBy("seq").agg((F.count("*") + F.when(F.col("seq") % 10 == 3, 1).otherwise(0)).alias("frame_count"))
    known = ["click", "purchase", "view", "signup", "error"]
    return checks.segment_failures(found, counts, ["seq"], known, "start", "end")


@query(f"""WITH {_RUNS} SELECT fr.seq, fr.frame_index, fr.event_type AS label FROM fr""", FRAMES)
def frame_labels(spark, sf_dir):
    found = S.runs(catalog.frames(spark, sf_dir), catalog.SEQ, "event_type").withColumnRenamed("event_type", "label")
    return checks.frame_labels(found, ["seq"], "start", "end")


@query("""WITH e AS (SELECT seq, frame_index, CASE WHEN seq % 6 = 1 AND frame_index = 2 THEN 100000 WHEN seq % 6 = 2 AND frame_index = 4 THEN 0 ELSE frame_index END AS frame,
  event_type FROM fr WHERE contact OR other), t AS (SELECT seq, count(*) AS n FROM fr GROUP BY seq),
o AS (SELECT *, lag(frame) OVER (PARTITION BY seq, event_type ORDER BY frame_index) AS p FROM e),
v AS (SELECT seq, bool_or(frame >= n) AS outside, bool_or(frame < p) AS back FROM o JOIN t USING (seq) GROUP BY seq)
SELECT seq, CASE WHEN outside THEN 'event outside the sequence' WHEN back THEN 'events go back' ELSE 'ok' END AS reason FROM t LEFT JOIN v USING (seq)""", FRAMES)
def event_failures(spark, sf_dir):
    df = catalog.frames(spark, sf_dir)
    moved = F.when((F.col("seq") % 6 == 1) & (F.col("frame_index") == 2), 100000).when((F.col("seq") % 6 == 2) & (F.col("frame_index") == 4), 0)
    events = df.where("contact OR other").select("seq", "frame_index", F.coalesce(moved, "frame_index").alias("frame"), F.lit("x").alias("side"), F.col("event_type").alias("event"))
    return checks.event_failures(events, df.groupBy("seq").agg(F.count("*").alias("frame_count")), ["seq"], position="frame_index")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 17 = 0 THEN 'missing in canonical' WHEN c_custkey % 5 = 0 THEN 'missing in represented' WHEN c_custkey % 11 = 0 THEN 'missing in segments'
WHEN c_custkey % 7 = 0 THEN 'frame count differs in represented' WHEN c_custkey % 13 = 0 THEN 'frame count differs in segments' WHEN c_custkey % 19 = 0 THEN 'rate differs in represented'
ELSE 'ok' END AS reason FROM customer WHERE c_custkey % 17 <> 0 OR c_custkey % 5 <> 0 OR c_custkey % 11 <> 0""")
def stage_alignment(spark, sf_dir):
    key = F.col("c_custkey")
    df = catalog.read(spark, sf_dir, "customer").select("c_custkey")
    frames = F.lit(100) + key % 50
    stages = {
        "canonical": df.where(key % 17 != 0).select("c_custkey", frames.alias("frame_count"), F.lit(30.0).alias("fps")),
        "represented": df.where(key % 5 != 0).select(
            "c_custkey", (frames + F.when(key % 7 == 0, 1).otherwise(0)).alias("frame_count"), (30 + F.when(key % 19 == 0, 0.5).otherwise(1e-9)).alias("fps")
        ),
        "segments": df.where(key % 11 != 0).select("c_custkey", (frames - F.when(key % 13 == 0, 1).otherwise(0)).alias("frame_count")),
        "description": df.select("c_custkey").where((key % 17 != 0) | (key % 5 != 0) | (key % 11 != 0)),
    }
    return checks.stage_alignment(stages, ["c_custkey"])


_STAGES = ["canonical", "represented", "segments", "description"]


@query("""WITH k AS (SELECT c_custkey AS k, c_custkey % 17 <> 0 AS a, c_custkey % 5 <> 0 AS b, c_custkey % 11 <> 0 AS c, c_custkey % 3 <> 0 AS d FROM customer)
SELECT k AS c_custkey, concat_ws(',', CASE WHEN a THEN 'canonical' END, CASE WHEN b THEN 'represented' END, CASE WHEN c THEN 'segments' END, CASE WHEN d THEN 'description' END) AS present,
concat_ws(',', CASE WHEN NOT a THEN 'canonical:' || CASE WHEN k % 2 = 0 THEN 'duration_lt_3s' ELSE 'absent' END END, CASE WHEN NOT b THEN 'represented:absent' END,
  CASE WHEN NOT c THEN 'segments:' || CASE WHEN k % 4 = 0 THEN 'a first' WHEN k % 2 = 0 THEN 'a second' ELSE 'absent' END END, CASE WHEN NOT d THEN 'description:absent' END) AS missing,
CASE WHEN NOT a THEN 'missing in canonical' WHEN NOT b THEN 'missing in represented' WHEN NOT c THEN 'missing in segments' WHEN NOT d THEN 'missing in description'
  WHEN k % 23 = 0 THEN 'repeated in segments' WHEN k % 7 = 0 THEN 'frame count differs in represented' WHEN k % 13 = 0 THEN 'frame count differs in segments'
  WHEN k % 19 = 0 THEN 'rate differs in represented' ELSE 'ok' END AS reason,
CASE WHEN a THEN 100 + k % 50 END AS frames, CASE WHEN b AND k % 19 = 0 THEN 30.5 WHEN b THEN 30.0 END AS rate, CASE WHEN d THEN 'text ' || k END AS text
FROM k WHERE a OR b OR c OR d""")
def joined_stages(spark, sf_dir):
    key = F.col("c_custkey")
    df = catalog.read(spark, sf_dir, "customer").select("c_custkey")
    frames = F.lit(100) + key % 50
    found = df.where(key % 11 != 0).select("c_custkey", (frames - F.when(key % 13 == 0, 1).otherwise(0)).alias("frame_count"))
    stages = {
        "canonical": df.where(key % 17 != 0).select("c_custkey", frames.alias("frame_count"), F.lit(30.0).alias("fps")),
        "represented": df.where(key % 5 != 0).select(
            "c_custkey", (frames + F.when(key % 7 == 0, 1).otherwise(0)).alias("frame_count"), (30 + F.when(key % 19 == 0, 0.5).otherwise(0.0)).alias("fps")
        ),
        "segments": found.union(found.where(key % 23 == 0)),
        "description": df.where(key % 3 != 0).select("c_custkey", F.concat(F.lit("text "), key.cast("string")).alias("text_summary_zh")),
    }
    why = df.where(key % 2 == 0).select("c_custkey", F.lit("canonical").alias("stage"), F.lit("duration_lt_3s").alias("reason"))
    for text, n in (("a second", 2), ("a first", 4)):
        why = why.union(df.where(key % n == 0).select("c_custkey", F.lit("segments"), F.lit(text)))
    known = {"canonical": ["frame_count", "fps"], "description": ["text_summary_zh"]}
    out = joined.merge_stages(stages, ["c_custkey"], known, why)
    missing = F.array_compact(F.array(*[F.concat(F.lit(f"{n}:"), F.col("missing")[n]) for n in _STAGES]))
    return out.select(
        "c_custkey", F.array_join("present", ",").alias("present"), F.array_join(missing, ",").alias("missing"), "reason",
        F.col("canonical.frame_count").alias("frames"), F.col("represented.fps").alias("rate"), F.col("description.text_summary_zh").alias("text"),
    )


@query("""SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'rotation is missing' WHEN 1 THEN 'rotation must have shape (3, 3)' WHEN 2 THEN 'rotation is not finite'
WHEN 3 THEN 'rotation is not orthonormal' WHEN 4 THEN 'rotation must have determinant 1' ELSE 'ok' END AS reason FROM customer""")
def rotation_failures(spark, sf_dir):
    key = F.col("c_custkey")
    a = key.cast("double") / 100
    row = lambda *v: F.array(*[x if isinstance(x, Column) else F.lit(float(x)) for x in v])
    turn = F.array(row(F.cos(a), -F.sin(a), 0), row(F.sin(a), F.cos(a), 0), row(0, 0, 1))
    matrix = (
        F.when(key % 6 == 1, F.array(row(1, 0, 0), row(0, 1, 0)))
        .when(key % 6 == 2, F.array(row(math.nan, 0, 0), row(0, 1, 0), row(0, 0, 1)))
        .when(key % 6 == 3, F.array(row(1, 0.1, 0), row(0, 1, 0), row(0, 0, 1)))
        .when(key % 6 == 4, F.array(row(F.cos(a), F.sin(a), 0), row(F.sin(a), -F.cos(a), 0), row(0, 0, 1)))
        .when(key % 6 == 5, turn)
    )
    return catalog.read(spark, sf_dir, "customer").select("c_custkey", matrix.alias("m")).select("c_custkey", checks.rotation_failure("m").alias("reason"))


@query("""SELECT c_custkey, CASE c_custkey % 10 WHEN 0 THEN 'missing keys' WHEN 1 THEN 'pose must have shape (T, 72)' WHEN 2 THEN 'trans must have shape (T, 3)'
WHEN 3 THEN 'pose and trans differ in length' WHEN 4 THEN 'pose or trans is not finite' WHEN 5 THEN 'beta must have shape (10,), (1, 10) or (T, 10)' WHEN 6 THEN 'beta is not constant'
WHEN 7 THEN 'fps must be positive' WHEN 8 THEN 'duration_lt_3s' ELSE 'ok' END AS reason FROM customer""")
def raw_reasons(spark, sf_dir):
    key = F.col("c_custkey") % 10
    n = F.when(key == 8, 8).otherwise(9)
    number = F.when(key == 4, F.lit(math.nan)).otherwise(F.lit(0.5))
    rows = lambda size, count: F.array_repeat(F.array_repeat(number, size), count)
    steady = F.array(F.array_repeat(F.lit(0.1), F.when(key == 5, 9).otherwise(10)))
    drifting = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_repeat(i.cast("double"), 10))
    raw = catalog.read(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(key != 0, rows(F.when(key == 1, 71).otherwise(72), n)).alias("pose"),
        rows(F.when(key == 2, 4).otherwise(3), F.when(key == 3, n + 1).otherwise(n)).alias("trans"),
        F.when(key == 6, drifting).otherwise(steady).alias("beta"),
        F.when(key == 7, F.lit(-3.0)).otherwise(F.lit(3.0)).alias("fps"),
    )
    return raw_tables.skip_short(raw_tables.validate_raw(raw)).select("c_custkey", "reason")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE round(l_tax, 6) END AS tax,
CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE round(l_discount, 6) END AS nested, CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE round(l_quantity, 6) END AS deep FROM lineitem""")
def finite_values(spark, sf_dir):
    key = F.col("l_suppkey")
    odd = lambda value, k, bad: F.when(key % k == 0, F.lit(bad)).otherwise(F.col(value))
    df = catalog.read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        odd("l_tax", 3, math.nan).alias("tax"),
        F.struct(odd("l_discount", 4, math.inf).alias("a"), F.array(F.struct(odd("l_quantity", 5, -math.inf).alias("b"))).alias("list")).alias("nest"),
    )
    clean = checks.finite_values(df)
    return clean.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round("tax", 6).alias("tax"), F.round("nest.a", 6).alias("nested"),
        F.round(F.col("nest.list")[0]["b"], 6).alias("deep"),
    )


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN CASE WHEN c_custkey % 4 = 0 THEN 'folder' ELSE 'B' END WHEN c_custkey % 3 = 0 THEN 'M' ELSE 'S' || c_custkey % 5 END AS subset,
CASE WHEN c_custkey % 2 = 0 THEN 'b' || c_custkey WHEN c_custkey % 3 = 0 THEN 'm' || c_custkey ELSE 's' || c_custkey END AS subject,
CASE WHEN c_custkey % 2 = 0 THEN 'bt' WHEN c_custkey % 3 = 0 THEN 'mt' ELSE 't__x' END AS trial FROM customer""")
def identity_fallbacks(spark, sf_dir):
    key, text = F.col("c_custkey"), F.col("c_custkey").cast("string")
    basic = F.when(key % 2 == 0, F.concat(F.lit('{"subject_id": "b'), text, F.lit('", "trial_id": "bt"'), F.when(key % 4 == 0, "").otherwise(', "subset": "B"'), F.lit("}")))
    meta = F.when(key % 3 == 0, F.concat(F.lit('{"subset": "M", "trial_id": "mt", "subject_id": "m'), text, F.lit('"}'))).otherwise(F.lit('{"subset": "M", "subject_id": "only"}'))
    json = F.concat(F.lit('{"basic_info": '), F.coalesce(basic, F.lit('{"subject_id": ""}')), F.lit(', "metadata": '), meta, F.lit("}"))
    df = catalog.read(spark, sf_dir, "customer").select(
        "c_custkey", json.alias("metadata"), F.concat(F.lit("S"), (key % 5).cast("string"), F.lit("__s"), text, F.lit("__t__x")).alias("stem"), F.lit("folder").alias("folder")
    )
    names = zip(("subset", "subject", "trial"), loaders.identity_from_metadata("metadata", "stem", "folder"), strict=True)
    return df.select("c_custkey", *[c.alias(n) for n, c in names])


@query("""SELECT c_custkey, c_nationkey::VARCHAR AS subset, c_mktsegment AS subject_id, c_custkey::VARCHAR AS trial_id FROM customer
WHERE c_nationkey IN (1, 2, 3, 4, 5, 6, 7) AND contains(lower(c_nationkey || '__' || c_mktsegment || '__' || c_custkey), 'ing__1')""")
def select_stems(spark, sf_dir):
    df = catalog.read(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("subset"), F.col("c_mktsegment").alias("subject_id"), F.col("c_custkey").cast("string").alias("trial_id")
    )
    return tables.select_sequences(df, subsets=[str(k) for k in range(1, 8)], stem_contains="ING__1")


@query(f"""WITH {_RUNS}, s AS (SELECT seq, any_value(event_type) AS label, min(frame_index) AS a, max(frame_index) AS b FROM i GROUP BY seq, run)
SELECT seq, label, round(a / 30.0, 6) AS start_sec, round((b + 1) / 30.0, 6) AS end_sec FROM s""", FRAMES)
def segment_intervals(spark, sf_dir):
    found = S.runs(catalog.frames(spark, sf_dir), catalog.SEQ, "event_type").select(
        "seq", F.col("event_type").alias("label"), F.col("start").alias("start_frame"), F.col("end").alias("end_frame")
    )
    df = loaders.segment_intervals(found, 30.0, ["seq"])
    return df.select("seq", "label", F.round("start_sec", 6).alias("start_sec"), F.round("end_sec", 6).alias("end_sec"))


@query("""SELECT seq, frame_index, CASE WHEN seq % 3 = 0 OR seq % 8 = 1 THEN NULL ELSE 72 END AS pose_size FROM fr WHERE seq % 5 <> 0""", FRAMES)
def extraction_input(spark, sf_dir):
    df = catalog.frames(spark, sf_dir).select("seq", "frame_index", "x")
    found = S.runs(catalog.frames(spark, sf_dir), catalog.SEQ, "event_type").where("seq % 5 <> 0")
    number = F.when((F.col("seq") % 8 == 1) & (F.col("frame_index") == 0), F.lit(math.nan)).otherwise(F.lit(1.0))
    poses = df.where("seq % 3 <> 0").select("seq", "frame_index", F.array_repeat(number, 72).alias("pose_raw"))
    return loaders.extraction_input(df, found, poses, ["seq"]).select("seq", "frame_index", F.when(F.col("pose_raw").isNotNull(), F.size("pose_raw")).alias("pose_size"))


_METRICS = {
    "valid_frame_ratio": "avg(valid::INT)", "finite_frame_ratio": "1.0", "speed_quality_ratio": "avg((NOT outlier)::INT)", "heading_source_valid_ratio": "1.0",
    "contact_confidence_mean": "avg((l_sure + r_sure) / 2)", "root_speed_xy_max_mps": "max(speed)", "floor_z_estimate_m": "any_value(floor_z)",
    "left_contact_ratio": "avg(l_on::INT)", "right_contact_ratio": "avg(r_on::INT)", "double_support_ratio": "avg((phase = 3)::INT)", "no_contact_ratio": "avg((phase = 0)::INT)",
    "root_speed_xy_mean_mps": "avg(speed)", "left_foot_speed_mean_mps": "avg(l_speed)", "right_foot_speed_mean_mps": "avg(r_speed)",
    "trunk_forward_flexion_mean_deg": "avg(flexion)", "trunk_lateral_lean_mean_deg": "avg(sideways)", "trunk_lean_mean_deg": "avg(lean)",
    "representation_quality_score_mean": "avg(score)",
}


@query(f"""SELECT {M._NAMES}, count(*) AS frame_count, sum((NOT valid)::INT)::BIGINT AS num_invalid_frames, sum(outlier::INT)::BIGINT AS velocity_outlier_count, 0::BIGINT AS joint_nan_frame_count,
sum(l_to::INT)::BIGINT AS left_toe_off_count, sum(r_to::INT)::BIGINT AS right_toe_off_count, {M._round(_METRICS, 5)} FROM rep GROUP BY seq""", M.REPRESENT_SQL)
def represent_metrics(spark, sf_dir):
    df = represent.quality_metrics(M.represented(spark, sf_dir))
    counts = ["frame_count", "num_invalid_frames", "velocity_outlier_count", "joint_nan_frame_count", "left_toe_off_count", "right_toe_off_count"]
    return df.select(*M.KEYS, *counts, *M.rounded(df, {n: n for n in _METRICS}, 5))


_TALL = " + ".join(f"r{{0}}{k} * b2{k}" for k in range(3))


@query(f"""WITH lo AS (SELECT seq, quantile_cont(z, 0.05) AS g FROM (SELECT c0.seq, unnest([{', '.join(f's * {M._lin(M._R3[2], M._pt(k))} + tz' for k in (10, 7, 11, 8))}]) AS z
  FROM c0 JOIN can USING (seq)) GROUP BY seq),
up AS (SELECT *, {_TALL.format(0)} AS ux, {_TALL.format(1)} AS uy, {_TALL.format(2)} AS uz FROM can JOIN lo USING (seq))
SELECT {M._NAMES}, true AS all_outputs_finite, round(s, 6) AS s_global, 0.0 AS first_root_xy_norm_m, round(g, 5) + 0.0 AS ground_z_percentile_m, 1.0 AS det_r_global,
floor_reason IS NULL AS floor_alignment_enabled, round(tilt, 4) AS floor_tilt_before_deg, round(sqrt(ux * ux + uy * uy + (uz - 1) * (uz - 1)), 5) AS body_up_after_error,
round(degrees(acos(least(uz / sqrt(ux * ux + uy * uy + uz * uz), 1.0))), 3) AS body_up_after_angle_deg FROM up""", M.CANONICAL_SQL)
def transform_checks(spark, sf_dir):
    df = C.transform_checks(C.canonicalize(M.tilted_motion(spark, sf_dir), M.FPS, M._TARGETS))
    digits = {"s_global": 6, "first_root_xy_norm_m": 6, "ground_z_percentile_m": 5, "det_r_global": 6, "floor_tilt_before_deg": 4, "body_up_after_error": 5, "body_up_after_angle_deg": 3}
    return df.select(*M.KEYS, "all_outputs_finite", "floor_alignment_enabled", *[(F.round(n, d) + 0.0).alias(n) for n, d in digits.items()])


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 25.0 WHEN c_custkey % 5 = 0 THEN 50.0 ELSE 30.0 END AS fps FROM customer""")
def rate_fallbacks(spark, sf_dir):
    key = F.col("c_custkey")
    given = F.when(key % 3 == 0, F.lit(25.0)).otherwise(F.lit(0.0))
    stored = F.when(key % 5 == 0, F.lit(50.0)).otherwise(F.lit(math.inf))
    return catalog.read(spark, sf_dir, "customer").select("c_custkey", loaders.rate(given, stored, F.lit(30.0)).alias("fps"))


_HEIGHT = "x"


@query("""WITH q AS (SELECT seq, quantile_cont(x, 0.02) AS lo, greatest(quantile_cont(x, 0.98) - quantile_cont(x, 0.02), 0.0001) AS span FROM fr GROUP BY seq)
SELECT seq, frame_index, round(CASE WHEN span < 0.16 THEN 0.5 ELSE greatest(least((x - lo) / span, 1.0), 0.0) END, 6) AS height,
round(abs(((heading - first_value(heading) OVER (PARTITION BY seq ORDER BY frame_index) + 180) % 360 + 360) % 360 - 180), 6) AS turned FROM fr JOIN q USING (seq)""", FRAMES)
def normalized_height(spark, sf_dir):
    df = segment.with_normalized_height(catalog.frames(spark, sf_dir), catalog.SEQ, _HEIGHT, "height")
    turned = F.abs(scalars.wrap_degrees(F.col("heading") - F.first("heading").over(catalog.SEQ.whole)))
    return df.select("seq", "frame_index", F.round("height", 6).alias("height"), F.round(turned, 6).alias("turned"))
