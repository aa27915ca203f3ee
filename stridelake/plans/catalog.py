"""Named queries of the ordered-sequence operators, with their SQL.

The tables hold no motion data, so sequences are the events of a user in order of
time, and the value, a derived angle and masks of event types stand for signals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stridelake.functions import scalars, strings, vectors
from stridelake.operators import aggregates, joins, tables
from stridelake.operators import sequences as S
from stridelake.operators.sequences import Sequence
from stridelake.plans import extract, represent, segment

SEQ = Sequence(("seq",))
FPS = 30.0

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}

FRAMES_SQL = """
fr AS MATERIALIZED (
  SELECT user_id AS seq,
    CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER) AS frame_index,
    value AS x, CAST(json_extract(props, '$.k') AS DOUBLE) AS y, (value * 7) % 360 - 180 AS heading,
    event_type, event_type IN ('click', 'purchase') AS contact, event_type IN ('view', 'signup') AS other,
    event_type <> 'error' AS valid
  FROM events)"""


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as frames: seq, frame_index, x, y, heading, event_type, contact, other, valid."""
    events = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    events = S.with_frame_index(events, ("user_id",), ["ts", "event_id"])
    return events.select(
        F.col("user_id").alias("seq"),
        "frame_index",
        F.col("value").alias("x"),
        F.get_json_object("props", "$.k").try_cast("double").alias("y"),
        (F.pmod(F.col("value") * 7, F.lit(360.0)) - 180).alias("heading"),
        "event_type",
        F.col("event_type").isin("click", "purchase").alias("contact"),
        F.col("event_type").isin("view", "signup").alias("other"),
        (F.col("event_type") != "error").alias("valid"),
    )


def query(sql: str | None = None, with_frames: bool = True):
    """Register a function as the query of its name, with the SQL of the same rows."""

    def register(function):
        name = function.__name__
        _QUERIES[name] = function
        if sql is not None:
            text = sql.strip()
            if with_frames:
                text = f"WITH {FRAMES_SQL.strip()}" + (f", {text[5:]}" if text.startswith("WITH ") else f"\n{text}")
            _SQL[name] = text
        return function

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def r6(value, name: str):
    value = F.col(value) if isinstance(value, str) else value
    return F.round(value, 6).alias(name)


# Derivatives, angles, fills -------------------------------------------------

_DIFF = """CASE WHEN lag({0}) OVER w IS NULL AND lead({0}) OVER w IS NULL THEN 0.0
    WHEN lag({0}) OVER w IS NULL THEN (lead({0}) OVER w - {0}) * 30
    WHEN lead({0}) OVER w IS NULL THEN ({0} - lag({0}) OVER w) * 30
    ELSE (lead({0}) OVER w - lag({0}) OVER w) * 15 END"""
_W = "WINDOW w AS (PARTITION BY seq ORDER BY frame_index)"


@query(f"SELECT seq, frame_index, round({_DIFF.format('x')}, 6) AS velocity FROM fr {_W}")
def finite_difference(spark, sf_dir):
    df = frames(spark, sf_dir)
    return df.select("seq", "frame_index", r6(S.finite_difference("x", SEQ, FPS), "velocity"))


@query(f"""WITH v AS (SELECT seq, frame_index, {_DIFF.format('x')} AS v FROM fr {_W}),
a AS (SELECT seq, frame_index, {_DIFF.format('v')} AS a FROM v {_W})
SELECT seq, frame_index, round(a, 4) AS acceleration, round(abs({_DIFF.format('a')}), 3) AS jerk FROM a {_W}""")
def higher_derivatives(spark, sf_dir):
    df = frames(spark, sf_dir).withColumn("v", S.finite_difference("x", SEQ, FPS))
    df = df.withColumn("a", S.finite_difference("v", SEQ, FPS))
    jerk = F.abs(S.finite_difference("a", SEQ, FPS))
    return df.select("seq", "frame_index", F.round("a", 4).alias("acceleration"), F.round(jerk, 3).alias("jerk"))


@query("""SELECT seq, frame_index, round(((heading * 3 + 180) % 360 + 360) % 360 - 180, 6) AS wrapped FROM fr""")
def wrap_degrees(spark, sf_dir):
    return frames(spark, sf_dir).select(
        "seq", "frame_index", r6(scalars.wrap_degrees(F.col("heading") * 3), "wrapped")
    )


_UNWRAP = """s AS (SELECT *, heading - lag(heading) OVER w AS d FROM fr WINDOW w AS (PARTITION BY seq ORDER BY frame_index)),
f AS (SELECT *, CASE WHEN d IS NULL OR abs(d) < 180 THEN 0.0
  WHEN ((d + 180) % 360 + 360) % 360 - 180 = -180 AND d > 0 THEN 180 - d
  ELSE ((d + 180) % 360 + 360) % 360 - 180 - d END AS c FROM s),
u AS (SELECT *, heading + sum(c) OVER (PARTITION BY seq ORDER BY frame_index ROWS UNBOUNDED PRECEDING) AS unwrapped FROM f)"""


@query(f"WITH {_UNWRAP} SELECT seq, frame_index, round(unwrapped, 6) AS unwrapped FROM u")
def unwrap_degrees(spark, sf_dir):
    df = S.unwrap_degrees(frames(spark, sf_dir), SEQ, "heading", "unwrapped")
    return df.select("seq", "frame_index", r6("unwrapped", "unwrapped"))


@query(f"""SELECT seq, frame_index, round(abs(((heading - first_value(heading) OVER w + 180) % 360 + 360) % 360 - 180), 6) AS turned
FROM fr {_W}""")
def heading_delta_abs(spark, sf_dir):
    start = F.first("heading").over(SEQ.whole)
    return frames(spark, sf_dir).select(
        "seq", "frame_index", r6(F.abs(scalars.wrap_degrees(F.col("heading") - start)), "turned")
    )


@query("""WITH p AS (SELECT *,
  last_value(CASE WHEN contact THEN frame_index END IGNORE NULLS) OVER (PARTITION BY seq ORDER BY frame_index ROWS UNBOUNDED PRECEDING) AS b,
  first_value(CASE WHEN contact THEN frame_index END IGNORE NULLS) OVER (PARTITION BY seq ORDER BY frame_index ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a
  FROM fr)
SELECT p.seq, p.frame_index, round(coalesce(s.x, 0.0), 6) AS filled FROM p LEFT JOIN fr s ON s.seq = p.seq AND s.frame_index =
  CASE WHEN b IS NOT NULL AND (a IS NULL OR p.frame_index - b <= a - p.frame_index) THEN b ELSE a END""")
def nearest_valid_fill(spark, sf_dir):
    df = S.nearest_valid_fill(frames(spark, sf_dir), SEQ, ["x"], "contact", [0.0])
    return df.select("seq", "frame_index", r6("x", "filled"))


# Runs, masks, crossings -----------------------------------------------------

_RUNS = """c AS (SELECT *, coalesce(({0} <> lag({0}) OVER w)::INT, 0) AS ch FROM fr WINDOW w AS (PARTITION BY seq ORDER BY frame_index)),
i AS (SELECT *, sum(ch) OVER (PARTITION BY seq ORDER BY frame_index ROWS UNBOUNDED PRECEDING) AS run FROM c)"""


@query(f"""WITH {_RUNS.format('contact')} SELECT seq, min(frame_index) AS start, max(frame_index) AS "end", count(*) AS length
FROM i WHERE contact GROUP BY seq, run""")
def true_runs(spark, sf_dir):
    return S.true_runs(frames(spark, sf_dir), SEQ, "contact").select("seq", "start", "end", "length")


@query(f"""WITH {_RUNS.format('contact')}, n AS (SELECT *, count(*) OVER (PARTITION BY seq, run) AS size FROM i)
SELECT seq, frame_index, contact AND size >= 2 AS kept FROM n""")
def remove_short_runs(spark, sf_dir):
    df = S.remove_short_true_runs(frames(spark, sf_dir), SEQ, "contact", 2, "kept")
    return df.select("seq", "frame_index", "kept")


@query(f"""WITH {_RUNS.format('contact')}, n AS (SELECT *, count(*) OVER (PARTITION BY seq, run) AS size FROM i)
SELECT seq, frame_index, contact OR size < 2 AS filled FROM n""")
def fill_short_runs(spark, sf_dir):
    df = S.fill_short_false_runs(frames(spark, sf_dir), SEQ, "contact", 2, "filled")
    return df.select("seq", "frame_index", "filled")


@query(f"""SELECT seq, frame_index, contact AND NOT coalesce(lag(contact) OVER w, false) AS onset,
NOT contact AND coalesce(lag(contact) OVER w, false) AS "offset" FROM fr {_W}""")
def onsets_offsets(spark, sf_dir):
    return frames(spark, sf_dir).select(
        "seq", "frame_index", S.mask_onsets("contact", SEQ).alias("onset"), S.mask_offsets("contact", SEQ).alias("offset")
    )


@query(f"""WITH c AS (SELECT *, coalesce(lag(x) OVER w < 50 AND x >= 50, false) AS up, coalesce(lag(x) OVER w > 20 AND x <= 20, false) AS down FROM fr {_W})
SELECT seq, frame_index, up, down, min(CASE WHEN up THEN frame_index END) OVER (PARTITION BY seq ORDER BY frame_index
  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_up FROM c""")
def threshold_crossings(spark, sf_dir):
    df = frames(spark, sf_dir)
    df = df.withColumn("up", S.crossings("x", SEQ, 50.0, True)).withColumn("down", S.crossings("x", SEQ, 20.0, False))
    return df.select("seq", "frame_index", "up", "down", S.next_true("up", SEQ).alias("next_up"))


@query(f"""WITH d AS (SELECT *, coalesce(NOT (x - lag(x) OVER w > 0), true)::INT AS b FROM fr {_W}),
g AS (SELECT *, sum(b) OVER (PARTITION BY seq ORDER BY frame_index ROWS UNBOUNDED PRECEDING) AS run FROM d)
SELECT seq, frame_index, min(frame_index) OVER (PARTITION BY seq, run) AS rise_start, max(frame_index) OVER (PARTITION BY seq, run) AS rise_end FROM g""")
def monotone_extremum(spark, sf_dir):
    df = S.monotone_bounds(frames(spark, sf_dir), SEQ, "x", True, "rise_start", "rise_end")
    return df.select("seq", "frame_index", "rise_start", "rise_end")


@query("""WITH s AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY seq) < 9 THEN x ELSE
  sum(x) OVER (PARTITION BY seq ORDER BY frame_index ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING) / 9 END AS s FROM fr),
d AS (SELECT *, s - lag(s) OVER (PARTITION BY seq ORDER BY frame_index) AS d FROM s),
e AS (SELECT seq, greatest(0.25 * quantile_cont(abs(d), 0.2), 1e-6) AS eps FROM d GROUP BY seq),
g AS (SELECT d.seq, frame_index, s, sg, sum(CASE WHEN d IS NULL OR (sg = 1 AND d < -eps) OR (sg = -1 AND d > eps) THEN 1 ELSE 0 END)
  OVER (PARTITION BY d.seq, sg ORDER BY frame_index ROWS UNBOUNDED PRECEDING) AS run
  FROM d JOIN e USING (seq), (SELECT unnest([1, -1]) AS sg)),
b AS (SELECT seq, min(frame_index) AS start, max(frame_index) AS "end", arg_max(s, frame_index) - arg_min(s, frame_index) AS displacement
  FROM g GROUP BY seq, sg, run HAVING count(*) > 1)
SELECT seq, start, "end", round(displacement, 6) AS displacement FROM (
  SELECT *, row_number() OVER (PARTITION BY seq ORDER BY abs(displacement) DESC, "end" - start DESC, start) AS r FROM b) WHERE r = 1""")
def longest_monotone_segment(spark, sf_dir):
    df = S.longest_monotone_segment(frames(spark, sf_dir), SEQ, "x")
    return df.select("seq", "start", "end", r6("displacement", "displacement"))


@query(f"""WITH p AS (SELECT seq, frame_index, 0.6 * (1 - least(greatest((x - quantile_cont(x, 0.05) OVER (PARTITION BY seq)) / 80, 0), 1))
  + 0.4 * (1 - least(greatest(abs({_DIFF.format('y')}) / 3000, 0), 1)) AS prob FROM fr {_W}),
m AS (SELECT *, round(prob, 8) >= 0.5 AS contact FROM p),
{_RUNS.format('contact').replace('FROM fr', 'FROM m')},
k AS (SELECT seq, frame_index, prob, contact AND count(*) OVER (PARTITION BY seq, run) >= 2 AS kept FROM i),
{_RUNS.format('kept').replace('FROM fr', 'FROM k').replace('c AS (', 'c2 AS (').replace('i AS (', 'i2 AS (').replace('FROM c)', 'FROM c2)')}
SELECT seq, frame_index, round(prob, 8) AS probability, kept OR count(*) OVER (PARTITION BY seq, run) < 2 AS contact FROM i2""")
def contact_probability(spark, sf_dir):
    df = frames(spark, sf_dir)
    floor = F.percentile("x", 0.05).over(Window.partitionBy("seq"))
    speed = F.abs(S.finite_difference("y", SEQ, FPS))
    cfg = represent.RepresentConfig(contact_height=80.0, contact_speed=3000.0)
    df = df.withColumn("clear", F.col("x") - floor).withColumn("prob", represent.contact_probability(F.col("clear"), speed, cfg))
    df = represent.steady_contacts(df, SEQ, F.round("prob", 8), "on", FPS, cfg)
    return df.select("seq", "frame_index", F.round("prob", 8).alias("probability"), F.col("on").alias("contact"))


# Smoothing and rolling ------------------------------------------------------


@query("""WITH o AS (SELECT unnest(range(-8, 9)) AS o), w AS (SELECT o, exp(-0.5 * (o / 2.0) ** 2) AS g FROM o),
b AS (SELECT seq, max(frame_index) AS last FROM fr GROUP BY seq)
SELECT fr.seq, fr.frame_index, round(sum(n.x * g) / sum(g), 6) AS smooth FROM fr JOIN b USING (seq) CROSS JOIN w
JOIN fr n ON n.seq = fr.seq AND n.frame_index = least(greatest(fr.frame_index + o, 0), last) GROUP BY fr.seq, fr.frame_index""")
def gaussian_smooth(spark, sf_dir):
    return frames(spark, sf_dir).select("seq", "frame_index", r6(S.gaussian_smooth("x", SEQ, 2), "smooth"))


@query("""SELECT seq, frame_index, round(CASE WHEN count(*) OVER (PARTITION BY seq) < 9 THEN x ELSE
sum(x) OVER (PARTITION BY seq ORDER BY frame_index ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING) / 9 END, 6) AS average FROM fr""")
def moving_average_zero_pad(spark, sf_dir):
    return frames(spark, sf_dir).select("seq", "frame_index", r6(S.moving_average_zero_padded("x", SEQ), "average"))


@query("""WITH q AS (SELECT seq, quantile_cont(x, 0.02) AS lo, quantile_cont(x, 0.98) AS hi FROM fr GROUP BY seq)
SELECT seq, frame_index, round(CASE WHEN hi - lo < 0.16 THEN 0.5 ELSE least(greatest((x - lo) / (hi - lo), 0), 1) END, 6) AS height FROM fr JOIN q USING (seq)""")
def norm_height_p2_p98(spark, sf_dir):
    df = segment.with_normalized_height(frames(spark, sf_dir), SEQ, "x", "height")
    return df.select("seq", "frame_index", r6("height", "height"))


@query("""WITH s AS (SELECT seq, frame_index, count(*) OVER w AS n, count(*) OVER (PARTITION BY seq) AS total,
  covar_pop(x, y) OVER w AS c, stddev_pop(x) OVER w * stddev_pop(y) OVER w AS d FROM fr
  WINDOW w AS (PARTITION BY seq ORDER BY frame_index ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING))
SELECT seq, frame_index, round(CASE WHEN n >= greatest(least(24, total) // 2, 3) AND d * n > 1e-8 THEN c / d ELSE 0.0 END, 6) AS correlation FROM s""")
def rolling_correlation(spark, sf_dir):
    return frames(spark, sf_dir).select("seq", "frame_index", r6(S.rolling_correlation("x", "y", SEQ, 24), "correlation"))


# Segments, pairing, intervals -----------------------------------------------


def _segments(df: DataFrame) -> DataFrame:
    return S.island(df, SEQ, "event_type", "segment_no")


@query(f"""WITH {_RUNS.format('event_type')} SELECT seq, run::INTEGER AS segment_no, any_value(event_type) AS label, min(frame_index) AS start,
max(frame_index) AS "end", round(avg(valid::INT), 6) AS valid_ratio, round(avg(x), 6) AS mean_score,
CASE WHEN avg(valid::INT) < 0.8 OR avg(x) < 20 THEN 'bad' WHEN bool_or(other) THEN 'warning' ELSE 'good' END AS status FROM i GROUP BY seq, run""")
def segment_quality(spark, sf_dir):
    ratio, score = F.avg(F.col("valid").cast("double")), F.avg("x")
    status = segment.graded((ratio < 0.8) | (score < 20), F.bool_or("other"))
    return (
        _segments(frames(spark, sf_dir))
        .groupBy("seq", "segment_no")
        .agg(
            F.first("event_type").alias("label"), F.min("frame_index").alias("start"), F.max("frame_index").alias("end"),
            r6(ratio, "valid_ratio"), r6(score, "mean_score"), status.alias("status"),
        )
    )


@query("""WITH t AS (SELECT seq, frame_index // 10 AS part, event_type, count(*) AS n FROM fr GROUP BY ALL)
SELECT seq, part, event_type AS rule FROM (SELECT *, row_number() OVER (PARTITION BY seq, part ORDER BY n DESC, event_type) AS r FROM t) WHERE r = 1""")
def majority_rule(spark, sf_dir):
    part = F.floor(F.col("frame_index") / 10).cast("int").alias("part")
    return frames(spark, sf_dir).groupBy("seq", part).agg(aggregates.majority("event_type").alias("rule"))


@query(f"""WITH {_RUNS.format('event_type')}, s AS (SELECT seq, min(frame_index) AS a, max(frame_index) AS b FROM i GROUP BY seq, run),
l AS (SELECT *, lag(b) OVER (PARTITION BY seq ORDER BY a) AS p FROM s)
SELECT seq, min(a) = 0 AND bool_and(p IS NULL OR p + 1 = a) AS covers, max(b)::INTEGER AS last_frame FROM l GROUP BY seq""")
def segments_cover_check(spark, sf_dir):
    from stridelake.sources.contracts import segments_cover

    segments = S.runs(frames(spark, sf_dir), SEQ, "event_type")
    return segments_cover(segments, ["seq"], "start", "end")


@query(f"""WITH {_RUNS.format('event_type')}, s AS (SELECT seq, run, min(frame_index) AS a, max(frame_index) AS b FROM i GROUP BY seq, run HAVING count(*) > 1)
SELECT fr.seq, fr.frame_index, s.run::INTEGER AS run, round(fr.x, 6) AS x FROM fr JOIN s ON s.seq = fr.seq AND fr.frame_index BETWEEN s.a AND s.b""")
def interval_join(spark, sf_dir):
    df = frames(spark, sf_dir)
    intervals = S.runs(df, SEQ, "event_type").where("length > 1").select("seq", "run", "start", "end")
    return joins.frames_in_intervals(df, intervals, SEQ).select("seq", "frame_index", "run", r6("x", "x"))


@query("""SELECT seq, frame_index, stop FROM (SELECT *, min(CASE WHEN other THEN frame_index END) OVER (PARTITION BY seq ORDER BY frame_index
ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS stop FROM fr) WHERE contact AND stop IS NOT NULL""")
def forward_asof_pairing(spark, sf_dir):
    return joins.first_after(frames(spark, sf_dir), SEQ, "contact", "other").select("seq", "frame_index", "stop")


@query("""SELECT f.seq, f.frame_index, CASE WHEN f.frame_index = 0 THEN NULL ELSE least(10,
  f.frame_index - 1 - coalesce((SELECT max(g.frame_index) FROM fr g WHERE g.seq = f.seq AND g.frame_index < f.frame_index AND NOT (g.x < 60)), -1))
  END::INTEGER AS slow_frames FROM fr f WHERE f.event_type = 'purchase'""")
def lookback_low_speed(spark, sf_dir):
    df = frames(spark, sf_dir).withColumn("slow", F.col("x") < 60).withColumn("mark", F.col("event_type") == "purchase")
    out = joins.trailing_run_before(df, SEQ, "mark", "slow", 10, "slow_frames")
    return out.select("seq", "frame_index", F.col("slow_frames").cast("int").alias("slow_frames"))


@query("""WITH e AS (SELECT seq, frame_index, contact, lag(contact) OVER w AS pc, lag(frame_index) OVER w AS pf FROM fr WHERE contact OR other
  WINDOW w AS (PARTITION BY seq ORDER BY frame_index)),
s AS (SELECT seq, frame_index - lag(frame_index) OVER (PARTITION BY seq, contact ORDER BY frame_index) AS d FROM e)
SELECT seq, step_mean, stride_mean FROM (SELECT seq, round(avg((frame_index - pf) / 30.0), 5) AS step_mean FROM e WHERE contact <> pc GROUP BY seq)
FULL JOIN (SELECT seq, round(avg(d / 30.0), 5) AS stride_mean FROM s WHERE d IS NOT NULL GROUP BY seq) USING (seq)""")
def alternating_step_times(spark, sf_dir):
    events = frames(spark, sf_dir).where("contact OR other").select("seq", "frame_index", F.col("contact").alias("side"))
    events = extract.event_gaps(events, ["seq"], "frame_index", FPS).withColumnsRenamed({"_t": "step", "_s": "stride"})
    return events.groupBy("seq").agg(
        F.round(F.avg("step"), 5).alias("step_mean"), F.round(F.avg("stride"), 5).alias("stride_mean")
    ).where(
        "step_mean IS NOT NULL OR stride_mean IS NOT NULL"
    )


@query("""WITH b AS (SELECT seq, count(*) AS n, arg_min(x, frame_index) AS a, arg_max(x, frame_index) AS z FROM fr GROUP BY seq)
SELECT seq, round(stddev_pop(x - (a + (z - a) * frame_index / (n - 1))), 5) AS sway FROM fr JOIN b USING (seq) GROUP BY seq""")
def detrended_std(spark, sf_dir):
    return frames(spark, sf_dir).groupBy("seq").agg(F.round(aggregates.detrended_std("x", "frame_index"), 5).alias("sway"))


@query(f"""WITH {_UNWRAP}, b AS (SELECT *, first_value(unwrapped) OVER w AS a, last_value(unwrapped) OVER w AS z FROM u
  WINDOW w AS (PARTITION BY seq ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT seq, min(CASE WHEN abs(z - a) >= 15 AND abs(unwrapped - a) >= 0.1 * abs(z - a) THEN frame_index END) AS onset FROM b GROUP BY seq""")
def first_onset(spark, sf_dir):
    df = S.unwrap_degrees(frames(spark, sf_dir), SEQ, "heading", "u")
    df = df.withColumn("hit", extract.has_turned("u", SEQ))
    return df.groupBy("seq").agg(F.min(F.when(F.col("hit"), F.col("frame_index"))).alias("onset"))


@query(f"""WITH m AS (SELECT *, lag(valid) OVER w AND valid AS ok, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS d FROM fr {_W})
SELECT seq, round(sum(d) FILTER (ok), 4) AS path FROM m GROUP BY seq""")
def path_length(spark, sf_dir):
    df = frames(spark, sf_dir).withColumn("d", S.path_step("x", "y", "valid", SEQ))
    return df.groupBy("seq").agg(F.round(F.sum("d"), 4).alias("path"))


# Labels ---------------------------------------------------------------------


@query(f"""WITH m AS (SELECT *, CASE WHEN contact AND x > 80 THEN 'sit_to_stand' WHEN contact AND x < 5 THEN 'stand_to_sit'
  WHEN other AND x < 20 THEN 'sit' WHEN other THEN 'turn' ELSE 'walk' END AS label FROM fr),
h AS (SELECT *, (label = 'walk' AND x < 30) OR (label = 'turn' AND y < 40) AS hes FROM m),
{_RUNS.format('hes').replace('FROM fr', 'FROM h')}
SELECT seq, frame_index, label, hes AND count(*) OVER (PARTITION BY seq, run) >= 2 AS hesitation FROM i""")
def priority_labels_hesitation(spark, sf_dir):
    df = frames(spark, sf_dir)
    contact, other, x = F.col("contact"), F.col("other"), F.col("x")
    label = (
        F.when(contact & (x > 80), "sit_to_stand").when(contact & (x < 5), "stand_to_sit")
        .when(other & (x < 20), "sit").when(other, "turn").otherwise("walk")
    )
    df = df.withColumn("label", label).withColumn(
        "slow", F.coalesce(((F.col("label") == "walk") & (x < 30)) | ((F.col("label") == "turn") & (F.col("y") < 40)), F.lit(False))
    )
    df = S.remove_short_true_runs(df, SEQ, "slow", 2, "hesitation")
    return df.select("seq", "frame_index", "label", "hesitation")


@query(f"""WITH {_RUNS.format('event_type')}, s AS (SELECT seq, run, any_value(event_type) AS label, min(frame_index) AS start FROM i GROUP BY seq, run)
SELECT seq, start, CASE WHEN label = 'click' AND lag(label) OVER w = 'view' AND lead(label) OVER w = 'purchase' THEN 'adjust' ELSE label END AS label
FROM s WINDOW w AS (PARTITION BY seq ORDER BY run)""")
def adjust_relabel(spark, sf_dir):
    segments = S.runs(frames(spark, sf_dir), SEQ, "event_type").withColumnRenamed("event_type", "label")
    out = segment.relabel_between(segments, ["seq"], "run", "click", "view", "purchase", "adjust")
    return out.select("seq", "start", "label")


# Aggregates -----------------------------------------------------------------


@query("""SELECT seq, round(quantile_cont(x, 0.95) - quantile_cont(x, 0.05), 6) AS range_x, round(stddev_pop(x) / abs(avg(x)) * 100, 6) AS cv,
round(abs(avg(x) - avg(y)) / greatest((abs(avg(x)) + abs(avg(y))) / 2, 1e-6) * 100, 6) AS asymmetry FROM fr WHERE valid GROUP BY seq""")
def robust_range_cv_asymmetry(spark, sf_dir):
    df = frames(spark, sf_dir).where("valid")
    out = df.groupBy("seq").agg(
        r6(aggregates.robust_range("x"), "range_x"), r6(aggregates.cv_percent("x"), "cv"),
        F.avg("x").alias("mx"), F.avg("y").alias("my"),
    )
    return out.select("seq", "range_x", "cv", r6(scalars.normalized_asymmetry("mx", "my"), "asymmetry"))


@query("""SELECT l_suppkey, round(CASE WHEN sum(l_discount) > 0 THEN sum(l_extendedprice * l_discount) / sum(l_discount) ELSE avg(l_extendedprice) END, 4)
AS price FROM lineitem GROUP BY l_suppkey""", with_frames=False)
def weighted_mean_fallback(spark, sf_dir):
    df = read(spark, sf_dir, "lineitem").groupBy("l_suppkey")
    return df.agg(F.round(aggregates.weighted_mean("l_extendedprice", "l_discount"), 4).alias("price"))


@query("""WITH u AS (SELECT seq, avg(x) AS speed, stddev_pop(x) AS spread FROM fr GROUP BY seq)
SELECT seq, round(cume_dist() OVER (ORDER BY speed), 6) AS speed_rank, round(1 - cume_dist() OVER (ORDER BY spread), 6) AS spread_rank,
round((cume_dist() OVER (ORDER BY speed) + 1 - cume_dist() OVER (ORDER BY spread)) / 2, 6) AS score FROM u""")
def percentile_ranks(spark, sf_dir):
    users = frames(spark, sf_dir).groupBy("seq").agg(F.avg("x").alias("speed"), F.stddev_pop("x").alias("spread"))
    out = aggregates.percentile_rank(users, users, ["speed", "spread"], ["seq"], inverted=("spread",))
    score = scalars.mean_of_known("speed_rank", "spread_rank")
    return out.select("seq", r6("speed_rank", "speed_rank"), r6("spread_rank", "spread_rank"), r6(score, "score"))


@query("""WITH d AS (SELECT seq, avg(contact::INT) AS l, avg(other::INT) AS r, count(*) FILTER (contact) AS nl, count(*) FILTER (other) AS nr FROM fr GROUP BY seq),
e AS (SELECT seq, contact, lag(contact) OVER (PARTITION BY seq ORDER BY frame_index) AS p FROM fr WHERE contact OR other),
a AS (SELECT seq, coalesce(avg((contact <> p)::INT), 0.0) AS alt FROM e GROUP BY seq)
SELECT seq, round((greatest(0, 1 - least(abs(l - 0.6) / 0.6, 1)) + greatest(0, 1 - least(abs(r - 0.6) / 0.6, 1)) + coalesce(alt, 0)
+ 1 - abs(nl - nr) / greatest(nl + nr, 1)) / 4, 6) AS stability FROM d LEFT JOIN a USING (seq)""")
def contact_stability(spark, sf_dir):
    df = frames(spark, sf_dir)
    left, right = aggregates.double_support_score("contact", "other")
    sides = df.where("contact OR other").withColumn("flip", (F.col("contact") != F.lag("contact").over(SEQ.window)).cast("double"))
    turns = sides.groupBy("seq").agg(F.avg("flip").alias("alternation"))
    duty = df.groupBy("seq").agg(
        left.alias("left"), right.alias("right"), F.count_if("contact").alias("nl"), F.count_if("other").alias("nr")
    )
    duty = duty.join(turns, "seq", "left")
    score = represent.contact_stability(*(F.col(c) for c in ("left", "right", "alternation", "nl", "nr")))
    return duty.select("seq", r6(score, "stability"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, list_position([l_tax, l_discount, l_quantity / 100], list_min([l_tax, l_discount, l_quantity / 100])) - 1 AS place,
round(least(l_tax, l_discount, l_quantity / 100), 6) AS lowest FROM lineitem""", with_frames=False)
def support_argmin(spark, sf_dir):
    df = read(spark, sf_dir, "lineitem")
    low = aggregates.lowest_of(("tax", F.col("l_tax")), ("discount", F.col("l_discount")), ("quantity", F.col("l_quantity") / 100))
    df = df.select("l_orderkey", "l_partkey", "l_suppkey", low.alias("low"))
    return df.select("l_orderkey", "l_partkey", "l_suppkey", F.col("low.place").alias("place"), r6("low.value", "lowest"))


@query("""SELECT seq, frame_index, round(x, 6) AS x FROM (SELECT *, row_number() OVER (PARTITION BY seq, frame_index // 15 ORDER BY x, frame_index) AS r,
count(*) OVER (PARTITION BY seq, frame_index // 15) AS n FROM fr) WHERE r <= ceil(n * 0.15)""")
def lowest_k_per_window(spark, sf_dir):
    out = aggregates.lowest_per_window(frames(spark, sf_dir), ["seq"], "frame_index", "x", 15, 0.15)
    return out.select("seq", "frame_index", r6("x", "x"))


@query("""WITH s AS (SELECT l_suppkey, var_pop(l_quantity) AS a, var_pop(l_discount) AS b, covar_pop(l_quantity, l_discount) AS c,
  covar_pop(l_quantity, l_extendedprice) AS d, covar_pop(l_discount, l_extendedprice) AS e FROM lineitem GROUP BY l_suppkey)
SELECT l_suppkey, round((d * b - e * c) / (a * b - c * c), 3) AS slope_x, round((e * a - d * c) / (a * b - c * c), 3) AS slope_y FROM s""", with_frames=False)
def plane_fit(spark, sf_dir):
    a, b, _, _ = aggregates.plane_fit("l_quantity", "l_discount", "l_extendedprice")
    df = read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(a.alias("a"), b.alias("b"))
    return df.select("l_suppkey", F.round("a", 3).alias("slope_x"), F.round("b", 3).alias("slope_y"))


@query("""WITH s AS (SELECT seq, var_samp(x) AS a, var_samp(y) AS b, covar_samp(x, y) AS c FROM fr GROUP BY seq)
SELECT seq, round(cos(0.5 * atan2(2 * c, a - b)), 6) AS axis_x, round(sin(0.5 * atan2(2 * c, a - b)), 6) AS axis_y,
round(((a + b) / 2 + sqrt(((a - b) / 2) ** 2 + c * c)) / (a + b), 6) AS share FROM s""")
def pca_heading(spark, sf_dir):
    x, y, share = aggregates.principal_axis("x", "y")
    return frames(spark, sf_dir).groupBy("seq").agg(r6(x, "axis_x"), r6(y, "axis_y"), r6(share, "share"))


# Vectors --------------------------------------------------------------------


def _points(spark, sf_dir):
    df = read(spark, sf_dir, "embeddings")
    point = lambda k: tuple(F.col("embedding")[3 * k + i].cast("double") for i in range(3))
    return df, point


@query("""WITH e AS (SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE) AS e FROM embeddings)
SELECT vec_id, round(sqrt((e[4]-e[1])**2 + (e[5]-e[2])**2 + (e[6]-e[3])**2), 6) AS bone,
round(degrees(acos(least(greatest((e[1]*e[4]+e[2]*e[5]+e[3]*e[6]) / (sqrt(e[1]**2+e[2]**2+e[3]**2) * sqrt(e[4]**2+e[5]**2+e[6]**2)), -1), 1))), 5) AS angle,
round(((degrees(atan2(e[2], e[1])) + 180) % 360 + 360) % 360 - 180, 6) AS heading, round(degrees(atan2(e[1], -e[3])), 6) AS sagittal FROM e""", with_frames=False)
def bone_lengths_angles(spark, sf_dir):
    df, point = _points(spark, sf_dir)
    a, b = point(0), point(1)
    return df.select(
        "vec_id", r6(vectors.norm(vectors.minus(b, a)), "bone"), F.round(vectors.angle_degrees(a, b), 5).alias("angle"),
        r6(vectors.heading_degrees(a), "heading"), r6(vectors.sagittal_degrees(a), "sagittal"),
    )


@query("""WITH e AS (SELECT vec_id, embedding[1]::DOUBLE * 9 AS x, embedding[2]::DOUBLE * 9 AS y, embedding[3]::DOUBLE * 9 AS z FROM embeddings),
a AS (SELECT vec_id, sqrt(x*x + y*y + z*z) AS t, x / greatest(sqrt(x*x + y*y + z*z), 1e-8) AS x, y / greatest(sqrt(x*x + y*y + z*z), 1e-8) AS y,
  z / greatest(sqrt(x*x + y*y + z*z), 1e-8) AS z FROM e)
SELECT vec_id, round(cos(t) + x*x*(1-cos(t)), 6) AS m00, round(x*y*(1-cos(t)) - z*sin(t), 6) AS m01,
round(degrees(atan2(z*y*(1-cos(t)) + x*sin(t), cos(t) + z*z*(1-cos(t)))), 4) AS roll,
round(degrees(asin(least(greatest(-(z*x*(1-cos(t)) - y*sin(t)), -1), 1))), 4) AS pitch,
round(degrees(atan2(y*x*(1-cos(t)) + z*sin(t), cos(t) + x*x*(1-cos(t)))), 4) AS yaw FROM a""", with_frames=False)
def rodrigues_euler(spark, sf_dir):
    df, point = _points(spark, sf_dir)
    m = vectors.axis_angle_matrix(vectors.scaled(point(0), 9.0))
    roll, pitch, yaw = vectors.euler_zyx_degrees(m)
    return df.select(
        "vec_id", r6(m[0][0], "m00"), r6(m[0][1], "m01"), F.round(roll, 4).alias("roll"), F.round(pitch, 4).alias("pitch"),
        F.round(yaw, 4).alias("yaw"),
    )


# Tables, names, text --------------------------------------------------------


@query("""SELECT c_custkey, c_name, round(c_acctbal, 2) AS balance, NULL::VARCHAR AS note FROM customer WHERE c_custkey % 7 <> 0
UNION ALL SELECT c_custkey, c_name, round(c_acctbal + 1, 2), 'new' FROM customer WHERE c_custkey % 7 = 0""", with_frames=False)
def upsert_summary(spark, sf_dir):
    customer = read(spark, sf_dir, "customer")
    old = customer.select("c_custkey", "c_name", F.round("c_acctbal", 2).alias("balance"))
    new = customer.where("c_custkey % 7 = 0").select(
        "c_custkey", "c_name", F.round(F.col("c_acctbal") + 1, 2).alias("balance"), F.lit("new").alias("note")
    )
    return tables.upsert(old, new, ["c_custkey"])


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""", with_frames=False)
def skip_existing(spark, sf_dir):
    done = read(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return tables.skip_existing(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), done, ["o_custkey"])


@query("""SELECT seq, frame_index FROM fr WHERE frame_index < 3""")
def per_subset_limit(spark, sf_dir):
    return tables.first_per_group(frames(spark, sf_dir), ["seq"], ["frame_index"], 3).select("seq", "frame_index")


@query(r"""SELECT page_id, trim(regexp_replace(url, '[^A-Za-z0-9_.-]+', '_', 'g'), '_') AS stem,
array_to_string([trim(regexp_replace(url, '[^A-Za-z0-9_.-]+', '_', 'g'), '_'), page_id::VARCHAR, 'a'], '__') AS name FROM pages""", with_frames=False)
def sanitize_stem(spark, sf_dir):
    return read(spark, sf_dir, "pages").select(
        "page_id", strings.safe_name("url").alias("stem"), strings.sequence_stem("url", "page_id", F.lit("a")).alias("name")
    )


@query("""WITH t AS (SELECT doc_id, '步行表现为：' || replace(lang || '、速度很慢；' || source, '。', '') || '、稳定性下降。' AS s FROM documents),
b AS (SELECT doc_id, trim(split_part(s, '：', 1)) || '：' AS header, rtrim(substr(s, instr(s, '：') + 1), '。') AS body FROM t),
c AS (SELECT doc_id, header, list_filter(list_transform(string_split(replace(body, '；', '、'), '、'), lambda v: trim(v)), lambda v: v <> '') AS c FROM b)
SELECT doc_id, header, len(c)::INTEGER AS clauses, list_contains(list_transform(c, lambda v: contains(v, '下降')), true) AS abnormal FROM c""", with_frames=False)
def split_clauses_abnormal(spark, sf_dir):
    text = F.concat(
        F.lit("步行表现为："), F.replace(F.concat("lang", F.lit("、速度很慢；"), "source"), F.lit("。"), F.lit("")),
        F.lit("、稳定性下降。"),
    )
    df = read(spark, sf_dir, "documents").select("doc_id", text.alias("s"))
    header, clauses = strings.split_clauses("s")
    df = df.select("doc_id", header.alias("header"), clauses.alias("c"))
    return df.select(
        "doc_id", "header", F.size("c").alias("clauses"), F.exists("c", lambda x: strings.has_phrase(x)).alias("abnormal")
    )


@query(f"""WITH d AS (SELECT seq, count(*) AS n, count(*) FILTER (NOT valid) AS bad FROM fr GROUP BY seq)
SELECT seq, CASE WHEN n < 60 THEN 'duration_lt_2s' WHEN bad > 10 THEN 'invalid frames' ELSE 'ok' END AS reason FROM d""")
def validate_sequences(spark, sf_dir):
    from stridelake.sources.contracts import first_failure

    df = frames(spark, sf_dir).groupBy("seq").agg(F.count("*").alias("n"), F.count_if(~F.col("valid")).alias("bad"))
    reason = first_failure([("duration_lt_2s", F.col("n") / FPS < 2), ("invalid frames", F.col("bad") > 10)])
    return df.select("seq", reason.alias("reason"))


@query("""WITH u AS (SELECT seq, avg(x) AS speed, count(*) AS n FROM fr GROUP BY seq),
b AS (SELECT seq, CASE WHEN speed < 40 THEN '速度很慢' WHEN speed < 50 THEN '速度偏慢' WHEN speed < 60 THEN '速度中等' ELSE '速度较快' END AS pace,
  CASE WHEN n < 60 THEN '步频偏低' WHEN n <= 75 THEN '步频中等' ELSE '步频偏高' END AS cadence FROM u)
SELECT seq, pace, cadence, '步行表现为' || pace || '、' || cadence || '。' AS sentence FROM b""")
def descriptor_fixed_bins(spark, sf_dir):
    users = frames(spark, sf_dir).groupBy("seq").agg(F.avg("x").alias("speed"), F.count("*").alias("n"))
    pace = scalars.binned("speed", [40, 50, 60], ["速度很慢", "速度偏慢", "速度中等", "速度较快"])
    cadence = scalars.binned("n", [60, 75], ["步频偏低", "步频中等", "步频偏高"], closed=(1,))
    out = users.select("seq", pace.alias("pace"), cadence.alias("cadence"))
    return out.withColumn("sentence", strings.summary_sentence("步行表现为", [F.col("pace"), F.col("cadence")]))


_FLAGSHIP = f"""WITH {_RUNS.format('event_type')}, l AS (SELECT *, CASE WHEN valid AND lag(valid) OVER w THEN sqrt((x - lag(x) OVER w) ** 2
  + (y - lag(y) OVER w) ** 2) END AS d FROM i WINDOW w AS (PARTITION BY seq ORDER BY frame_index)),
g AS (SELECT seq, run::INTEGER AS segment_no, any_value(event_type) AS label, count(*) AS n, quantile_cont(x, 0.95) - quantile_cont(x, 0.05) AS range_x,
  sum(d) AS path FROM l GROUP BY seq, run),
k AS (SELECT *, CASE WHEN path IS NOT NULL THEN cume_dist() OVER (PARTITION BY path IS NULL ORDER BY round(path, 6)) END AS rank FROM g)
SELECT seq, segment_no, label, n, round(range_x, 6) AS range_x, round(path, 4) AS path, round(rank, 6) AS rank,
CASE WHEN rank < 0.4 THEN '路径较紧凑' WHEN rank < 0.75 THEN '路径紧凑性一般' WHEN rank IS NOT NULL THEN '路径较分散' END AS phrase FROM k"""


@query(_FLAGSHIP)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of each sequence with their features, ranked against all segments, as phrases."""
    df = _segments(frames(spark, sf_dir)).withColumn("d", S.path_step("x", "y", "valid", SEQ))
    segments = df.groupBy("seq", "segment_no").agg(
        F.first("event_type").alias("label"), F.count("*").alias("n"),
        aggregates.robust_range("x").alias("range_x"), F.sum("d").alias("path"),
    )
    segments = segments.withColumn("p", F.round("path", 6))
    ranked = aggregates.percentile_rank(segments, segments, ["p"], ["seq", "segment_no"])
    phrase = scalars.binned("p_rank", [0.4, 0.75], ["路径较紧凑", "路径紧凑性一般", "路径较分散"])
    return ranked.select(
        "seq", "segment_no", "label", "n", r6("range_x", "range_x"), F.round("path", 4).alias("path"), r6("p_rank", "rank"),
        phrase.alias("phrase"),
    )


@query("""WITH m AS (SELECT *, CASE WHEN seq % 3 = 0 THEN NULL WHEN frame_index % 5 = 0 THEN NULL ELSE event_type = 'purchase' END AS strike,
contact AND NOT coalesce(lag(contact) OVER (PARTITION BY seq ORDER BY frame_index), false) AS onset FROM fr)
SELECT seq, frame_index FROM (SELECT *, bool_or(strike IS NOT NULL) OVER (PARTITION BY seq) AS given FROM m) WHERE CASE WHEN given THEN coalesce(strike, false) ELSE onset END""")
def supplied_events(spark, sf_dir):
    """Frames of events as a mask gives them, in sequences without one the onsets of contact."""
    df = frames(spark, sf_dir)
    strike = F.when((F.col("seq") % 3 != 0) & (F.col("frame_index") % 5 != 0), F.col("event_type") == "purchase")
    df = df.select("seq", "frame_index", strike.alias("strike"), S.mask_onsets("contact", SEQ).alias("onset"))
    return df.withColumn("event", S.supplied_or("strike", "onset", SEQ)).where("event").select("seq", "frame_index")
