"""Named queries of values in JSON texts, segments read from them, final records, and fits to targets, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.operators.sequences import Sequence
from stridelake.plans import canonicalize, catalog, record
from stridelake.sources import loaders, nested

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def query(sql: str):
    def register(function):
        _QUERIES[function.__name__] = function
        _SQL[function.__name__] = sql.strip()
        return function

    return register


@query("""SELECT event_id, CASE event_id % 9 WHEN 1 THEN NULL WHEN 3 THEN 'z' WHEN 5 THEN '[1,2]' WHEN 6 THEN NULL WHEN 7 THEN '{"deep":' || event_id || '}'
WHEN 8 THEN NULL ELSE json_extract_string(props, '$.k') END AS found FROM events""")
def nested_lookup(spark, sf_dir):
    key, props = F.col("event_id") % 9, F.col("props")
    text = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    json = (
        F.when(key == 0, props)
        .when(key == 1, text('{"a": [1, {"b": ', props, '}], "k": null}'))
        .when(key == 2, text('{"a": {"k": null, "x": ', props, '}, "b": [[', props, "]]}"))
        .when(key == 3, text('{"z": {"k": "z"}, "a": {"k": "a"}, "b": ', props, "}"))
        .when(key == 4, text('{"a": "{\\"k\\": 1}", "b": ', props, "}"))
        .when(key == 5, text('{"a": {"b": ', props, '}, "k": [1, 2]}'))
        .when(key == 6, text('{"a": ', props))
        .when(key == 7, text('[[], {}, {"q": {"r": [{"k": {"deep": ', F.col("event_id").cast("string"), "}}]}}, ", props, "]"))
        .otherwise(text('{"a": {"b": [{"c": "k"}, null, "k"]}, "d": 1.5}'))
    )
    return catalog.read(spark, sf_dir, "events").select("event_id", nested.find_nested(json, "k").alias("found"))


@query("""WITH o AS (SELECT o_orderkey AS k, o_custkey, o_orderstatus, round(o_totalprice)::BIGINT AS price FROM orders)
SELECT k AS o_orderkey, place, CASE WHEN reason = 'ok' THEN id END AS segment_id, CASE WHEN reason = 'ok' THEN a END AS start_frame, CASE WHEN reason = 'ok' THEN b END AS end_frame,
CASE WHEN reason = 'ok' THEN c END AS confidence, CASE WHEN reason = 'ok' THEN why END AS reasons, CASE WHEN reason = 'ok' THEN used END AS used, reason FROM (
  SELECT k, 0 AS place, CASE WHEN k % 3 = 0 THEN '' ELSE 's' || k END AS id, CASE WHEN k % 4 = 0 THEN 0 ELSE o_custkey END AS a, price AS b, CASE WHEN k % 2 = 0 THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS c,
    CASE k % 4 WHEN 0 THEN '' WHEN 1 THEN 'None' WHEN 2 THEN o_orderstatus ELSE o_orderstatus || ',7' END AS why, k % 3 <> 0 AS used,
    CASE WHEN k % 13 = 0 THEN 'end_frame is not a number' ELSE 'ok' END AS reason FROM o WHERE k % 7 <> 0 AND k % 11 <> 0
  UNION ALL SELECT k, 1, '', 0, -1, 0.0, '', false, CASE WHEN k % 5 = 0 THEN 'segment is not an object' ELSE 'ok' END FROM o WHERE k % 7 <> 0 AND k % 11 <> 0
  UNION ALL SELECT k, NULL, NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN k % 7 = 0 THEN 'not JSON' ELSE 'no list of segments' END FROM o WHERE k % 7 = 0 OR k % 11 = 0)""")
def segment_records(spark, sf_dir):
    k = F.col("o_orderkey")
    status = F.concat(F.lit('"'), F.col("o_orderstatus"), F.lit('"'))
    why = F.when(k % 4 == 0, "[]").when(k % 4 == 1, "null").when(k % 4 == 2, status).otherwise(F.concat(F.lit("["), status, F.lit(", 7]")))
    end = F.when(k % 13 == 0, '"last"').otherwise(F.round("o_totalprice").cast("long").cast("string"))
    first = F.concat(
        F.lit("{"), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit('"segment_id": "s'), k.cast("string"), F.lit('", '))),
        F.when(k % 4 == 0, "").otherwise(F.concat(F.lit('"start_frame": "'), F.col("o_custkey").cast("string"), F.lit('", '))), F.lit('"end_frame": '), end,
        F.when(k % 2 == 0, ', "confidence": null').otherwise(', "confidence": "0.5"'), F.lit(', "quality": {"reasons": '), why, F.lit('}, "used_for_extraction": '),
        F.when(k % 3 == 0, '""').otherwise("1"), F.lit("}"),
    )
    both = F.concat(F.lit('{"segments": ['), first, F.when(k % 5 == 0, ", 3").otherwise(', {"quality": []}'), F.lit("]}"))
    json = F.when(k % 7 == 0, '{"segments": [').when(k % 11 == 0, '{"segments": "none"}').otherwise(both)
    df = nested.segment_records(catalog.read(spark, sf_dir, "orders").select("o_orderkey", json.alias("payload")), ["o_orderkey"])
    good = lambda c: F.when(F.col("reason") == "ok", c)
    return df.select(
        "o_orderkey", "place", good(F.col("segment_id")).alias("segment_id"), good(F.col("start_frame")).alias("start_frame"), good(F.col("end_frame")).alias("end_frame"),
        good(F.col("confidence")).alias("confidence"), good(F.array_join("quality_reasons", ",")).alias("reasons"), good(F.col("used_for_extraction")).alias("used"), "reason",
    )


@query("""WITH w AS (SELECT o_custkey AS k, CASE WHEN o_orderpriority LIKE '1%' THEN 0 ELSE 1 END AS place, o_orderpriority AS text FROM orders WHERE o_orderkey % 3 = 0),
ln AS (SELECT l_orderkey, count(*) AS n, sum(l_linenumber)::BIGINT AS numbers, sum(round(l_quantity))::BIGINT AS quantity FROM lineitem GROUP BY 1),
f AS (SELECT * FROM ln WHERE l_orderkey % 2 = 0), g AS (SELECT * FROM ln WHERE l_orderkey % 5 = 0),
s AS (SELECT o_custkey AS k, list(to_json({'segment': CASE WHEN o_orderkey % 7 <> 0 THEN {'at': epoch_us(o_orderdate) // 86400000000, 'state': o_orderstatus} END,
    'walk': CASE WHEN f.l_orderkey IS NOT NULL THEN {'n': f.n, 'quantity': f.quantity} END, 'turn': CASE WHEN g.l_orderkey IS NOT NULL THEN {'numbers': g.numbers} END})::VARCHAR
    ORDER BY CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END NULLS LAST, o_orderkey::VARCHAR COLLATE "C") AS e, count(f.l_orderkey) AS walk, count(g.l_orderkey) AS turn
  FROM orders LEFT JOIN f ON f.l_orderkey = o_orderkey LEFT JOIN g ON g.l_orderkey = o_orderkey
  WHERE o_orderkey % 7 <> 0 OR f.l_orderkey IS NOT NULL OR g.l_orderkey IS NOT NULL GROUP BY 1),
t AS (SELECT k, list(text ORDER BY place, text) AS all_texts, list(text ORDER BY text) FILTER (place = 0) AS a, list(text ORDER BY text) FILTER (place = 1) AS b FROM (SELECT DISTINCT * FROM w) GROUP BY k),
c AS (SELECT coalesce(c_custkey, s.k, t.k) AS k, c_custkey, c_name, c_nationkey, c_mktsegment, e, walk, turn, all_texts, a, b
  FROM (SELECT * FROM customer) FULL JOIN s ON s.k = c_custkey FULL JOIN t ON t.k = coalesce(c_custkey, s.k))
SELECT k AS c_custkey, '{"sequence":' || CASE WHEN k % 11 = 0 OR c_custkey IS NULL THEN 'null' ELSE to_json({'name': c_name, 'nation': c_nationkey})::VARCHAR END
  || ',"segments":[' || coalesce(array_to_string(e, ','), '') || '],"stages":' || CASE WHEN c_custkey IS NULL THEN '[]' ELSE to_json([{'stage': 'first', 'state': c_mktsegment, 'warnings': coalesce(a, [])},
    {'stage': 'second', 'state': 'ok', 'warnings': coalesce(b, [])}])::VARCHAR END
  || ',"warnings":' || to_json(coalesce(all_texts, []))::VARCHAR || ',"counts":{"walk":' || coalesce(walk, 0) || ',"turn":' || coalesce(turn, 0) || '}}' AS payload FROM c""")
def sequence_records(spark, sf_dir):
    orders, customer = catalog.read(spark, sf_dir, "orders"), catalog.read(spark, sf_dir, "customer")
    key, order = F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey")
    lines = catalog.read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("n"), F.sum("l_linenumber").alias("numbers"), F.sum(F.round("l_quantity")).cast("long").alias("quantity")
    )
    lines = orders.select(key, "o_orderkey").join(lines, "o_orderkey")
    segments = orders.where(order % 7 != 0).select(key, "o_orderkey", F.unix_date(F.to_date("o_orderdate")).alias("at"), F.col("o_orderstatus").alias("state"))
    first = F.col("o_orderpriority").startswith("1")
    warnings = orders.where(order % 3 == 0).select(
        key, F.when(first, 0).otherwise(1).alias("place"), F.when(first, "first").otherwise("second").alias("stage"), F.col("o_orderpriority").alias("text")
    )
    states = [customer.select("c_custkey", F.lit(i).alias("place"), F.lit(n).alias("stage"), c.alias("state")) for i, (n, c) in enumerate((("first", F.col("c_mktsegment")), ("second", F.lit("ok"))))]
    records = record.sequence_records(
        {"sequence": customer.where("c_custkey % 11 <> 0").select("c_custkey", F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))},
        segments, {"walk": lines.where(order % 2 == 0).select("c_custkey", "o_orderkey", "n", "quantity"), "turn": lines.where(order % 5 == 0).select("c_custkey", "o_orderkey", "numbers")},
        warnings, states[0].union(states[1]), ["c_custkey"], "o_orderkey", "at",
    )
    return loaders.as_json(records, ["c_custkey"])


_AIMS = {"left_thigh": 0.3, "left_shank": 0.04, "right_thigh": 0.06, "right_shank": 0.05}
_LENGTHS = {
    "left_thigh": "l_quantity / 100", "left_shank": "CASE WHEN l_linenumber <> 1 THEN l_discount END", "right_thigh": "CASE WHEN l_suppkey % 4 <> 1 THEN l_tax END",
    "right_shank": "l_extendedprice / 1000000",
}
_AIM_SQL = {n: f"CASE WHEN s.k % 6 <> 2 AND s.k % 5 <> {i} THEN {t} * CASE WHEN s.k % 7 = {i} THEN -1 WHEN s.k % 3 = 0 THEN 2 ELSE 1 END END" for i, (n, t) in enumerate(_AIMS.items())}


@query(f"""WITH b AS (SELECT l_suppkey AS k, {', '.join(f'median(v{i}) FILTER (v{i} > 1e-6) AS m{i}' for i in range(4))}
  FROM (SELECT l_suppkey, {', '.join(f'{e} AS v{i}' for i, e in enumerate(_LENGTHS.values()))} FROM lineitem) GROUP BY 1),
r AS (SELECT s.k, {', '.join(f'm{i}, {_AIM_SQL[n]} / m{i} AS r{i}' for i, n in enumerate(_AIMS))} FROM b AS s),
f AS (SELECT *, [x FOR x IN [r0, r1, r2, r3] IF x > 1e-6] AS good FROM r),
g AS (SELECT *, len(good) AS n, CASE WHEN len(good) >= 2 THEN list_median(good) END AS raw FROM f)
SELECT k AS l_suppkey, round(CASE WHEN raw IS NULL THEN 1.0 ELSE greatest(least(raw, 1.35), 0.75) END, 6) AS s_global, round(raw, 6) AS scale_raw,
CASE WHEN raw IS NULL THEN 'insufficient_valid_bones' WHEN raw > 1.35 * (1 + 1e-5) OR raw < 0.75 * (1 - 1e-5) THEN 'clipped' ELSE 'ok' END AS scale_flag,
CASE WHEN raw IS NULL THEN 'insufficient_valid_bones' END AS scale_reason, n AS bone_count_valid, round(m1, 6) AS left_shank_length,
round(CASE WHEN r3 > 1e-6 THEN r3 END, 6) AS right_shank_ratio FROM g""")
def scale_targets(spark, sf_dir):
    number = F.col("l_suppkey")
    lengths = {n: F.expr(e) for n, e in _LENGTHS.items()}
    nan = F.lit(float("nan"))
    # Thighs lie along x and shanks along y, so each bone is as long as its value; what is null there is not a number here.
    xs, ys = {}, {}
    for side, hip, knee, ankle in (("left", 1, 4, 7), ("right", 2, 5, 8)):
        thigh, shank = (F.coalesce(lengths[f"{side}_{part}"].cast("double"), nan) for part in ("thigh", "shank"))
        xs |= {hip: thigh, knee: F.lit(0.0), ankle: F.lit(0.0)}
        ys |= {ankle: shank}
    joints = F.array(*[F.struct(xs.get(i, F.lit(0.0)).alias("x"), ys.get(i, F.lit(0.0)).alias("y"), F.lit(0.0).alias("z")) for i in range(24)])
    frames = catalog.read(spark, sf_dir, "lineitem").select("l_suppkey", joints.alias("joints_3d"))
    keys = frames.select("l_suppkey").distinct()
    sign = lambda i: F.when(number % 7 == i, -1).when(number % 3 == 0, 2).otherwise(1)
    rows = [
        keys.where((number % 6 != 2) & (number % 5 != i)).select("l_suppkey", F.lit(n).alias("bone"), (F.lit(t) * sign(i)).alias("length"))
        for i, (n, t) in enumerate(_AIMS.items())
    ]
    targets = rows[0].union(rows[1]).union(rows[2]).union(rows[3])
    df = canonicalize.scale_fit(frames, targets, Sequence(("l_suppkey",), "frame_index"))
    return df.select(
        "l_suppkey", F.round("s_global", 6).alias("s_global"), F.round("scale_raw", 6).alias("scale_raw"), "scale_flag", "scale_reason", "bone_count_valid",
        F.round(F.col("bones")["left_shank"]["length"], 6).alias("left_shank_length"), F.round(F.col("bones")["right_shank"]["ratio"], 6).alias("right_shank_ratio"),
    )


_CARRIED = {"left_ankle": (7, "l_tax"), "right_ankle": (8, "l_discount"), "left_foot": (10, "l_quantity / 500"), "right_foot": (11, "l_extendedprice / 1000000")}
_LOST = "l_suppkey % 5 = 1 AND l_linenumber = 1"


@query(f"""WITH p AS (SELECT l_suppkey, CASE WHEN {_LOST} THEN 2 ELSE list_position(zs, list_min(zs)) - 1 END AS place, CASE WHEN NOT ({_LOST}) THEN list_min(zs) END AS z,
    l_suppkey % 7 = 2 AND l_linenumber = 2 AS far FROM (SELECT *, [{', '.join(f'({e})::DOUBLE' for _, e in _CARRIED.values())}] AS zs FROM lineitem)),
a AS (SELECT l_suppkey, count(*) AS n, avg((z IS NOT NULL AND NOT (far AND place = 0))::INT) AS finite, bool_or(z IS NULL) AS odd, min(z) AS lo, max(z) AS hi,
  {', '.join(f'count(*) FILTER (place = {k}) AS n{k}' for k in range(4))} FROM p GROUP BY 1)
SELECT l_suppkey, n AS frame_count, round(finite, 6) AS finite_ratio, CASE WHEN NOT odd THEN round(lo, 6) END AS min_z, CASE WHEN NOT odd THEN round(hi, 6) END AS max_z,
{', '.join(f'n{k} AS {n}_selected_count, round(n{k} / n, 6) AS {n}_selected_ratio' for k, n in enumerate(_CARRIED))},
CASE WHEN finite < 1 THEN 'support_points_nonfinite' ELSE '' END AS warnings FROM a""")
def support_metrics(spark, sf_dir):
    zs = {k: F.expr(e).cast("double") for k, e in _CARRIED.values()}
    zs[10] = F.when(F.expr(_LOST), F.lit(float("nan"))).otherwise(zs[10])
    far = F.when((F.col("l_suppkey") % 7 == 2) & (F.col("l_linenumber") == 2), F.lit(float("inf"))).otherwise(0.0)
    zero = F.lit(0.0)
    joints = F.array(*[F.struct((far if i == 7 else zero).alias("x"), zero.alias("y"), zs.get(i, zero).alias("z")) for i in range(24)])
    frames = catalog.read(spark, sf_dir, "lineitem").select("l_suppkey", joints.alias("joints_3d"))
    df = canonicalize.support_metrics(frames, Sequence(("l_suppkey",), "frame_index"))
    digits = ["finite_ratio", "min_z", "max_z", *[f"{n}_selected_ratio" for n in _CARRIED]]
    return df.select(
        "l_suppkey", "frame_count", *[F.round(n, 6).alias(n) for n in digits], *[f"{n}_selected_count" for n in _CARRIED], F.array_join("warnings", ",").alias("warnings")
    )
