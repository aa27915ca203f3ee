import json

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stridelake.plans import record_queries
from stridelake.sources import nested
from stridelake.sources.contracts import quarantine

SF = "/root/testdata/sf0.001"
VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-99, 99) | st.sampled_from(["", "k", '{"k": 1}', '["k"]', "a\\b", 'q"q', "{", "é]"]),
    lambda inner: st.lists(inner, max_size=4) | st.dictionaries(st.sampled_from(["k", "z", "a", "b c", '"', "é"]), inner, max_size=4),
    max_leaves=25,
)


def first_value(value, key):
    if isinstance(value, dict) and key in value:
        return value[key]
    inner = value.values() if isinstance(value, dict) else value if isinstance(value, list) else []
    return next((found for found in (first_value(v, key) for v in inner) if found is not None), None)


@settings(max_examples=3, deadline=None)
@given(st.lists(VALUES, min_size=60, max_size=60), st.booleans())
def test_first_value_in_order(spark, values, escaped):
    df = spark.createDataFrame([(i, json.dumps(v, ensure_ascii=escaped)) for i, v in enumerate(values)], "i int, j string")
    for i, text in df.select("i", nested.find_nested("j", "k")).collect():
        expected = first_value(values[i], "k")
        assert text is None if expected is None else text == expected if isinstance(expected, str) else json.loads(text) == expected, values[i]


@pytest.mark.parametrize(
    ("text", "expected", "levels"),
    [
        (None, None, None), ("", None, 0), ('{"k": 1', None, 1), ('{"a": 1} {"k": 1}', None, 1), ('{"k": 1, "k": 2}', None, 1), ('"k"', None, 0), (" [[\n{\"k\": 3}]] ", "3", 3),
        ('{"\\u006b": "e"}', "e", 1), ('{"x": {"\\u006b": "e"}}', "e", 2), ('{"a": {"x": "\\"}]{"}}', None, 2), ("[" * 60 + '{"k": true}' + "]" * 60, "true", 61),
        ('{"a": [' + ",".join(["{}"] * 20000) + '], "b": {"k": "' + "x" * 100000 + '"}}', "x" * 100000, 3),
    ],
)
def test_odd_texts(spark, text, expected, levels):
    df = spark.createDataFrame([(text,)], "j string")
    assert tuple(df.select(nested.find_nested("j", "k"), nested.depth("j")).first()) == (expected, levels)


def test_segments_with_defaults(spark):
    rows = {
        "plain": '{"segments": [{"segment_id": "s1", "label": "walk", "start_frame": 3, "end_frame": "9", "confidence": "0.5", "quality": {"status": "ok", "reasons": ["a", 1, null, true]}, '
        '"used_for_extraction": "false", "auxiliary_overlap_labels": "turn", "hesitation_overlap_frames": 2.9}, {}]}',
        "blank": '{"segments": [{"segment_id": 0, "quality": 5, "confidence": "", "start_time_sec": null, "used_for_extraction": 0, "auxiliary_overlap_labels": null}, '
        '{"quality": {"reasons": null, "valid_frame_ratio": null}}, {"quality": {"reasons": "one"}, "auxiliary_overlap_labels": [[1], {"a": 2}]}]}',
        "wrong": '{"segments": [1, {"start_frame": null}, {"end_frame": "x"}, {"confidence": [1]}, {"start_frame": 1}]}',
        "broken": '{"segments": [', "none": "{}", "empty": '{"segments": []}', "other": '{"segments": {"a": 1}}', "null": None,
    }
    df = spark.createDataFrame(list(rows.items()), "k string, payload string").withColumn("place", F.lit("clashes"))
    got = {(r["k"], r["place"]): r for r in nested.segment_records(df, ["k"]).collect()}
    assert {k: r["reason"] for k, r in got.items()} == {
        ("plain", 0): "ok", ("plain", 1): "ok", ("blank", 0): "ok", ("blank", 1): "ok", ("blank", 2): "ok", ("wrong", 0): "segment is not an object",
        ("wrong", 1): "start_frame is not a number", ("wrong", 2): "end_frame is not a number", ("wrong", 3): "confidence is not a number", ("wrong", 4): "ok",
        ("broken", None): "not JSON", ("none", None): "no list of segments", ("other", None): "no list of segments", ("null", None): "not JSON",
    }
    first, second = got["plain", 0], got["plain", 1]
    assert (first["start_frame"], first["end_frame"], first["confidence"], first["hesitation_overlap_frames"], first["used_for_extraction"]) == (3, 9, 0.5, 2, True)
    assert first["quality_reasons"] == ["a", "1", "None", "True"] and first["auxiliary_overlap_labels"] == ["turn"] and first["quality_status"] == "ok"
    assert (second["segment_id"], second["start_frame"], second["end_frame"], second["confidence"], second["used_for_extraction"]) == ("", 0, -1, 0.0, False)
    blank = [got["blank", i] for i in range(3)]
    assert (blank[0]["segment_id"], blank[0]["confidence"], blank[0]["auxiliary_overlap_labels"]) == ("", 0.0, [])
    assert [b["quality_reasons"] for b in blank] == [[], ["None"], ["one"]] and blank[2]["auxiliary_overlap_labels"] == ["[1]", '{"a":2}']
    good, bad = quarantine(nested.segment_records(df, ["k"]))
    assert (good.count(), bad.count()) == (6, 8) and nested.segment_records(df.limit(0), ["k"]).count() == 0


@pytest.mark.parametrize("name", sorted(record_queries.queries()))
def test_rows_equal_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("events", "customer", "orders", "lineitem", "supplier", "part"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = record_queries.queries()[name](spark, SF)
    names = sorted(df.columns)
    expected = con.execute(f"SELECT {', '.join(f'"{n}"' for n in names)} FROM ({record_queries.oracle_sql()[name]})").fetchall()
    got = sorted(repr(tuple(r)) for r in df.select(*names).collect())
    assert got == sorted(map(repr, expected)) and got
