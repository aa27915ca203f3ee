import duckdb
import pytest

import motion
from stridelake.plans import contract_queries
from stridelake.sources import joined

SF = "/root/testdata/sf0.001"


@pytest.fixture
def stages(spark):
    a = spark.createDataFrame([("a", 10, 30.0), ("b", 5, 30.0), ("c", 7, 30.0), (None, 3, 30.0), ("f", None, None)], "k string, frame_count int, fps double")
    b = spark.createDataFrame([("a", 10, 30.0), ("b", 6, 30.0), ("d", 1, 30.0), (None, 3, 31.0), ("f", 2, 30.0)], "k string, frame_count int, fps double")
    c = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z"), (None, "n"), ("a", "w"), ("f", None)], "k string, text string")
    d = spark.createDataFrame([("a",), ("b",), (None,), ("f",)], "k string")
    return {"A": a, "B": b, "C": c, "D": d}


def test_each_side_missing(spark, stages):
    why = spark.createDataFrame([("c", "B", "too short"), ("c", "B", "gap"), ("c", "A", "unused"), ("nowhere", "A", "unused")], "k string, stage string, reason string")
    got = {r["k"]: r for r in joined.merge_stages(stages, ["k"], why=why).collect()}
    assert {k: r["reason"] for k, r in got.items()} == {
        "a": "repeated in C", "b": "frame count differs in B", "c": "missing in B", "d": "missing in A", None: "rate differs in B", "f": "ok",
    }
    assert got["c"]["missing"] == {"B": "gap", "D": "absent"} and got["c"]["present"] == ["A", "C"] and got["c"]["B"] is None
    assert got["d"]["missing"] == {"A": "absent", "C": "absent", "D": "absent"} and got["a"]["C"]["text"] == "w"
    assert got["f"]["A"].asDict() == {"frame_count": None, "fps": None}


def test_one_exchange_joins_all(spark, stages):
    plan = joined.merge_stages(stages, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_unknown_columns_and_no_rows(spark, stages):
    with pytest.raises(ValueError, match="unexpected"):
        joined.merge_stages(stages, ["k"], {"A": ["frame_count"]})
    none = {n: df.limit(0) for n, df in stages.items()}
    assert joined.merge_stages(none, ["k"]).count() == 0


def test_frames_of_sound_sequences(spark):
    frames = spark.createDataFrame(motion.rows("good", motion.walk(0.2)) + motion.rows("bad", motion.walk(0.2)), motion.SCHEMA)
    keys = ["subset", "subject_id", "trial_id"]
    counts = frames.groupBy(*keys).count().withColumnRenamed("count", "frame_count")
    represented = frames.selectExpr(*keys, "frame_index", "frame_index / 30.0D AS time_s")
    segments = counts.where("trial_id = 'good'").selectExpr(*keys, "'walk' AS label", "0 AS start_frame", "3 AS end_frame")
    merged = joined.merge_stages({"canonical": counts, "segments": segments.select(*keys)}, keys)
    out = joined.joined_frames(merged, frames, represented, segments, keys).orderBy("frame_index").collect()
    assert [r["label"] for r in out] == ["walk"] * 4 + [None] * 2 and {r["trial_id"] for r in out} == {"good"}
    assert out[3]["time_s"] == pytest.approx(0.1) and len(out[0]["joints_can"]) == 24


def test_query_is_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{SF}/customer.parquet'")
    df = contract_queries.joined_stages(spark, SF)
    names = sorted(df.columns)
    expected = con.execute(f"SELECT {', '.join(names)} FROM ({contract_queries.oracle_sql()['joined_stages']})").fetchall()
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)) for r in df.collect() and df.select(*names).collect())
