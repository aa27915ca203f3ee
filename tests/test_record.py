import math
import re

import pytest

from stridelake.plans import canonicalize, record
from stridelake.sources.store import StageStore

KEYS = ["k"]


def tables(spark):
    singles = {"sequence": spark.createDataFrame([("a", 10), ("b", 5), (None, 3)], "k string, frame_count int")}
    segments = spark.createDataFrame([("a", "s2", 5, "walk"), ("a", "s10", 5, "turn"), ("a", "s1", 9, "walk"), ("c", "s1", 0, "walk"), ("a", None, 0, "x")], "k string, segment_id string, start_frame int, label string")
    walk = spark.createDataFrame([("a", "s2", 1.0, {"m": "why"}), ("a", "s2", 1.0, {"m": "why"}), ("a", "lost", 2.0, None), ("d", None, 1.0, {})], "k string, segment_id string, speed double, missing map<string, string>")
    turn = spark.createDataFrame([], "k string, segment_id string, angle double")
    warnings = spark.createDataFrame([("a", 1, "B", "late"), ("a", 0, "A", "x"), ("a", 1, "B", "x"), ("a", 0, "A", "x"), (None, 0, "A", "n"), ("a", 2, "C", "no state")], "k string, place int, stage string, text string")
    states = spark.createDataFrame([("a", 1, "B", "ok"), ("a", 0, "A", "ok"), (None, 0, "A", "rejected"), ("e", 0, "A", "ok")], "k string, place int, stage string, state string")
    return singles, segments, {"walk": walk, "turn": turn}, warnings, states


def test_grains_nest(spark):
    out = record.sequence_records(*tables(spark), KEYS)
    got = {r["k"]: r.asDict(recursive=True) for r in out.collect()}
    assert set(got) == {"a", "b", "c", "e", None}
    a = got["a"]
    assert [(s["segment"] and s["segment"]["label"], s["walk"] and s["walk"]["speed"], s["turn"]) for s in a["segments"]] == [
        ("turn", None, None), ("walk", 1.0, None), ("walk", None, None), (None, 2.0, None),
    ]
    assert a["segments"][1]["walk"]["missing"] == {"m": "why"} and a["sequence"] == {"frame_count": 10}
    assert a["warnings"] == ["x", "late", "no state"] and a["counts"] == {"walk": 2, "turn": 0}
    assert a["stages"] == [{"stage": "A", "state": "ok", "warnings": ["x"]}, {"stage": "B", "state": "ok", "warnings": ["late", "x"]}]
    assert got["c"]["sequence"] is None and len(got["c"]["segments"]) == 1 and got["b"]["segments"] == [] == got["b"]["stages"]
    assert got[None]["stages"] == [{"stage": "A", "state": "rejected", "warnings": ["n"]}] and got["e"]["warnings"] == []


def test_one_exchange(spark):
    plan = record.sequence_records(*tables(spark), KEYS)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange ", plan)) == 1


def test_empty_tables_and_no_features(spark):
    singles, segments, features, warnings, states = tables(spark)
    none = [df.limit(0) for df in (segments, warnings, states)]
    out = record.sequence_records({"sequence": singles["sequence"].limit(0)}, none[0], {}, none[1], none[2], KEYS)
    assert out.count() == 0 and "segments" in out.columns
    assert {r["k"]: r["counts"] for r in record.sequence_records(singles, segments, {}, warnings, states, KEYS).collect()}["a"] == {}


BONES = "subset string, subject_id string, trial_id string, frame_index int, joints_3d array<struct<x: double, y: double, z: double>>"


def frame(trial, i, thigh, shank, right=0.5):
    points = [(0.0, 0.0, 0.0)] * 24
    points[1], points[7], points[2], points[8] = (thigh, 0.0, 0.0), (0.0, shank, 0.0), (right, 0.0, 0.0), (0.0, right, 0.0)
    return ("A", "s", trial, i, points)


def test_scale_with_missing_zero_and_outlying_bones(spark):
    nan, inf = math.nan, math.inf
    rows = [frame("plain", i, 0.5, 0.5) for i in range(3)]
    rows += [frame("holes", 0, nan, 0.0), frame("holes", 1, 0.4, 0.5), frame("holes", 2, inf, 0.5), frame("none", 0, nan, 0.0, 0.0), frame("outlier", 0, 50.0, 0.5), frame("small", 0, 5.0, 5.0, 5.0)]
    frames = spark.createDataFrame(rows, BONES)
    aims = dict.fromkeys(canonicalize.BONES, 0.5)
    fit = lambda targets: {r["trial_id"]: r for r in canonicalize.scale_fit(frames, targets).collect()}
    for targets in (aims, spark.createDataFrame(list(aims.items()) + [("left_thigh", 9.0), ("other", 1.0)], "bone string, length double")):
        got = fit(targets)
        assert {k: (r["s_global"], r["scale_flag"], r["scale_reason"], r["bone_count_valid"]) for k, r in got.items()} == {
            "plain": (1.0, "ok", None, 4), "holes": (1.0, "ok", None, 4), "none": (1.0, "insufficient_valid_bones", "insufficient_valid_bones", 0),
            "outlier": (1.0, "ok", None, 4), "small": (0.75, "clipped", None, 4),
        }
        assert got["holes"]["bones"]["left_thigh"].asDict() == {"target": 0.5, "length": 0.4, "ratio": 1.25} and got["none"]["bones"]["left_shank"]["length"] is None
    own = spark.createDataFrame([("plain", "left_thigh", 0.6), ("plain", "left_shank", 0.6), ("plain", "right_thigh", 0.0), ("plain", "right_shank", None)], "trial_id string, bone string, length double")
    got = fit(own)
    assert got["plain"]["s_global"] == pytest.approx(1.2) and got["plain"]["bone_count_valid"] == 2
    assert got["small"]["scale_reason"] == "insufficient_valid_bones" and got["small"]["scale_raw"] is None
    assert tuple(fit(None)["plain"])[3:] == (1.0, None, None, None, None, None)
    assert canonicalize.scale_fit(frames.limit(0), aims).count() == 0


def test_which_joint_carries_the_weight(spark):
    def at(trial, i, heights, x=0.0):
        points = [(0.0, 0.0, 9.0)] * 24
        for joint, z in zip((7, 8, 10, 11), heights, strict=True):
            points[joint] = (x, 0.0, z)
        return ("A", "s", trial, i, points)

    nan = math.nan
    rows = [at("ties", 0, (0.1, 0.1, 0.2, 0.3)), at("ties", 1, (0.4, 0.3, 0.2, 0.2)), at("nan", 0, (0.1, 0.2, nan, nan)), at("nan", 1, (0.1, 0.2, 0.3, 0.05))]
    rows += [at("far", 0, (0.1, 0.2, 0.3, 0.4), math.inf), ("A", "s", "none", 0, None)]
    got = {r["trial_id"]: r for r in canonicalize.support_metrics(spark.createDataFrame(rows, BONES)).collect()}
    names = [f"{n}_selected_count" for n in canonicalize.CARRIERS]
    assert {k: [r[n] for n in names] for k, r in got.items()} == {"ties": [1, 0, 1, 0], "nan": [0, 0, 1, 1], "far": [1, 0, 0, 0], "none": [1, 0, 0, 0]}
    assert (got["ties"]["min_z"], got["ties"]["max_z"], got["ties"]["left_foot_selected_ratio"], got["ties"]["warnings"]) == (0.1, 0.2, 0.5, [])
    assert (got["nan"]["finite_ratio"], got["nan"]["min_z"], got["nan"]["warnings"]) == (0.5, None, ["support_points_nonfinite"])
    assert got["far"]["finite_ratio"] == 0 and got["far"]["min_z"] == 0.1 and got["none"]["min_z"] is None
    assert canonicalize.support_metrics(spark.createDataFrame([], BONES)).count() == 0


def test_records_of_runs_without_some_tables(spark, tmp_path):
    folder, keys = str(tmp_path / "runs"), ("subset", "subject_id", "trial_id")
    shape = "subset string, subject_id string, trial_id string, frame_count int, reason string, status string, stages struct<input: string, walk: string>, warnings array<string>, floor_reason string, yaw_reason string"
    rows = [("A", "s", "x", 9, "ok", "described", ("ok", "none"), ["dim"], "tilted", None), ("A", "s", "y", 3, "too short", "rejected", ("rejected", "not_run"), None, None, None)]
    StageStore(spark, folder, keys).put("status", spark.createDataFrame(rows, shape))
    got = {r["trial_id"]: r.asDict(recursive=True) for r in record.stored_records(spark, folder, 30.0, "lib").collect()}
    assert got["x"]["segments"] == [] and got["x"]["description"] is None and got["x"]["counts"] == {"walk": 0, "turn": 0}
    assert got["x"]["warnings"] == ["dim", "tilted"] and got["y"]["warnings"] == ["too short"]
    assert [(s["stage"], s["state"], s["warnings"]) for s in got["x"]["stages"]] == [("input", "ok", ["dim"]), ("canonicalization", "partial", ["tilted"]), ("walk", "none", [])]
    assert got["y"]["stages"][1]["state"] == "not_run"
