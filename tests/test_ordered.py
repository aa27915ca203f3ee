"""Stages that run over whole sequences at once: against the window operators, and what their plans hold."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

import motion
from stridelake.operators import ordered
from stridelake.operators import sequences as S
from stridelake.operators.sequences import Sequence
from stridelake.plans import motion_queries as M
from stridelake.plans import represent

SMALL = "/root/testdata/sf0.001"
SEQ = Sequence(("k",), "t")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["represent_quality", "represent_metrics", "segment_signals", "label_frames", "label_metrics", "segments"])
def test_frames_are_sorted_once(spark, name):
    text = plan(M.queries()[name](spark, SMALL)) if name in M.queries() else plan(_metrics(spark))
    assert text.count("Window [") == 1 and text.count("Sort [") <= 4 and "FlatMapGroups" not in text and "SortMergeJoin" not in text


def _metrics(spark):
    from stridelake.plans import contract_queries

    return contract_queries.queries()["represent_metrics"](spark, SMALL)


def test_ordered_functions_equal_windows(spark):
    nan, inf = math.nan, math.inf
    series = {
        "plain": [10.0, 100.0, -170.0, 175.0, 4.0, 5.0, 5.0, 350.0], "one": [3.0], "nan": [1.0, 2.0, nan, 200.0, -20.0, 4.0], "null": [1.0, None, 3.0, 190.0, None, 7.0],
        "inf": [1.0, inf, 3.0], "none": [None, None],
    }
    rows = [(k, t, v, t % 3 == 0 if k != "none" else False) for k, values in series.items() for t, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k string, t int, v double, ok boolean").repartition(3, "k")
    names = ["rate", "smooth", "unwrapped", "long"]

    def run(rows, columns):
        v, ok = columns
        ok = ok > 0
        return [rows.difference(v, 30.0), rows.smoothed(v, 1), rows.unwrapped(v), rows.steady(rows.steady(ok, 2, True), 2, False).astype(float)]

    got = ordered.in_order(df, SEQ, ["v", "ok"], run, StructType([StructField(n, DoubleType()) for n in names]))
    want = df.withColumn("rate", S.finite_difference("v", SEQ, 30.0)).withColumn("smooth", S.gaussian_smooth("v", SEQ, 1))
    want = S.unwrap_degrees(want, SEQ, "v", "unwrapped")
    want = S.fill_short_false_runs(S.remove_short_true_runs(want, SEQ, "ok", 2, "a"), SEQ, "a", 2, "b").withColumn("long", F.col("b").cast("double"))
    got = ordered.in_order(got, SEQ, ["v", F.col("t") % 3], lambda rows, c: [rows.correlation(*c, 4)], StructType([StructField("r", DoubleType())]))
    want, names = want.withColumn("r", S.rolling_correlation("v", F.col("t") % 3, SEQ, 4)), [*names, "r"]
    key = lambda r: [None if x is None else "nan" if x != x else round(x, 9) for x in r]
    a, b = ([key(r[2:]) for r in d.select("k", "t", *names).orderBy("k", "t").collect()] for d in (got, want))
    assert a == b


def test_points_that_are_missing_or_no_numbers(spark):
    rows = motion.rows("null", motion.walk(1.0)) + motion.rows("nan", motion.walk(1.0)) + motion.rows("all", motion.walk(1.0)) + motion.rows("one", motion.walk(1.0))[:1]
    change = {"null": None, "nan": (math.nan, 0.0, 0.9)}
    rows = [(*r[:4], [change[r[2]], *r[4][1:]] if r[2] in change and r[3] == 7 else [None] * 24 if r[2] == "all" else r[4], r[5]) for r in rows]
    df = represent.represent(spark.createDataFrame(rows, motion.SCHEMA), motion.FPS)
    got = {(r["trial_id"], r["frame_index"]): r for r in df.collect()}
    assert len(got) == 91 and "trans_can" in df.columns
    null, nan, empty, one = got["null", 7], got["nan", 7], got["all", 7], got["one", 0]
    # A heading of a missing pelvis comes from the frame before, one of NaN is NaN.
    assert null["heading_deg"] == pytest.approx(0.0) and null["joint_nan_mask"] and null["root_pos_m"] is None and got["null", 8]["root_speed_xy_mps"] is None
    assert nan["joint_nan_mask"] and math.isnan(nan["root_pos_m"]["x"]) and math.isnan(got["nan", 8]["root_speed_xy_mps"]) and not nan["valid_frame_mask"]
    assert not empty["heading_source_valid"] and empty["heading_deg"] == 0.0 and empty["floor_z"] is None and empty["left_foot_contact_prob"] is None
    assert one["root_speed_xy_mps"] == 0.0 and one["yaw_rate_deg_s"] == 0.0


def test_filters_see_whole_sequences_and_moved_rows_are_refused(spark, monkeypatch):
    df = spark.createDataFrame([("a", t, float(t)) for t in range(20)], "k string, t int, v double")
    out = StructType([StructField("sum", DoubleType())])
    total = lambda rows, columns: [np.cumsum(columns[0])]
    once = ordered.in_order(ordered.placed(df, SEQ), SEQ, ["v"], total, out)
    twice = ordered.in_order(once, SEQ, ["sum"], total, StructType([StructField("twice", DoubleType())]))
    assert twice.where("t = 19 AND sum > 100").first()["twice"] == sum(sum(range(k + 1)) for k in range(20))
    moved = once.drop("sum").where("t <> 5")
    with pytest.raises(Exception, match="have been moved"):
        ordered.in_order(moved, SEQ, ["v"], total, out).collect()
    assert ordered.in_order(df.limit(0), SEQ, ["v"], total, out).collect() == []


@pytest.mark.parametrize("name", ["_walks", "_turns"])
def test_features_neither_store_nor_join_frames(spark, monkeypatch, name):
    kept = []
    monkeypatch.setattr(M, "written", lambda df: kept.append(df.columns) or df.localCheckpoint())
    text = plan(getattr(M, name)(spark, SMALL))
    assert kept and not [c for c in kept if "frame_index" in c]
    assert text.count("Window [") == 1 and text.count("explode(sequence") == 1


def test_transforms_are_solved_in_one_pass(spark, monkeypatch):
    from stridelake.plans import canonicalize as C

    kept = []
    monkeypatch.setattr(C, "written", lambda df: kept.append(df.columns) or df)
    rows = motion.rows("walk", motion.walk(1.0)) + [(*r[:4], [(0.0, 0.0, 0.0)] * 24, r[5]) for r in motion.rows("flat", motion.walk(1.0))]
    schema = motion.SCHEMA.replace("joints_can", "joints_3d").replace("trans_can", "trans_canonical")
    frames, names = spark.createDataFrame(rows, schema), ["trial_id", "s_global", "scale_flag", "scale_reason"]
    for targets in ({"left_thigh": 0.45, "left_shank": 0.4}, {"left_thigh": 9.0, "right_thigh": 9.0}, None):
        want = sorted(map(tuple, C.scale_fit(frames, targets).select(names).collect()), key=str)
        got = sorted(map(tuple, C.solve_transforms(frames, motion.FPS, targets).select(names).collect()), key=str)
        assert [r[2:] for r in got] == [r[2:] for r in want] and [r[1] for r in got] == pytest.approx([r[1] for r in want])
    assert len(kept) == 3


def test_transform_checks_read_frames_once(spark):
    from stridelake.plans import contract_queries

    assert plan(contract_queries.queries()["transform_checks"](spark, SMALL)).count("explode(sequence") == 1
