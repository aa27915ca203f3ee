import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stridelake.functions import scalars, strings
from stridelake.operators import aggregates, scanners, sequences, tables
from stridelake.operators.sequences import Sequence
from stridelake.plans import represent

SEQ = Sequence(("k",), "i")


def frame(spark, values, more=""):
    return spark.createDataFrame([("a", i, *v) if isinstance(v, tuple) else ("a", i, v) for i, v in enumerate(values)], f"k string, i int, x double{more}")


def column(df, name):
    return [r[name] for r in df.orderBy("i").collect()]


def test_finite_difference_edges(spark):
    values = [0.0, 1.0, 4.0, 9.0]
    got = column(frame(spark, values).withColumn("v", sequences.finite_difference("x", SEQ, 2.0)), "v")
    assert got == [2.0, 4.0, 8.0, 10.0]
    assert column(frame(spark, [5.0]).withColumn("v", sequences.finite_difference("x", SEQ, 2.0)), "v") == [0.0]


def test_unwrap_equals_numpy(spark):
    values = [0.0, 170.0, -170.0, 10.0, -170.0, 180.0, -180.0, 0.0, 180.0, 350.0]
    got = column(sequences.unwrap_degrees(frame(spark, values), SEQ, "x", "u"), "u")
    assert np.allclose(got, np.unwrap(values, period=360))


def test_fill_takes_the_earlier_of_two(spark):
    rows = [(9.0, False), (1.0, True), (9.0, False), (9.0, False), (9.0, False), (2.0, True), (9.0, False)]
    df = sequences.nearest_valid_fill(frame(spark, rows, ", ok boolean"), SEQ, ["x"], "ok", [7.0])
    assert column(df, "x") == [1.0, 1.0, 1.0, 1.0, 2.0, 2.0, 2.0]
    df = sequences.nearest_valid_fill(frame(spark, [(9.0, False)], ", ok boolean"), SEQ, ["x"], "ok", [7.0])
    assert column(df, "x") == [7.0]


def test_rolling_correlation_without_variance(spark):
    df = frame(spark, [(1.0, 2.0)] * 10, ", y double").withColumn("r", sequences.rolling_correlation("x", "y", SEQ, 6))
    assert column(df, "r") == [0.0] * 10


def test_gaussian_repeats_the_ends(spark):
    values = [float(v) for v in np.random.default_rng(1).normal(size=12)]
    got = column(frame(spark, values).withColumn("s", sequences.gaussian_smooth("x", SEQ, 2)), "s")
    w = np.array(sequences.gaussian_weights(2))
    padded = np.pad(values, len(w) // 2, mode="edge")
    assert np.allclose(got, np.convolve(padded, w[::-1], mode="valid"))


def test_half_frames_round_to_even(spark):
    df = spark.range(1).select(scalars.seconds_to_frames(0.25, 10.0).alias("a"), scalars.seconds_to_frames(0.35, 10.0).alias("b"))
    assert tuple(df.first()) == (2, 4)
    assert scalars.frames_of(0.25, 10.0) == 2


@settings(max_examples=40, deadline=None)
@given(st.lists(st.floats(0, 1, width=32), min_size=3, max_size=60))
def test_sit_stand_events_advance_and_stay_inside(values):
    events = scanners.sit_stand_events(np.array(values))
    for kind, start, end, core, stop in events:
        assert 0 <= start <= core < stop <= end < len(values)
        first, last = values[core], values[stop]
        assert (first <= 0.8 and last <= 0.2) if kind == "stand_to_sit" else (first >= 0.2 and last >= 0.8)
    assert all(a[2] < b[3] for a, b in zip(events, events[1:]))


def test_turn_back_is_cut_at_its_run():
    angle = np.array([170, 170, 160, 120, 80, 60, 60, 60.0])
    allowed = np.array([True] * 6 + [False, True])
    fast = np.ones(8)
    assert scanners.turn_events(angle, fast, fast * 50, allowed) == [("return_turn", 1, 5, 2, 5)]


def test_upsert_unites_columns(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, x string")
    new = spark.createDataFrame([(2, "c", 5), (3, "d", 6)], "id int, x string, y int")
    got = {tuple(r) for r in tables.upsert(old, new, ["id"]).collect()}
    assert got == {(1, "a", None), (2, "c", 5), (3, "d", 6)}


def test_percentile_rank_of_unknown_values(spark):
    values = spark.createDataFrame([(1, 0.0), (2, 5.0), (3, None), (4, math.nan)], "id int, m double")
    reference = spark.createDataFrame([(1.0,), (5.0,), (9.0,), (None,)], "m double")
    got = {r["id"]: r["m_rank"] for r in aggregates.percentile_rank(values, reference, ["m"], ["id"]).collect()}
    assert got == {1: 0.0, 2: pytest.approx(2 / 3), 3: None, 4: None}


def test_percentile_rank_whatever_order_rows_come_in(spark):
    """Ranges are made twice, and on a cluster rows come in another order each time."""
    n = 400_000

    def mixed(batches):
        for batch in batches:
            yield batch.take(pa.array(np.random.default_rng().permutation(batch.num_rows)))

    with_batches = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(with_batches)
    spark.conf.set(with_batches, str(n))
    try:
        df = spark.range(n).select("id", F.sqrt("id").alias("m")).mapInArrow(mixed, "id long, m double")
        ranked = aggregates.percentile_rank(df, df, ["m"], ["id"])
        assert ranked.where(F.abs(F.col("m_rank") - (F.col("id") + 1) / n) > 1e-9).count() == 0
    finally:
        spark.conf.set(with_batches, before)


@pytest.mark.parametrize("least", [0, 1, 2, 3, 20])
def test_short_runs_with_unknown_rows(spark, least):
    masks = [None if x == 2 else bool(x) for x in np.random.default_rng(least).integers(0, 3, 60).tolist()] + [True] * 3 + [False] * 4
    want = list(masks)
    for same in [list(g) for _, g in itertools.groupby(range(len(masks)), key=lambda i: masks[i])]:
        if masks[same[0]] is True and len(same) < least:
            want[same[0] : same[-1] + 1] = [False] * len(same)
    df = spark.createDataFrame([("a", i, m) for i, m in enumerate(masks)], "k string, i int, m boolean")
    got = sequences.remove_short_true_runs(df, SEQ, "m", least, "out").orderBy("i").collect()
    assert [r["out"] for r in got] == want


def test_contacts_are_steadied_in_one_order(spark):
    df = spark.range(10).select(F.lit("a").alias("k"), F.col("id").cast("int").alias("i"), F.rand(1).alias("p"))
    df = represent.steady_contacts(df.repartition(2, "k"), SEQ, F.col("p"), "on", 30.0)
    assert df._jdf.queryExecution().executedPlan().toString().count("Sort [") == 1


def test_names_and_clauses(spark):
    df = spark.createDataFrame([(" a/b c ", "六维：步态减慢、；平衡良好。")], "n string, t string")
    header, clauses = strings.split_clauses("t")
    row = df.select(strings.safe_name("n").alias("n"), header.alias("h"), clauses.alias("c")).first()
    assert (row["n"], row["h"], row["c"]) == ("a_b_c", "六维：", ["步态减慢", "平衡良好"])
    flags = df.select(F.transform(clauses, lambda x: strings.has_phrase(x)).alias("f")).first()["f"]
    assert flags == [True, False]


def test_a_supplied_mask_counts_for_its_whole_sequence(spark):
    rows = [("a", 0, None, True), ("a", 1, True, False), ("b", 0, None, True), ("b", 1, None, None), ("c", 0, False, True)]
    df = spark.createDataFrame(rows, "k string, i int, mask boolean, other boolean")
    got = df.withColumn("event", sequences.supplied_or("mask", "other", SEQ)).orderBy("k", "i").collect()
    assert [r["event"] for r in got] == [False, True, True, False, False]
