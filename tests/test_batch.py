import math

import pytest
from pyspark.sql import functions as F

import motion
from stridelake.plans import batch, record
from stridelake.sources import checks, loaders
from stridelake.sources.store import StageStore


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return str(tmp_path_factory.mktemp("stages"))


@pytest.fixture(scope="module")
def stages(spark, folder):
    rows = motion.rows("walk", motion.walk()) + motion.rows("turn", motion.walk_turn_walk()) + motion.rows("sit", motion.sit_stand(), subject="s2")
    broken = [(s, j, "broken", i, points[:23], root) for s, j, _, i, points, root in motion.rows("x", motion.walk(1.0))]
    other = motion.rows("far", motion.walk(1.0), subset="B")
    frames = spark.createDataFrame(rows + broken + other, motion.SCHEMA)
    return batch.run_stages(spark, frames, folder, motion.FPS, subsets=["A"])


def test_status_of_every_sequence(stages):
    got = {r["trial_id"]: (r["reason"], r["status"], r["walk_count"], r["turn_count"]) for r in stages["status"].collect()}
    assert got["walk"] == ("ok", "described", 1, 0) and got["turn"] == ("ok", "described", 2, 1)
    assert got["broken"] == ("joints must have 24 points", "rejected", 0, 0) and got["sit"][1] == "described" and "far" not in got
    assert stages["frames"].where("trial_id = 'broken'").isEmpty()


def test_record_of_every_sequence(spark, stages, folder, tmp_path):
    assert record.stored_records(spark, str(tmp_path / "none"), motion.FPS, "lib") is None
    df = record.stored_records(spark, folder, motion.FPS, "lib")
    got = {r["trial_id"]: r.asDict(recursive=True) for r in df.collect()}
    turn, broken = got["turn"], got["broken"]
    assert turn["counts"] == {"walk": 2, "turn": 1} and turn["sequence"]["reference_library"] == "lib" and turn["description"]["text_summary_zh"]
    starts = [s["segment"]["start_frame"] for s in turn["segments"]]
    assert starts == sorted(starts) and [s["segment"]["label"] for s in turn["segments"] if s["turn"]] == ["turn"]
    assert [s["stage"] for s in turn["stages"]] == ["input", "segmentation", "walk", "turn", "description"]
    assert broken["segments"] == [] and broken["description"] is None and broken["sequence"]["status"] == "rejected"
    assert broken["warnings"] == [broken["sequence"]["reason"]] and broken["stages"][0] == {"stage": "input", "state": "rejected", "warnings": broken["warnings"]}
    payload = loaders.as_json(df, ["subset", "subject_id", "trial_id"]).where("trial_id = 'turn'").first()["payload"]
    assert "NaN" not in payload and '"counts":{"walk":2,"turn":1}' in payload


def test_features_and_description(stages):
    walk = stages["walk"].where("trial_id = 'walk'").first()
    assert walk["gait_speed_mps"] == pytest.approx(1.0, abs=0.05) and walk["step_length_mean_m"] > 0.3
    assert walk["cadence_steps_per_min"] == pytest.approx(120, abs=12) and walk["missing_features"] == {}
    turn = stages["turn"].first()
    assert turn["turn_angle_deg"] == pytest.approx(180, abs=25) and turn["trial_id"] == "turn"
    assert turn["missing_features"]["en_bloc_index"] == "missing_pose_orientation_signals"
    text = {r["trial_id"]: r["text_summary_zh"] for r in stages["description"].collect()}
    assert text["walk"].startswith("步行表现为") and "转身表现为" in text["turn"]
    cover = checks.segment_failures(stages["segments"], stages["status"].where("reason = 'ok'").select("subset", "subject_id", "trial_id", "frame_count"),
                                    ["subset", "subject_id", "trial_id"], ["walk", "turn", "sit", "stand_to_sit", "sit_to_stand", "adjust"])
    assert {r["reason"] for r in cover.collect()} == {"ok"}


def raw_of(spark, rows):
    """Motion in raw axes with y up, as it may come."""
    turn = lambda p: F.struct(p["y"].alias("x"), p["z"].alias("y"), p["x"].alias("z"))
    df = spark.createDataFrame(rows, motion.SCHEMA)
    keys = ["subset", "subject_id", "trial_id", "frame_index"]
    return df.select(*keys, F.transform("joints_can", turn).alias("joints_raw"), turn(F.col("trans_can")).alias("trans_raw"))


def test_from_raw_frames_with_faults_and_again(spark, tmp_path):
    rows = motion.rows("walk", motion.walk()) + motion.rows("turn", motion.walk_turn_walk()) + motion.rows("short", motion.walk(2.0))
    gap = [r for r in motion.rows("gap", motion.walk()) if r[3] != 40]
    nan = [(*r[:4], [(math.nan, 0.0, 0.0), *r[4][1:]], r[5]) if r[3] == 7 else r for r in motion.rows("nan", motion.walk())]
    raw, folder = raw_of(spark, rows + gap + nan), str(tmp_path / "runs")
    first = batch.run_raw(spark, raw, folder, motion.FPS)
    assert set(first) == set(batch.RAW_STAGES)
    status = {r["trial_id"]: r for r in first["status"].collect()}
    assert {k: r["reason"] for k, r in status.items()} == {
        "walk": "ok", "turn": "ok", "short": "duration_lt_3s", "gap": "frames must count from 0 without gaps", "nan": "joints are not finite",
    }
    assert status["walk"]["status"] == "described" and status["turn"]["turn_count"] == 1
    assert status["walk"]["stages"].asDict() == {"input": "ok", "segmentation": "ok", "walk": "ok", "turn": "none", "description": "ok"}
    assert set(status["gap"]["stages"][1:]) == {"not_run"}
    speed = first["walk"].where("trial_id = 'walk'").first()["gait_speed_mps"]
    assert speed == pytest.approx(1.0, abs=0.05)

    # The second run mends one sequence and passes by those that were sound, whose rows stay.
    mended = raw_of(spark, motion.rows("gap", motion.walk()) + motion.rows("walk", motion.walk(4.0)))
    second = batch.run_raw(spark, mended, folder, motion.FPS, skip=True)
    assert [r["trial_id"] for r in second["status"].collect()] == ["gap"]
    store = StageStore(spark, folder, ("subset", "subject_id", "trial_id"))
    counts = {r["trial_id"]: r["n"] for r in store.current("frames").groupBy("trial_id").agg(F.count("*").alias("n")).collect()}
    assert counts == {"walk": 180, "turn": 240, "gap": 180}
    assert store.latest().where("reason = 'ok'").count() == 3 and store.latest().count() == 5

    # A run that ends before its status changes nothing; one that doesn't replaces just what it is about.
    store = StageStore(spark, folder, ("subset", "subject_id", "trial_id"))
    assert store.run.startswith("00000003-")
    store.put("frames", store.current("frames").where("trial_id = 'turn'").limit(1))
    assert store.current("frames").where("trial_id = 'turn'").count() == 240
    store.put("status", store.current("status").where("trial_id = 'turn'").drop("run"))
    counts = {r["trial_id"]: r["n"] for r in store.current("frames").groupBy("trial_id").agg(F.count("*").alias("n")).collect()}
    assert counts == {"walk": 180, "turn": 1, "gap": 180}


def test_a_store_without_rows(spark, tmp_path):
    store = StageStore(spark, str(tmp_path / "none"), ("subset", "subject_id", "trial_id"))
    assert store.latest() is None and store.current("frames") is None
    empty = store.put("frames", spark.createDataFrame([], "subset string, subject_id string, trial_id string, x int"))
    assert empty.count() == 0 and empty.columns == ["subset", "subject_id", "trial_id", "x"]


def test_payload_has_no_numbers_that_json_lacks(spark):
    df = spark.createDataFrame([(1, math.nan, ([math.inf, 2.0],), {"k": -math.inf})], "id int, x double, s struct<v: array<double>>, m map<string, double>")
    assert loaders.as_json(df, ["id"]).first()["payload"] == '{"x":null,"s":{"v":[null,2.0]},"m":{"k":null}}'


def test_one_sequence_or_an_error(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    assert loaders.single_sequence(df.where("id = 1")).count() == 1
    for bad in (df, df.limit(0)):
        with pytest.raises(ValueError, match="exactly one"):
            loaders.single_sequence(bad)


def test_reference_table_may_be_missing(spark, tmp_path):
    schema = spark.createDataFrame([], "a string, b double").schema
    assert loaders.reference_table(spark, str(tmp_path / "none.csv"), schema).count() == 0
    (tmp_path / "some.csv").write_text("a,b\nx,1.5\n")
    assert tuple(loaders.reference_table(spark, str(tmp_path / "some.csv"), schema).first()) == ("x", 1.5)


def test_units_survive_parquet(spark, tmp_path):
    df = checks.with_units(spark.createDataFrame([(1.0,)], "v double"), {"v": ("m/s", "speed"), "w": ("m", "none")})
    df.write.parquet(str(tmp_path / "t"))
    assert checks.data_dictionary(spark.read.parquet(str(tmp_path / "t"))) == [("v", "double", "m/s", "speed")]


def test_included_features_join_their_reasons(spark):
    df = spark.createDataFrame([("walk", "included", ["a", "b"]), ("walk", "skipped", []), ("turn", "included", [])], "label string, extraction_status string, reasons array<string>")
    assert [r["reasons"] for r in loaders.included_features(df, "walk").collect()] == ["a;b"]
