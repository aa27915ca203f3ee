import pytest
from pyspark.sql import functions as F

import motion
from stridelake.plans import represent, segment


@pytest.fixture(scope="module")
def labelled(spark):
    rows = motion.rows("walk", motion.walk()) + motion.rows("turn", motion.walk_turn_walk()) + motion.rows("sit", motion.sit_stand())
    frames = represent.represent(spark.createDataFrame(rows, motion.SCHEMA), motion.FPS)
    frames = frames.cache()
    out = segment.with_segments(segment.label_frames(segment.signals(frames, motion.FPS), motion.FPS)).cache()
    return frames, out


def labels(out, trial):
    rows = out.where(F.col("trial_id") == trial).groupBy("segment_no").agg(F.first("label").alias("l")).orderBy("segment_no")
    return [r["l"] for r in rows.collect()]


def test_known_labels(labelled):
    _, out = labelled
    assert labels(out, "walk") == ["walk"]
    assert labels(out, "turn") == ["walk", "turn", "walk"]
    assert labels(out, "sit") == ["walk", "stand_to_sit", "sit", "sit_to_stand", "walk"]


def test_frames_are_valid_and_speed_is_known(labelled):
    frames, _ = labelled
    row = frames.where("trial_id = 'walk'").agg(
        F.avg("root_speed_xy_mps").alias("v"), F.avg("heading_deg").alias("h"), F.bool_and("valid_frame_mask").alias("ok"),
        F.count_if("left_heel_strike").alias("n"), F.max(F.abs("trunk_lean_angle_deg")).alias("lean"),
    ).first()
    assert row["v"] == pytest.approx(1.0, abs=1e-6) and row["h"] == pytest.approx(0.0, abs=1e-6)
    assert row["ok"] and 5 <= row["n"] <= 7 and row["lean"] == pytest.approx(0.0, abs=1e-3)


def test_segments_partition_the_sequence(labelled):
    from stridelake.sources.contracts import segments_cover

    frames, out = labelled
    found = segment.segments(out, motion.FPS, represent.gait_summary(frames, motion.FPS))
    cover = segments_cover(found, ["subset", "subject_id", "trial_id"], "start_frame", "end_frame").collect()
    assert len(cover) == 3 and all(r["covers"] for r in cover)
    assert found.where("hesitation_overlap_frames > 0 AND label NOT IN ('walk', 'turn')").isEmpty()
    assert {r["status"] for r in found.collect()} <= {"good", "warning"}


def test_canonical_frame_undoes_tilt_and_turn(spark):
    import numpy as np

    from stridelake.plans import canonicalize

    tilt, turn = np.radians(20), np.radians(40)
    ry = np.array([[np.cos(tilt), 0, np.sin(tilt)], [0, 1, 0], [-np.sin(tilt), 0, np.cos(tilt)]])
    rz = np.array([[np.cos(turn), -np.sin(turn), 0], [np.sin(turn), np.cos(turn), 0], [0, 0, 1]])
    rows = []
    for s, j, t, i, joints, root in motion.rows("walk", motion.walk()):
        move = lambda p: tuple(map(float, ry @ rz @ np.array(p) + [3, 2, 1]))
        rows.append((s, j, t, i, [move(p) for p in joints], move(root)))
    schema = motion.SCHEMA.replace("joints_can", "joints_3d").replace("trans_can", "trans_canonical")
    out = canonicalize.canonicalize(spark.createDataFrame(rows, schema), motion.FPS)
    found = sorted(out.select("frame_index", "joints_can", "trans_can", "floor_reason", "yaw_reason").collect())
    first, last = found[0], found[-1]
    assert abs(first["trans_can"]["x"]) < 1e-9 and abs(first["trans_can"]["y"]) < 1e-9
    assert last["trans_can"]["x"] == pytest.approx(179 / 30, abs=0.05) and abs(last["trans_can"]["y"]) < 0.1
    ground = [min(p["z"] for p in r["joints_can"]) for r in found]
    assert abs(float(np.percentile(ground, 5))) < 0.05
    left, right = first["joints_can"][1], first["joints_can"][2]
    assert left["y"] - right["y"] == pytest.approx(0.2, abs=0.01) and abs(left["x"] - right["x"]) < 0.01
    assert first["floor_reason"] is None and first["yaw_reason"] is None
