from stridelake.sources import contracts, tables


def payload(pose=72, frames=8, beta=((0.0,) * 10,), fps=30.0, trans=3, value=0.0):
    return ([[value] * pose] * frames, [[0.0] * trans] * frames, [list(b) for b in beta], fps)


SCHEMA = "pose array<array<double>>, trans array<array<double>>, beta array<array<double>>, fps double"


def test_first_broken_rule_wins(spark):
    rows = [
        payload(), payload(pose=71), payload(trans=2), payload(frames=0), payload(value=float("nan")), payload(fps=0.0),
        payload(beta=[(float(i),) * 10 for i in range(8)]), payload(beta=[(1.0,) * 10] * 8), payload(frames=90), (None, None, None, 30.0),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {SCHEMA}")
    got = {r["i"]: r["reason"] for r in tables.skip_short(tables.validate_raw(df)).collect()}
    assert got[0] == "duration_lt_3s" and got[8] == "ok" and got[7] == "duration_lt_3s"
    assert "pose must have shape" in got[1] and "trans must have shape" in got[2] and got[3] == "no frames"
    assert got[4] == "pose or trans is not finite" and got[5] == "fps must be positive" and got[6] == "beta is not constant"
    assert got[9] == "missing keys"


def test_nested_and_flat_identity(spark):
    nested = spark.createDataFrame([("A", {"2": {"T1": (30.0,)}})], "subset string, sequences map<string, map<string, struct<fps: double>>>")
    assert tuple(tables.flatten_dataset(nested).first()) == ("A", "2", "T1", 30.0)
    flat = spark.createDataFrame([(" ", "x")], "subject string, name string")
    row = tables.with_identity(flat, "stem").first()
    assert (row["subject_id"], row["trial_id"], row["subset"]) == ("x", "trial_0001", "single_sequence")


def test_contract_names_what_is_wrong(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert contracts.require_columns(df, ["a"]) is df
    for needed, exactly in ((["c"], False), (["a"], True)):
        try:
            contracts.require_columns(df, needed, exactly)
        except ValueError as error:
            assert "c" in str(error) or "b" in str(error)
        else:
            raise AssertionError
