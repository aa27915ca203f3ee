from stridelake.streaming.causal import stream_events


def test_state_carries_over_micro_batches(spark, tmp_path):
    batches = [
        [("a", 0, True, 0.0), ("a", 1, True, 1.0), ("b", 0, False, 5.0)],
        [("a", 1, True, 1.0), ("a", 2, False, 4.0), ("b", 1, True, None), ("b", 2, True, 7.0)],
    ]
    schema = "k string, i long, m boolean, x double"
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/part={n}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    query = (
        stream_events(stream, ["k"], "i", "m", "x", 2.0).writeStream.format("memory").queryName("seen")
        .option("checkpointLocation", str(tmp_path / "state")).outputMode("append").start()
    )
    query.processAllAvailable()
    query.stop()
    got = {(r["k"], r["i"]): (r["onset"], r["offset"], r["rate"]) for r in spark.table("seen").collect()}
    assert got == {
        ("a", 0): (True, False, 0.0), ("a", 1): (False, False, 2.0), ("a", 2): (False, True, 6.0),
        ("b", 0): (False, False, 0.0), ("b", 1): (True, False, None), ("b", 2): (False, False, None),
    }
