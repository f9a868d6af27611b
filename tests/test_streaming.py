import datetime as dt

from venueweave.streaming import incremental


def test_each_file_is_read_once(spark, tmp_path):
    source, seen = str(tmp_path / "in"), []
    spark.range(3).write.parquet(source + "/a")
    for _ in range(2):
        incremental.file_stage(spark, source + "/*", "id bigint", str(tmp_path / "check"), lambda batch, _: seen.append(batch.count()))
    assert sum(seen) == 3
    spark.range(2).write.parquet(source + "/b")
    incremental.file_stage(spark, source + "/*", "id bigint", str(tmp_path / "check"), lambda batch, _: seen.append(batch.count()))
    assert sum(seen) == 5


def test_windows_and_unchanged_rows(spark, tmp_path):
    at = dt.datetime(2026, 1, 1, 10)
    data = [(1, "x", at), (1, "x", at + dt.timedelta(minutes=5)), (1, "y", at + dt.timedelta(minutes=6)), (1, "x", at + dt.timedelta(minutes=7)), (2, "x", at + dt.timedelta(minutes=61))]
    spark.createDataFrame(data, "id bigint, hash string, ts timestamp").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema("id bigint, hash string, ts timestamp").parquet(str(tmp_path / "in"))

    def run(frame, name, mode):
        frame.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
        return sorted(tuple(r) for r in spark.table(name).collect())

    kept = run(incremental.changed_rows(stream(), "id", "hash", "ts").select("id", "hash"), "kept", "append")
    assert kept == [(1, "x"), (1, "x"), (1, "y"), (2, "x")]
    counts = run(incremental.windowed_counts(stream(), "ts", "hash").select("hash", "n"), "counts", "complete")
    assert counts == [("x", 1), ("x", 3), ("y", 1)]
