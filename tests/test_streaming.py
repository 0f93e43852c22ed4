
from pyspark.sql import functions as F

from tidewire import operators as ops
from tidewire.sinks.replay_safe import batch_writer, latest_pane, read_batches, replay_safe_sink
from tidewire.streaming import (
    run_early,
    run_final,
    rows_dropped_by_watermark,
    run_available,
    bounded_side_counts,
    merged_cogroup,
    stream_side_counts,
    stream_window_counts,
)

LATE_FILES = [[1, 25], [2, 61], [3, 45], [200]]


def _write_files(spark, path, files):
    for f in files:
        (spark.createDataFrame([("a", s) for s in f], "key string, s long")
              .select("key", F.timestamp_seconds("s").alias("ts"))
              .coalesce(1).write.mode("append").parquet(path))


def _window_query(spark, src_path, out, ckpt):
    src = spark.readStream.schema("key string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(src_path)
    agg = stream_window_counts(src, "ts", "20 seconds", ("key",), "20 seconds")
    return (agg.writeStream.format("parquet").outputMode("append")
               .option("path", out).option("checkpointLocation", ckpt))


def _counts(spark, out):
    return sorted((r.window_start.second + 60 * r.window_start.minute, r.n)
                  for r in spark.read.parquet(out).collect())


def test_late_data_one_run_per_file(spark, scratch):
    """FIXTURES.md late-data table: each file in its own run, so a no-data
    batch closes windows between files; the row at 3 s is dropped."""
    emitted, dropped = [], 0
    for i, f in enumerate(LATE_FILES):
        _write_files(spark, f"{scratch}/in", [f])
        q = run_available(_window_query(spark, f"{scratch}/in", f"{scratch}/out", f"{scratch}/ck"))
        dropped += rows_dropped_by_watermark(q)
        emitted.append(_counts(spark, f"{scratch}/out"))
    assert emitted[0] == []
    assert emitted[1] == [(0, 2), (20, 1)]
    assert emitted[2] == [(0, 2), (20, 1)] and dropped == 1
    assert emitted[3] == [(0, 2), (20, 1), (40, 1), (60, 1)]


def test_late_data_back_to_back_batches(spark, scratch):
    """Same files in one run: the late-event watermark lags two batches,
    so the row at 3 s still joins its window."""
    _write_files(spark, f"{scratch}/in", LATE_FILES)
    q = run_available(_window_query(spark, f"{scratch}/in", f"{scratch}/out", f"{scratch}/ck"))
    assert rows_dropped_by_watermark(q) == 0
    assert _counts(spark, f"{scratch}/out") == [(0, 3), (20, 1), (40, 1), (60, 1)]


def test_new_checkpoint_keeps_older_output(spark, scratch):
    """A second query on the same path starts at batch 0 again and must not
    replace what the first one wrote."""
    for i, part in enumerate(([1, 2], [3, 4])):
        (spark.createDataFrame([(v,) for v in part], "v long").coalesce(1).write.parquet(f"{scratch}/in{i}"))
        src = spark.readStream.schema("v long").parquet(f"{scratch}/in{i}")
        run_available(replay_safe_sink(src, f"{scratch}/out", f"{scratch}/ck{i}"))
    assert sorted(r.v for r in read_batches(spark, f"{scratch}/out").collect()) == [1, 2, 3, 4]


def test_unfinished_batch_is_not_read(spark, scratch):
    write = batch_writer(scratch, query_id="q")
    write(spark.range(3), 0)
    spark.range(3, 5).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false") \
        .parquet(f"{scratch}/query_id=q/batch_id=1")
    assert read_batches(spark, scratch).count() == 3


def test_replay_safe_batch_rerun_does_not_duplicate(spark, scratch):
    write = batch_writer(scratch, query_id="q")
    batch = spark.range(5).withColumnRenamed("id", "v")
    write(batch, 0)
    write(spark.range(5, 7).withColumnRenamed("id", "v"), 1)
    write(spark.range(5, 7).withColumnRenamed("id", "v"), 1)  # batch 1 replayed
    back = read_batches(spark, scratch)
    assert back.count() == 7
    assert sorted(r.v for r in back.collect()) == list(range(7))


def test_update_mode_last_pane_equals_batch(spark, scratch):
    _write_files(spark, f"{scratch}/in", [[1, 2], [3, 25], [26, 44]])
    src = spark.readStream.schema("key string, ts timestamp").option("maxFilesPerTrigger", 1) \
        .parquet(f"{scratch}/in")
    agg = stream_window_counts(src, "ts", "20 seconds", ("key",), "20 seconds")
    run_available(replay_safe_sink(agg, f"{scratch}/out", f"{scratch}/ck", output_mode="update"))
    panes = read_batches(spark, f"{scratch}/out")
    # panes of one group only grow
    by_group = {}
    for r in panes.orderBy("batch_id").collect():
        by_group.setdefault(r.window_start, []).append(r.n)
    assert all(v == sorted(v) for v in by_group.values())
    last = {r.window_start.second: r.n for r in latest_pane(panes, ["window_start", "key"]).collect()}
    assert last == {0: 3, 20: 2, 40: 1}


def test_stream_cogroup_matches_batch(spark, scratch):
    rows = [("a", "x", 1), ("a", "y", 2), ("s", "w", 3), ("a", "z", 30)]
    for r in rows:
        (spark.createDataFrame([r], "key string, value string, s long")
              .select("key", "value", F.timestamp_seconds("s").alias("ts"))
              .coalesce(1).write.mode("append").parquet(f"{scratch}/stream"))
    (spark.createDataFrame([("a", "1", 5), ("b", "2", 5)], "key string, value string, s long")
          .select("key", "value", F.timestamp_seconds("s").alias("ts")).write.parquet(f"{scratch}/bounded"))
    schema = "key string, value string, ts timestamp"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/stream")
    counts = stream_side_counts(stream, window="20 seconds", lateness="20 seconds")
    run_available(replay_safe_sink(counts, f"{scratch}/out", f"{scratch}/ck", output_mode="update"))
    bounded = bounded_side_counts(spark.read.schema(schema).parquet(f"{scratch}/bounded"), window="20 seconds")
    last = merged_cogroup(read_batches(spark, f"{scratch}/out"), bounded)
    got = sorted(r.line for r in ops.format_cogroup(last).collect())
    b_stream = spark.read.parquet(f"{scratch}/stream").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    b_bounded = spark.read.parquet(f"{scratch}/bounded").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    want = sorted(r.line for r in ops.windowed_cogroup(b_stream, b_bounded).collect())
    assert got == want
    assert "K: [a], SVs: [x],[y],, BVs: [1]," in got


def test_compact_panes_keeps_latest(spark, scratch):
    from tidewire.sinks.replay_safe import compact_panes, complete_batches
    write = batch_writer(scratch, query_id="q")
    write(spark.createDataFrame([("a", 1), ("b", 1)], "k string, n long"), 0)
    write(spark.createDataFrame([("a", 3)], "k string, n long"), 1)
    write(spark.createDataFrame([("b", 4)], "k string, n long"), 2)
    compact_panes(spark, scratch, ["k"])
    assert len(complete_batches(spark, scratch)) == 2  # the fold and the newest batch
    last = latest_pane(read_batches(spark, scratch), ["k"])
    assert sorted(tuple(r) for r in last.select("k", "n").collect()) == [("a", 3), ("b", 4)]
    write(spark.createDataFrame([("a", 5)], "k string, n long"), 3)
    last = latest_pane(read_batches(spark, scratch), ["k"])
    assert sorted(tuple(r) for r in last.select("k", "n").collect()) == [("a", 5), ("b", 4)]


def test_start_early_processing_time_cadence(spark, scratch):
    """The long-running form: panes at a processing-time cadence until stopped."""
    from tidewire.streaming import start_early
    _write_files(spark, f"{scratch}/in", [[1, 2], [25]])
    src = spark.readStream.schema("key string, ts timestamp").parquet(f"{scratch}/in")
    agg = stream_window_counts(src, "ts", "20 seconds", ("key",), "20 seconds")
    q = start_early(agg, f"{scratch}/out", f"{scratch}/ck", every="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    last = {r.window_start.second: r.n for r in
            latest_pane(read_batches(spark, f"{scratch}/out"), ["window_start", "key"]).collect()}
    assert last == {0: 2, 20: 1}


def test_restart_from_checkpoint_equals_one_run(spark, scratch):
    """Stop after part of the input, restart from the same checkpoint when
    the rest has arrived: state and sinks continue without loss or
    duplicates (update mode + replay-safe sink, and append file sink)."""
    files = [[("a", "x", 1), ("b", "y", 2)], [("a", "y", 25)], [("a", "x", 3), ("b", "x", 41)], [("c", "z", 90)]]

    def add(batch_rows):
        (spark.createDataFrame(batch_rows, "key string, value string, s long")
              .select("key", "value", F.timestamp_seconds("s").alias("ts"))
              .coalesce(1).write.mode("append").parquet(f"{scratch}/in"))

    def run_both():
        ss = "key string, value string, ts timestamp"
        src = spark.readStream.schema(ss).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
        run_early(stream_side_counts(src), f"{scratch}/cg", f"{scratch}/ck-cg")
        src2 = spark.readStream.schema(ss).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
        run_final(stream_window_counts(src2, "ts", "20 seconds", ("key",), "20 seconds"),
                  f"{scratch}/wc", f"{scratch}/ck-wc")

    (spark.createDataFrame([("a", "1", 5)], "key string, value string, s long")
          .select("key", "value", F.timestamp_seconds("s").alias("ts")).write.parquet(f"{scratch}/bounded"))
    for rows in files[:2]:
        add(rows)
    run_both()                      # first run, then the job stops
    for rows in files[2:]:
        add(rows)
    run_both()                      # restarted from the same checkpoints

    bounded = spark.read.schema("key string, value string, ts timestamp").parquet(f"{scratch}/bounded")
    last = merged_cogroup(read_batches(spark, f"{scratch}/cg"), bounded_side_counts(bounded))
    got = sorted((r.window_start.second + 60 * r.window_start.minute, r.line)
                 for r in ops.format_cogroup(last).collect())
    # one uninterrupted batch computation: no row is late here (the row at
    # 3 s meets a late-event watermark of 5 s, so it joins its window)
    kept = [r for b in files for r in b]
    stream_df = spark.createDataFrame(kept, "key string, value string, s long") \
        .select("key", "value", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"))
    bounded_df = spark.read.parquet(f"{scratch}/bounded").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    want = sorted((r.window_start.second + 60 * r.window_start.minute, r.line)
                  for r in ops.windowed_cogroup(stream_df, bounded_df).collect())
    assert got == want
    counts = sorted((r.window_start.second + 60 * r.window_start.minute, r.key, r.n)
                    for r in spark.read.parquet(f"{scratch}/wc").collect())
    # append mode: windows closed by the final watermark (90 - 20 s) only
    assert counts == [(0, "a", 2), (0, "b", 1), (20, "a", 1), (40, "b", 1)]


def test_replay_safe_sink_survives_crash_after_write(spark, scratch):
    """Batch 1 is written, then the job dies before the batch commits; the
    restart re-runs batch 1 with the same id and overwrites it: every input
    row appears exactly once."""
    import pytest
    for part in ([1, 2], [3, 4], [5]):
        (spark.createDataFrame([(v,) for v in part], "v long").coalesce(1)
              .write.mode("append").parquet(f"{scratch}/in"))
    write = batch_writer(f"{scratch}/out")

    def crashing(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("simulated crash after the write")

    src = spark.readStream.schema("v long").option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
    q = (src.writeStream.option("checkpointLocation", f"{scratch}/ck").foreachBatch(crashing)
            .trigger(availableNow=True).start())
    with pytest.raises(Exception):
        q.awaitTermination()
    src = spark.readStream.schema("v long").option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
    run_available(replay_safe_sink(src, f"{scratch}/out", f"{scratch}/ck"))
    back = read_batches(spark, f"{scratch}/out")
    assert sorted(r.v for r in back.collect()) == [1, 2, 3, 4, 5]
