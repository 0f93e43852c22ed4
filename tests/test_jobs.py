"""End-to-end jobs on broker-shaped replay input (no broker needed)."""

import pytest
from pyspark.sql import functions as F

from tidewire.plans import jobs
from tidewire.sources.replay import BROKER_SCHEMA, as_broker_records
from tidewire.streaming import run_available


def _records(spark, rows):
    df = spark.createDataFrame(rows, "k string, v string, off long, s long")
    return as_broker_records(df, F.col("k"), F.col("v"), F.col("off"),
                             F.timestamp_seconds("s"), ts_is_ntz=False)


def test_copy_modes(spark):
    recs = _records(spark, [(None, "a,1", 0, 1), ("k", None, 1, 2), ("k2", "b,2", 2, 3)])
    pr = sorted(tuple(r) for r in jobs.copy_plan(recs, "pr").collect())
    assert pr == [("topic1", "k", "null"), ("topic2", "k2", "b,2"), ("topic2", "null", "a,1")]
    assert jobs.copy_plan(recs, "values").columns == ["value"]
    assert jobs.copy_plan(recs, "kv").columns == ["key", "value"]
    with pytest.raises(ValueError, match="mode must be one of"):
        jobs.copy_plan(recs, "xx")


def test_cogroup_job_end_to_end(spark, scratch):
    _records(spark, [("x", "a,x", 0, 1), ("x", "a,y", 1, 2), ("x", "s,w", 2, 3)]) \
        .coalesce(1).write.parquet(f"{scratch}/topic")
    spark.createDataFrame([("a,1",), ("b,2",)], "value string").write.text(f"{scratch}/bounded")
    recs = spark.readStream.schema(BROKER_SCHEMA).parquet(f"{scratch}/topic")
    lines = spark.read.text(f"{scratch}/bounded")
    from tidewire.sinks.replay_safe import replay_safe_sink
    run_available(replay_safe_sink(jobs.cogroup_plan(recs), f"{scratch}/out", f"{scratch}/ck", output_mode="update"))
    from tidewire import operators as ops
    out = jobs.cogroup_result(spark, f"{scratch}/out", lines, "1970-01-01 00:00:00", stamp_offset="5 seconds")
    assert sorted(r.line for r in ops.format_cogroup(out).collect()) == [
        "K: [a], SVs: [x],[y],, BVs: [1],", "K: [b], SVs: , BVs: [2],", "K: [s], SVs: [w],, BVs: "]


def test_cogroup_backlog_is_not_late_against_the_start(spark, scratch):
    """Topic rows at 1000, 1040, 1080 and 1120 s, one file each, start 5000 s:
    all four are counted."""
    from tidewire.sinks.replay_safe import replay_safe_sink
    for i, s in enumerate((1000, 1040, 1080, 1120)):
        _records(spark, [("x", "a,v", i, s)]).coalesce(1).write.mode("append").parquet(f"{scratch}/topic")
    recs = spark.readStream.schema(BROKER_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/topic")
    run_available(replay_safe_sink(jobs.cogroup_plan(recs), f"{scratch}/out", f"{scratch}/ck", output_mode="update"))
    lines = spark.createDataFrame([("a,1",)], "value string")
    out = jobs.cogroup_result(spark, f"{scratch}/out", lines, "1970-01-01 01:23:20").collect()
    assert sum(r.n for r in out if r.side == 0) == 4 and sum(r.n for r in out if r.side == 1) == 1


def test_cogroup_result_before_the_first_batch(spark, scratch):
    lines = spark.createDataFrame([("a,1",)], "value string")
    out = jobs.cogroup_result(spark, f"{scratch}/none", lines, "1970-01-01 00:00:00").collect()
    assert [(r.key, r.side, r.n) for r in out] == [("a", 1, 1)]


def test_copy_bounds(spark, scratch):
    recs = _records(spark, [("k", f"v{i}", i, 10 * i) for i in range(6)])
    assert jobs.copy_plan(recs, "pr", for_time="25 seconds").count() == 3
    assert sorted(r.value for r in jobs.copy_plan(recs, "kv", for_count=2).collect()) == ["v0", "v1"]
    recs.write.parquet(scratch)
    with pytest.raises(ValueError, match="batch read"):
        jobs.copy_plan(spark.readStream.schema(BROKER_SCHEMA).parquet(scratch), "pr", for_count=1)


def test_lookup_job(spark, scratch):
    _records(spark, [("x", "a,x", 0, 1), ("x", "z,y", 1, 2)]).coalesce(1).write.parquet(f"{scratch}/topic")
    recs = spark.readStream.schema(BROKER_SCHEMA).parquet(f"{scratch}/topic")
    q = jobs.lookup_job(recs, spark.createDataFrame([("a,1",)], "value string"), f"{scratch}/out", f"{scratch}/ck")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(r.line for r in spark.read.parquet(f"{scratch}/out").collect()) == [
        "K: [a], SVs: x, BVs: 1", "K: [z], SVs: y, BVs: null"]


def test_keyed_write_job(spark, scratch):
    raw = spark.createDataFrame([(str(i % 5), f"n{i}_c{i}") for i in range(20)], "id string, raw string")
    jobs.keyed_write_job(raw, scratch)
    back = spark.read.parquet(scratch)
    assert sorted(tuple(r) for r in back.collect()) == sorted((str(i % 5), f"n{i}", f"c{i}") for i in range(20))
    files = back.withColumn("f", F.input_file_name()).groupBy("id").agg(F.countDistinct("f").alias("n"))
    assert files.filter("n > 1").count() == 0


def test_lookup_plan_streaming(spark, scratch):
    _records(spark, [("x", "a,x", 0, 1), ("x", "z,y", 1, 2)]).coalesce(1).write.parquet(f"{scratch}/topic")
    recs = spark.readStream.schema(BROKER_SCHEMA).parquet(f"{scratch}/topic")
    lookup = spark.createDataFrame([("a,1",), ("b,2",)], "value string")
    out = jobs.lookup_plan(recs, lookup)
    q = (out.writeStream.format("parquet").option("path", f"{scratch}/out")
            .option("checkpointLocation", f"{scratch}/ck"))
    run_available(q)
    assert sorted(r.line for r in spark.read.parquet(f"{scratch}/out").collect()) == [
        "K: [a], SVs: x, BVs: 1", "K: [z], SVs: y, BVs: null"]


def test_parquet_job_from_rate_source(spark, scratch):
    from tidewire.sources.files import sequence
    from tidewire.sinks.files import windowed_parquet
    seq = sequence(spark, rows_per_batch=10, partitions=2)
    # an unbounded source: availableNow runs what is available at start
    run_available(windowed_parquet(jobs.parquet_plan(seq), f"{scratch}/out", f"{scratch}/ck"), 120)
    back = spark.read.parquet(f"{scratch}/out")
    rows = back.select("value", "record.row").collect()
    assert len(rows) >= 10
    assert all(r.row == f"IO IT Test line of text. Line seed: {r.value}" for r in rows)


def test_parquet_plan_windows(spark):
    seq = spark.range(12).select(F.col("id").alias("value"), F.timestamp_seconds("id").alias("timestamp"))
    out = jobs.parquet_plan(seq)
    starts = sorted({r.window_start.second for r in out.collect()})
    assert starts == [0, 5, 10]


def test_kinesis_job_with_stand_in_client(spark, tmp_path):
    import json
    log = str(tmp_path / "sent.jsonl")
    df = spark.range(10).select(F.encode(F.col("id").cast("string"), "UTF-8").alias("data"))
    jobs.kinesis_job(df, "data", "stream-1", client_factory="tests.support.fake_stream_client:factory",
                     options={"fake_log": log})
    sent = [r for line in open(log) for r in json.loads(line)["records"]]
    assert sorted(int(v) for _, v in sent) == list(range(10))
    assert {json.loads(line)["stream"] for line in open(log)} == {"stream-1"}
