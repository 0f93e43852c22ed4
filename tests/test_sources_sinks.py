"""Kinesis-style sink, file sinks."""

import json
import os

from pyspark.sql import functions as F

from tests.conftest import local_path
from tidewire.sinks.files import keyed_partition_write, window_dir_column, windowed_parquet
from tidewire.sinks.kinesis import kinesis_records, register as register_kinesis

def test_kinesis_sink_sends_all_rows_in_batches(spark, tmp_path):
    log = str(tmp_path / "sent.jsonl")
    register_kinesis(spark)
    data = spark.range(1200).select(F.encode(F.col("id").cast("string"), "UTF-8").alias("data"))
    frame = kinesis_records(data, "data", "key").repartition(3)
    (frame.write.format("tidewire-kinesis").mode("append")
          .option("stream", "s1").option("client_factory", "tests.support.fake_stream_client:factory")
          .option("fake_log", log).save())
    calls = [json.loads(x) for x in open(log)]
    sent = [r for c in calls for r in c["records"]]
    assert sorted(int(v) for _, v in sent) == list(range(1200))
    assert {k for k, _ in sent} == {"key"}
    assert all(len(c["records"]) <= 500 for c in calls)


def test_kinesis_sink_keeps_to_the_byte_limit(spark, tmp_path):
    log = str(tmp_path / "sent.jsonl")
    register_kinesis(spark)
    data = spark.range(120).select(F.encode(F.rpad(F.col("id").cast("string"), 200_000, "."), "UTF-8").alias("data"))
    frame = kinesis_records(data, "data", "key").coalesce(1)
    (frame.write.format("tidewire-kinesis").mode("append")
          .option("stream", "s1").option("client_factory", "tests.support.fake_stream_client:factory")
          .option("fake_log", log).save())
    calls = [json.loads(x) for x in open(log)]
    assert all(sum(len(v) + len(k) for k, v in c["records"]) <= 5 * 1024 * 1024 for c in calls)
    assert sorted(int(v.rstrip(".")) for c in calls for _, v in c["records"]) == list(range(120))


def test_kinesis_sink_resends_rejected_records_only(spark, tmp_path):
    log = str(tmp_path / "sent.jsonl")
    register_kinesis(spark)
    data = spark.range(700).select(F.encode(F.col("id").cast("string"), "UTF-8").alias("data"))
    (kinesis_records(data, "data", "key").coalesce(1).write.format("tidewire-kinesis").mode("append")
          .option("stream", "s1").option("client_factory", "tests.support.fake_stream_client:throttling")
          .option("fake_log", log).save())
    taken = [v for line in open(log) for _, v in json.loads(line)["records"]]
    assert sorted(int(v) for v in taken) == list(range(700))  # every record, none twice
    assert sum(1 for _ in open(log)) == 4


def test_kinesis_sink_refuses_what_the_service_cannot_take(spark, tmp_path):
    import pytest
    register_kinesis(spark)
    big = spark.range(1).select(F.encode(F.rpad(F.lit("x"), 1_100_000, "x"), "UTF-8").alias("data"))
    w = kinesis_records(big, "data", "key").write.format("tidewire-kinesis").mode("append").option(
        "stream", "s1").option("client_factory", "tests.support.fake_stream_client:factory").option(
        "fake_log", str(tmp_path / "x"))
    with pytest.raises(Exception, match="over the service's limit"):
        w.save()


def test_endless_topic_read_takes_no_end(spark):
    import pytest

    from tidewire.sources.kafka import kafka_stream
    with pytest.raises(ValueError, match="no end"):
        kafka_stream(spark, "h:1", "t", ending_timestamp_ms=5)


def test_keyed_partition_write_colocates_keys(spark, scratch):
    df = spark.range(1000).select((F.col("id") % 37).alias("k"), F.col("id").alias("v"))
    keyed_partition_write(df, "k", scratch)
    back = spark.read.parquet(scratch).withColumn("f", F.input_file_name())
    files_per_key = back.groupBy("k").agg(F.countDistinct("f").alias("nf"))
    assert files_per_key.filter("nf > 1").count() == 0
    assert back.count() == 1000


def test_windowed_parquet_directory_layout(spark, scratch):
    df = spark.createDataFrame([(0, "2024-01-01 00:00:01"), (1, "2024-01-01 00:00:07"),
                                (2, "2024-01-02 00:00:00")], "value long, t string") \
        .select("value", F.window(F.col("t").cast("timestamp_ntz"), "5 seconds").start.alias("window_start"))
    windowed_parquet(window_dir_column(df, grain="day"), scratch)
    dirs = sorted(d for d in os.listdir(local_path(scratch)) if d.startswith("window_dir="))
    assert dirs == ["window_dir=2024-01-01", "window_dir=2024-01-02"]
    per_window = window_dir_column(df, grain=None).select("window_dir").distinct().count()
    assert per_window == 3


def test_keyed_partition_write_spread_bounds_writers_per_key(spark, scratch):
    df = spark.range(3000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 7).alias("k"),
                                  F.col("id").alias("v"))
    # small partitions are joined at run time; here they are kept apart to see the spread
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed_partition_write(df, "k", scratch, spread=3)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    back = spark.read.parquet(scratch).withColumn("f", F.input_file_name())
    assert back.count() == 3000
    assert back.groupBy("k").agg(F.countDistinct("f").alias("nf")).filter("nf > 3").count() == 0
    hot_files = back.filter("k = 0").select("f").distinct().count()
    assert 1 < hot_files <= 3
