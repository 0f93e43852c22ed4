"""Key/value parsing, routing and shaping (FIXTURES.md section 2)."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewire import operators as ops
from tidewire.functions.kv import csv_pair_valid, long_from_bytes, long_to_bytes

# line -> (valid, key, value), from the Java split(",") rule
CSV_CASES = [
    ("a,b", True, "a", "b"),
    ("a", False, None, None),
    ("a,", False, None, None),
    ("", False, None, None),
    (",b", True, "", "b"),
    ("a,,c", True, "a", ""),
    ("a,b,,", True, "a", "b"),
    (",,c", True, "", ""),
    (None, False, None, None),
]


def java_split_fields(line: str) -> list[str]:
    """Model of Java String.split(",") (trailing empty strings removed)."""
    parts = line.split(",")
    while parts and parts[-1] == "":
        parts.pop()
    return parts if parts else [""] if line == "" else parts


def test_csv_edge_cases(spark):
    df = spark.createDataFrame([(c[0],) for c in CSV_CASES], "line string")
    good, bad = ops.parse_csv_kv(df, line="line", on_bad="quarantine", keep=("line",))
    got = {r.line: (r.key, r.value) for r in good.collect()}
    rejected = [r.line for r in bad.collect()]
    for line, valid, k, v in CSV_CASES:
        if valid:
            assert got[line] == (k, v)
        else:
            assert line in rejected and line not in got


def test_csv_fail_mode_raises(spark):
    df = spark.createDataFrame([("a,b",), ("a,",)], "value string")
    with pytest.raises(PySparkException, match="fewer than two fields"):
        ops.parse_csv_kv(df).collect()


def test_csv_fail_check_survives_pruning(spark):
    df = spark.createDataFrame([("a,b",), ("x",)], "value string")
    with pytest.raises(PySparkException):
        ops.parse_csv_kv(df).select("value").collect()


def test_csv_drop_mode(spark):
    df = spark.createDataFrame([("a,b",), ("a",), (None,)], "value string")
    assert [tuple(r) for r in ops.parse_csv_kv(df, on_bad="drop").collect()] == [("a", "b")]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab,", max_size=6), min_size=1, max_size=20))
def test_csv_predicate_matches_java_split(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = [r[0] for r in df.select(csv_pair_valid("line")).collect()]
    assert got == [len(java_split_fields(x)) >= 2 for x in lines]


def test_decode_kv_string_and_long(spark):
    df = spark.createDataFrame([(bytearray(b"k"), bytearray("vé".encode()), 7)],
                               "key binary, value binary, offset long")
    assert ops.decode_kv(df, keep=("offset",)).collect()[0].asDict() == \
        {"offset": 7, "key": "k", "value": "vé"}
    longs = spark.createDataFrame([(42,), (-1,), (None,)], "k long")
    back = longs.select(long_to_bytes("k").alias("b")).select(F.hex("b"), long_from_bytes("b"))
    assert [tuple(r) for r in back.collect()] == [
        ("000000000000002A", 42), ("FFFFFFFFFFFFFFFF", -1), (None, None)]


def test_null_to_literal_and_routing(spark):
    df = spark.createDataFrame([(0, None, "x"), (1, "k", None), (2, "a", "b")],
                               "offset long, key string, value string")
    out = ops.route_alternate(ops.null_to_literal(df), "offset").orderBy("offset").collect()
    assert [(r.topic, r.key, r.value) for r in out] == [
        ("topic2", "null", "x"), ("topic1", "k", "null"), ("topic2", "a", "b")]


def test_prefix_param(spark):
    words = spark.createDataFrame([(f"word{i}",) for i in range(10)], "word string")
    out = [r.word for r in ops.prefix(words, "word", "UserValue").collect()]
    assert out == [f"UserValue_word{i}" for i in range(10)]


def test_text_to_lines(spark):
    df = spark.createDataFrame([(1, "a,b\nc\n"), (2, None)], "doc_id long, text string")
    rows = [tuple(r) for r in ops.text_to_lines(df).collect()]
    assert rows == [(1, 1, "a,b"), (1, 2, "c"), (1, 3, "")]


def test_kafka_option_builders():
    from tidewire.sinks.kafka import sink_options
    from tidewire.sources.kafka import source_options
    o = source_options("h:9092", ["a", "b"], group_id="test.group", read_committed=True,
                       ending_timestamp_ms=10_000)
    assert o == {"kafka.bootstrap.servers": "h:9092", "subscribe": "a,b",
                 "kafka.group.id": "test.group", "kafka.isolation.level": "read_committed",
                 "endingTimestamp": "10000"}
    assert "topic" not in sink_options("h:9092")  # per-record routing stays possible
    with pytest.raises(ValueError):
        source_options("", "t")


def test_kafka_frame(spark):
    from tidewire.sinks.kafka import kafka_frame
    df = spark.createDataFrame([(1, "k", "v", "t1")], "o long, key string, value string, topic string")
    assert kafka_frame(df, topic="topic").columns == ["topic", "key", "value"]
    assert kafka_frame(df, key=None).columns == ["value"]


def test_event_time_policy(spark):
    from tidewire.operators import event_time_from_policy
    df = spark.createDataFrame([(0, 0), (1, 1)], "offset long, timestampType int") \
        .withColumn("timestamp", F.timestamp_seconds("offset"))
    assert event_time_from_policy(df.filter("timestampType = 0"), "create").count() == 1
    with pytest.raises(PySparkException, match="not of type create"):
        event_time_from_policy(df, "create").collect()
    assert event_time_from_policy(df, "log_append").filter("timestampType = 1").count() == 1
    assert dict(event_time_from_policy(df, "processing").dtypes)["ts"] == "timestamp"
    with pytest.raises(ValueError):
        event_time_from_policy(df, "wall")
