"""Co-group, lookup join, unique lookup, aggregates (FIXTURES.md section 2)."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewire import operators as ops


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_join_fixture(spark):
    stream = spark.createDataFrame([("a", "x"), ("z", "y")], "key string, value string")
    lookup = ops.unique_lookup(spark.createDataFrame([("a", "1"), ("b", "2")], "key string, value string"))
    out = sorted(r.line for r in ops.lookup_join(stream, lookup).collect())
    assert out == ["K: [a], SVs: x, BVs: 1", "K: [z], SVs: y, BVs: null"]


def test_lookup_duplicate_key_fails(spark):
    stream = spark.createDataFrame([("a", "x")], "key string, value string")
    dup = spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "9")], "key string, value string")
    with pytest.raises(PySparkException, match="Duplicate values for a"):
        ops.lookup_join(stream, ops.unique_lookup(dup)).collect()
    assert [tuple(r) for r in ops.duplicate_keys(dup).collect()] == [("a", 2)]


def test_lookup_join_broadcasts_small_side_without_stream_shuffle(spark, scratch):
    # a written table carries size statistics; Spark broadcasts it because it
    # is below the broadcast threshold, and the stream side is not shuffled
    spark.createDataFrame([("1", "a")], "key string, value string").write.parquet(scratch)
    stream = spark.range(1000).select(F.col("id").cast("string").alias("key"), F.lit("v").alias("value"))
    lookup = ops.unique_lookup(spark.read.parquet(scratch))
    plan = _plan(ops.lookup_join(stream, lookup))
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan
    assert "SortMergeJoin" not in plan


def test_lookup_join_beyond_threshold_is_shuffle_join(spark, scratch):
    spark.createDataFrame([("1", "a")], "key string, value string").write.parquet(scratch)
    stream = spark.range(1000).select(F.col("id").cast("string").alias("key"), F.lit("v").alias("value"))
    lookup = ops.unique_lookup(spark.read.parquet(scratch))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(ops.lookup_join(stream, lookup))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" not in plan


def test_cogroup_fixture(spark):
    ts = F.lit("2024-01-01 00:00:05").cast("timestamp_ntz")
    stream = spark.createDataFrame([("a", "x"), ("a", "y"), ("s", "w")], "key string, value string") \
        .withColumn("ts", ts)
    bounded = spark.createDataFrame([("a", "1"), ("b", "2")], "key string, value string").withColumn("ts", ts)
    out = sorted(r.line for r in ops.windowed_cogroup(stream, bounded).collect())
    assert out == ["K: [a], SVs: [x],[y],, BVs: [1],",
                   "K: [b], SVs: , BVs: [2],",
                   "K: [s], SVs: [w],, BVs: "]


def test_cogroup_repeated_values_and_windows(spark):
    rows = [("a", "x", "2024-01-01 00:00:01"), ("a", "x", "2024-01-01 00:00:02"),
            ("a", "x", "2024-01-01 00:00:21"), ("a", None, "2024-01-01 00:00:03")]
    stream = spark.createDataFrame(rows, "key string, value string, t string") \
        .withColumn("ts", F.col("t").cast("timestamp_ntz")).drop("t")
    bounded = stream.limit(0)
    out = sorted((str(r.window_start), r.line) for r in ops.windowed_cogroup(stream, bounded).collect())
    assert out == [("2024-01-01 00:00:00", "K: [a], SVs: [null],[x],[x],, BVs: "),
                   ("2024-01-01 00:00:20", "K: [a], SVs: [x],, BVs: ")]


def test_cogroup_plan_two_exchanges_no_python(spark):
    ts = F.lit("2024-01-01 00:00:05").cast("timestamp_ntz")
    s = spark.range(100).select(F.col("id").cast("string").alias("key"), F.lit("v").alias("value"), ts.alias("ts"))
    plan = _plan(ops.windowed_cogroup(s, s))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_count" in plan
    assert "Python" not in plan and "ArrowEval" not in plan


def test_bracket_list(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, "c")], "g int, v string")
    out = {r.g: r.values for r in ops.bracket_list(df, ["g"], "v").collect()}
    assert out == {1: "[a],[b],[b],", 2: "[c],"}


def test_global_max_and_cutoff_filter(spark):
    words = spark.createDataFrame([("ab",), ("abcd",), ("abcdef",), ("xyz",)], "w string")
    cutoff = ops.global_max(words.filter(F.col("w").startswith("x")), F.length("w"))
    kept = sorted(r.w for r in ops.filter_by_global(words, F.length("w"), cutoff).collect())
    assert kept == ["ab", "xyz"]
    plan = _plan(ops.filter_by_global(words, F.length("w"), cutoff))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_bounded_by_count_and_time(spark):
    df = spark.range(100).withColumnRenamed("id", "offset")
    assert [r.offset for r in ops.bounded_by_count(df, "offset", 5).collect()] == [0, 1, 2, 3, 4]
    t = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-01 00:00:09",), ("2024-01-01 00:00:10",)],
                              "t string").select(F.col("t").cast("timestamp_ntz").alias("ts"))
    assert ops.bounded_by_time(t, "ts", "10 seconds").count() == 2


def test_assign_event_time(spark):
    df = spark.createDataFrame([("a",)], "k string")
    r = ops.assign_event_time(df, "2024-01-01 00:00:00", "30 seconds").collect()[0]
    assert str(r.ts) == "2024-01-01 00:00:30"
    inst = ops.assign_event_time(df, "2024-01-01 00:00:00", "30 seconds", as_instant=True)
    assert dict(inst.dtypes)["ts"] == "timestamp"


def test_salted_lookup_join_same_result_and_spread(spark, scratch):
    rows = [("hot", f"v{i}") for i in range(300)] + [("a", "x"), ("z", "y")]
    stream = spark.createDataFrame(rows, "key string, value string")
    lookup = ops.unique_lookup(spark.createDataFrame([("hot", "H"), ("a", "1")], "key string, value string"))
    plain = sorted(tuple(r) for r in ops.lookup_join(stream, lookup).collect())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted_df = ops.lookup_join(stream, lookup, salt=4)
        salted = sorted(tuple(r) for r in salted_df.collect())
        plan = _plan(salted_df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert salted == plain and len(plain) == 302
    assert "_salt" in plan and "BroadcastHashJoin" not in plan
    assert "_salt" not in salted_df.columns


def test_unique_lookup_on_dup_max(spark):
    dup = spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "9")], "key string, value string")
    assert sorted(tuple(r) for r in ops.unique_lookup(dup, on_dup="max").collect()) == [("a", "9"), ("b", "2")]
    with pytest.raises(ValueError):
        ops.unique_lookup(dup, on_dup="first")


def test_bucketed_lookup_is_not_shuffled(spark, scratch):
    """A large lookup written bucketed by key: only the stream side moves."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lk = spark.range(1000).select(F.col("id").cast("string").alias("key"), F.lit("v").alias("value"))
        table = ops.bucketed_lookup(lk, "tw_lookup_bucketed", 8, path=scratch)
        stream = spark.range(5000).select((F.col("id") % 1000).cast("string").alias("key"),
                                          F.lit("s").alias("value"))
        joined = ops.lookup_join(stream, table)
        plan = _plan(joined)
        assert joined.filter("lookup_value = 'v'").count() == 5000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS tw_lookup_bucketed")
    assert plan.count("Exchange hashpartitioning") == 1
