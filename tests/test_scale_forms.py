"""Dense numbers, lists in parts, histogram-sized writers, and the co-group of two streams."""

import collections
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewire import operators as ops
from tidewire.functions.records import bracket_join
from tidewire.sinks import histogram_write
from tidewire.sinks.files import HOT_SHARE, writer_plan
from tidewire.streaming import run_final, stream_stream_cogroup


def test_dense_numbers_over_gaps_ties_and_one_range(spark):
    rng = random.Random(2)
    offsets = rng.sample(range(10**6), 3000)
    df = spark.createDataFrame([(o,) for o in offsets], "offset long").repartition(7)
    got = {r.offset: r.number for r in ops.dense_numbers(df, "offset").collect()}
    assert got == {o: i for i, o in enumerate(sorted(offsets))}
    ties = spark.createDataFrame([(1,)] * 50 + [(0,)], "offset long")
    rows = ops.dense_numbers(ties, "offset").collect()
    assert sorted(r.number for r in rows) == list(range(51)) and [r.number for r in rows if r.offset == 0] == [0]
    assert ops.dense_numbers(df.where("false"), "offset").collect() == []


def test_route_dense_alternates_strictly_and_uses_no_single_task(spark):
    df = spark.range(0, 999).where("id % 3 <> 1").withColumnRenamed("id", "offset")
    out = ops.route_dense(df)
    topics = [r.topic for r in out.orderBy("offset").collect()]
    assert topics == ["topic2" if i % 2 == 0 else "topic1" for i in range(len(topics))]
    assert "SinglePartition" not in out._jdf.queryExecution().toString()


def _parts_joined(df, keys, value, limit):
    rows = ops.bracket_parts(df, keys, value, limit).collect()
    by_key = collections.defaultdict(dict)
    for r in rows:
        assert r.part not in by_key[tuple(r[k] for k in keys)]
        by_key[tuple(r[k] for k in keys)][r.part] = r["values"]
    return by_key


@pytest.mark.parametrize("limit", [1, 7, 64, 10**6])
def test_bracket_parts_make_the_one_line_list(spark, limit):
    rng = random.Random(limit)
    rows = [(rng.choice(["a", "b", None]), rng.choice(["x", "yy", "é", "", None, "long" * 5])) for _ in range(400)] + [("one", "v")]
    rows += [("hot", "same")] * 900 + [("hot", f"v{i}") for i in range(300)]  # a value and a group beyond any part
    df = spark.createDataFrame(rows, "k string, v string").repartition(5)
    line = {(r.k,): r["values"] for r in ops.bracket_list(df, "k", "v").collect()}
    got = _parts_joined(df, ["k"], "v", limit)
    assert {k: "".join(p[i] for i in sorted(p)) for k, p in got.items()} == line
    longest = max(len(f"[{v}],") for _, v in rows if v is not None)
    assert all(len(t) < limit + longest for p in got.values() for t in p.values())


def test_a_line_beyond_its_bound_fails_clearly(spark):
    df = spark.createDataFrame([("k", [("ab", 5), (None, 1)])], "k string, e array<struct<value:string,n:long>>")
    assert df.select(bracket_join("e", limit=32).alias("l")).first().l == "[null]," + "[ab]," * 5
    with pytest.raises(Exception, match="too long for one line"):
        df.select(bracket_join("e", limit=31).alias("l")).collect()


def test_histogram_write_bounds_every_writer(spark, scratch):
    """A third of the rows have one key, some keys are null, the others few rows each."""
    writers, n = 12, 12000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 11 == 0, F.lit(None)).otherwise(
        F.col("id") % 900).cast("int").alias("k"), "id", F.concat(F.lit("r"), "id").alias("v"))
    histogram_write(df, "k", scratch, writers)
    back = spark.read.parquet(scratch).withColumn("f", F.input_file_name())
    assert back.count() == n and back.select("id").distinct().count() == n
    sizes = [r["count"] for r in back.groupBy("f").count().collect()]
    assert len(sizes) <= writers and max(sizes) <= (1 + 2 * HOT_SHARE) * n / writers
    hot = HOT_SHARE * n / writers
    files = back.groupBy("k").agg(F.count_distinct("f").alias("files"), F.count("*").alias("n")).collect()
    assert all(r.files == 1 for r in files if r.n <= hot)
    assert max(r.files for r in files) > 3


def test_writer_plan_of_nothing_and_of_one_key(spark, scratch):
    none = spark.createDataFrame([], "k string")
    assert writer_plan(none, "k", 4)[1] == {}
    histogram_write(none, "k", f"{scratch}/none", 4)
    one = spark.range(1000).select(F.lit("only").alias("k"), "id")
    histogram_write(one, "k", f"{scratch}/one", 4)
    sizes = [r["count"] for r in spark.read.parquet(f"{scratch}/one").groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 1000 and len(sizes) == 4 and max(sizes) < 400


def test_stream_stream_cogroup_waits_for_the_lagging_side(spark, scratch):
    start = dt.datetime(2024, 1, 1)

    def topic(name, i, rows):
        spark.createDataFrame([(k, v, start + dt.timedelta(seconds=s)) for k, v, s in rows], "key string, value string, t timestamp").withColumnRenamed(
            "t", "ts").write.parquet(f"{scratch}/{name}/slice={i}")
        return spark.readStream.schema("key string, value string, ts timestamp").parquet(
            f"{scratch}/{name}/slice={{{','.join(map(str, range(i + 1)))}}}")

    def run(left, right):
        both = stream_stream_cogroup(left, right)
        run_final(both, f"{scratch}/out", f"{scratch}/ck")
        return sorted((r.key, r.side, r.value, r.n, r.window_start.second) for r in
                      spark.read.schema(both.schema).parquet(f"{scratch}/out").collect())
    left = topic("left", 0, [("a", "x", 1), ("a", "x", 2), ("only-left", "y", 3), ("a", "z", 200)])
    right = topic("right", 0, [("a", "p", 5)])
    assert run(left, right) == []  # the left side has passed, the right one has not
    right = topic("right", 1, [("only-right", "q", 15), ("a", "late", 10), ("b", "r", 100)])
    left = topic("left", 1, [("c", "w", 201)])
    assert run(left, right) == [("a", 0, "x", 2, 0), ("a", 1, "late", 1, 0), ("a", 1, "p", 1, 0), ("only-left", 0, "y", 1, 0),
                                ("only-right", 1, "q", 1, 0)]
    with pytest.raises(ValueError):
        stream_stream_cogroup(left, spark.range(1))
