"""Hot keys: one key holding a third of all rows (derived from events)."""

from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidewire import operators as ops

SF = "/root/testdata/sf0.01"


def _hot_events(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    key = F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.col("user_id").cast("string"))
    return ev.select(key.alias("key"), F.col("event_type").alias("value"), "ts", "event_id")


def test_hot_key_bracket_list_matches_brute_force(spark):
    hot = _hot_events(spark)
    got = {r.key: r.values for r in ops.bracket_list(hot, ["key"], "value").collect()}
    groups = defaultdict(list)
    for r in hot.select("key", "value").collect():
        groups[r.key].append(r.value)
    want = {k: "".join(f"[{v}]," for v in sorted(vs)) for k, vs in groups.items()}
    assert got == want
    assert Counter(r.key for r in hot.select("key").collect())["hot"] > hot.count() // 4


def test_hot_key_cogroup_pre_aggregates(spark):
    hot = _hot_events(spark).drop("event_id")
    plan_df = ops.windowed_cogroup(hot, hot.limit(0), window=None)
    plan = plan_df._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan  # raw rows are counted before any shuffle
    line = plan_df.filter("key = 'hot'").collect()[0].line
    n_hot = hot.filter("key = 'hot'").count()
    stream_values = line.split(", SVs: ")[1].split(", BVs: ")[0]
    assert stream_values.count("],") == n_hot  # every row of the hot key is in its line


SKEW_CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000",
             "spark.sql.adaptive.coalescePartitions.enabled": "false",
             "spark.sql.shuffle.partitions": "16"}


def _joined_with_conf(spark, build):
    old = {k: spark.conf.get(k) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        joined = build()
        rows = joined.collect()
        return rows, joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_skewed_shuffle_lookup_is_split_by_aqe(spark):
    """A hot key on the stream side of a shuffle join is split by AQE when
    the lookup is checkpointed.  (AQE splits along map outputs, so the
    one-file table is spread over several map tasks first, as any large
    scan is.)"""
    hot = _hot_events(spark).select("event_id", "key", "value").repartition(8)
    raw = spark.read.parquet(f"{SF}/customer.parquet").select(
        F.col("c_custkey").cast("string").alias("key"), F.col("c_mktsegment").alias("value")) \
        .unionByName(spark.createDataFrame([("hot", "HOT")], "key string, value string"))

    rows, plan = _joined_with_conf(spark, lambda: ops.lookup_join(hot, ops.checked_lookup(raw)))
    assert len(rows) == hot.count()
    assert sum(r.lookup_value == "HOT" for r in rows) == hot.filter("key = 'hot'").count()
    assert "SortMergeJoin(skew=true)" in plan

    # fed directly by the uniqueness aggregate, the join cannot be split
    _, plan = _joined_with_conf(spark, lambda: ops.lookup_join(hot, ops.unique_lookup(raw)))
    assert "skew=true" not in plan


def test_salted_lookup_spreads_hot_key_without_aqe(spark):
    hot = _hot_events(spark).select("event_id", "key", "value")
    lookup = ops.unique_lookup(spark.createDataFrame([("hot", "HOT")], "key string, value string"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        salted = ops.lookup_join(hot, lookup, salt=8).filter("key = 'hot'")
        per_task = salted.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(per_task) > 1  # the hot key is joined by several tasks
    assert sum(r["count"] for r in per_task) == hot.filter("key = 'hot'").count()


def test_hot_order_first_record_join_is_split_after_checkpoint(spark):
    """Record equality joins lines to their order's first record; with the
    first records checkpointed, a hot order is split by AQE."""
    from tidewire.session import reliable_checkpoint
    li = spark.read.parquet(f"{SF}/lineitem.parquet").withColumn(
        "l_orderkey", F.when(F.col("l_partkey") % 3 == 0, F.lit(-1)).otherwise(F.col("l_orderkey"))) \
        .repartition(8)
    rec = F.struct(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"))
    first = li.groupBy("l_orderkey").agg(
        F.min_by(rec, F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("first_rec"))

    def build(first_side):
        return li.join(first_side, "l_orderkey").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
            rec.eqNullSafe(F.col("first_rec")).alias("same"))

    rows, plan = _joined_with_conf(spark, lambda: build(reliable_checkpoint(first)))
    assert len(rows) == li.count()
    assert "SortMergeJoin(skew=true)" in plan
    _, plan = _joined_with_conf(spark, lambda: build(first))
    assert "skew=true" not in plan
