"""Queries that go through a source or a sink: written into the shared
checkpoint directory, then read back with Spark."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire import operators as ops
from tidewire.fixed import BRACKET_ITEM
from tidewire.plans.batch_queries import _ROUTE_SQL
from tidewire.plans.inputs import ROUTE_TOPICS, event_broker_records, event_lines, table
from tidewire.plans.registry import query
from tidewire.session import scratch_path
from tidewire.sinks.files import histogram_write, topic_files
from tidewire.sources.files import text_lines


@query("text_lines", """
select cast(user_id as varchar) as key, event_type as value from events
""")
def text_lines_q(spark, sf):
    """Bounded CSV file: event lines written as text, read line by line,
    cut into key/value."""
    path = scratch_path(spark, "text-lines")
    event_lines(spark, sf).select("line").write.text(path)
    return ops.parse_csv_kv(text_lines(spark, path), line="value")


@query("topic_sink_roundtrip", _ROUTE_SQL)
def topic_sink_roundtrip(spark, sf):
    """Per-record destinations: routed records land in one directory per
    topic and read back with the topic as a partition column."""
    kv = ops.decode_kv(event_broker_records(spark, sf), keep=("offset",))
    routed = ops.route_alternate(kv, "offset", ROUTE_TOPICS)
    path = scratch_path(spark, "topic-files")
    topic_files(routed.select("offset", "topic", "key", "value"), path)
    return spark.read.parquet(path).select("offset", F.col("topic").cast("string"), "key", "value")


@query("keyed_partition_write", """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders
""")
def keyed_partition_write_q(spark, sf):
    """Rows partitioned by customer key before the write, the writers sized by the key
    histogram: a customer that holds much of the table is split, small ones are packed."""
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(spark, "keyed-write")
    histogram_write(orders, "o_custkey", path, writers=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spark.read.parquet(path)


@query("route_dense", f"""
select event_id as "offset",
       case when (row_number() over (order by event_id) - 1) % 2 = 0 then '{ROUTE_TOPICS[0]}' else '{ROUTE_TOPICS[1]}' end as topic
from events where event_id % 3 <> 1
""")
def route_dense_q(spark, sf):
    """Strict alternation on offsets with gaps: the topic as compaction may have left it."""
    topic = event_broker_records(spark, sf).where(F.col("offset") % 3 != 1)
    return ops.route_dense(topic.select("offset"), "offset", ROUTE_TOPICS)


#: Characters of a part of the registered part lists.
PART = 256


@query("group_bracket_parts", f"""
with c as (
  select event_type as key, cast(user_id as varchar) as value, count(*) as n,
         length(cast(user_id as varchar)) + {len(BRACKET_ITEM[0] + BRACKET_ITEM[1])} as size
  from events group by 1, 2),
b as (select *, coalesce(sum(n * size) over (partition by key order by value rows between unbounded preceding and 1 preceding), 0) as start from c),
i as (select key, value, start + unnest(range(0, n)) * size as place from b)
select key, (place // {PART})::bigint as part,
       string_agg('{BRACKET_ITEM[0]}' || value || '{BRACKET_ITEM[1]}', '' order by place) as value_list
from i group by 1, 2
""")
def group_bracket_parts(spark, sf):
    """The users of every event type as a list in numbered parts: few groups, each with a large share
    of all rows, none of them gathered."""
    ev = table(spark, sf, "events", "event_type", "user_id").select(
        F.col("event_type").alias("key"), F.col("user_id").cast("string").alias("value"))
    return ops.bracket_parts(ev, "key", "value", PART, out="value_list")
