"""Copies whose progress outlives their checkpoint: sink groups, recorded offsets, bounded drains.

``events`` is replayed as a topic of three partitions in slices of rising offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.plans.inputs import event_broker_records
from tidewire.plans.registry import query
from tidewire.session import scratch_path
from tidewire.sinks.ledger import drain, ledger_sink, read_group
from tidewire.sinks.replay_safe import replay_safe_sink
from tidewire.sources.replay import BROKER_SCHEMA, read_slices, write_slices
from tidewire.streaming import run_available
from tidewire.streaming.offsets import OffsetRecorder, behind, observed_offsets, recorded_offsets

PARTITIONS, SLICES, GROUP = 3, 4, "copy"
#: Records of the bounded drain, and of the one that goes on behind it.
DRAIN_COUNT, DRAIN_MORE = 4321, 2000

_COPY_COLS = ["topic", "partition", "offset", "key", "value"]
_COPY_SCHEMA = T.StructType([BROKER_SCHEMA[c] for c in _COPY_COLS])


def partitioned_topic(spark, sf) -> str:
    """``events`` as a topic of ``PARTITIONS`` partitions, in slices of equal offset ranges."""
    path = scratch_path(spark, "replay-topic")
    records = event_broker_records(spark, sf).withColumn("partition", (F.col("offset") % PARTITIONS).cast("int"))
    bounds = records.agg(F.struct(F.min("offset").alias("lo"), F.max("offset").alias("hi")).alias("b")).scalar()
    step = F.call_function("div", bounds.getField("hi") - bounds.getField("lo"), F.lit(SLICES).cast("bigint")) + 1
    sliced = F.call_function("div", F.col("offset") - bounds.getField("lo"), step).cast("int")
    write_slices(records.withColumn("slice", sliced), path)
    return path


def _copied(df: DataFrame) -> DataFrame:
    return df.select("topic", "partition", "offset", F.decode("key", "UTF-8").alias("key"),
                     F.decode("value", "UTF-8").alias("value"))


_COPY_SQL = f"""
select 'input' as topic, (event_id % {PARTITIONS})::integer as "partition", event_id as "offset",
       cast(user_id as varchar) as key, cast(user_id as varchar) || ',' || event_type as value
from events
"""


@query("ledger_copy", _COPY_SQL)
def ledger_copy(spark, sf) -> DataFrame:
    """A sink group that outlives its checkpoint: one query copies half the topic; another, with a
    new checkpoint, reads the whole topic again.  Every offset lands once."""
    topic, base = partitioned_topic(spark, sf), scratch_path(spark, "ledger-copy")
    for k, upto in enumerate((SLICES // 2 - 1, SLICES - 1)):
        run_available(ledger_sink(read_slices(spark, topic, upto).select(*_COPY_COLS), base, GROUP, f"{base}/checkpoint-{k}"))
    return _copied(read_group(spark, base, GROUP, _COPY_SCHEMA))


@query("recorded_offsets", f"""
select 'input' as topic, (event_id % {PARTITIONS})::integer as "partition", max(event_id) + 1 as next_offset
from events group by 1, 2
""")
def recorded_offsets_q(spark, sf) -> DataFrame:
    """Offsets committed after the checkpoint: a listener records the end offsets of every batch."""
    topic, base = partitioned_topic(spark, sf), scratch_path(spark, "recorded-offsets")
    for i in range(SLICES):
        copy_from_record(spark, read_slices(spark, topic, i), base, f"{base}/checkpoint")
    ends = recorded_offsets(spark, base, GROUP)
    return spark.createDataFrame([(t, int(p), o) for t, parts in ends.items() for p, o in parts.items()],
                                 "topic string, partition int, next_offset long")


def copy_from_record(spark, records: DataFrame, base: str, checkpoint: str) -> None:
    """Copy what lies behind the group's recorded offsets and record how far the copy came."""
    name = f"copy-{abs(hash(checkpoint)) % 10**9}"
    listener = OffsetRecorder(spark, base, GROUP, name)
    spark.streams.addListener(listener)
    try:
        seen = observed_offsets(records, {"input": PARTITIONS}).select(*_COPY_COLS)
        # not Spark's file sink: its log would take a new checkpoint's batch 0 for the old one's
        q = run_available(replay_safe_sink(seen, f"{base}/data", checkpoint).queryName(name))
        listener.caught_up(q)
    finally:
        spark.streams.removeListener(listener)


def resume_from_record(spark, records: DataFrame, base: str, checkpoint: str) -> None:
    """The same with a new checkpoint: starts behind the group's recorded offsets."""
    copy_from_record(spark, behind(records, recorded_offsets(spark, base, GROUP)), base, checkpoint)


@query("drain_by_count", f"""
select 'input' as topic, (event_id % {PARTITIONS})::integer as "partition", event_id as "offset",
       cast(user_id as varchar) as key, cast(user_id as varchar) || ',' || event_type as value
from events order by event_id limit {DRAIN_COUNT + DRAIN_MORE}
""")
def drain_by_count(spark, sf) -> DataFrame:
    """A bounded read of an endless topic: stops inside a batch, at a record count; the next drain, with a new
    checkpoint, goes on right behind the cut."""
    topic, base = partitioned_topic(spark, sf), scratch_path(spark, "drain")
    for k, n in enumerate((DRAIN_COUNT, DRAIN_MORE)):
        drain(read_slices(spark, topic, SLICES - 1).select(*_COPY_COLS), base, GROUP, f"{base}/checkpoint-{k}", for_count=n)
    return _copied(read_group(spark, base, GROUP, _COPY_SCHEMA))
