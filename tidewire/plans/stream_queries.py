"""Structured Streaming queries, replayed from slices of the tables.

``events`` is turned into broker-shaped rows and written once, by all tasks, one
directory per time slice; each query is run once per slice, resuming from its
checkpoint, writes through a real sink into the shared checkpoint directory, and
returns the read-back output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire import operators as ops
from tidewire.plans.inputs import (
    ALLOWED_LATENESS,
    BOUNDED_STAMP_OFFSET,
    FILE_WINDOW,
    JOIN_WINDOW,
    PIPELINE_START,
    ROUTE_TOPICS,
    customer_lines,
    event_broker_records,
)
from tidewire.plans.batch_queries import _LOOKUP_SQL, _ROUTE_SQL, _cogroup_sql, supplier_lookup
from tidewire.fixed import SEQUENCE_LINE
from tidewire.plans.registry import query
from tidewire.session import scratch_path
from tidewire.sinks.files import window_dir_column, windowed_parquet
from tidewire.sinks.replay_safe import latest_count, read_batches, replay_safe_sink
from tidewire.sources.replay import BROKER_SCHEMA, read_slices, time_slices, write_slices
from tidewire.streaming import run_available, run_early, run_final, stream_window_counts

REPLAY_SLICES = 4
#: A start after the last event: everything in the topic is a backlog.
BACKLOG_START = "2024-03-01 00:00:00"

#: Records of every seventh event arrive this much after their time, which is less
#: than the allowed lateness: none of them may be lost.
DELAY, DELAYED = "10 seconds", 7


def event_slices(spark, sf: str, redeliver_first: bool = False) -> tuple[str, int]:
    """``(path, slices)`` of the broker-shaped ``events`` in slices of their
    arrival.  ``redeliver_first`` appends slice 0 again at the end, as a late
    re-delivery."""
    path = scratch_path(spark, "replay-events")
    records = event_broker_records(spark, sf)
    late = F.col("offset") % DELAYED == 0
    arrival = F.when(late, F.col("timestamp") + F.expr(f"INTERVAL {DELAY}")).otherwise(F.col("timestamp"))
    sliced = time_slices(records.withColumn("arrival", arrival), "arrival", REPLAY_SLICES).drop("arrival")
    write_slices(sliced, path)
    if not redeliver_first:
        return path, REPLAY_SLICES
    again = spark.read.schema(BROKER_SCHEMA).parquet(f"{path}/slice=0")
    write_slices(again.withColumn("slice", F.lit(REPLAY_SLICES)), path)
    return path, REPLAY_SLICES + 1


def replayed(spark, sf: str, build, run, redeliver_first: bool = False) -> None:
    """Run ``run(build(records))`` once per slice of the replayed topic."""
    path, slices = event_slices(spark, sf, redeliver_first)
    for i in range(slices):
        run(build(read_slices(spark, path, i)))


def event_pairs(records: DataFrame) -> DataFrame:
    """``(offset, ts, key, value)`` parsed from the replayed topic; ``ts`` is
    the record timestamp (an instant, usable for watermarks)."""
    kv = ops.decode_kv(records, keep=("offset", "timestamp"))
    return ops.parse_csv_kv(kv, line="value", keep=("offset", "timestamp")) \
        .withColumnRenamed("timestamp", "ts")


def _run_to_files(spark, sf, build, name: str, partition_by: str | None = None,
                  redeliver_first: bool = False) -> DataFrame:
    """On-time output through the append-mode file sink, read back."""
    base, schema = scratch_path(spark, name), []

    def run(df):
        schema[:] = [df.schema]
        run_final(df, f"{base}/data", f"{base}/checkpoint", partition_by=partition_by)
    replayed(spark, sf, build, run, redeliver_first)
    return spark.read.schema(schema[0]).parquet(f"{base}/data")


def _run_update(spark, sf, build, name: str) -> str:
    """Update-mode output through the replay-safe sink; returns its path."""
    base = scratch_path(spark, name)
    replayed(spark, sf, build, lambda df: run_early(df, f"{base}/data", f"{base}/checkpoint"))
    return f"{base}/data"


def _window_counts(records: DataFrame) -> DataFrame:
    return stream_window_counts(event_pairs(records), "ts", JOIN_WINDOW, ("key",), ALLOWED_LATENESS)


# --------------------------------------------------------------- windows

_APPEND_SQL = f"""
with g as (
  select time_bucket(interval '{JOIN_WINDOW}', ts) as window_start,
         time_bucket(interval '{JOIN_WINDOW}', ts) + interval '{JOIN_WINDOW}' as window_end,
         cast(user_id as varchar) as key, count(*) as n
  from events group by 1, 2, 3)
select * from g
where window_end <= (select max(ts) from events) - interval '{ALLOWED_LATENESS}'
"""


@query("stream_window_append", _APPEND_SQL)
def stream_window_append(spark, sf):
    """On-time panes only: a window is emitted once the watermark passes
    its end; windows still open at the end of the input are not.  Records that
    arrive late by less than the allowed lateness are counted."""
    return _run_to_files(spark, sf, _window_counts, "stream-window-append")


@query("late_redelivery_stream", _APPEND_SQL)
def late_redelivery_stream(spark, sf):
    """Same stream with the first slice delivered again at the end: every
    re-delivered row is behind the watermark, dropped, and not counted
    twice, so the output equals the on-time result."""
    return _run_to_files(spark, sf, _window_counts, "stream-late-redelivery", redeliver_first=True)


@query("stream_early_panes", f"""
select time_bucket(interval '{JOIN_WINDOW}', ts) as window_start,
       time_bucket(interval '{JOIN_WINDOW}', ts) + interval '{JOIN_WINDOW}' as window_end,
       cast(user_id as varchar) as key, count(*) as n
from events group by all
""")
def stream_early_panes(spark, sf):
    """Update mode: every micro-batch re-emits the full current count of the
    groups it touched (accumulating panes); the last pane per group is
    the complete result, including windows that are still open."""
    panes = read_batches(spark, _run_update(spark, sf, _window_counts, "stream-early-panes"))
    return latest_count(panes, ["window_start", "window_end", "key"])


# --------------------------------------------------------------- joins

def _cogroup(spark, sf, start: str, name: str) -> DataFrame:
    """P1 on the replayed topic and the customers as the bounded side."""
    from tidewire.plans.jobs import cogroup_plan, cogroup_result
    out = _run_update(spark, sf, lambda r: cogroup_plan(r, JOIN_WINDOW, ALLOWED_LATENESS), name)
    lines = customer_lines(spark, sf).withColumnRenamed("line", "value")
    return cogroup_result(spark, out, lines, start, JOIN_WINDOW, BOUNDED_STAMP_OFFSET)


@query("stream_cogroup_final", _cogroup_sql(JOIN_WINDOW))
def stream_cogroup_final(spark, sf):
    """The co-group job on the replayed topic and the bounded customers,
    stamped with one event time; last panes, rendered as co-group lines."""
    return ops.format_cogroup(_cogroup(spark, sf, PIPELINE_START, "stream-cogroup"), windowed=True)


@query("stream_cogroup_backlog", f"""
with u as (
  select cast(user_id as varchar) as key, event_type as value, ts, 0 as side from events
  union all
  select cast(c_custkey as varchar), c_mktsegment,
         timestamp '{BACKLOG_START}' + interval '{BOUNDED_STAMP_OFFSET}', 1 from customer)
select time_bucket(interval '{JOIN_WINDOW}', ts) as window_start,
       time_bucket(interval '{JOIN_WINDOW}', ts) + interval '{JOIN_WINDOW}' as window_end,
       key, side, value, count(*) as n
from u group by 1, 2, 3, 4, 5
""")
def stream_cogroup_backlog(spark, sf):
    """The same job started after the last event was written, the normal first
    start on a topic's earliest offset: no record is late against the bounded
    side's stamp.  Long form."""
    return _cogroup(spark, sf, BACKLOG_START, "stream-backlog")


@query("stream_lookup_join", _LOOKUP_SQL)
def stream_lookup_join(spark, sf):
    """Stream-static left lookup of every record's user among the suppliers."""
    lookup = supplier_lookup(spark, sf)

    def build(records):
        stream = event_pairs(records).withColumnRenamed("offset", "event_id")
        return ops.lookup_join(stream, lookup, "key", "value").select(
            "event_id", "key", "value", "lookup_value", "line")
    return _run_to_files(spark, sf, build, "stream-lookup")


# --------------------------------------------------------------- copies, sinks

@query("copy_routed", _ROUTE_SQL)
def copy_routed(spark, sf):
    """Topic copy in routing mode: NULL key/value -> ``"null"``, alternate
    topics by offset parity, per-topic output directories."""
    def build(records):
        kv = ops.null_to_literal(ops.decode_kv(records, keep=("offset",)), ("key", "value"))
        return ops.route_alternate(kv, "offset", ROUTE_TOPICS).select("offset", "topic", "key", "value")
    return _run_to_files(spark, sf, build, "copy-routed", partition_by="topic").select("offset", "topic", "key", "value")


@query("copy_kv_stream", """
select cast(user_id as varchar) as key, cast(user_id as varchar) || ',' || event_type as value
from events
""")
def copy_kv_stream(spark, sf):
    """Topic copy, mode ``kv`` (``plans.jobs.copy_plan``): key and value as
    they are; written to files here instead of a topic."""
    from tidewire.plans.jobs import copy_plan
    return _run_to_files(spark, sf, lambda r: copy_plan(r, "kv"), "copy-kv")


@query("copy_values_stream", """
select cast(user_id as varchar) || ',' || event_type as value from events
""")
def copy_values_stream(spark, sf):
    """Topic copy, mode ``values``: the value only, no key."""
    from tidewire.plans.jobs import copy_plan
    return _run_to_files(spark, sf, lambda r: copy_plan(r, "values"), "copy-values")


@query("replay_safe_write", """
select event_id as "offset", cast(user_id as varchar) as key,
       cast(user_id as varchar) || ',' || event_type as value
from events
""")
def replay_safe_write(spark, sf):
    """Exactly-once copy re-aimed: every micro-batch overwrites its own
    directory, so a re-run batch replaces its output."""
    base = scratch_path(spark, "replay-safe")
    replayed(spark, sf, lambda r: ops.decode_kv(r, keep=("offset",)),
             lambda df: run_available(replay_safe_sink(df, f"{base}/data", f"{base}/checkpoint")))
    return read_batches(spark, f"{base}/data").select("offset", "key", "value")


@query("windowed_parquet_roundtrip", f"""
select event_id as value, replace('{SEQUENCE_LINE}', '%s', event_id::varchar) as "row",
       time_bucket(interval '{FILE_WINDOW}', ts) as window_start,
       time_bucket(interval '{FILE_WINDOW}', ts) + interval '{FILE_WINDOW}' as window_end
from events
""")
def windowed_parquet_roundtrip(spark, sf):
    """Sequence -> 5 s windows -> text line -> one-field record -> Parquet
    files grouped by window (directories per day), read back."""
    from pyspark.sql import types as T

    from tidewire.functions.time import instant_to_ntz
    schema = T.StructType([T.StructField("row", T.StringType(), False)])
    base, out = scratch_path(spark, "windowed-parquet"), []

    def build(records):
        w = F.window("timestamp", FILE_WINDOW)
        lines = records.select(F.col("offset").alias("value"),
                               instant_to_ntz(w.start).alias("window_start"),
                               instant_to_ntz(w.end).alias("window_end"),
                               F.format_string(SEQUENCE_LINE, F.col("offset")).alias("row"))
        rows = ops.to_record(lines, schema, keep=("value", "window_start", "window_end"))
        return window_dir_column(rows, "window_start", grain="day")

    def run(df):
        out[:] = [df.schema]
        run_available(windowed_parquet(df, f"{base}/data", f"{base}/checkpoint"))
    replayed(spark, sf, build, run)
    back = spark.read.schema(out[0]).parquet(f"{base}/data")
    return back.select("value", "record.row", "window_start", "window_end")

