"""End-to-end jobs, one per pipeline of the original collection.

Each job takes its input as a DataFrame of broker-shaped records (from
``sources.kafka_stream`` on a cluster, or ``sources.replay.read_slices``
offline), so the same code runs against a topic or a replay.  ``*_plan``
functions return the DataFrame to be written (testable without a broker);
``*_job`` functions attach the sink and start the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire import operators as ops
from tidewire.fixed import (
    ALLOWED_LATENESS,
    BOUNDED_STAMP_OFFSET,
    EARLY_FIRING_DELAY,
    EMPLOYEE_SEPARATOR,
    FILE_WINDOW,
    JOIN_WINDOW,
    KINESIS_PARTITION_KEY,
    ROUTE_TOPICS,
    SEQUENCE_LINE,
)
from tidewire.sinks.files import keyed_partition_write, window_dir_column, windowed_parquet
from tidewire.sinks.kafka import kafka_frame, kafka_sink, kafka_write
from tidewire.sinks.replay_safe import read_batches, replay_safe_sink
from tidewire.streaming.joins import bounded_side_counts, merged_cogroup, stream_lookup_join, stream_side_counts

COPY_MODES = ("kv", "pr", "once", "values")
LINE_SCHEMA = T.StructType([T.StructField("row", T.StringType(), False)])


# ------------------------------------------------------------------ P1, P2

def cogroup_plan(records: DataFrame, window: str = JOIN_WINDOW, lateness: str = ALLOWED_LATENESS) -> DataFrame:
    """P1, stream side: topic ``k,v`` records counted per key, value and
    window; long form, to be written in update mode."""
    kv = ops.decode_kv(records, keep=("timestamp",))
    stream = ops.parse_csv_kv(kv, line="value", keep=("timestamp",)).withColumnRenamed("timestamp", "ts")
    return stream_side_counts(stream, window=window, lateness=lateness)


def cogroup_bounded(bounded_lines: DataFrame, start_instant, window: str = JOIN_WINDOW,
                    stamp_offset: str = BOUNDED_STAMP_OFFSET) -> DataFrame:
    """P1, bounded side: ``k,v`` lines stamped with the start plus an offset,
    counted in the one window they fall into."""
    bounded = ops.assign_event_time(ops.parse_csv_kv(bounded_lines, line="value"),
                                    start_instant, stamp_offset, as_instant=True)
    return bounded_side_counts(bounded, window=window)


def cogroup_job(records: DataFrame, out: str, checkpoint: str, early_every: str = EARLY_FIRING_DELAY, **kw):
    """Start P1 with early panes every ``early_every``; ``cogroup_result``
    reads the co-group so far at any time."""
    from tidewire.streaming.runner import start_early
    return start_early(cogroup_plan(records, **kw), out, checkpoint, every=early_every)


def cogroup_result(spark: SparkSession, out: str, bounded_lines: DataFrame, start_instant,
                   window: str = JOIN_WINDOW, stamp_offset: str = BOUNDED_STAMP_OFFSET) -> DataFrame:
    """P1's co-group so far, in long form ``(window_start, window_end, key,
    side, value, n)``; ``operators.format_cogroup`` renders small groups as lines."""
    bounded = cogroup_bounded(bounded_lines, start_instant, window, stamp_offset)
    return merged_cogroup(read_batches(spark, out, schema=bounded.schema), bounded)


def lookup_plan(records: DataFrame, lookup_lines: DataFrame) -> DataFrame:
    """P2: each topic record looks its key up in the unique-key bounded
    table; one output line per record (``"null"`` on a miss).  Nothing runs
    here; each micro-batch checks and joins the lookup (for one too big to
    broadcast, pass ``operators.bucketed_lookup``'s table to the join)."""
    kv = ops.decode_kv(records, keep=("offset",))
    stream = ops.parse_csv_kv(kv, line="value", keep=("offset",))
    lookup = ops.unique_lookup(ops.parse_csv_kv(lookup_lines, line="value"))
    return stream_lookup_join(stream, lookup)


def lookup_job(records: DataFrame, lookup_lines: DataFrame, out: str, checkpoint: str, fmt: str = "parquet"):
    """Start P2: the joined lines through the append-mode file sink, whose
    commit log hides what a failed batch left."""
    return (lookup_plan(records, lookup_lines).writeStream.format(fmt).outputMode("append")
            .option("path", out).option("checkpointLocation", checkpoint).start())


# ------------------------------------------------------------------ P3-P6

def copy_plan(records: DataFrame, mode: str = "pr", topics=ROUTE_TOPICS,
              for_time: str | None = None, for_count: int | None = None) -> DataFrame:
    """Topic copy in one of the modes ``kv`` (key/value as is), ``pr``
    (NULL -> ``"null"`` and per-record topic by offset parity), ``once``
    (key/value for the replay-safe sink) or ``values`` (values only).

    ``for_time`` (of the records' own time, from the first one on) and
    ``for_count`` (first records by offset) bound a batch read; an endless read has
    no first and last record to count from, so it takes no bound."""
    if mode not in COPY_MODES:
        raise ValueError(f"mode must be one of {', '.join(COPY_MODES)}, not {mode!r}")
    if for_time is not None or for_count is not None:
        if records.isStreaming:
            raise ValueError("a bound needs a batch read of the topic")
        if for_time is not None:
            records = ops.bounded_by_time(records, "timestamp", for_time)
        if for_count is not None:
            records = ops.bounded_by_count(records, "offset", for_count)
    if mode == "values":
        return kafka_frame(ops.decode_kv(records), key=None)
    if mode == "pr":
        kv = ops.null_to_literal(ops.decode_kv(records, keep=("offset",)))
        return kafka_frame(ops.route_alternate(kv, "offset", topics), topic="topic")
    return kafka_frame(ops.decode_kv(records))


def copy_job(records: DataFrame, mode: str, servers: str, out_topic: str | None,
             checkpoint: str | None = None, out_path: str | None = None, **bound):
    """Start a topic copy (a batch read is copied at once; ``for_time`` and
    ``for_count`` bound it, as the routed copy's read is bounded).  ``once`` writes replay-safe files to ``out_path``
    (Spark's broker sink is at-least-once); ``pr`` routes per record, so it
    sets no topic option."""
    plan = copy_plan(records, mode, **bound)
    if not records.isStreaming:
        if mode == "once":
            raise ValueError("mode 'once' copies a stream")
        return kafka_write(plan, servers, None if mode == "pr" else out_topic)
    if mode == "once":
        if not out_path:
            raise ValueError("mode 'once' needs out_path")
        return replay_safe_sink(plan, out_path, checkpoint).start()
    return kafka_sink(plan, servers, None if mode == "pr" else out_topic, checkpoint)


# ------------------------------------------------------------------ P7, P8

def avro_read_plan(records: DataFrame, schema_json: str) -> DataFrame:
    """P7: registry-framed Avro values -> records (needs spark-avro)."""
    framed = ops.strip_registry_frame(records, "value", keep=("key", "offset"))
    return ops.decode_avro(framed, "payload", schema_json)


def kinesis_job(df: DataFrame, data: str, stream: str, partition_key=KINESIS_PARTITION_KEY,
                client_factory: str | None = None, region: str | None = None,
                options: dict | None = None) -> None:
    """P8: write byte payloads to a record stream (``options`` go to the
    client factory, e.g. an endpoint; never credentials)."""
    from tidewire.sinks.kinesis import kinesis_records, register
    register(df.sparkSession)
    w = (kinesis_records(df, data, partition_key).write.format("tidewire-kinesis")
         .mode("append").option("stream", stream).options(**(options or {})))
    if client_factory:
        w = w.option("client_factory", client_factory)
    if region:
        w = w.option("region", region)
    w.save()


# ------------------------------------------------------------------ P9

def parquet_plan(sequence: DataFrame, ts: str = "timestamp", window: str = FILE_WINDOW,
                 grain: str | None = "day") -> DataFrame:
    """P9: sequence numbers -> text line -> one-field record, tagged with
    their tumbling window and output directory."""
    from tidewire.functions.time import instant_to_ntz
    w = F.window(ts, window)
    lines = sequence.select(
        "value", instant_to_ntz(w.start).alias("window_start"),
        F.format_string(SEQUENCE_LINE, F.col("value")).alias("row"))
    rec = ops.to_record(lines, LINE_SCHEMA, keep=("value", "window_start"))
    return window_dir_column(rec, "window_start", grain)


def parquet_job(sequence: DataFrame, path: str, checkpoint: str, **kw):
    """Start P9 on a streaming sequence (e.g. ``sources.sequence(spark)``)."""
    return windowed_parquet(parquet_plan(sequence, **kw), path, checkpoint).start()


# ------------------------------------------------------------------ P11

def keyed_write_plan(raw: DataFrame, id_col: str = "id", raw_col: str = "raw") -> DataFrame:
    """P11 input: ``id -> name_country`` cut into an employee record."""
    return ops.parse_delimited(raw, raw_col, EMPLOYEE_SEPARATOR, ["emp_name", "emp_address"], keep=(id_col,))


def keyed_write_job(raw: DataFrame, path: str, spread: int = 1, **kw) -> None:
    """P11: the parsed records, written partitioned by their id."""
    keyed_partition_write(keyed_write_plan(raw, **kw), kw.get("id_col", "id"), path, spread=spread)
