"""Write byte payloads to a Kinesis-style record stream.

Apache Spark ships no Kinesis sink, so this is a Python data source
writer: every task sends its own partition in batches through a client
that is created *inside the task* from a factory named in the options
(``"module:function"``), so no credentials or clients travel with the
plan.  Credentials come from the executor's environment, never options.

Frame first with ``kinesis_records`` (``partition_key``, ``data``), then
``df.write.format("tidewire-kinesis").option("stream", ...).save()``.

Delivery is at-least-once: a task that fails or is re-run after a lost
executor sends its whole partition again, and record streams have no
idempotent put.  Consumers that need exactly-once must de-duplicate (for
example on a payload id).  Records that the service rejects (throttling) are sent
again, they alone, for a bounded time; after that the task fails, so nothing is
silently dropped.
"""

from __future__ import annotations

import importlib
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)

from tidewire.fixed import KINESIS_PARTITION_KEY

# limits of the service: records and bytes (data and keys) a call, bytes a record
MAX_RECORDS_PER_CALL = 500
MAX_CALL_BYTES = 5 * 1024 * 1024
MAX_RECORD_BYTES = 1024 * 1024
#: Seconds for which rejected records of a call are sent again.
RETRY_SECONDS = 60.0


def kinesis_records(df: DataFrame, data: str = "data",
                    partition_key: str | Column = KINESIS_PARTITION_KEY) -> DataFrame:
    """Frame rows as ``(partition_key STRING, data BINARY)``.

    A constant key (the original's choice) sends everything to one shard;
    pass a column to spread records over shards.
    """
    pk = partition_key if isinstance(partition_key, Column) else F.lit(partition_key)
    return df.select(pk.cast("string").alias("partition_key"), F.col(data).cast("binary").alias("data"))


def _boto3_factory(options: dict):
    import boto3  # optional dependency, only needed on a real cluster
    return boto3.client("kinesis", region_name=options.get("region"))


def _load_factory(spec: str | None):
    if not spec:
        return _boto3_factory
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)


@dataclass
class SentCount(WriterCommitMessage):
    records: int
    calls: int


def _throttled_call(client, stream: str, records: list[dict], deadline: float) -> int:
    """Send one call's records; those the service rejects, and only those,
    are sent again with growing pauses until ``deadline``.  Returns the calls made."""
    calls, pause = 0, 0.1
    while records:
        answer = client.put_records(StreamName=stream, Records=records) or {}
        calls += 1
        if not answer.get("FailedRecordCount"):
            break
        results = answer.get("Records") or []
        if len(results) != len(records):
            raise RuntimeError(f"stream {stream} rejected records without saying which")
        records = [r for r, a in zip(records, results) if a.get("ErrorCode")]
        if time.monotonic() + pause > deadline:
            codes = sorted({a["ErrorCode"] for a in results if a.get("ErrorCode")})
            raise RuntimeError(f"{len(records)} records were rejected by stream {stream} until the time was up: {codes}")
        time.sleep(pause)
        pause = min(5.0, 2 * pause)
    return calls


def _send_partition(options: dict, batches) -> SentCount:
    """Send record batches in calls that keep to the service's limits."""
    stream = options["stream"]
    client = _load_factory(options.get("client_factory"))(options)
    retry = float(options.get("retry_seconds", RETRY_SECONDS))
    call, size, records, calls = [], 0, 0, 0
    for b in batches:
        keys, data = b.column("partition_key").to_pylist(), b.column("data").to_pylist()
        for key, payload in zip(keys, data):
            payload = payload or b""
            weight = len(payload) + len((key or "").encode())
            if weight > MAX_RECORD_BYTES:
                raise ValueError(f"a record of {weight} bytes is over the service's limit of {MAX_RECORD_BYTES}")
            if call and (len(call) >= MAX_RECORDS_PER_CALL or size + weight > MAX_CALL_BYTES):
                calls += _throttled_call(client, stream, call, time.monotonic() + retry)
                call, size = [], 0
            call.append({"Data": payload, "PartitionKey": key})
            size += weight
            records += 1
    if call:
        calls += _throttled_call(client, stream, call, time.monotonic() + retry)
    return SentCount(records, calls)


class _KinesisWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.options = dict(options)
        if "stream" not in self.options:
            raise ValueError("option 'stream' is required")

    def write(self, iterator):
        return _send_partition(self.options, iterator)

    def commit(self, messages):
        self.sent = sum(m.records for m in messages if m is not None)

    def abort(self, messages):
        pass


class _KinesisStreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, options):
        self.options = dict(options)

    def write(self, iterator):
        return _send_partition(self.options, iterator)

    def commit(self, messages, batchId):
        pass

    def abort(self, messages, batchId):
        pass


class KinesisSink(DataSource):
    """``format("tidewire-kinesis")``; options ``stream``, ``region``,
    ``client_factory``.  Input columns: ``partition_key``, ``data``."""

    @classmethod
    def name(cls):
        return "tidewire-kinesis"

    def writer(self, schema, overwrite):
        return _KinesisWriter(self.options)

    def streamWriter(self, schema, overwrite):
        return _KinesisStreamWriter(self.options)


def register(spark) -> None:
    from tidewire.session import ship_package
    ship_package(spark)
    spark.dataSource.register(KinesisSink)
