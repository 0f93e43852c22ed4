"""Broker sources: option builders and readers.

The Kafka connector package must be on the classpath to run these; the
option building is plain Python and unit-tested.  Spark keeps consumed
offsets in the query checkpoint and does not commit them to the broker,
so a consumer group id only matters for broker-side quotas and ACLs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def source_options(servers: str, topics: str | list[str], group_id: str | None = None,
                   read_committed: bool = False, starting: str | None = None,
                   ending_timestamp_ms: int | None = None, extra: dict | None = None) -> dict:
    """Options for ``format('kafka')``.

    * ``read_committed``: only records of committed transactions.
    * ``ending_timestamp_ms`` (batch reads): stop at records newer than
      this time, a reproducible way to bound a topic read.
    """
    if not servers:
        raise ValueError("bootstrap servers are required")
    if isinstance(topics, (list, tuple)):
        topics = ",".join(topics)
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topics}
    if group_id:
        opts["kafka.group.id"] = group_id
    if read_committed:
        opts["kafka.isolation.level"] = "read_committed"
    if starting:
        opts["startingOffsets"] = starting
    if ending_timestamp_ms is not None:
        opts["endingTimestamp"] = str(ending_timestamp_ms)
    opts.update(extra or {})
    return opts


def kafka_stream(spark: SparkSession, servers: str, topics, **kw) -> DataFrame:
    """Unbounded read: rows ``key, value (BINARY), topic, partition, offset,
    timestamp, timestampType``; shape with ``operators.decode_kv``."""
    opts = source_options(servers, topics, **kw)
    if "endingTimestamp" in opts:
        raise ValueError("a streaming read has no end; bound it with kafka_batch")
    return spark.readStream.format("kafka").options(**opts).load()


def kafka_batch(spark: SparkSession, servers: str, topics, **kw) -> DataFrame:
    """Bounded read of a topic (offsets or an ending timestamp)."""
    return spark.read.format("kafka").options(**source_options(servers, topics, **kw)).load()
