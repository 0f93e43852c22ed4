"""Broker sinks: record framing and writer builders.

Spark's Kafka sink reads ``key``, ``value`` and (optionally) ``topic``
columns.  When a ``topic`` column decides the destination per record, no
``topic`` option may be set: Spark's option overrides the column.
The Kafka connector package must be on the classpath to *run* these.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kafka_frame(df: DataFrame, key: str | None = "key", value: str = "value",
                topic: str | None = None) -> DataFrame:
    """Select the sink's columns as text: ``[topic,] [key,] value``."""
    cols = []
    if topic:
        cols.append(F.col(topic).cast("string").alias("topic"))
    if key:
        cols.append(F.col(key).cast("string").alias("key"))
    cols.append(F.col(value).cast("string").alias("value"))
    return df.select(*cols)


def sink_options(servers: str, topic: str | None = None, extra: dict | None = None) -> dict:
    """Options of the Kafka sink; ``topic=None`` keeps per-record routing."""
    if not servers:
        raise ValueError("bootstrap servers are required")
    opts = {"kafka.bootstrap.servers": servers}
    if topic:
        opts["topic"] = topic
    opts.update(extra or {})
    return opts


def kafka_sink(df: DataFrame, servers: str, topic: str | None, checkpoint: str,
               extra: dict | None = None):
    """Start a streaming write (``df`` already framed with ``kafka_frame``).

    At-least-once: Spark's Kafka sink may repeat a micro-batch after a
    failure.  For an exactly-once result use ``replay_safe_sink``.
    """
    if topic is None and "topic" not in df.columns:
        raise ValueError("either a topic or a 'topic' column is required")
    return (df.writeStream.format("kafka").options(**sink_options(servers, topic, extra))
              .option("checkpointLocation", checkpoint).start())


def kafka_write(df: DataFrame, servers: str, topic: str | None = None, extra: dict | None = None) -> None:
    """Batch write of a framed DataFrame."""
    df.write.format("kafka").options(**sink_options(servers, topic, extra)).save()


def topic_sink(df: DataFrame, servers: str, checkpoint: str, topic: str = "topic",
               key: str | None = "key", value: str = "value", extra: dict | None = None):
    """Streaming write where each record names its own topic (the ``topic``
    column); no ``topic`` option is set, since it would override the column."""
    return kafka_sink(kafka_frame(df, key, value, topic), servers, None, checkpoint, extra)
