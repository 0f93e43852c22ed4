"""Inputs of the registered queries, all read from (or derived by Spark
from) the given tables, with only the needed columns selected so that the
Parquet scan prunes the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.sources.replay import as_broker_records

from tidewire.fixed import (  # noqa: F401  (re-exported for the query modules)
    ALLOWED_LATENESS,
    BOUNDED_STAMP_OFFSET,
    FILE_WINDOW,
    JOIN_WINDOW,
    KINESIS_PARTITION_KEY,
    ROUTE_TOPICS,
    USER_VALUE,
)

# "Pipeline start" used to stamp the bounded side in the registered queries
# (our parameter: start + 30 s lands on 2024-01-02 00:00:00, inside the
# events' time range).
PIPELINE_START = "2024-01-01 23:59:30"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """A given table, projected to ``cols`` (pruned at the scan).  Read anew
    every time, so rows added meanwhile are seen."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def event_broker_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as topic records: key = user id text, value =
    ``user_id,event_type``, offset = event id, timestamp = event time."""
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    return as_broker_records(
        ev, key=F.col("user_id"),
        value=F.concat_ws(",", F.col("user_id").cast("string"), F.col("event_type")),
        offset=F.col("event_id"), ts=F.col("ts"))


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, ts, line)`` with ``line = user_id,event_type``."""
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    return ev.select("event_id", "ts",
                     F.concat_ws(",", F.col("user_id").cast("string"), F.col("event_type")).alias("line"))


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bounded CSV side: ``c_custkey,c_mktsegment`` per customer."""
    c = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    return c.select(F.concat_ws(",", F.col("c_custkey").cast("string"), F.col("c_mktsegment")).alias("line"))


def supplier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup side of the lookup join: every supplier as ``s_suppkey,s_name``.
    Suppliers have fewer keys than users, so there are hits and misses."""
    s = table(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    return s.select(F.concat_ws(",", F.col("s_suppkey").cast("string"), F.col("s_name")).alias("line"))
