"""A running side input: one value that a stream keeps up to date and others read.

The value is a table of versions, one small file each, made by one stream's micro-batches.  Another
stream reads the newest version when a micro-batch of its own is first run, and notes which one it was before
it writes; if that batch has to run again it sees the same version, so its output is the same.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.sinks.ledger import Files
from tidewire.sinks.replay_safe import batch_writer


def versions(spark: SparkSession, path: str) -> list[dict]:
    files = Files(spark, path)
    return [json.loads(files.read(f"versions/{n}")) for n in files.names("versions")]


def publish_max(stream: DataFrame, value: Column, path: str, checkpoint: str):
    """A ``DataStreamWriter`` (not started) that keeps the largest ``value`` (a whole number) of the
    stream so far: a partial maximum per task, one number to the driver, one version per batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        known = versions(spark, path)
        if any(v["query"] == query and v["batch"] >= batch_id for v in known):
            return
        new = batch.agg(F.max(value).alias("m")).first()["m"]
        best = max((v for v in (known[-1]["value"] if known else None, new) if v is not None), default=None)
        if not Files(spark, path).create(f"versions/{len(known):012d}.json", json.dumps(
                {"query": query, "batch": batch_id, "value": best})):
            raise RuntimeError(f"two queries publish to {path}")
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)


def with_side_input(stream: DataFrame, path: str, use: Callable[[DataFrame, int | None], DataFrame], out: str, checkpoint: str):
    """A ``DataStreamWriter`` (not started) that writes ``use(batch, value)`` of every micro-batch, replay
    safe; ``value`` is None before the first version."""
    store = batch_writer(out)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        files, pin = Files(spark, path), f"pins/{query}/{batch_id:012d}.json"
        if pin.rsplit("/", 1)[1] not in files.names(f"pins/{query}"):
            known = versions(spark, path)
            files.create(pin, json.dumps({"value": known[-1]["value"] if known else None}))
        store(use(batch, json.loads(files.read(pin))["value"]), batch_id)
        for old in files.names(f"pins/{query}")[:-2]:  # only the newest batch can run again
            files.delete(f"pins/{query}/{old}")
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
