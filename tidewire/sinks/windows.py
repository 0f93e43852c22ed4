"""Windowed files that are read only when their window is complete.

A micro-batch's rows go to their windows' directories; the batch's commit holds the watermark it
has reached.  A window is complete once the watermark has passed its end: from then on late rows
for it are dropped (and counted), so what a reader sees of it never changes.  Beside the files
every batch writes a manifest of the windows it has completed, one row per window with its
number of rows; it is a table that Spark computes, not a list on the driver.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.fixed import ALLOWED_LATENESS, FILE_WINDOW
from tidewire.functions.time import instant_to_ntz
from tidewire.sinks.files import window_dir_column
from tidewire.sinks.ledger import Files
from tidewire.streaming.panes import millis


def _commits(files: Files) -> list[dict]:
    return [json.loads(files.read(f"commits/{n}")) for n in files.names("commits")]


def complete_windows_writer(path: str, ts: str = "ts", window: str = FILE_WINDOW, lateness: str = ALLOWED_LATENESS,
                            grain: str | None = "day"):
    """The ``foreachBatch`` function; ``ts`` is an instant."""
    late = millis(lateness)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query:
            raise RuntimeError("the streaming query's id is not known in this batch")
        files = Files(spark, path)
        done = _commits(files)
        if any(c["query"] == query and c["batch"] >= batch_id for c in done):
            return  # committed, but the checkpoint was not
        latest = done[-1]["latest_ms"] if done else None
        w = F.window(ts, window)
        rows = batch.withColumns({"window_start": instant_to_ntz(w.start), "window_end": instant_to_ntz(w.end),
                                  "_end_ms": F.unix_millis(w.end)})
        in_time = rows if latest is None else rows.where(F.col("_end_ms") > latest - late)
        name = f"query_id={query}/batch_id={batch_id}"
        window_dir_column(in_time, "window_start", grain).drop("_end_ms").write.mode("overwrite").partitionBy(
            "window_dir").parquet(f"{path}/data/{name}")
        seen = rows.agg(F.max(F.unix_millis(ts)).alias("m"), F.count(F.lit(1)).alias("n"),
                        F.count_if(F.col("_end_ms") <= (latest if latest is not None else 0) - late).alias("late")).first()
        now = max((v for v in (latest, seen["m"]) if v is not None), default=None)
        commit = {"query": query, "batch": batch_id, "latest_ms": now, "complete_ms": None if now is None else now - late,
                  "late_rows": seen["late"] if latest is not None else 0}
        if now is not None:
            held = _held(spark, path, [*done, commit], batch.schema)
            fresh = held if latest is None else held.where(F.unix_millis(F.col("window_end").cast("timestamp")) > latest - late)
            _complete(fresh, now - late).groupBy("window_start", "window_end").agg(F.count(F.lit(1)).alias("rows")).write.mode(
                "overwrite").parquet(f"{path}/manifest/{name}")
        if not files.create(f"commits/{len(done):012d}.json", json.dumps(commit)):
            raise RuntimeError(f"two queries write the windows of {path}")
    return write


_BOUNDS = [T.StructField("window_start", T.TimestampNTZType()), T.StructField("window_end", T.TimestampNTZType())]


def _held(spark: SparkSession, path: str, commits: list[dict], schema) -> DataFrame:
    full = T.StructType([*schema.fields, *_BOUNDS])
    if not commits:
        return spark.createDataFrame([], full)
    found = [f"{path}/data/query_id={c['query']}/batch_id={c['batch']}" for c in commits]
    return spark.read.option("basePath", f"{path}/data").schema(full).parquet(*found).select(*full.names)


def _complete(rows: DataFrame, complete_ms: int) -> DataFrame:
    return rows.where(F.unix_millis(F.col("window_end").cast("timestamp")) <= complete_ms)


def read_complete_windows(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of all complete windows (``schema`` and ``window_start``, ``window_end``); open windows and
    batches that were not committed are invisible.  A filter on the files, no join."""
    commits = _commits(Files(spark, path))
    held = _held(spark, path, commits, schema)
    known = [c["complete_ms"] for c in commits if c["complete_ms"] is not None]
    return _complete(held, known[-1]) if known else held.where("false")


def complete_windows(spark: SparkSession, path: str) -> DataFrame:
    """The manifest: ``(window_start, window_end, rows)`` of every complete window."""
    found = [f"{path}/manifest/query_id={c['query']}/batch_id={c['batch']}" for c in _commits(Files(spark, path))
             if c["latest_ms"] is not None]
    kind = T.StructType([*_BOUNDS, T.StructField("rows", T.LongType())])
    if not found:
        return spark.createDataFrame([], kind)
    return spark.read.option("basePath", f"{path}/manifest").schema(kind).parquet(*found).select(*kind.names)


def complete_windows_sink(stream: DataFrame, path: str, checkpoint: str, **kw):
    """A ``DataStreamWriter`` (not started)."""
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(complete_windows_writer(path, **kw))
