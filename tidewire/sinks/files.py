"""File sinks: windowed Parquet, key-partitioned writes, per-topic files."""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyed_partition_write(df: DataFrame, key: str, path: str, fmt: str = "parquet", mode: str = "overwrite",
                          spread: int = 1, max_records_per_file: int | None = None) -> None:
    """Hash-partition rows by ``key``, then write: all rows of a key land in
    the same task's output files.  The number of writers follows the data:
    Spark starts from its shuffle partitions and joins small ones at run time.

    A key can be too big for one task.  ``spread=s`` hashes on ``(key,
    pmod(hash(row), s))`` instead, so a key's rows go to at most ``s``
    tasks (the co-location guarantee becomes "at most ``s`` writers per
    key").  ``max_records_per_file`` caps file size inside a task.

    Spark's commit protocol replaces the original's lock directory: task
    output is committed once, a lost executor's attempt is discarded.
    """
    if spread > 1:
        salt = F.pmod(F.hash(*[F.col(c) for c in df.columns]), F.lit(spread))
        parted = df.repartition(F.col(key), salt)
    else:
        parted = df.repartition(F.col(key))
    w = parted.write.mode(mode).format(fmt)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(path)


#: Buckets that the keys of one writer are dealt to on average, and the share of a writer's mean
#: load from which a key is hot.
BUCKETS_PER_WRITER, HOT_SHARE = 64, 0.25


def writer_plan(df: DataFrame, key: str, writers: int) -> tuple[list[int], dict]:
    """``(writer of each bucket, {hot key: (first slot, slots)})`` from the key histogram.

    Keys with more than ``HOT_SHARE`` of a writer's mean load are hot: at most
    ``writers / HOT_SHARE`` of them, each split into slots of at most that share.  All other keys
    fall into buckets by hash, whose counts are added up in Spark.  Slots and buckets, a number bounded by
    ``writers``, are packed largest first into the emptiest writer."""
    counts = df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(1, math.ceil(HOT_SHARE * total / writers))
    hot = [(r["k"], r["n"]) for r in counts.where(F.col("n") > least).collect()]
    buckets = writers * BUCKETS_PER_WRITER
    load = [0] * buckets
    for r in counts.where(F.col("n") <= least).groupBy(F.pmod(F.xxhash64("k"), F.lit(buckets)).alias("b")).agg(
            F.sum("n").alias("n")).collect():
        load[r["b"]] = r["n"]
    pieces = [(n, (False, None, b)) for b, n in enumerate(load) if n]
    slots = {}
    for k, n in hot:
        slots[k] = [0] * -(-n // least)
        pieces += [(n / len(slots[k]), (True, k, i)) for i in range(len(slots[k]))]
    heap = [(0, w) for w in range(writers)]
    writer_of = [0] * buckets
    for n, (is_key, k, i) in sorted(pieces, key=lambda p: -p[0]):
        held, w = heapq.heappop(heap)
        heapq.heappush(heap, (held + n, w))
        (slots[k] if is_key else writer_of)[i] = w
    return writer_of, slots


def histogram_write(df: DataFrame, key: str, path: str, writers: int, fmt: str = "parquet", mode: str = "overwrite",
                    max_records_per_file: int | None = None) -> None:
    """Write partitioned by ``key`` with ``writers`` tasks of about equal size: a hot key is split by
    its share of the rows, small keys are packed together, every other key has one writer.

    One counting pass (partial counts per key) and one shuffle of the rows, straight to the
    planned writers.  The plan is an array of ``writers * BUCKETS_PER_WRITER`` numbers and a map of
    the hot keys, both bounded by ``writers``."""
    writer_of, slots = writer_plan(df, key, writers)
    bucket = F.pmod(F.xxhash64(key), F.lit(len(writer_of)))
    target = F.array(*[F.lit(w) for w in writer_of])[bucket.cast("int")]
    if slots:
        salt = F.xxhash64(*[F.col(c) for c in df.columns], F.lit(1))
        named = [(k, w) for k, w in slots.items() if k is not None]
        of_key = F.lit(None).cast("array<int>")
        if named:
            kind = df.schema[key].dataType
            of_key = F.create_map(*[x for k, w in named for x in (F.lit(k).cast(kind), F.array(*map(F.lit, w)))])[F.col(key)]
        if None in slots:
            of_key = F.when(F.col(key).isNull(), F.array(*map(F.lit, slots[None]))).otherwise(of_key)
        target = F.coalesce(F.get(of_key, F.pmod(salt, F.size(of_key)).cast("int")), target)
    w = df.repartitionById(writers, target).write.mode(mode).format(fmt)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(path)


def topic_files(df: DataFrame, path: str, topic: str = "topic", mode: str = "overwrite") -> None:
    """Per-record destinations as directories: ``<path>/topic=<t>/``."""
    df.write.mode(mode).partitionBy(topic).parquet(path)


def window_dir_column(df: DataFrame, window_start: str = "window_start",
                      grain: str | None = "day", out: str = "window_dir") -> DataFrame:
    """Directory column for windowed output.

    ``grain=None`` makes one directory per window (the original layout);
    ``'day'``/``'hour'`` group small windows into one directory each, which
    keeps the file count proportional to data volume, not window count.
    """
    if grain is None:
        return df.withColumn(out, F.date_format(window_start, "yyyy-MM-dd'T'HH-mm-ss"))
    fmt = {"day": "yyyy-MM-dd", "hour": "yyyy-MM-dd'T'HH"}[grain]
    return df.withColumn(out, F.date_format(window_start, fmt))


def windowed_parquet(df: DataFrame, path: str, checkpoint: str | None = None,
                     shards: int = 0, dir_col: str = "window_dir"):
    """Write windowed records as Parquet, one directory per ``dir_col``.

    ``shards=0`` leaves the file count to Spark (one file per task and
    directory); ``shards=n`` repartitions to ``n`` tasks first (batch only).
    Batch input is written at once; for streaming input the append-mode
    file sink writer is returned, not started (its commit log makes each
    micro-batch land exactly once); the caller picks the trigger.
    """
    if df.isStreaming:
        if checkpoint is None:
            raise ValueError("a streaming write needs a checkpoint location")
        return (df.writeStream.format("parquet").outputMode("append")
                  .partitionBy(dir_col).option("checkpointLocation", checkpoint)
                  .option("path", path))
    out = df.repartition(shards) if shards > 0 else df
    out.write.mode("overwrite").partitionBy(dir_col).parquet(path)
    return None
