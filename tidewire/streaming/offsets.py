"""Offsets recorded after a micro-batch is in the checkpoint.

A consumer that commits its offsets back when a bundle is final lets others see how far it has
come, and start there.  ``OffsetRecorder`` is a listener: Spark reports a micro-batch's progress
after its checkpoint entry is written, and the listener then notes the batch's end offsets
under the consumer group, as one small file.  They come from the broker source's own report or, for
replays, from ``observed_offsets``.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidewire.sinks.ledger import Files

OBSERVED = "tidewire-offsets"


def observed_offsets(records: DataFrame, partitions: dict[str, int]) -> DataFrame:
    """``records`` with their largest offset per topic and partition reported as each batch's
    metric (``partitions``: the number of partitions of each topic)."""
    seen = [F.max(F.when((F.col("topic") == topic) & (F.col("partition") == p), F.col("offset"))).alias(f"{topic}/{p}")
            for topic, n in sorted(partitions.items()) for p in range(n)]
    return records.observe(OBSERVED, *seen)


def end_offsets(progress) -> dict[str, dict[str, int]]:
    """Per topic and partition the next offset after this batch, as far as its report tells."""
    out: dict = {}
    for source in progress.sources:
        try:
            ends = json.loads(source.endOffset)
        except (TypeError, ValueError):
            continue
        # the broker source reports {topic: {partition: offset}}; file sources report something else
        if isinstance(ends, dict) and ends and all(isinstance(v, dict) for v in ends.values()):
            for topic, by_partition in ends.items():
                out.setdefault(topic, {}).update({p: int(o) for p, o in by_partition.items()})
    seen = progress.observedMetrics.get(OBSERVED)
    for name, last in (seen.asDict() if seen is not None else {}).items():
        if last is not None:
            topic, p = name.rsplit("/", 1)
            out.setdefault(topic, {})[p] = int(last) + 1
    return out


class OffsetRecorder(StreamingQueryListener):
    """Notes the end offsets of every batch of ``query_name`` below ``<path>/offsets/<group>/``."""

    def __init__(self, spark: SparkSession, path: str, group: str, query_name: str):
        self.spark, self.path, self.group, self.query_name = spark, path, group, query_name
        self.last: tuple = (None, -1)
        self.failure: Exception | None = None

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        if p.name != self.query_name:
            return
        try:
            ends = end_offsets(p)
            if ends:
                record_offsets(self.spark, self.path, self.group, ends)
            self.last = (str(p.runId), p.batchId)
        except Exception as e:  # a listener's error reaches nobody: keep it for whoever waits
            self.failure = e

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def caught_up(self, query, timeout_s: float = 60) -> None:
        """Wait until the last batch of a query that has ended is recorded."""
        until = time.monotonic() + timeout_s
        batches = [p.batchId for p in query.recentProgress]
        while batches and self.last != (str(query.runId), batches[-1]):
            if self.failure is not None:
                raise self.failure
            if time.monotonic() > until:
                raise TimeoutError("the last batch's offsets were not recorded")
            time.sleep(0.05)


def record_offsets(spark: SparkSession, path: str, group: str, ends: dict[str, dict[str, int]]) -> None:
    """Note ``ends`` as the group's newest record; older ones but one go."""
    files = Files(spark, path)
    folder = f"offsets/{group}"
    names = files.names(folder)
    merged = json.loads(files.read(f"{folder}/{names[-1]}")) if names else {}
    for topic, by_partition in ends.items():
        have = merged.setdefault(topic, {})
        for p, end in by_partition.items():
            have[p] = max(end, have.get(p, 0))
    number = int(names[-1].split(".")[0]) + 1 if names else 0
    if not files.create(f"{folder}/{number:012d}.json", json.dumps(merged, sort_keys=True)):
        raise RuntimeError(f"two queries record offsets of the group {group}")
    for n in names[:-1]:
        files.delete(f"{folder}/{n}")


def recorded_offsets(spark: SparkSession, path: str, group: str) -> dict[str, dict[str, int]]:
    """Per topic and partition the next offset of the group; empty before the first batch.  As JSON it is
    the broker source's ``startingOffsets``."""
    files = Files(spark, path)
    names = files.names(f"offsets/{group}")
    return json.loads(files.read(f"offsets/{group}/{names[-1]}")) if names else {}


def behind(records: DataFrame, ends: dict[str, dict[str, int]]) -> DataFrame:
    """The records at or behind the recorded offsets: a start from the record for
    sources that have no starting offsets."""
    for topic, by_partition in sorted(ends.items()):
        for p, end in sorted(by_partition.items()):
            records = records.where(~((F.col("topic") == topic) & (F.col("partition") == int(p)) & (F.col("offset") < end)))
    return records
