"""A sink group whose progress outlives the checkpoint.

A broker's exactly-once sink group remembers, in the output itself, how far it has
come.  Here the group is a directory::

    <path>/group=<g>/data/query_id=<q>/batch_id=<n>/   rows of a micro-batch
    <path>/group=<g>/ledger/<epoch>-<batch>.json       one commit
    <path>/group=<g>/owner/<epoch>                     the query that holds the group

A commit names a batch's directory and, per topic and partition, the offset behind the
last one it holds.  It is one file, created by renaming, so it is there whole or not at all, and only
rows that a commit names are read.  Every batch is cut against the commits of all earlier batches: a
query with a new checkpoint may read the topic again from the start and still every offset
lands once.  A query that starts takes the group over by creating the next epoch's owner file;
the query that held it before fails at its next batch instead of writing beside it.

Offsets of a partition must rise through the batches, as a topic's do.  What reaches the driver is
one row per topic and partition of a batch, which the topic's partitions bound.  Old commits are
folded into one when there are ``FOLD`` of them, so a start reads a bounded number of files.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Commits after which they are folded into one.
FOLD = 100

PLACE = ["topic", "partition"]


class Files:
    """Small files through Hadoop's file system API, wherever the path points."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.root = spark._jvm, path.rstrip("/")
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        p = self._path(folder)
        if not self.fs.exists(p):
            return []
        return sorted(n for n in (s.getPath().getName() for s in self.fs.listStatus(p)) if not n.startswith("."))

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """A new file, whole or not at all; False if there is one of that name."""
        folder, leaf = name.rsplit("/", 1)
        draft = self._path(f"{folder}/.{leaf}-{uuid.uuid4().hex[:8]}")
        out = self.fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        done = not self.fs.exists(self._path(name)) and self.fs.rename(draft, self._path(name))
        if not done:
            self.fs.delete(draft, False)
        return done

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


class Ledger:
    """What the group ``group`` below ``path`` has committed."""

    def __init__(self, spark: SparkSession, path: str, group: str):
        self.path = f"{path.rstrip('/')}/group={group}"
        self.files = Files(spark, self.path)

    def commits(self) -> list[dict]:
        """All commits, in order; a folded file holds many."""
        found: dict = {}
        for name in self.files.names("ledger"):
            for c in json.loads(self.files.read(f"ledger/{name}")):
                found[c["epoch"], c["batch"]] = c  # a fold and what it was folded from hold the same
        return [found[k] for k in sorted(found)]

    def positions(self, commits: list[dict] | None = None) -> dict[tuple[str, int], int]:
        """Per topic and partition the next offset to be written."""
        out: dict = {}
        for c in self.commits() if commits is None else commits:
            for topic, partition, end in c["ends"]:
                out[topic, partition] = max(end, out.get((topic, partition), 0))
        return out

    def starting_offsets(self) -> str:
        """The broker source's ``startingOffsets`` for a query that goes on from here;
        partitions the group has not met are left to the source's default."""
        out: dict = {}
        for (topic, partition), end in sorted(self.positions().items()):
            out.setdefault(topic, {})[str(partition)] = end
        return json.dumps(out)

    def take_over(self, query: str) -> int:
        """Make ``query`` the group's owner; its epoch."""
        while True:
            names = self.files.names("owner")
            epoch = int(names[-1]) if names else 0
            if names and self.files.read(f"owner/{names[-1]}") == query:
                return epoch
            if self.files.create(f"owner/{epoch + 1:012d}", query):
                return epoch + 1

    def commit(self, query: str, epoch: int, batch: int, ends: list, rows: int) -> None:
        newest = self.files.names("owner")[-1]
        if int(newest) != epoch:
            raise RuntimeError(f"query {query} no longer holds the group: {self.files.read(f'owner/{newest}')} does")
        entry = {"epoch": epoch, "batch": batch, "query": query, "ends": ends, "rows": rows}
        if not self.files.create(f"ledger/{epoch:012d}-{batch:012d}.json", json.dumps([entry])):
            raise RuntimeError(f"batch {batch} of epoch {epoch} has been committed before")
        names = self.files.names("ledger")
        if len(names) > FOLD:
            old = names[:-1]
            entries = [c for n in old for c in json.loads(self.files.read(f"ledger/{n}"))]
            self.files.create(f"ledger/{old[-1][:-5]}-fold.json", json.dumps(entries))
            for n in old:
                self.files.delete(f"ledger/{n}")


def _after(rows: DataFrame, ends: dict) -> DataFrame:
    """The rows at or behind ``ends``: one literal map, as large as the topic has partitions."""
    if not ends:
        return rows
    place = F.concat_ws("/", "partition", "topic")
    known = F.create_map(*[F.lit(x) for (t, p), end in sorted(ends.items()) for x in (f"{p}/{t}", end)])
    return rows.where(F.col("offset") >= F.coalesce(known[place], F.lit(0)))


def _before_bound(rows: DataFrame, room: int | None, until) -> tuple[DataFrame, bool]:
    """The rows in front of the bound, a prefix of every partition, and whether it was met."""
    met = False
    if until is not None:
        cut = rows.where(F.col("timestamp") >= F.lit(until)).groupBy(*PLACE).agg(F.min("offset").alias("cut"))
        stop = {(r["topic"], r["partition"]): r["cut"] for r in cut.collect()}  # one row per partition
        if stop:
            met = True
            place = F.concat_ws("/", "partition", "topic")
            known = F.create_map(*[F.lit(x) for (t, p), c in sorted(stop.items()) for x in (f"{p}/{t}", c)])
            rows = rows.where(F.col("offset") < F.coalesce(known[place], F.lit((1 << 63) - 1)))
    if room is not None:
        held = rows.count()
        met = met or held >= room
        if held > room:  # per task the first ``room`` rows, then one merge
            rows = rows.orderBy("offset", "partition", "topic").limit(room)
    return rows, met


def ledger_writer(path: str, group: str, for_count: int | None = None, until=None, fmt: str = "parquet"):
    """The ``foreachBatch`` function of a sink group.  ``for_count`` (records of this query) and
    ``until`` (record time) bound it: the batch that meets the bound is cut there, the cut
    is what the ledger keeps, and later batches write nothing; ``writer.done`` tells."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query:
            raise RuntimeError("the streaming query's id is not known in this batch")
        ledger = Ledger(spark, path, group)
        epoch = ledger.take_over(query) if "epoch" not in state else state["epoch"]
        state["epoch"] = epoch
        commits = ledger.commits()
        if any(c["epoch"] == epoch and c["batch"] >= batch_id for c in commits):
            return  # committed, but the checkpoint was not: the restarted query runs the batch again
        mine = sum(c["rows"] for c in commits if c["query"] == query)
        room = None if for_count is None else for_count - mine
        if write.done or room == 0:
            write.done = True
            return
        rows, met = _before_bound(_after(batch, ledger.positions(commits)), room, until)
        out = f"{ledger.path}/data/query_id={query}/batch_id={batch_id}"
        rows.write.mode("overwrite").format(fmt).save(out)
        back = spark.read.format(fmt).schema(batch.schema).load(out).groupBy(*PLACE).agg(
            F.max("offset").alias("last"), F.count(F.lit(1)).alias("n")).collect()  # one row per partition
        ledger.commit(query, epoch, batch_id, [[r["topic"], r["partition"], r["last"] + 1] for r in back],
                      sum(r["n"] for r in back))
        write.done = met

    state: dict = {}
    write.done = False
    return write


def ledger_sink(records: DataFrame, path: str, group: str, checkpoint: str, **bound):
    """A ``DataStreamWriter`` (not started) that copies broker records (``topic``, ``partition``,
    ``offset`` and any other columns) into a sink group."""
    return records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(ledger_writer(path, group, **bound))


def drain(records: DataFrame, path: str, group: str, checkpoint: str, for_count: int | None = None,
          until=None, timeout_s: float = 600) -> bool:
    """Copy an endless topic into a sink group up to a bound, then stop: ``for_count`` records by
    this query, or all records in front of the first one of its partition at or behind ``until``.  True if the bound
    was met, False if the topic has no more for now.  A later drain of the same group,
    with a new checkpoint, goes on right behind the cut."""
    import time
    if (for_count is None) == (until is None):
        raise ValueError("give for_count or until")
    write = ledger_writer(path, group, for_count, until)
    q = records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()
    end = time.monotonic() + timeout_s
    while q.isActive and not write.done:
        if q.awaitTermination(0.2):
            break
        if time.monotonic() > end:
            q.stop()
            raise TimeoutError(f"the topic was not drained within {timeout_s} s")
    if write.done:
        q.stop()
    elif q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return write.done


def read_group(spark: SparkSession, path: str, group: str, schema, fmt: str = "parquet") -> DataFrame:
    """The rows that the group's commits name, and nothing a failed batch has left."""
    ledger = Ledger(spark, path, group)
    found = [f"{ledger.path}/data/query_id={c['query']}/batch_id={c['batch']}" for c in ledger.commits() if c["rows"]]
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).load(found)
