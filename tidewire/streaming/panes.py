"""Panes by timers: early ones by processing time, on-time and late ones by event time.

Both operators keep, per key and window, the count of every distinct value and what is known of
its panes, and emit accumulating panes in long form: every firing repeats the group's counts, one
row per value.  They are ``transformWithState`` operators, so timers are part of the state and
survive a restart.  Such operators keep several state tables each, which Spark's default state
store cannot hold: where the session names that one, they choose RocksDB for the queries started next.

* ``timer_panes``: a pane fires ``delay`` of processing time after its first element, as
  early firings do; the next element opens the next pane.
* ``late_panes``: the on-time pane fires when the event-time watermark passes the window's end; a
  row that arrives after that and inside the allowed lateness fires the window again, at once, as
  a late pane; when the lateness is over the state goes and later rows are dropped.

Every call from Python into the state store, and every row that reaches Python by itself, costs far
more than a row.  So groups share buckets: rows are counted before the shuffle and travel and are
stored as Arrow chunks, one state key holds the groups of a bucket, and a timer of it fires all panes
that are due.  When panes fire, a task holds the counts of one bucket: those of the windows of one
span (a window, or ``span`` of ``timer_panes``) and of one in ``buckets`` keys.  A key too hot for one
task can be split with ``parts``: its values are dealt out by hash, each part fires panes of its own.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewire.fixed import ALLOWED_LATENESS, EARLY_FIRING_DELAY, JOIN_WINDOW

EARLY, ON_TIME, LATE = "early", "on-time", "late"
PANE_ROWS = ("window_start timestamp_ntz, window_end timestamp_ntz, key string, value string, n long, "
             "kind string, pane long")
_GROUP, _BUCKET = ["window_ms", "key", "part"], ["span", "bucket"]

#: Timer panes of so much event time share their buckets, which are so many; it is read again whenever
#: one of their panes fires.
SPAN, BUCKETS = "1 hour", 32

#: Rows (or bytes) counted at once before the shuffle, and rows of a chunk.
_PACK_ROWS, _PACK_BYTES, _CHUNK_ROWS = 1 << 19, 32 << 20, 1 << 13

# the driver starts a worker of its own to set up the state, which sees no shipped files: the
# processors travel by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def millis(duration: str) -> int:
    """Milliseconds of a duration such as ``20 seconds`` (no months or years)."""
    number, unit = duration.split()
    return int(number) * {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000,
                          "day": 86_400_000}[unit.rstrip("s")]


def _schema():
    import pyarrow as pa
    return pa.schema([("window_ms", pa.int64()), ("key", pa.string()), ("part", pa.int32()), ("value", pa.string()), ("n", pa.int64())])


def _added_up(table, by=(*_GROUP, "value")):
    """One row per group and value (nulls are values, too)."""
    return table.group_by([*by], use_threads=False).aggregate([("n", "sum")]).rename_columns([*by, "n"])


def _pack(table) -> list[bytes]:
    return [b.serialize().to_pybytes() for b in table.select(_schema().names).cast(_schema()).combine_chunks().to_batches(_CHUNK_ROWS)]


def _unpack(chunks):
    import pyarrow as pa
    return pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(c), _schema()) for c in chunks], _schema())


def _packed(batches: Iterator) -> Iterator:
    """Counts of the rows of a task, in chunks by bucket, each with its largest event time."""
    held, rows, size = [], 0, 0
    for batch in batches:
        held, rows, size = [*held, batch], rows + batch.num_rows, size + batch.nbytes
        if rows >= _PACK_ROWS or size >= _PACK_BYTES:
            yield _by_bucket(held)
            held, rows, size = [], 0, 0
    if rows:
        yield _by_bucket(held)


def _by_bucket(batches: list):
    import numpy as np
    import pyarrow as pa
    table = pa.Table.from_batches(batches)
    if table["window_ms"].null_count:
        raise ValueError("a row without event time is in no window")
    by = [*_BUCKET, *_GROUP, "value"]
    table = table.group_by(by, use_threads=False).aggregate([([], "count_all"), ("ts", "max")]).rename_columns([*by, "n", "ts"])
    table = table.sort_by([(c, "ascending") for c in _BUCKET]).combine_chunks()
    span, bucket, ts = (table[c].combine_chunks() for c in (*_BUCKET, "ts"))
    span, bucket, us = span.to_numpy(), bucket.to_numpy(), ts.cast("int64").to_numpy()
    cuts = np.flatnonzero(np.r_[True, (span[1:] != span[:-1]) | (bucket[1:] != bucket[:-1])])
    chunks = [_pack(table.slice(lo, hi - lo)) for lo, hi in zip(cuts, [*cuts[1:], len(table)])]
    many = [len(c) for c in chunks]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(span[cuts], many)), pa.array(np.repeat(bucket[cuts], many)), pa.array([c for each in chunks for c in each], pa.binary()),
         pa.array(np.repeat(np.maximum.reduceat(us, cuts), many)).cast(ts.type)], [*_BUCKET, "chunk", "ts"])


def _groups(*tables):
    """``(ids, first)``: the number of every row's group, per table, and where each group comes first in all."""
    import numpy as np
    import pyarrow as pa
    rows = pa.concat_tables(tables)
    window, key = (rows[c].combine_chunks().dictionary_encode("encode") for c in _GROUP[:2])
    part = rows["part"].to_numpy().astype("int64")
    ids = window.indices.to_numpy().astype("int64") * len(key.dictionary) + key.indices.to_numpy()
    _, first, ids = np.unique(ids * (part.max(initial=0) + 1) + part, return_index=True, return_inverse=True)
    return np.split(ids, np.cumsum([len(t) for t in tables])[:-1]), first


class _Log:
    """Counted rows of a bucket, in chunks; added up whenever as many more have come as it held."""

    def __init__(self, handle: StatefulProcessorHandle, name: str):
        self.chunks = handle.getListState(name, "chunk binary")
        self.size = handle.getValueState(f"{name}_size", "held long, more long")

    def read(self):
        return _unpack(c for c, in self.chunks.get())

    def add(self, chunks: list[bytes]) -> None:
        for i in range(0, len(chunks), 16):
            self.chunks.appendList([(c,) for c in chunks[i:i + 16]])
        held, more = self.size.get() or (0, 0)
        more += len(_unpack(chunks))
        if more > held + _CHUNK_ROWS:
            table = _added_up(self.read())
            self.chunks.put([(c,) for c in _pack(table)])
            held, more = len(table), 0
        self.size.update((held, more))

    def clear(self) -> None:
        self.chunks.clear()
        self.size.clear()


class _Panes(StatefulProcessor):
    """Counts per value of the groups of a bucket, and how many panes each group has fired."""

    def __init__(self, window: int):
        self.window = window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts, self.fired = _Log(handle, "counts"), _Log(handle, "fired")

    def fire(self, rows, ids, due, fired, fired_ids, groups, kind: str) -> Iterator:
        """The panes of the groups that are ``due`` (a flag per group), numbered after those ``fired``."""
        import numpy as np
        import pandas as pd
        import pyarrow as pa
        number = np.bincount(fired_ids, weights=fired["n"].to_numpy(), minlength=len(due)).astype("int64")
        panes = rows.append_column("pane", pa.array(number[ids])).filter(pa.array(due[ids]))
        for batch in _added_up(panes, (*_GROUP, "pane", "value")).to_batches(_CHUNK_ROWS):
            start = batch["window_ms"].to_numpy().astype("datetime64[ms]")
            yield pd.DataFrame({
                "window_start": start, "window_end": start + np.timedelta64(self.window, "ms"), "key": batch["key"].to_pandas(),
                "value": batch["value"].to_pandas(), "n": batch["n"].to_pandas(), "kind": kind, "pane": batch["pane"].to_pandas()})
        once = groups.filter(pa.array(due))
        if len(once):
            n = once.schema.get_field_index("n")
            self.fired.add(_pack(once.set_column(n, "n", pa.array(np.ones(len(once), "int64")))))

    def close(self) -> None:
        pass


class _TimerPanes(_Panes):
    """Rows are ``fresh`` until the pane fires that they have opened, or come into; every one opened in
    a micro-batch is due at the same time."""

    def __init__(self, window: int, delay: int):
        super().__init__(window)
        self.delay = delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.fresh = handle.getListState("fresh", "chunk binary, at long")

    def handleInputRows(self, key, rows, timerValues):
        now, some = timerValues.getCurrentProcessingTimeInMs(), False
        for batch in rows:
            chunks = [(c, now) for c in batch["chunk"]]
            for i in range(0, len(chunks), 16):
                self.fresh.appendList(chunks[i:i + 16])
                some = True
        if some:
            self.handle.registerTimer(now + self.delay)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        import numpy as np
        import pyarrow as pa
        now, fresh = timerValues.getCurrentProcessingTimeInMs(), list(self.fresh.get())
        if all(at + self.delay > now for _, at in fresh):  # fired with an earlier timer of this micro-batch
            return
        tables = [_unpack([c]) for c, _ in fresh]
        at = np.repeat([at for _, at in fresh], [len(t) for t in tables])
        new, held, fired = pa.concat_tables(tables), self.counts.read(), self.fired.read()
        (new_ids, held_ids, fired_ids), first = _groups(new, held, fired)
        opened = np.full(len(first), np.iinfo("int64").max)
        np.minimum.at(opened, new_ids, at)
        due = opened <= now - self.delay
        yield from self.fire(pa.concat_tables([new, held]), np.r_[new_ids, held_ids], due, fired, fired_ids,
                             pa.concat_tables([new, held, fired]).take(first), EARLY)
        self.counts.add(_pack(_added_up(new.filter(pa.array(due[new_ids])))))
        wait = [(c, t) for t in np.unique(at) for c in _pack(new.filter(pa.array((at == t) & ~due[new_ids])))]
        self.fresh.clear()
        for i in range(0, len(wait), 16):
            self.fresh.appendList([(c, int(t)) for c, t in wait[i:i + 16]])


class _LatePanes(_Panes):
    """The query's watermark runs ``lateness + window`` behind the largest event time, so the
    engine drops no row whose window still takes late rows; this class compares windows with the
    event time itself.  A bucket holds groups of one window; those that have fired no pane are due."""

    def __init__(self, window: int, lateness: int):
        super().__init__(window)
        self.lateness = lateness

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.due = handle.getValueState("due", "due boolean")

    def handleInputRows(self, key, rows, timerValues):
        end = int(key[0]) + self.window
        behind = self.lateness + self.window
        now = timerValues.getCurrentWatermarkInMs() + behind
        if end <= now - self.lateness:  # over: dropped
            return
        some, late = False, []
        for batch in rows:
            if not len(batch):
                continue
            some = True
            self.counts.add(list(batch["chunk"]))
            if end <= now:
                late.extend(batch["chunk"])
        if not some:
            return
        if late:
            yield from self.panes(LATE, _unpack(late))
        elif not self.due.exists():
            self.handle.registerTimer(end - behind)
            self.due.update((True,))
        self.handle.registerTimer(end + self.lateness - behind)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        end = int(key[0]) + self.window
        if self.due.exists():  # both timers may have passed in one step of the watermark; the first one fires the panes
            yield from self.panes(ON_TIME)
            self.due.clear()
        if expiredTimerInfo.getExpiryTimeInMs() >= end - self.window:
            self.counts.clear()
            self.fired.clear()

    def panes(self, kind: str, late=None) -> Iterator:
        """Panes of the groups that have fired none or, given ``late`` rows, of theirs."""
        import numpy as np
        import pyarrow as pa
        late = _schema().empty_table() if late is None else late
        rows, fired = self.counts.read(), self.fired.read()
        (ids, fired_ids, late_ids), first = _groups(rows, fired, late)
        due = np.full(len(first), kind == ON_TIME)
        due[fired_ids] = False
        due[late_ids] = True
        yield from self.fire(rows, ids, due, fired, fired_ids, pa.concat_tables([rows, fired]).take(first), kind)


def _column_families(spark: SparkSession) -> None:
    """A state store with column families, unless the session names one of its own choice.  A query
    keeps the store that its checkpoint records; others of this session are free to share this one."""
    name, package = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state"
    if spark.conf.get(name) == f"{package}.HDFSBackedStateStoreProvider":
        spark.conf.set(name, f"{package}.RocksDBStateStoreProvider")


def _bucketed(stream: DataFrame, key: str, value: str, ts: str, window: int, span: int, buckets: int, parts: int) -> DataFrame:
    """The stream's counts in chunks: ``span``, ``bucket``, ``chunk``, and ``ts``, the largest event time of a chunk."""
    if not stream.isStreaming:
        raise ValueError("panes are fired on a stream")
    _column_families(stream.sparkSession)
    start = F.floor(F.unix_millis(ts) / F.lit(window)).cast("long") * window
    part = F.pmod(F.xxhash64(value), F.lit(parts)).cast("int") if parts > 1 else F.lit(0)
    rows = stream.select(start.alias("window_ms"), F.col(key).cast("string").alias("key"), part.alias("part"),
                         F.col(value).cast("string").alias("value"), F.col(ts).cast("timestamp").alias("ts"))
    wide = max(1, span // window) * window
    bucket = F.pmod(F.xxhash64("key", "part"), F.lit(max(buckets, parts))).cast("int")
    rows = rows.withColumns({"span": F.col("window_ms") - F.pmod("window_ms", F.lit(wide)), "bucket": bucket})
    return rows.mapInArrow(_packed, "span long, bucket int, chunk binary, ts timestamp")


def timer_panes(stream: DataFrame, key: str = "key", value: str = "value", ts: str = "ts",
                window: str = JOIN_WINDOW, delay: str = EARLY_FIRING_DELAY, parts: int = 1,
                span: str = SPAN, buckets: int = BUCKETS) -> DataFrame:
    """Early panes ``delay`` after each pane's first element, by processing time.  Run it with a
    processing-time trigger (``run_timers``): timers are looked at in every micro-batch, also in
    those without rows.  A processing-time operator knows no watermark, so its state stays; put
    ``late_panes`` beside it where windows must be closed.  A ``span`` holds the windows that get rows
    at the same time; a backlog of long time is read faster with a longer one."""
    size = millis(window)
    return _bucketed(stream, key, value, ts, size, millis(span), buckets, parts).groupBy(*_BUCKET).transformWithStateInPandas(
        _TimerPanes(size, millis(delay)), outputStructType=PANE_ROWS, outputMode="Update", timeMode="ProcessingTime")


def late_panes(stream: DataFrame, key: str = "key", value: str = "value", ts: str = "ts",
               window: str = JOIN_WINDOW, lateness: str = ALLOWED_LATENESS, parts: int = 1,
               buckets: int = BUCKETS) -> DataFrame:
    """On-time and late panes by event time.  A window is judged by the largest event time of the
    micro-batches before the one its rows arrive in, as watermarks are."""
    size, late = millis(window), millis(lateness)
    rows = _bucketed(stream, key, value, ts, size, size, buckets, parts).withWatermark("ts", f"{size + late} milliseconds")
    return rows.groupBy(*_BUCKET).transformWithStateInPandas(
        _LatePanes(size, late), outputStructType=PANE_ROWS, outputMode="Update", timeMode="EventTime")
