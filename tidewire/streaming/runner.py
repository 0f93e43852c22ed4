"""Running streaming queries to completion and reading their progress."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidewire.fixed import EARLY_FIRING_DELAY

def run_available(writer: DataStreamWriter, timeout_s: float | None = None) -> StreamingQuery:
    """Process everything available now (in as many micro-batches as the
    sources' rate limits give), then stop.  Raises the query's error."""
    q = writer.trigger(availableNow=True).start()
    finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if finished is False:
        q.stop()
        raise TimeoutError(f"stream did not finish within {timeout_s} s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def rows_dropped_by_watermark(q: StreamingQuery) -> int:
    """Rows that stateful operators dropped as too late, over the batches
    still in ``recentProgress`` (``spark.sql.streaming.numRecentProgressUpdates``)."""
    return sum(op.numRowsDroppedByWatermark for p in q.recentProgress for op in p.stateOperators)


def batches_run(q: StreamingQuery) -> int:
    return len(q.recentProgress)


def run_final(df, path: str, checkpoint: str, partition_by: str | None = None,
              fmt: str = "parquet", timeout_s: float | None = None):
    """On-time results only: append-mode file sink (a windowed aggregate is
    written once the watermark passes the window end), run to the end of
    the available input.  Returns the finished query; read the output with
    ``spark.read`` (the sink's commit log hides uncommitted files).  Stateful
    queries take the session's ``spark.sql.shuffle.partitions`` as their number of
    state partitions, for good: the checkpoint records it."""
    w = (df.writeStream.format(fmt).outputMode("append")
           .option("path", path).option("checkpointLocation", checkpoint))
    if partition_by:
        w = w.partitionBy(partition_by)
    return run_available(w, timeout_s)


def run_early(df, path: str, checkpoint: str, fmt: str = "parquet", timeout_s: float | None = None):
    """Early (accumulating) results: update-mode output, every pane written
    through the replay-safe sink; the complete result is
    ``sinks.latest_pane`` (or ``latest_count``) of what was written."""
    from tidewire.sinks.replay_safe import replay_safe_sink
    return run_available(replay_safe_sink(df, path, checkpoint, output_mode="update", fmt=fmt), timeout_s)


def start_early(df, path: str, checkpoint: str, every: str = EARLY_FIRING_DELAY):
    """Long-running form of ``run_early``: a pane update every ``every`` of
    processing time (the early-firing cadence), until stopped."""
    from tidewire.sinks.replay_safe import replay_safe_sink
    return replay_safe_sink(df, path, checkpoint, output_mode="update").trigger(processingTime=every).start()


def run_timers(df, path: str, checkpoint: str, delay: str = EARLY_FIRING_DELAY, every: str = "1 second",
               timeout_s: float = 600):
    """Run a query with processing-time timers of ``delay`` until its input is used up and no
    timer can be pending, then stop it.  Its output goes through the replay-safe sink.

    A timer that an earlier run left is due ``delay`` after this one's start at the latest, one of
    this run ``delay`` after the end of the last micro-batch with new input: the first micro-batch
    without any that begins after both has fired them all.  A run's first micro-batch does not count:
    it may repeat one that was cut short, as of that one's input and time."""
    from tidewire.sinks.replay_safe import replay_safe_sink
    from tidewire.streaming.panes import millis
    wait = dt.timedelta(milliseconds=millis(delay))
    due = dt.datetime.now(dt.timezone.utc) + wait
    q = replay_safe_sink(df, path, checkpoint, output_mode="update").trigger(processingTime=every).start()
    until, seen = time.monotonic() + timeout_s, -1
    try:
        while time.monotonic() < until:
            if q.exception() is not None:
                raise RuntimeError(str(q.exception()))
            for p in [p for p in q.recentProgress if p.batchId > seen]:
                first, seen, began = seen < 0, p.batchId, dt.datetime.fromisoformat(p.timestamp)
                if p.numInputRows or any(s.startOffset != s.endOffset for s in p.sources):
                    due = max(due, began + dt.timedelta(milliseconds=p.durationMs["triggerExecution"]) + wait)
                elif began > due and not first:
                    return q
            time.sleep(0.2)
        raise TimeoutError(f"timers still pending after {timeout_s} s")
    finally:
        q.stop()
