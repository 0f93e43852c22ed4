"""Event-time assignment and fixed (tumbling) windows."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.fixed import BOUNDED_STAMP_OFFSET, JOIN_WINDOW
from tidewire.functions.time import ntz_to_instant


def _instant_literal(instant) -> Column:
    if isinstance(instant, Column):
        return instant
    if isinstance(instant, _dt.datetime):
        instant = instant.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(instant)).cast("timestamp_ntz")


def assign_event_time(df: DataFrame, instant, offset: str | None = BOUNDED_STAMP_OFFSET,
                      col: str = "ts", as_instant: bool = False) -> DataFrame:
    """Stamp every row with one event time: ``instant`` (+ ``offset``).

    The instant is passed in (e.g. the job's start time, fixed once on the
    driver) and never read from the clock inside the plan, so re-running a
    task gives the same stamp.  The result is UTC wall-clock
    ``TIMESTAMP_NTZ``; ``as_instant=True`` gives a ``TIMESTAMP`` usable as
    a stream's watermark column.
    """
    ts = _instant_literal(instant)
    if offset:
        ts = ts + F.expr(f"INTERVAL {offset}")
    if as_instant:
        ts = ntz_to_instant(ts)
    return df.withColumn(col, ts)


def fixed_window(df: DataFrame, ts: str = "ts", length: str = JOIN_WINDOW,
                 start: str = "window_start", end: str = "window_end") -> DataFrame:
    """Tag rows with their tumbling window ``[start, end)``, epoch aligned."""
    w = F.window(F.col(ts), length)
    return df.withColumns({start: w.start, end: w.end})


def window_counts(df: DataFrame, ts: str = "ts", length: str = JOIN_WINDOW,
                  keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows per tumbling window (and keys): partial counts before the shuffle."""
    start = F.window(F.col(ts), length).start
    return (df.groupBy(start.alias("window_start"), *keys)
              .agg(F.count(F.lit(1)).alias("n"))
              .select("window_start",
                      (F.col("window_start") + F.expr(f"INTERVAL {length}")).alias("window_end"),
                      *keys, "n"))


# broker timestamp types (the ``timestampType`` column of the Kafka source)
CREATE_TIME = 0
LOG_APPEND_TIME = 1


def event_time_from_policy(df: DataFrame, policy: str = "create", out: str = "ts",
                           timestamp: str = "timestamp", timestamp_type: str = "timestampType") -> DataFrame:
    """Event time of broker records by policy.

    * ``'create'`` / ``'log_append'``: the record's own timestamp, which must
      be of that type (a record of the other type fails the job);
    * ``'processing'``: the micro-batch's processing time
      (``current_timestamp()``: one value per batch, so a re-run batch may
      get another time; prefer a record time where one exists).
    """
    if policy == "processing":
        return df.withColumn(out, F.current_timestamp())
    wanted = {"create": CREATE_TIME, "log_append": LOG_APPEND_TIME}.get(policy)
    if wanted is None:
        raise ValueError(f"unknown event-time policy {policy!r}")
    return df.withColumn(out, F.when(F.col(timestamp_type) == wanted, F.col(timestamp)).otherwise(
        F.raise_error(F.concat(F.lit(f"record timestamp is not of type {policy}: type "),
                               F.coalesce(F.col(timestamp_type).cast("string"), F.lit("null"))))))
