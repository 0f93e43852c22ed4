"""Streaming windowed aggregation: final (append) and early (update) panes.

Mapping of the original trigger settings:

* on-time result when the watermark passes the window end
  -> ``outputMode('append')`` with ``withWatermark(ts, lateness)``;
* early results at a processing-time cadence
  -> ``outputMode('update')`` + ``trigger(processingTime=...)``; each
  update repeats the whole group's current value (accumulating panes);
* allowed lateness -> the watermark delay: a row whose window ended at
  or before the watermark of the batch it arrives in is dropped (and
  counted in ``numRowsDroppedByWatermark``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.fixed import ALLOWED_LATENESS, JOIN_WINDOW
from tidewire.functions.time import instant_to_ntz


def stream_window_counts(df: DataFrame, ts: str = "ts", length: str = JOIN_WINDOW,
                         keys: tuple[str, ...] = (), lateness: str = ALLOWED_LATENESS) -> DataFrame:
    """Rows per (tumbling window, keys) with a watermark; window bounds come
    out as UTC wall-clock ``TIMESTAMP_NTZ``."""
    w = F.window(F.col(ts), length)
    return (df.withWatermark(ts, lateness)
            .groupBy(w.alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(instant_to_ntz("w.start").alias("window_start"),
                    instant_to_ntz("w.end").alias("window_end"), *keys, "n"))


