"""Stream x bounded joins as Structured Streaming queries.

Co-group: the bounded side is known before the stream starts and all its rows
carry one event time, so it fills one known window.  Only the stream is aggregated
as a stream; the bounded side is counted as a batch and the two long forms are put
together when the result is read.  The watermark then follows the stream's own
times alone: a topic read from its earliest offset is never late against the
bounded side's stamp, and the bounded rows take no state.

The state kept per (window, key) is the long form ``(side, value, n)``: it grows
with distinct values, not with rows, and it is what the update-mode output carries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.fixed import ALLOWED_LATENESS, JOIN_WINDOW
from tidewire.functions.time import instant_to_ntz
from tidewire.operators.joins import BOUNDED_SIDE, STREAM_SIDE, lookup_join
from tidewire.sinks.replay_safe import latest_count

LONG_KEYS = ["window_start", "window_end", "key", "side", "value"]


def _counts(df: DataFrame, side: int, key: str, value: str, ts: str, window: str) -> DataFrame:
    w = F.window(ts, window)
    return (df.groupBy(w.alias("w"), F.col(key).alias("key"), F.col(value).cast("string").alias("value"))
              .agg(F.count(F.lit(1)).alias("n"))
              .select(instant_to_ntz("w.start").alias("window_start"), instant_to_ntz("w.end").alias("window_end"),
                      "key", F.lit(side).alias("side"), "value", "n"))


def stream_side_counts(stream: DataFrame, key: str = "key", value: str = "value", ts: str = "ts",
                       window: str = JOIN_WINDOW, lateness: str = ALLOWED_LATENESS) -> DataFrame:
    """Streaming long form of the stream side: ``(window_start, window_end,
    key, side, value, n)``; ``ts`` must be an instant (``TIMESTAMP``)."""
    return _counts(stream.withWatermark(ts, lateness), STREAM_SIDE, key, value, ts, window)


def bounded_side_counts(bounded: DataFrame, key: str = "key", value: str = "value", ts: str = "ts",
                        window: str = JOIN_WINDOW) -> DataFrame:
    """The same long form of the bounded side, as a batch."""
    return _counts(bounded, BOUNDED_SIDE, key, value, ts, window)


def merged_cogroup(panes: DataFrame, bounded: DataFrame) -> DataFrame:
    """The co-group so far, in long form: the last pane of every stream count
    and the bounded side's counts.  One hash aggregate over the panes."""
    return latest_count(panes, LONG_KEYS).unionByName(bounded.select(*LONG_KEYS, "n"))


def stream_stream_cogroup(left: DataFrame, right: DataFrame, key: str = "key", value: str = "value", ts: str = "ts",
                          window: str = JOIN_WINDOW, lateness: str = ALLOWED_LATENESS) -> DataFrame:
    """Co-group of two endless inputs inside the stream, long form, for append output.

    Each side has its own watermark; the query's is the smaller of the two (Spark's default policy),
    so a window is written, once, when both sides have passed its end, and its state goes then.
    A side that lags holds windows open and loses nothing; a key that only one side has gives that
    side's rows, as in a full outer join, but without a row for each pair.  After a restart Spark knows a
    side's own watermark again only when that side has new rows: until then no window is written."""
    if not (left.isStreaming and right.isStreaming):
        raise ValueError("both sides must be streams")
    if left.sparkSession.conf.get("spark.sql.streaming.multipleWatermarkPolicy", "min") != "min":
        raise ValueError("the watermark must follow the slower side (spark.sql.streaming.multipleWatermarkPolicy=min)")
    sides = [df.withWatermark(ts, lateness).select(F.col(ts).alias("ts"), F.col(key).alias("key"), F.col(value).cast("string").alias("value"),
                                                   F.lit(side).alias("side"))
             for df, side in ((left, STREAM_SIDE), (right, BOUNDED_SIDE))]
    both = sides[0].unionByName(sides[1])
    w = F.window("ts", window)
    return (both.groupBy(w.alias("w"), "key", "side", "value").agg(F.count(F.lit(1)).alias("n"))
                .select(instant_to_ntz("w.start").alias("window_start"), instant_to_ntz("w.end").alias("window_end"),
                        "key", "side", "value", "n"))


def stream_lookup_join(stream: DataFrame, lookup: DataFrame, key: str = "key",
                       value: str = "value", **kw) -> DataFrame:
    """Stream-static left lookup join; ``lookup`` is a batch DataFrame
    (re-read every micro-batch, so point it at a written, checked table)."""
    if not stream.isStreaming:
        raise ValueError("stream side must be a streaming DataFrame")
    return lookup_join(stream, lookup, key, value, **kw)
