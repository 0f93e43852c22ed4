"""Joins of a (possibly unbounded) keyed input with a bounded one.

* ``windowed_cogroup``: full co-group on key and tumbling window; one row
  per (window, key) that lists the values of both sides.
* ``lookup_join``: each element of the big side looks its key up in a
  unique-key table; a miss yields the literal ``"null"``.
* ``unique_lookup`` / ``duplicate_keys``: build and audit that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.fixed import COGROUP_LINE, DUPLICATE_KEY_MESSAGE, JOIN_WINDOW, NULL_TEXT
from tidewire.functions.kv import java_text
from tidewire.functions.records import bracket_join

STREAM_SIDE = 0
BOUNDED_SIDE = 1


# --------------------------------------------------------------- lookups

def unique_lookup(df: DataFrame, key: str = "key", value: str = "value",
                  on_dup: str = "fail") -> DataFrame:
    """``(key, value)`` with one row per key.

    ``on_dup='fail'`` (default): a duplicate key fails the job.  The check
    is a distributed aggregate (partial count and any-value per task,
    merged after one shuffle on the key).  It is lazy: it fires when the
    value column is computed, so keep the value column in the output of
    whatever consumes the table (see ``duplicate_keys`` for an audit).
    ``on_dup='max'`` keeps the greatest value of a duplicated key instead
    (deterministic on replay).
    """
    if on_dup == "max":
        return df.groupBy(key).agg(F.max(value).alias(value))
    if on_dup != "fail":
        raise ValueError("on_dup must be 'fail' or 'max'")
    return (df.groupBy(key)
              .agg(F.count(F.lit(1)).alias("_n"), F.any_value(value).alias("_v"))
              .select(key, F.when(F.col("_n") > 1,
                                  F.raise_error(F.concat(F.lit(DUPLICATE_KEY_MESSAGE),
                                                         java_text(key))))
                             .otherwise(F.col("_v")).alias(value)))


def checked_lookup(df: DataFrame, key: str = "key", value: str = "value",
                   on_dup: str = "fail") -> DataFrame:
    """``unique_lookup``, computed once and cut from its lineage with a
    reliable ``checkpoint()`` (written below ``spark.checkpoint.dir``).

    This runs a job (the check happens here, eagerly).  Use it for lookups
    too big to broadcast: a join whose lookup side is the uniqueness
    aggregate itself reuses that aggregate's shuffle, and AQE cannot split
    skewed keys of such a join; a checkpointed lookup gets its own join
    shuffle, which AQE can split.
    """
    from tidewire.session import reliable_checkpoint
    return reliable_checkpoint(unique_lookup(df, key, value, on_dup))


def bucketed_lookup(df: DataFrame, table: str, buckets: int, path: str | None = None,
                    key: str = "key", value: str = "value", on_dup: str = "fail") -> DataFrame:
    """Check a lookup once and save it as a table bucketed by ``key``
    (data at ``path`` when given, e.g. below the shared checkpoint folder).

    For lookups too big to broadcast that are joined again and again (every
    micro-batch of a stream): a join with a bucketed table shuffles only the
    other side, to ``buckets`` partitions, so use the stream's shuffle
    partition count.  Returns the table.
    """
    w = unique_lookup(df, key, value, on_dup).write.mode("overwrite")
    if path:
        w = w.option("path", path)
    w.bucketBy(buckets, key).saveAsTable(table)
    return df.sparkSession.table(table)


def duplicate_keys(df: DataFrame, key: str = "key") -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1))


def lookup_join(stream: DataFrame, lookup: DataFrame, key: str = "key",
                value: str = "value", lookup_value: str = "lookup_value",
                miss: str = NULL_TEXT, line: str | None = "line",
                broadcast: bool | None = None, salt: int = 1,
                broadcast_limit: int = 1_000_000) -> DataFrame:
    """Left lookup: every ``stream`` row once, plus the looked-up value.

    ``lookup`` must be unique on ``key`` (build it with ``unique_lookup``).
    The join strategy is left to Spark: it broadcasts the lookup side only
    when its estimated size is below ``spark.sql.autoBroadcastJoinThreshold``
    (and AQE re-checks with real sizes); beyond that it is a shuffle join,
    where AQE splits skewed stream partitions (when the lookup side is a
    scan or a checkpoint, see ``checked_lookup``).  ``broadcast=True``
    forces the broadcast for callers that know the lookup's size bound;
    beyond ``broadcast_limit`` rows it fails the job instead of growing.

    ``salt=s`` (shuffle joins whose hot keys AQE cannot split, for example
    when the lookup side reuses an aggregate's shuffle) spreads each key of the stream over ``s`` buckets by
    a hash of the whole row, and replicates every lookup row into the ``s``
    buckets: a hot key is then joined by ``s`` tasks, at the price of an
    ``s`` times larger lookup side.  The salt is deterministic, so a
    re-run task routes rows the same way.
    """
    lk = lookup.select(key, F.col(value).alias(lookup_value))
    on = [key]
    left = stream
    if salt > 1:
        left = stream.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in stream.columns]),
                                                 F.lit(salt)))
        lk = lk.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salt - 1).cast("long"))))
        on = [key, "_salt"]
    if broadcast:
        # the size is checked where it is broadcast: one row too many fails the job
        size = lk.agg(F.count(F.lit(1))).scalar()
        lk = F.broadcast(lk.where(F.when(size <= broadcast_limit, True).otherwise(
            F.raise_error(F.lit(f"a lookup of more than {broadcast_limit} rows is not broadcast")).cast("boolean"))))
    out = left.join(lk, on=on, how="left") \
        .withColumn(lookup_value, F.coalesce(F.col(lookup_value), F.lit(miss)))
    if salt > 1:
        out = out.drop("_salt")
    if line:
        out = out.withColumn(line, F.concat(
            F.lit(COGROUP_LINE[0]), java_text(key), F.lit(COGROUP_LINE[1]), java_text(value),
            F.lit(COGROUP_LINE[2]), F.col(lookup_value)))
    return out


# --------------------------------------------------------------- co-group

def tag_sides(left: DataFrame, right: DataFrame, key: str = "key", value: str = "value",
              ts: str | None = "ts") -> DataFrame:
    """Union of both inputs as ``(key, value[, ts], side)``; side 0 = stream."""
    cols = [F.col(key).alias("key"), F.col(value).cast("string").alias("value")]
    if ts:
        cols.append(F.col(ts).alias("ts"))
    return (left.select(*cols, F.lit(STREAM_SIDE).alias("side"))
                .unionByName(right.select(*cols, F.lit(BOUNDED_SIDE).alias("side"))))


def cogroup_counts(left: DataFrame, right: DataFrame, key: str = "key", value: str = "value",
                   ts: str | None = "ts", window: str | None = JOIN_WINDOW) -> DataFrame:
    """Long form of the co-group: ``(window_start, window_end, key, side, value, n)``.

    One aggregation whose partial counts run before the shuffle.  This is
    the scalable representation (its rows grow with distinct values, not
    with input rows), and the state a streaming co-group keeps.
    """
    tagged = tag_sides(left, right, key, value, ts if window else None)
    if window:
        # shuffle on the window start only; the end is derived afterwards
        start = F.window("ts", window).start
        return (tagged.groupBy(start.alias("window_start"), "key", "side", "value")
                      .agg(F.count(F.lit(1)).alias("n"))
                      .select("window_start",
                              (F.col("window_start") + F.expr(f"INTERVAL {window}")).alias("window_end"),
                              "key", "side", "value", "n"))
    return tagged.groupBy("key", "side", "value").agg(F.count(F.lit(1)).alias("n"))


def format_cogroup(counts: DataFrame, windowed: bool = True) -> DataFrame:
    """Long form -> one line per (window, key):
    ``K: [k], SVs: [v],[v],, BVs: [w],``.  A key seen on one side only
    still gets a line, with the other list empty."""
    keys = ["window_start", "key"] if windowed else ["key"]
    entry = F.struct(F.col("value"), F.col("n"))
    return (counts.groupBy(*keys)
                  .agg(F.collect_list(F.when(F.col("side") == STREAM_SIDE, entry)).alias("_s"),
                       F.collect_list(F.when(F.col("side") == BOUNDED_SIDE, entry)).alias("_b"))
                  .select(*keys, F.concat(F.lit(COGROUP_LINE[0]), java_text("key"), F.lit(COGROUP_LINE[1]),
                                          bracket_join("_s"), F.lit(COGROUP_LINE[2]),
                                          bracket_join("_b")).alias("line")))


def windowed_cogroup(left: DataFrame, right: DataFrame, key: str = "key", value: str = "value",
                     ts: str = "ts", window: str | None = JOIN_WINDOW) -> DataFrame:
    """Co-group two keyed inputs on key and tumbling window (``window=None``:
    one global window).  Output ``(window_start, key, line)`` / ``(key, line)``.

    Plan: tagged union -> partial count -> shuffle on (window, key, side,
    value) -> final count -> shuffle on (window, key) -> collect of distinct
    ``(value, n)`` pairs.  No Python, no join, no per-pair output.
    """
    counts = cogroup_counts(left, right, key, value, ts, window)
    return format_cogroup(counts, windowed=window is not None)
