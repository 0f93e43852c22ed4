"""Key/value shaping steps: DataFrame -> DataFrame, batch or streaming.

None of these shuffles: each is a projection or a filter that Spark
fuses into the scan's whole-stage-codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.fixed import NULL_TEXT, PREFIX_SEPARATOR, ROUTE_TOPICS
from tidewire.functions.kv import (
    alternate_topic,
    csv_field,
    csv_pair_valid,
    long_from_bytes,
    null_to_literal as _null_to_literal,
    prefixed,
)

BAD_POLICIES = ("fail", "drop", "quarantine")


def decode_kv(df: DataFrame, key_type: str = "string", keep: tuple[str, ...] = ()) -> DataFrame:
    """Broker record -> ``(key, value)`` text, dropping source metadata.

    ``key_type='long'`` reads the key as a signed big-endian 8-byte number.
    ``keep`` names metadata columns to retain (e.g. ``offset``).
    """
    if key_type == "string":
        key = F.col("key").cast("string")
    elif key_type == "long":
        key = long_from_bytes("key")
    else:
        raise ValueError(f"unknown key_type {key_type!r}")
    return df.select(*keep, key.alias("key"), F.col("value").cast("string").alias("value"))


def values_only(df: DataFrame, value: str = "value") -> DataFrame:
    """Keep only the value column."""
    return df.select(value)


def _failing(valid: Column, line: Column, result: Column) -> Column:
    return F.when(valid, result).otherwise(
        F.raise_error(F.concat(F.lit("line has fewer than two fields: "),
                               F.coalesce(line, F.lit("null")))))


def parse_csv_kv(df: DataFrame, line: str = "value", on_bad: str = "fail",
                 key: str = "key", value: str = "value", keep: tuple[str, ...] = ()):
    """Cut ``k,v[,...]`` text into ``(key, value)``; the old key is ignored.

    A line with fewer than two fields (see ``csv_pair_valid``) is handled by
    ``on_bad``: ``'fail'`` raises when the row is computed (the default,
    like the per-element exception of the original), ``'drop'`` filters it
    out, ``'quarantine'`` returns ``(good, rejects)``.
    """
    if on_bad not in BAD_POLICIES:
        raise ValueError(f"on_bad must be one of {BAD_POLICIES}")
    src = F.col(line)
    valid = F.coalesce(csv_pair_valid(src), F.lit(False))
    k, v = csv_field(src, 1), csv_field(src, 2)
    if on_bad == "fail":
        # both outputs carry the check so that pruning one keeps it alive
        return df.select(*keep, _failing(valid, src, k).alias(key), _failing(valid, src, v).alias(value))
    good = df.filter(valid).select(*keep, k.alias(key), v.alias(value))
    if on_bad == "drop":
        return good
    rejects = df.filter(~valid)
    return good, rejects


def null_to_literal(df: DataFrame, cols=("key", "value"), literal: str = NULL_TEXT) -> DataFrame:
    """Replace NULL by ``literal`` in ``cols`` (other columns unchanged)."""
    return df.withColumns({c: _null_to_literal(c, literal) for c in cols})


def route_alternate(df: DataFrame, seq: str = "offset", topics=ROUTE_TOPICS,
                    topic_col: str = "topic") -> DataFrame:
    """Add a ``topic`` column alternating between two topics by ``seq`` parity."""
    even, odd = topics
    return df.withColumn(topic_col, alternate_topic(seq, even, odd))


def prefix(df: DataFrame, col: str, prefix_value: str, out: str | None = None,
           sep: str = PREFIX_SEPARATOR) -> DataFrame:
    """``<prefix>_<value>`` with a run-time parameter."""
    return df.withColumn(out or col, prefixed(col, prefix_value, sep))


def text_to_lines(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                  line: str = "line", line_no: str = "line_no") -> DataFrame:
    """Whole texts -> one row per ``\\n``-separated line (1-based numbers)."""
    return df.select(*keep, F.posexplode(F.split(F.col(text), "\n")).alias("_pos", line)) \
        .select(*keep, (F.col("_pos") + 1).cast("bigint").alias(line_no), line)
