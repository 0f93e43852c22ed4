"""Aggregations: grouped value lists, global maximum, filters against a
data-derived global value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.records import bracket_join


def value_counts(df: DataFrame, keys, value: str) -> DataFrame:
    """``(keys..., value, n)``: how often each value occurs per group.

    This is the pre-aggregation step of every list-building operator: the
    partial count runs map-side, and the shuffle is hashed on the keys *and*
    the value, so a hot key with many distinct values is spread over many
    reducers instead of landing on one.
    """
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def bracket_list(df: DataFrame, keys, value: str, out: str = "values") -> DataFrame:
    """Per group, all values as ``[v],[v],`` (sorted; empty string if none).

    Two aggregations: (1) value counts per group, combined map-side;
    (2) one small ``collect_list`` of ``(value, n)`` per group.  The second
    buffer holds distinct values only, never the group's raw rows.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    counts = value_counts(df, keys, value)
    return (counts.groupBy(*keys)
                  .agg(F.collect_list(F.struct(F.col(value).alias("value"), "n")).alias("_e"))
                  .select(*keys, bracket_join("_e").alias(out)))


def global_max(df: DataFrame, expr: Column | str, out: str = "max_value") -> DataFrame:
    """One-row maximum (partial max per task, one tiny final merge)."""
    e = F.col(expr) if isinstance(expr, str) else expr
    return df.agg(F.max(e).alias(out))


def filter_by_global(df: DataFrame, expr: Column, cutoff: DataFrame, op: str = "<=") -> DataFrame:
    """Keep rows where ``expr <op> cutoff`` for a one-row, one-column ``cutoff``.

    ``cutoff`` becomes an uncorrelated scalar subquery: Spark computes it
    once and inlines the value into the filter, so nothing is joined or
    broadcast and the big side is never shuffled.
    """
    value = cutoff.scalar()
    ops = {"<=": expr <= value, "<": expr < value, ">=": expr >= value,
           ">": expr > value, "==": expr == value}
    if op not in ops:
        raise ValueError(f"unsupported comparison {op!r}")
    return df.filter(ops[op])
