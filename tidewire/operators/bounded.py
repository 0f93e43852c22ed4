"""Make an unbounded input bounded: by event time or by record count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_by_time(df: DataFrame, ts: str = "ts", duration: str = "10 seconds") -> DataFrame:
    """Rows whose event time is before ``first event time + duration``.

    The original caps *reading time* on the wall clock, which depends on
    machine speed; capping by the records' own time gives the same
    answer on every run.  The start is an uncorrelated scalar subquery
    (one partial/final ``min``) that already holds the end, so the filter
    compares the column with a plain value, which reaches the scan.
    """
    end = df.agg((F.min(ts) + F.expr(f"INTERVAL {duration}")).alias("end")).scalar()
    return df.filter(F.col(ts) < end)


def bounded_by_count(df: DataFrame, order_col: str = "offset", n: int = 5) -> DataFrame:
    """The first ``n`` records in ``order_col`` order (batch input).

    Spark plans this as a per-task top-``n`` followed by one merge of at
    most ``n x tasks`` rows, never a full sort.
    """
    return df.orderBy(F.col(order_col).asc()).limit(n)
