"""Running numbers and sums over a whole table without a window over one partition.

Two passes: the rows are range-partitioned and sorted once, written, and counted per
range; the ranges' totals, one row per range, become prefix sums; a row's number is
its range's prefix and its place inside the range.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.fixed import BRACKET_ITEM, NULL_TEXT, ROUTE_TOPICS
from tidewire.functions.kv import alternate_topic
from tidewire.functions.records import bracket_join
from tidewire.operators.aggs import value_counts
from tidewire.session import reliable_checkpoint

_PLACE_BITS = 33  # ``monotonically_increasing_id``: the partition above 33 bits of the row's place


def in_ranges(df: DataFrame, *order: str) -> DataFrame:
    """``df`` in ranges of ``order``, written once; ``_range`` and ``_place`` (from 0, in
    order) say where a row stands."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    return reliable_checkpoint(placed).withColumns({
        "_range": F.shiftright("_id", _PLACE_BITS).cast("int"),
        "_place": F.col("_id").bitwiseAND((1 << _PLACE_BITS) - 1)}).drop("_id")


def dense_numbers(df: DataFrame, *order: str, out: str = "number") -> DataFrame:
    """Number the rows 0, 1, 2, ... in ``order`` (ties in any order).  One shuffle; the driver sees
    one count per range."""
    rows = in_ranges(df, *order)
    held = {r["_range"]: r["n"] for r in rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = [held.get(i, 0) for i in range(max(held, default=-1) + 1)]
    before = [0, *accumulate(counts)][:len(counts)] or [0]
    first = F.element_at(F.array(*[F.lit(b).cast("long") for b in before]), F.col("_range") + 1)
    return rows.withColumn(out, first + F.col("_place")).drop("_range", "_place")


def route_dense(df: DataFrame, order: str = "offset", topics=ROUTE_TOPICS, topic_col: str = "topic") -> DataFrame:
    """Add a ``topic`` column that strictly alternates between two topics in ``order``, whatever gaps
    the offsets of a compacted or transactional topic have."""
    even, odd = topics
    return dense_numbers(df, order, out="_number").withColumn(
        topic_col, alternate_topic("_number", even, odd)).drop("_number")


def bracket_parts(df: DataFrame, keys, value: str, limit: int = 1 << 20, out: str = "values") -> DataFrame:
    """Per group, all values as ``[v],[v],`` in numbered parts: ``(keys..., part, values)``, whose texts in the
    order of ``part`` make the list that ``bracket_list`` gives as one line.

    A part holds the items that begin in its ``limit`` characters of the list, so it is at most one
    item longer.  No group is gathered: equal values are counted, the counts are range-partitioned by
    group and value, and prefix sums of the rendered lengths (inside a range, then over a group's
    ranges) place every value; one that fills several parts is split by arithmetic."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    text = F.concat(F.lit(BRACKET_ITEM[0]), F.coalesce(F.col(value).cast("string"), F.lit(NULL_TEXT)), F.lit(BRACKET_ITEM[1]))
    # a null stands first, as in a sorted array
    rows = in_ranges(value_counts(df, keys, value).withColumn("_size", F.length(text).cast("long")), *keys, value)
    inside = Window.partitionBy(*keys, "_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    spans = rows.groupBy(*keys, "_range").agg(F.sum(F.col("n") * F.col("_size")).alias("_span")).withColumn(
        "_ahead", F.coalesce(F.sum("_span").over(ahead), F.lit(0)))  # a group's ranges: few rows
    spans = spans.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_range").alias("_in"), "_ahead")
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    placed = rows.join(spans, [*same, F.col("_range") == F.col("_in")]).select(
        *keys, F.col(value).alias("_value"), "n", "_size", "_range", "_place", "_ahead")
    begin = F.col("_ahead") + F.coalesce(F.sum(F.col("n") * F.col("_size")).over(inside), F.lit(0))
    placed = placed.withColumn("_begin", begin)
    last = F.col("_begin") + (F.col("n") - 1) * F.col("_size")
    cut = placed.withColumn("part", F.explode(F.sequence(F.expr(f"_begin div {limit}"), F.call_function("div", last, F.lit(limit).cast("long")))))

    def items_before(start):  # of this value, those that begin in front of ``start``
        return F.least(F.col("n"), F.greatest(F.lit(0).cast("long"), F.call_function(
            "div", start - F.col("_begin") + F.col("_size") - 1, F.col("_size"))))
    held = cut.withColumn("n", items_before((F.col("part") + 1) * limit) - items_before(F.col("part") * limit)).where("n > 0")
    return held.groupBy(*keys, "part").agg(F.collect_list(F.struct(F.col("_value").alias("value"), "n")).alias("_e")).select(
        *keys, "part", bracket_join("_e").alias(out))
