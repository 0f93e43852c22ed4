"""Broker-shaped records and their replay in time slices.

Without a broker, a stream is replayed from Parquet files that Spark
writes from a table, one directory per time slice, in one pass of all tasks.
The streaming query is then run once per slice, resuming from its checkpoint, so
that every slice is one micro-batch.  The rows have the broker source's
columns, so the same downstream code runs against a real topic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.time import epoch_micros, ntz_to_instant

BROKER_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])


def as_broker_records(df: DataFrame, key: Column, value: Column, offset: Column,
                      ts: Column, topic: str = "input", partition: int = 0,
                      ts_is_ntz: bool = True,
                      timestamp_type: int = 0) -> DataFrame:
    """Rows shaped like the broker source: key/value bytes plus metadata
    (``timestamp_type`` 0: set by the producer, 1: by the broker at append)."""
    instant = ntz_to_instant(ts) if ts_is_ntz else ts
    return df.select(
        F.encode(key.cast("string"), "UTF-8").alias("key"),
        F.encode(value.cast("string"), "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(partition).cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        instant.alias("timestamp"),
        F.lit(timestamp_type).alias("timestampType"),
    )


def time_slices(df: DataFrame, ts: str, slices: int, out: str = "slice") -> DataFrame:
    """Tag rows with ``slice`` in ``0..slices-1``: equal event-time ranges.

    Integer arithmetic on epoch microseconds; the bounds are two scalar
    subqueries (one partial min/max per task).
    """
    us = epoch_micros(ts) if dict(df.dtypes)[ts] == "timestamp_ntz" else F.unix_micros(F.col(ts))
    # one subquery for both bounds (Spark reuses it for both references)
    bounds = df.agg(F.struct(F.min(us).alias("lo"), F.max(us).alias("hi"))).scalar()
    lo, hi = bounds.getField("lo"), bounds.getField("hi")
    slice_us = F.call_function("div", hi - lo, F.lit(slices).cast("bigint")) + F.lit(1)
    return df.withColumn(out, F.call_function("div", us - lo, slice_us).cast("int"))


def write_slices(df: DataFrame, path: str, slice_col: str = "slice", fmt: str = "parquet") -> None:
    """Write the rows once, by all tasks, one directory per slice."""
    df.write.mode("append").partitionBy(slice_col).format(fmt).save(path)


def read_slices(spark: SparkSession, path: str, upto: int, schema: T.StructType = BROKER_SCHEMA,
                fmt: str = "parquet") -> DataFrame:
    """Stream the slices ``0 .. upto``.  A query that is run once per slice,
    with ``upto`` one higher each time and the same checkpoint, finds the earlier
    slices' files in its log and takes the new slice as one micro-batch, however
    many files it has."""
    slices = ",".join(str(i) for i in range(upto + 1))
    return spark.readStream.format(fmt).schema(schema).load(f"{path.rstrip('/')}/slice={{{slices}}}")
