"""Text and sequence sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def text_lines(spark: SparkSession, path: str, streaming: bool = False,
               files_per_trigger: int | None = None) -> DataFrame:
    """One row per line (column ``value``); splittable, read in parallel.
    ``streaming=True`` watches the directory for new files."""
    if not streaming:
        return spark.read.text(path)
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def sequence(spark: SparkSession, start: int = 0, end: int | None = None,
             rows_per_batch: int = 1000, partitions: int | None = None) -> DataFrame:
    """Consecutive longs ``value`` from ``start``.

    Bounded (``end`` given): ``spark.range``, split over ``partitions``.
    Unbounded: the deterministic ``rate-micro-batch`` source, which emits
    ``rows_per_batch`` values per micro-batch with a ``timestamp`` column.
    """
    if end is not None:
        return spark.range(start, end, numPartitions=partitions).withColumnRenamed("id", "value")
    df = (spark.readStream.format("rate-micro-batch")
               .option("rowsPerBatch", rows_per_batch)
               .option("numPartitions", partitions or spark.sparkContext.defaultParallelism)
               .load())
    return df.withColumn("value", F.col("value") + F.lit(start))
