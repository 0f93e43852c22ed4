"""Replay-safe (effectively exactly-once) streaming output.

Each micro-batch is written to a directory of its own, named by the streaming
query's id and the batch id, in overwrite mode.  If a batch is re-run after a
failure (Spark re-runs the last uncommitted batch with the same id and the
same input offsets), it replaces its earlier output instead of adding to it.  A
query with a new checkpoint has another id, so it never touches what an older one
wrote.  The same sink takes update-mode output, which Spark's file sink does
not accept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def batch_writer(path: str, fmt: str = "parquet", query_id: str | None = None):
    """The ``foreachBatch`` function: overwrite ``<path>/query_id=<q>/batch_id=<n>``;
    the running query's id unless ``query_id`` is given."""
    def write(batch: DataFrame, batch_id: int) -> None:
        query = query_id or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query:
            raise RuntimeError("the streaming query's id is not known in this batch")
        batch.write.mode("overwrite").format(fmt).save(f"{path}/query_id={query}/batch_id={batch_id}")
    return write


def replay_safe_sink(df: DataFrame, path: str, checkpoint: str, output_mode: str = "append",
                     fmt: str = "parquet"):
    """A ``DataStreamWriter`` (not started) writing through ``batch_writer``."""
    return (df.writeStream.outputMode(output_mode)
              .option("checkpointLocation", checkpoint)
              .foreachBatch(batch_writer(path, fmt)))


def _fs(spark, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def complete_batches(spark, path: str) -> list[str]:
    """Directories of the batches whose write job has committed."""
    p, fs = _fs(spark, f"{path}/query_id=*/batch_id=*/_SUCCESS")
    return sorted(s.getPath().getParent().toString() for s in fs.globStatus(p) or [])


def read_batches(spark, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """All batches completely written so far, with their ``query_id`` and
    ``batch_id`` columns.  Without any, ``schema`` gives the empty result."""
    found = complete_batches(spark, path)
    if not found:
        if schema is None:
            raise FileNotFoundError(f"no complete batch below {path}")
        return spark.createDataFrame([], schema)
    return spark.read.option("basePath", path).format(fmt).load(found)


def _one_query():
    """The query that wrote a pane; a fold counts as the query it was folded from."""
    return F.regexp_replace("query_id", "-fold-.*$", "")


def latest_pane(df: DataFrame, keys, batch_col: str = "batch_id",
                keep_batch: bool = False) -> DataFrame:
    """Per group, the row of the highest batch id (the last, most complete
    pane of an update-mode aggregate).  ``max_by`` combines map-side, so no
    group is gathered whole, but its buffer is a struct, so Spark sorts by
    the keys on both sides of the shuffle; for counts use ``latest_count``.
    Batch ids of two queries cannot be compared, so a group that two queries wrote to fails
    the job.  ``keep_batch`` keeps the winning batch id as a column."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in keys and c not in (batch_col, "query_id")]
    if keep_batch:
        rest.append(batch_col)
    last = F.max_by(F.struct(*rest), F.col(batch_col)).alias("_last")
    if "query_id" not in df.columns:
        one = df.groupBy(*keys).agg(last)
    else:
        query = _one_query()
        one = df.groupBy(*keys).agg(last, F.min(query).alias("_q0"), F.max(query).alias("_q1")).withColumn(
            "_last", F.when(F.col("_q0") == F.col("_q1"), F.col("_last")).otherwise(F.raise_error(F.concat(
                F.lit("panes of one group come from two queries: "), "_q0", F.lit(", "), "_q1"))))
    return one.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])


def latest_count(df: DataFrame, keys, count: str = "n") -> DataFrame:
    """Per group, the last pane of a count: within one query a group's count
    only grows, so that is its maximum, a plain hash aggregate.  What several queries have
    counted (``query_id``), each from where the one before it stopped, is added up."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if "query_id" not in df.columns:
        return df.groupBy(*keys).agg(F.max(count).alias(count))
    each = df.groupBy(*keys, _one_query().alias("_query")).agg(F.max(count).alias(count))
    return each.groupBy(*keys).agg(F.sum(count).alias(count))


def compact_panes(spark, path: str, keys, batch_col: str = "batch_id", fmt: str = "parquet") -> None:
    """Fold the complete batches of each query into one that holds the latest
    pane per group.  It is written beside them under a query id of its own, as the
    last batch folded, and they go only after it has committed; the newest batch,
    which a restart may write again, is left alone.

    Batch ids stay in the output, so ``latest_pane`` gives the same result before
    and after.  A crash in between leaves both the fold and its inputs: the same
    panes twice, which ``latest_pane`` folds again."""
    found = complete_batches(spark, path)
    by_query: dict[str, list[str]] = {}
    for d in found:
        by_query.setdefault(d.split("query_id=")[1].split("/")[0], []).append(d)
    for query, dirs in by_query.items():
        dirs.sort(key=lambda d: int(d.rsplit("batch_id=", 1)[1]))
        old = dirs[:-1]
        if len(old) < 2:
            continue
        last = old[-1].rsplit("batch_id=", 1)[1]
        panes = spark.read.option("basePath", path).format(fmt).load(old)
        folded = latest_pane(panes, keys, batch_col).select(
            *[c for c in panes.columns if c not in ("query_id", batch_col)])
        fold = f"{path}/query_id={query.split('-fold-')[0]}-fold-{uuid.uuid4().hex[:8]}/batch_id={last}"
        folded.write.format(fmt).save(fold)
        for d in old:
            p, fs = _fs(spark, d)
            fs.delete(p, True)
