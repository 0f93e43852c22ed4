"""Complete windows and running side inputs, across late slices and replayed batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewire.sinks import read_batches
from tidewire.sinks.windows import _commits, complete_windows, complete_windows_sink, complete_windows_writer, read_complete_windows
from tidewire.sinks.ledger import Files
from tidewire.streaming import run_available
from tidewire.streaming.side_input import publish_max, versions, with_side_input

START = dt.datetime(2024, 1, 1)
SCHEMA = "id long, ts timestamp"


def _slice(spark, path, i, seconds):
    spark.createDataFrame([(s, START + dt.timedelta(seconds=s)) for s in seconds], SCHEMA).write.parquet(f"{path}/in/slice={i}")
    return spark.readStream.schema(SCHEMA).parquet(f"{path}/in/slice={{{','.join(map(str, range(i + 1)))}}}")


def _ids(spark, path):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampType())])
    return sorted(r.id for r in read_complete_windows(spark, path, schema).collect())


def test_open_windows_are_invisible_and_late_rows_do_not_reopen_them(spark, scratch):
    def run(i, seconds):
        run_available(complete_windows_sink(_slice(spark, scratch, i, seconds), scratch, f"{scratch}/ck"))
    assert _ids(spark, scratch) == []
    run(0, [1, 2, 7, 30])  # reaches 30 s: windows up to 10 s are complete
    assert _ids(spark, scratch) == [1, 2, 7]
    run(1, [3, 14, 31])  # 3 s is late for its window; 14 s is not
    assert _ids(spark, scratch) == [1, 2, 7]
    run(2, [13, 12, 45])  # completes [10, 15), [15, 20), [20, 25)
    assert _ids(spark, scratch) == [1, 2, 7, 12, 13, 14]
    got = {r.window_start.second: r.rows for r in complete_windows(spark, scratch).collect()}
    assert got == {0: 2, 5: 1, 10: 3}
    assert [c["late_rows"] for c in _commits(Files(spark, scratch))][:1] == [0]
    assert sum(c["late_rows"] for c in _commits(Files(spark, scratch))) == 1


def test_windows_survive_a_crash_before_the_commit(spark, scratch, monkeypatch):
    df = _slice(spark, scratch, 0, [1, 2, 60])
    with monkeypatch.context() as m:
        m.setattr(Files, "create", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            run_available(complete_windows_sink(df, scratch, f"{scratch}/ck"))
    assert _ids(spark, scratch) == []
    run_available(complete_windows_sink(df, scratch, f"{scratch}/ck"))
    assert _ids(spark, scratch) == [1, 2]
    assert {r.rows for r in complete_windows(spark, scratch).collect()} == {2}


def test_windows_go_on_with_a_new_checkpoint(spark, scratch):
    """The commits, not the checkpoint, hold the watermark: what was complete stays so."""
    run_available(complete_windows_sink(_slice(spark, scratch, 0, [1, 60]), scratch, f"{scratch}/ck"))
    spark.createDataFrame([(100, START + dt.timedelta(seconds=100)), (2, START + dt.timedelta(seconds=2))], SCHEMA).write.parquet(f"{scratch}/more/s=0")
    more = spark.readStream.schema(SCHEMA).parquet(f"{scratch}/more/s=0")
    run_available(complete_windows_sink(more, scratch, f"{scratch}/ck2"))
    assert _ids(spark, scratch) == [1, 60]


def test_writer_outside_a_query_fails(spark, scratch):
    with pytest.raises(RuntimeError, match="not known"):
        complete_windows_writer(scratch)(spark.createDataFrame([], SCHEMA), 0)


def test_a_replayed_batch_sees_the_version_it_saw_first(spark, scratch):
    df = _slice(spark, scratch, 0, [3, 8])
    run_available(publish_max(df, F.col("id"), f"{scratch}/side", f"{scratch}/ck-side"))
    calls = []

    def use(batch, value):
        calls.append(value)
        if len(calls) == 1:
            raise RuntimeError("lost in the batch")
        return batch.where(F.col("id") * 2 <= F.lit(value)).withColumn("cutoff", F.lit(value).cast("long"))
    with pytest.raises(Exception, match="lost in the batch"):
        run_available(with_side_input(df, f"{scratch}/side", use, f"{scratch}/out", f"{scratch}/ck"))
    run_available(publish_max(_slice(spark, scratch, 1, [50]), F.col("id"), f"{scratch}/side", f"{scratch}/ck-side"))
    assert [v["value"] for v in versions(spark, f"{scratch}/side")] == [8, 50]
    run_available(with_side_input(df, f"{scratch}/side", use, f"{scratch}/out", f"{scratch}/ck"))
    assert calls == [8, 8]
    assert [(r.id, r.cutoff) for r in read_batches(spark, f"{scratch}/out").collect()] == [(3, 8)]
    both = spark.readStream.schema(SCHEMA).parquet(f"{scratch}/in/slice={{0,1}}")
    run_available(with_side_input(both, f"{scratch}/side", use, f"{scratch}/out", f"{scratch}/ck"))
    assert calls == [8, 8, 50]


def test_a_side_input_without_a_version_is_none(spark, scratch):
    df = _slice(spark, scratch, 0, [3])
    run_available(with_side_input(df, f"{scratch}/side", lambda b, v: b.withColumn("cutoff", F.lit(v).cast("long")),
                                  f"{scratch}/out", f"{scratch}/ck"))
    assert [r.cutoff for r in read_batches(spark, f"{scratch}/out").collect()] == [None]
