"""Sink groups, recorded offsets and bounded drains: restarts without loss or repeat."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidewire.plans.ledger_queries import GROUP, PARTITIONS, copy_from_record, resume_from_record
from tidewire.sinks import read_batches
from tidewire.sinks.ledger import FOLD, Ledger, drain, ledger_sink, ledger_writer, read_group
from tidewire.streaming import run_available
from tidewire.streaming.offsets import end_offsets, recorded_offsets

SCHEMA = "topic string, partition int, offset long, timestamp timestamp, value string"


def _rows(lo, hi):
    """Offsets ``lo .. hi - 1``, dealt to the partitions; one record a second."""
    start = dt.datetime(2024, 1, 1)
    return [("input", i % PARTITIONS, i, start + dt.timedelta(seconds=i), f"v{i}") for i in range(lo, hi)]


def _write(spark, path, i, lo, hi):
    spark.createDataFrame(_rows(lo, hi), SCHEMA).write.parquet(f"{path}/in/slice={i}")


def _read(spark, path, upto):
    return spark.readStream.schema(SCHEMA).parquet(f"{path}/in/slice={{{','.join(map(str, range(upto + 1)))}}}")


def _held(spark, path):
    return sorted(r.offset for r in read_group(spark, path, GROUP, SCHEMA).collect())


def test_a_new_checkpoint_copies_no_offset_twice(spark, scratch):
    for i in range(3):
        _write(spark, scratch, i, 40 * i, 40 * i + 40)
    for k, upto in enumerate((0, 1, 2, 2)):  # each with its own checkpoint: the whole topic again
        run_available(ledger_sink(_read(spark, scratch, upto), scratch, GROUP, f"{scratch}/ck{k}"))
        assert _held(spark, scratch) == list(range(40 * upto + 40))
    ledger = Ledger(spark, scratch, GROUP)
    assert ledger.positions() == {("input", p): max(range(p, 120, PARTITIONS)) + 1 for p in range(PARTITIONS)}
    assert json.loads(ledger.starting_offsets()) == {"input": {str(p): max(range(p, 120, 3)) + 1 for p in range(3)}}


def test_a_crash_between_write_and_commit_leaves_nothing_behind(spark, scratch, monkeypatch):
    _write(spark, scratch, 0, 0, 30)

    def broken(self, *a):
        raise RuntimeError("lost before the commit")
    with monkeypatch.context() as m:
        m.setattr(Ledger, "commit", broken)
        with pytest.raises(Exception, match="lost before the commit"):
            run_available(ledger_sink(_read(spark, scratch, 0), scratch, GROUP, f"{scratch}/ck"))
    assert _held(spark, scratch) == []  # its files are there, no commit names them
    run_available(ledger_sink(_read(spark, scratch, 0), scratch, GROUP, f"{scratch}/ck"))
    _write(spark, scratch, 1, 30, 50)
    run_available(ledger_sink(_read(spark, scratch, 1), scratch, GROUP, f"{scratch}/other"))
    assert _held(spark, scratch) == list(range(50))


def test_a_crash_between_commit_and_checkpoint_does_not_write_again(spark, scratch):
    """The batch runs again with the same id; the ledger holds it, so nothing is written."""
    _write(spark, scratch, 0, 0, 30)
    stop = []

    def dies_late(df, ck):
        write = ledger_writer(scratch, GROUP)

        def once(batch, batch_id):
            write(batch, batch_id)
            if not stop:
                stop.append(1)
                raise RuntimeError("lost before the checkpoint")
        return df.writeStream.option("checkpointLocation", ck).foreachBatch(once)
    with pytest.raises(Exception, match="lost before the checkpoint"):
        run_available(dies_late(_read(spark, scratch, 0), f"{scratch}/ck"))
    run_available(dies_late(_read(spark, scratch, 0), f"{scratch}/ck"))
    assert _held(spark, scratch) == list(range(30))
    assert len(Ledger(spark, scratch, GROUP).commits()) == 1


def test_a_query_that_lost_the_group_fails(spark, scratch):
    ledger = Ledger(spark, scratch, GROUP)
    first = ledger.take_over("one")
    assert ledger.take_over("one") == first
    ledger.commit("one", first, 0, [["input", 0, 5]], 5)
    assert ledger.take_over("two") == first + 1
    with pytest.raises(RuntimeError, match="no longer holds"):
        ledger.commit("one", first, 1, [["input", 0, 9]], 4)
    ledger.commit("two", first + 1, 0, [["input", 0, 7]], 2)
    assert ledger.positions() == {("input", 0): 7}


def test_old_commits_are_folded(spark, scratch):
    ledger = Ledger(spark, scratch, GROUP)
    epoch = ledger.take_over("one")
    for i in range(FOLD + 20):
        ledger.commit("one", epoch, i, [["input", 0, i + 1]], 1)
    assert len(ledger.files.names("ledger")) <= FOLD
    assert [c["batch"] for c in ledger.commits()] == list(range(FOLD + 20))


def test_drain_by_count_stops_inside_a_batch_and_goes_on_behind_the_cut(spark, scratch):
    for i in range(3):
        _write(spark, scratch, i, 40 * i, 40 * i + 40)
    assert drain(_read(spark, scratch, 2), scratch, GROUP, f"{scratch}/ck0", for_count=50)
    assert _held(spark, scratch) == list(range(50))
    assert drain(_read(spark, scratch, 2), scratch, GROUP, f"{scratch}/ck1", for_count=31)
    assert _held(spark, scratch) == list(range(81))
    assert not drain(_read(spark, scratch, 2), scratch, GROUP, f"{scratch}/ck2", for_count=1000)
    assert _held(spark, scratch) == list(range(120))


def test_drain_by_time_keeps_a_prefix_of_every_partition(spark, scratch):
    rows = _rows(0, 60)
    rows[10] = (*rows[10][:3], dt.datetime(2024, 1, 2), "ahead")  # its partition is cut here
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{scratch}/in/slice=0")
    until = dt.datetime(2024, 1, 1, 0, 0, 30)
    assert drain(_read(spark, scratch, 0), scratch, GROUP, f"{scratch}/ck0", until=until)
    assert _held(spark, scratch) == [i for i in range(30) if i % 3 != 10 % 3 or i < 10]
    run_available(ledger_sink(_read(spark, scratch, 0), scratch, GROUP, f"{scratch}/ck1"))
    assert _held(spark, scratch) == list(range(60))


def test_a_drain_needs_one_bound(spark, scratch):
    with pytest.raises(ValueError):
        drain(spark.readStream.format("rate").load(), scratch, GROUP, f"{scratch}/ck")


def test_a_start_from_recorded_offsets_loses_and_repeats_nothing(spark, scratch):
    topic = [_rows(0, 40), _rows(40, 80), _rows(80, 120)]

    def read(upto):
        rows = spark.readStream.schema("topic string, partition int, offset long, key binary, value binary").parquet(
            f"{scratch}/in/slice={{{','.join(map(str, range(upto + 1)))}}}")
        return rows
    for i, part in enumerate(topic):
        spark.createDataFrame(part, SCHEMA).select("topic", "partition", "offset", F.encode(F.lit("k"), "UTF-8").alias("key"),
                                                   F.encode("value", "UTF-8").alias("value")).write.parquet(f"{scratch}/in/slice={i}")
    copy_from_record(spark, read(0), f"{scratch}/a", f"{scratch}/a/ck")
    assert recorded_offsets(spark, f"{scratch}/a", GROUP) == {"input": {str(p): max(range(p, 40, 3)) + 1 for p in range(3)}}
    # another consumer of the group, with another checkpoint and the whole topic before it
    resume_from_record(spark, read(2), f"{scratch}/a", f"{scratch}/a/ck-new")
    got = sorted(r.offset for r in read_batches(spark, f"{scratch}/a/data").collect())
    assert got == list(range(120))
    assert recorded_offsets(spark, f"{scratch}/a", GROUP) == {"input": {str(p): max(range(p, 120, 3)) + 1 for p in range(3)}}


def test_end_offsets_of_the_broker_source():
    class Source:
        endOffset = '{"t":{"0":23,"1":-1}}'

    class Files:
        endOffset = '{"logOffset":3}'

    class Progress:
        sources = [Source(), Files()]
        observedMetrics = {}
    assert end_offsets(Progress()) == {"t": {"0": 23, "1": -1}}
