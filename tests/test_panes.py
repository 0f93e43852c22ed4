"""Timer and late panes; folding of panes by query."""

import pytest
from pyspark.sql import functions as F

from tidewire.sinks import latest_count, latest_pane, read_batches
from tidewire.streaming import run_early, run_timers
from tidewire.streaming.panes import PANE_ROWS, late_panes, millis, timer_panes

BASE_MS = 1704067200000  # 2024-01-01


def _topic(spark, path, i, rows):
    """Slice ``i`` of a topic of ``(key, value, millisecond)``, and the stream up to it."""
    spark.createDataFrame(rows, "key string, value string, ms long").write.parquet(f"{path}/slice={i}")
    upto = ",".join(map(str, range(i + 1)))
    rows = spark.readStream.schema("key string, value string, ms long").parquet(f"{path}/slice={{{upto}}}")
    return rows.withColumn("ts", F.timestamp_millis(F.col("ms") + BASE_MS))


def _panes(spark, path):
    rows = read_batches(spark, path, schema=PANE_ROWS).collect()
    return sorted((r.key, r.window_start.second, r.kind, r.pane, r.value or "", r.n) for r in rows)


LATE_SLICES = [
    [("a", "x", 1000), ("a", "y", 2000), ("b", None, 21000), ("a", "x", 3000)],   # passes 20 s
    [("a", "x", 4000), ("b", "z", 40500)],                                        # late for a; passes 40 s
    [("a", "late", 5000), ("c", "q", 100000), ("b", "m", 39000)],                 # late, judged at 40.5 s
    [("a", "gone", 1000), ("b", "l2", 39999), ("c", "q", 85000), ("c", "w", 150000)],
]
LATE_WANT = sorted([
    ("a", 0, "on-time", 0, "x", 2), ("a", 0, "on-time", 0, "y", 1), ("a", 0, "late", 1, "x", 3), ("a", 0, "late", 1, "y", 1),
    ("b", 20, "on-time", 0, "", 1), ("b", 20, "late", 1, "", 1), ("b", 20, "late", 1, "m", 1), ("b", 40, "on-time", 0, "z", 1),
    ("c", 20, "late", 0, "q", 1),   # its first row comes after the window has passed: 85 s of [80, 100)
    ("c", 40, "on-time", 0, "q", 1)])


def test_late_rows_fire_their_window_again(spark, scratch):
    """``a`` at 5 s arrives when its lateness is over (40.5 s), ``b`` at 39.999 s as well (100 s)."""
    for i, rows in enumerate(LATE_SLICES):
        run_early(late_panes(_topic(spark, f"{scratch}/in", i, rows), window="20 seconds", lateness="20 seconds"),
                  f"{scratch}/out", f"{scratch}/ck")
    assert _panes(spark, f"{scratch}/out") == LATE_WANT


def test_late_panes_of_a_split_key_hold_the_same_counts(spark, scratch):
    rows = [("hot", f"v{i % 9}", 100 * i) for i in range(150)]
    for i, part in enumerate([rows, [("hot", "end", 90000)]]):
        run_early(late_panes(_topic(spark, f"{scratch}/in", i, part), parts=4), f"{scratch}/out", f"{scratch}/ck")
    got = [r for r in _panes(spark, f"{scratch}/out") if r[2] == "on-time"]
    assert sorted((v, n) for _, _, _, _, v, n in got) == sorted((f"v{k}", sum(i % 9 == k for i in range(150))) for k in range(9))


def test_timer_panes_fire_after_a_restart_with_a_pending_timer(spark, scratch):
    """The first run stops before its timers are due; they are in the checkpoint, and the second run
    fires them, with the elements that have come meanwhile."""
    from tidewire.sinks import replay_safe_sink
    out, ck = f"{scratch}/out", f"{scratch}/ck"
    first = timer_panes(_topic(spark, f"{scratch}/in", 0, [("a", "x", 1000), ("a", None, 2000), ("b", "y", 30000)]), delay="6 seconds")
    q = replay_safe_sink(first, out, ck, output_mode="update").trigger(processingTime="200 milliseconds").start()
    while not any(p.numInputRows for p in q.recentProgress):
        assert q.exception() is None
    q.stop()
    assert _panes(spark, out) == []
    second = timer_panes(_topic(spark, f"{scratch}/in", 1, [("a", "x", 3000)]), delay="6 seconds")
    run_timers(second, out, ck, delay="6 seconds")
    last = latest_count(read_batches(spark, out), ["key", "window_start", "value"]).collect()
    assert sorted((r.key, r.value or "", r.n) for r in last) == [("a", "", 1), ("a", "x", 2), ("b", "y", 1)]
    assert {r[3] for r in _panes(spark, out) if r[0] == "b"} == {0}


def test_timer_panes_accumulate_over_panes(spark, scratch):
    for i, rows in enumerate([[("a", "x", 1000)], [("a", "y", 2000)]]):
        run_timers(timer_panes(_topic(spark, f"{scratch}/in", i, rows), delay="1 second"), f"{scratch}/out", f"{scratch}/ck",
                   delay="1 second", every="200 milliseconds")
    assert _panes(spark, f"{scratch}/out") == [("a", 0, "early", 0, "x", 1), ("a", 0, "early", 1, "x", 1), ("a", 0, "early", 1, "y", 1)]


def test_timers_are_waited_for_after_a_repeated_batch(spark, scratch):
    """A restarted run repeats the micro-batch that was cut short, without the rows that came since."""
    from pathlib import Path

    from tests.conftest import local_path
    out, ck = f"{scratch}/out", f"{scratch}/ck"
    run_timers(timer_panes(_topic(spark, f"{scratch}/in", 0, [("a", "x", 1000)]), delay="1 millisecond"), out, ck,
               delay="1 millisecond", every="200 milliseconds")
    begun, ended = (max((f for f in Path(local_path(ck), log).iterdir() if f.name.isdigit()), key=lambda f: int(f.name))
                    for log in ("offsets", "commits"))
    if begun.name == ended.name:  # the run was stopped between two micro-batches: as if in the last one
        ended.unlink()
    run_timers(timer_panes(_topic(spark, f"{scratch}/in", 1, [("a", "y", 2000)]), delay="1 millisecond"), out, ck,
               delay="1 millisecond", every="200 milliseconds")
    assert [r for r in _panes(spark, out) if r[3] == 1] == [("a", 0, "early", 1, "x", 1), ("a", 0, "early", 1, "y", 1)]


class _State:
    """A list or value state of one bucket, in memory."""

    def __init__(self, *_):
        self.held = []

    def get(self):
        return iter([*self.held]) if not isinstance(self.held, tuple) else self.held

    def appendList(self, values):
        self.held.extend(values)

    def put(self, values):
        self.held = [*values]

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = []


class _Value(_State):
    def get(self):
        return self.held or None


class _Handle:
    def __init__(self):
        self.timers, self.getListState, self.getValueState = set(), _State, _Value

    def registerTimer(self, at):
        self.timers.add(at)


def test_groups_of_a_bucket_fire_each_at_its_own_time():
    """``a`` opens at 0 and takes a row at 50, ``b`` opens at 50: due at 100 and 150, with a row of ``a`` at 150
    that opens its next pane."""
    from types import SimpleNamespace

    import pandas as pd
    import pyarrow as pa

    from tidewire.streaming.panes import _TimerPanes, _pack, _schema
    panes, handle, got = _TimerPanes(20000, 100), _Handle(), []
    panes.init(handle)
    for now, rows in ((0, [("a", "x")]), (50, [("a", None), ("b", "y")]), (100, []), (149, []), (150, [("a", "x")]), (250, [])):
        times = SimpleNamespace(getCurrentProcessingTimeInMs=lambda now=now: now)
        if rows:
            table = pa.Table.from_pylist([{"window_ms": 0, "key": k, "part": 0, "value": v, "n": 1} for k, v in rows], _schema())
            assert not [*panes.handleInputRows((0, 0), iter([pd.DataFrame({"chunk": _pack(table)})]), times)]
        for at in sorted(t for t in handle.timers if t <= now):
            for frame in panes.handleExpiredTimer((0, 0), times, None):
                got += sorted((now, r.key, r.pane, r.value or "", r.n) for r in frame.itertuples())
            handle.timers.discard(at)
    assert got == [(100, "a", 0, "", 1), (100, "a", 0, "x", 1), (150, "b", 0, "y", 1), (250, "a", 1, "", 1), (250, "a", 1, "x", 2)]


def test_timer_panes_of_many_keys_share_state(spark, scratch):
    """A state key, a timer and calls into the state for every key and window took a run of 600,000 of them far too long."""
    rows = [(f"k{i}", f"v{i % 3}", 1000 + i) for i in range(1500)] * 2
    q = run_timers(timer_panes(_topic(spark, f"{scratch}/in", 0, rows), delay="1 second"), f"{scratch}/out", f"{scratch}/ck",
                   delay="1 second", every="200 milliseconds")
    assert 0 < max(s.numRowsTotal for p in q.recentProgress for s in p.stateOperators) < 500
    got = read_batches(spark, f"{scratch}/out", schema=PANE_ROWS).collect()
    assert sorted((r.key, r.value, r.n, r.pane) for r in got) == sorted((f"k{i}", f"v{i % 3}", 2, 0) for i in range(1500))


def test_late_panes_of_many_values_share_state(spark, scratch):
    """A state entry, and calls into the state, for every value of a group took a run of millions of them far too long."""
    slices = [[("hot", f"v{i}", 1000 + i) for i in range(1500)] * 2 + [("end", "e", 41000)],
              [("hot", "v7", 1500), ("hot", "new", 1600), ("end", "e", 41500)]]
    held = []
    for i, rows in enumerate(slices):
        q = run_early(late_panes(_topic(spark, f"{scratch}/in", i, rows), lateness="1 minute"), f"{scratch}/out", f"{scratch}/ck")
        held += [s.numRowsTotal for p in q.recentProgress for s in p.stateOperators]
    assert 0 < max(held) < 100
    got = [r for r in read_batches(spark, f"{scratch}/out", schema=PANE_ROWS).collect() if r.key == "hot"]
    assert sorted((r.value, r.n) for r in got if (r.kind, r.pane) == ("on-time", 0)) == sorted((f"v{i}", 2) for i in range(1500))
    assert sorted((r.value, r.n) for r in got if (r.kind, r.pane) == ("late", 1)) == sorted(
        [("new", 1), *((f"v{i}", 3 if i == 7 else 2) for i in range(1500))])


def test_late_panes_are_the_same_from_small_chunks(spark, scratch, monkeypatch):
    """Counts of one bucket come in many chunks, which are added up meanwhile."""
    from tidewire.streaming import panes
    monkeypatch.setattr(panes, "_PACK_ROWS", 2)
    monkeypatch.setattr(panes, "_CHUNK_ROWS", 1)
    for i, rows in enumerate(LATE_SLICES):
        run_early(late_panes(_topic(spark, f"{scratch}/in", i, rows), window="20 seconds", lateness="20 seconds", buckets=1),
                  f"{scratch}/out", f"{scratch}/ck")
    assert _panes(spark, f"{scratch}/out") == LATE_WANT


def test_panes_choose_a_state_store_that_holds_them(spark, scratch):
    """Spark's default store has no column families; a store of the session's own choice stays."""
    from tidewire.streaming.panes import _column_families
    name, package = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state"
    before = spark.conf.get(name)
    rows = [("a", "x", 1000), ("a", "y", 2000), ("b", None, 41000)]
    try:
        spark.conf.set(name, f"{package}.HDFSBackedStateStoreProvider")
        run_early(late_panes(_topic(spark, f"{scratch}/late", 0, rows)), f"{scratch}/out", f"{scratch}/ck")
        spark.conf.set(name, f"{package}.HDFSBackedStateStoreProvider")
        run_timers(timer_panes(_topic(spark, f"{scratch}/timer", 0, rows), delay="1 second"), f"{scratch}/out2", f"{scratch}/ck2",
                   delay="1 second", every="200 milliseconds")
        spark.conf.set(name, "org.example.Store")
        _column_families(spark)
        assert spark.conf.get(name) == "org.example.Store"
    finally:
        spark.conf.set(name, before)
    assert _panes(spark, f"{scratch}/out") == [("a", 0, "on-time", 0, "x", 1), ("a", 0, "on-time", 0, "y", 1)]
    assert _panes(spark, f"{scratch}/out2") == [("a", 0, "early", 0, "x", 1), ("a", 0, "early", 0, "y", 1), ("b", 40, "early", 0, "", 1)]


def test_panes_need_a_stream_and_a_fixed_duration(spark):
    with pytest.raises(KeyError):
        millis("2 months")
    with pytest.raises(ValueError, match="stream"):
        timer_panes(spark.createDataFrame([], "key string, value string, ts timestamp"))


def test_counts_of_two_queries_on_one_path_are_added(spark):
    """A query restarted with a new checkpoint counts on from where the first one stopped."""
    rows = [("k", 3, "q1", 0), ("k", 5, "q1", 10), ("k", 3, "q2", 0), ("k", 4, "q1-fold-0a1b", 9), ("m", 1, "q2", 0)]
    df = spark.createDataFrame(rows, "k string, n long, query_id string, batch_id long")
    assert {r.k: r.n for r in latest_count(df, ["k"]).collect()} == {"k": 8, "m": 1}


def test_last_panes_of_two_queries_are_refused(spark):
    df = spark.createDataFrame([("k", 5, "q1", 10), ("k", 3, "q1-fold-77", 9), ("m", 1, "q2", 0)],
                               "k string, n long, query_id string, batch_id long")
    assert {r.k: r.n for r in latest_pane(df, ["k"]).collect()} == {"k": 5, "m": 1}
    both = df.union(spark.createDataFrame([("k", 3, "q2", 0)], df.schema))
    with pytest.raises(Exception, match="two queries"):
        latest_pane(both, ["k"]).collect()
