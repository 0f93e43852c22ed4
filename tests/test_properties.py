"""Brute-force models of the grouping operators, checked on random inputs."""

import datetime as dt
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewire import operators as ops

KEYS = st.sampled_from(["a", "b", "é", None])
VALUES = st.one_of(st.none(), st.sampled_from(["x", "y", "zz", "ü", ""]))
SECONDS = st.integers(min_value=0, max_value=95)
ROWS = st.lists(st.tuples(KEYS, VALUES, SECONDS), max_size=25)


def _df(spark, rows):
    return spark.createDataFrame(rows, "key string, value string, s long") \
        .select("key", "value", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"))


def _brackets(values):
    # Spark sorts NULL first (ascending), and renders it as "null"
    ordered = sorted(values, key=lambda v: (v is not None, v or ""))
    return "".join(f"[{'null' if v is None else v}]," for v in ordered)


def _model(stream, bounded, window):
    groups = defaultdict(lambda: ([], []))
    for side, rows in ((0, stream), (1, bounded)):
        for k, v, s in rows:
            w = (s // window) * window if window else None
            groups[(w, k)][side].append(v)
    return sorted(((w, k, f"K: [{'null' if k is None else k}], SVs: {_brackets(sv)}, BVs: {_brackets(bv)}")
                   for (w, k), (sv, bv) in groups.items()), key=repr)


@settings(max_examples=25, deadline=None)
@given(ROWS, ROWS)
def test_windowed_cogroup_matches_model(spark, stream, bounded):
    out = ops.windowed_cogroup(_df(spark, stream), _df(spark, bounded), window="20 seconds").collect()
    epoch = dt.datetime(1970, 1, 1)
    rows = [((r.window_start - epoch) // dt.timedelta(seconds=1), r.key, r.line) for r in out]
    got = sorted(rows, key=repr)
    assert got == _model(stream, bounded, 20)


@settings(max_examples=25, deadline=None)
@given(ROWS, ROWS)
def test_global_cogroup_matches_model(spark, stream, bounded):
    out = ops.windowed_cogroup(_df(spark, stream), _df(spark, bounded), window=None).collect()
    got = sorted(((None, r.key, r.line) for r in out), key=repr)
    assert got == _model(stream, bounded, None)


@settings(max_examples=25, deadline=None)
@given(ROWS)
def test_bracket_list_matches_model(spark, rows):
    out = {r.key: r.values for r in ops.bracket_list(_df(spark, rows), ["key"], "value").collect()}
    groups = defaultdict(list)
    for k, v, _ in rows:
        groups[k].append(v)
    assert out == {k: _brackets(vs) for k, vs in groups.items()}


BATCHES = st.lists(st.lists(st.integers(min_value=0, max_value=200), min_size=1, max_size=4),
                   min_size=2, max_size=5)


def _java_split(line):
    parts = line.split(",")
    while parts and parts[-1] == "":
        parts.pop()
    return parts if line != "" else [""]


def _kept(batches, ts):
    """Rows that back-to-back micro-batches count: a row is late if its 20 s
    window ended at or before (latest time two batches or more ago) - 20 s."""
    out, seen = [], []
    for b in batches:
        mark = max((ts(r) for x in seen[:-1] for r in x), default=0) - 20
        out += [r for r in b if ts(r) - ts(r) % 20 + 20 > mark]
        seen.append(b)
    return out


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab,é", max_size=7), min_size=1, max_size=15))
def test_csv_key_value_match_java_split(spark, lines):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    good, _ = ops.parse_csv_kv(df, line="line", on_bad="quarantine", keep=("i",))
    got = {r.i: (r.key, r.value) for r in good.collect()}
    want = {i: (p[0], p[1]) for i, x in enumerate(lines) for p in [_java_split(x)] if len(p) >= 2}
    assert got == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab_", max_size=7), min_size=1, max_size=15))
def test_delimited_matches_keep_empty_split(spark, raws):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(raws)], "i int, raw string")
    out = ops.parse_delimited(df, "raw", "_", ["f0", "f1"], keep=("i",), on_bad="drop")
    got = {r.i: (r.f0, r.f1) for r in out.collect()}
    want = {i: (x.split("_")[0], x.split("_")[1]) for i, x in enumerate(raws) if len(x.split("_")) >= 2}
    assert got == want


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(KEYS, VALUES), max_size=20),
       st.dictionaries(st.sampled_from(["a", "b", "é", "z"]), st.sampled_from(["1", "2", ""]), max_size=4))
def test_lookup_join_matches_model(spark, stream, table):
    s = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(stream)], "i int, key string, value string")
    lk = ops.unique_lookup(spark.createDataFrame(list(table.items()), "key string, value string"))
    got = {r.i: (r.lookup_value, r.line) for r in ops.lookup_join(s, lk).collect()}
    want = {}
    for i, (k, v) in enumerate(stream):
        b = table.get(k, "null") if k is not None else "null"
        want[i] = (b, f"K: [{'null' if k is None else k}], SVs: {'null' if v is None else v}, BVs: {b}")
    assert got == want


@settings(max_examples=4, deadline=None)
@given(BATCHES)
def test_update_mode_last_pane_equals_batch(spark, batches):
    """Random schedules: the last update-mode pane per window equals the
    batch count over the rows the engine kept (the late groups dropped)."""
    from tidewire.session import scratch_path
    from tidewire.sinks.replay_safe import latest_pane, read_batches
    from tidewire.streaming import run_early, stream_window_counts
    base = scratch_path(spark, "prop-update")
    for b in batches:
        (spark.createDataFrame([("a", s) for s in b], "key string, s long")
              .select("key", F.timestamp_seconds("s").alias("ts"))
              .coalesce(1).write.mode("append").parquet(f"{base}/in"))
    src = spark.readStream.schema("key string, ts timestamp").option("maxFilesPerTrigger", 1) \
        .parquet(f"{base}/in")
    run_early(stream_window_counts(src, "ts", "20 seconds", ("key",), "20 seconds"),
              f"{base}/out", f"{base}/ck")
    last = {(r.window_start, r.n) for r in
            latest_pane(read_batches(spark, f"{base}/out"), ["window_start", "key"]).collect()}
    kept = spark.createDataFrame([(v,) for v in _kept(batches, lambda v: v)], "s long") \
        .select(F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"))
    want = {(r.window_start, r.n) for r in ops.window_counts(kept, "ts", "20 seconds").collect()}
    assert last == want


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.sampled_from(["x", "y"]),
                                   st.integers(min_value=0, max_value=150)), min_size=1, max_size=4),
                min_size=2, max_size=4),
       st.integers(min_value=0, max_value=150))
def test_stream_cogroup_last_panes_equal_batch_cogroup(spark, batches, bounded_at):
    """Stream batches plus a bounded side at any time: the rendered last panes
    equal the batch co-group of the rows the engine keeps."""
    from tidewire.session import scratch_path
    from tidewire.sinks.replay_safe import read_batches
    from tidewire.streaming import bounded_side_counts, merged_cogroup, run_early, stream_side_counts
    base = scratch_path(spark, "prop-cogroup")
    schema = "key string, value string, s long"
    for b in batches:
        (spark.createDataFrame(b, schema).select("key", "value", F.timestamp_seconds("s").alias("ts"))
              .coalesce(1).write.mode("append").parquet(f"{base}/stream"))
    bounded_rows = [("a", "1", bounded_at), ("c", "2", bounded_at)]
    (spark.createDataFrame(bounded_rows, schema).select("key", "value", F.timestamp_seconds("s").alias("ts"))
          .coalesce(1).write.parquet(f"{base}/bounded"))
    ss = "key string, value string, ts timestamp"
    stream = spark.readStream.schema(ss).option("maxFilesPerTrigger", 1).parquet(f"{base}/stream")
    run_early(stream_side_counts(stream), f"{base}/out", f"{base}/ck")
    bounded = spark.read.schema(ss).parquet(f"{base}/bounded")
    last = merged_cogroup(read_batches(spark, f"{base}/out"), bounded_side_counts(bounded))
    got = sorted((r.window_start, r.line) for r in ops.format_cogroup(last).collect())

    # only the stream can be late, against its own times
    def frame(rows):
        return spark.createDataFrame(rows, schema).select(
            "key", "value", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"))
    want_df = ops.windowed_cogroup(frame(_kept(batches, lambda r: r[2])), frame(bounded_rows))
    want = sorted((r.window_start, r.line) for r in want_df.collect())
    assert got == want


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(1, 4), st.sampled_from(["A", "N", "R"]),
                          st.sampled_from(["F", "O"])), min_size=1, max_size=25))
def test_first_record_equality_matches_model(spark, lines):
    """Each line's (flag, status) record vs the first line of its order,
    NULL (flag 'N') equal to NULL; ties in the order are identical rows."""
    df = spark.createDataFrame(lines, "o int, ln int, rf string, ls string")
    rec = F.struct(F.nullif("rf", F.lit("N")).alias("flag"), F.col("ls").alias("status"))
    order = ["ln", "rf", "ls"]
    first = df.groupBy("o").agg(F.min_by(rec, F.struct(*order)).alias("first_rec"))
    out = df.join(first, "o").select("o", "ln", "rf", "ls", rec.eqNullSafe(F.col("first_rec")).alias("same"))
    got = sorted((r.o, r.ln, r.rf, r.ls, r.same) for r in out.collect())
    firsts = {}
    for o, ln, rf, ls in sorted(lines, key=lambda x: (x[0], x[1], x[2], x[3])):
        firsts.setdefault(o, (None if rf == "N" else rf, ls))
    want = sorted((o, ln, rf, ls, (None if rf == "N" else rf, ls) == firsts[o]) for o, ln, rf, ls in lines)
    assert got == want


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 10**9), min_size=1, max_size=30), st.integers(1, 6))
def test_time_slices_match_integer_formula(spark, micros, k):
    from tidewire.sources.replay import time_slices
    df = spark.createDataFrame([(m,) for m in micros], "us long") \
        .select("us", F.timestamp_micros("us").alias("t"))
    got = sorted((r.us, r.slice) for r in time_slices(df, "t", k).collect())
    lo, hi = min(micros), max(micros)
    assert got == sorted((m, (m - lo) // ((hi - lo) // k + 1)) for m in micros)
