"""Plan checks over the registered batch queries: no Python evaluation
nodes, no cartesian products, and projections pruned at the Parquet scan."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from tidewire import operators as ops

SF = "/root/testdata/sf0.001"
BATCH_QUERIES = [
    "decode_kv", "parse_csv_kv", "parse_csv_rejects", "null_to_literal", "route_alternate",
    "prefix_param", "fixed_window_20s", "assign_event_time", "group_bracket_list", "global_max",
    "length_cutoff", "unique_lookup", "duplicate_keys", "lookup_join", "windowed_cogroup",
    "global_cogroup", "windowed_cogroup_counts", "employee_records", "parse_delimited",
    "render_records", "payload_roundtrip", "record_equality", "registry_frame", "sequence_lines",
    "bounded_by_time", "bounded_by_count", "kinesis_records", "global_cogroup_counts", "event_time_policy",
]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH_QUERIES)
def test_no_python_and_no_cartesian(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                 "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, (name, node)


def test_scans_are_pruned(spark):
    plan = _plan(E.queries()["lookup_join"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in plan
    assert "ReadSchema: struct<s_suppkey:bigint,s_name:string>" in plan
    plan = _plan(E.queries()["parse_csv_kv"](spark, SF))
    assert "Exchange" not in plan


@pytest.mark.parametrize("name", ["windowed_cogroup_counts", "global_cogroup_counts"])
def test_long_form_cogroup_has_one_exchange(spark, name):
    assert _plan(E.queries()[name](spark, SF)).count("Exchange hashpartitioning") == 1


def test_record_equality_has_no_aggregate(spark):
    plan = _plan(E.queries()["record_equality"](spark, SF))
    assert "Aggregate" not in plan and plan.count("FileScan") == 2


def test_latest_count_is_a_hash_aggregate(spark):
    from tidewire.sinks.replay_safe import latest_count
    df = spark.createDataFrame([("a", 0, 1), ("a", 1, 3)], "k string, batch_id int, n long")
    out = latest_count(df, ["k"])
    assert "SortAggregate" not in _plan(out) and [tuple(r) for r in out.collect()] == [("a", 3)]


def test_bound_reaches_the_scan(spark):
    from tidewire.plans.inputs import table
    out = ops.bounded_by_time(table(spark, SF, "events", "event_id", "ts"), "ts", "1 day")
    assert out.count() < table(spark, SF, "events", "ts").count()


def test_table_sees_new_rows(spark, scratch):
    from tidewire.plans.inputs import table
    spark.range(10).write.parquet(f"{scratch}/t.parquet")
    assert table(spark, scratch, "t").count() == 10
    spark.range(20).write.mode("append").parquet(f"{scratch}/t.parquet")
    assert table(spark, scratch, "t").count() == 30


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=12)), min_size=1, max_size=15))
def test_payload_roundtrip_property(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = ops.payload_roundtrip(df, "t", keep=("i",)).orderBy("i").collect()
    assert [r.t for r in out] == texts
    assert [r.n_bytes for r in out] == [None if t is None else len(t.encode()) for t in texts]
