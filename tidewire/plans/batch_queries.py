"""Batch queries over the given tables (one per operator of the inventory)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire import operators as ops
from tidewire.fixed import (
    BRACKET_ITEM,
    COGROUP_LINE,
    EMPLOYEE_SEPARATOR,
    EMPLOYEE_TEMPLATE,
    NULL_TEXT,
    SEQUENCE_LINE,
)
from tidewire.functions.kv import long_to_bytes
from tidewire.functions.records import decimal_bytes, registry_frame, same_record
from tidewire.plans.inputs import (
    BOUNDED_STAMP_OFFSET,
    FILE_WINDOW,
    JOIN_WINDOW,
    PIPELINE_START,
    ROUTE_TOPICS,
    USER_VALUE,
    customer_lines,
    event_broker_records,
    event_lines,
    supplier_lines,
    table,
)
from tidewire.plans.registry import query

# ------------------------------------------------------------- key / value

_EVENT_KV_SQL = """
select cast(user_id as varchar) as key, cast(user_id as varchar) || ',' || event_type as value
from events
"""


@query("decode_kv", _EVENT_KV_SQL)
def decode_kv(spark, sf):
    return ops.decode_kv(event_broker_records(spark, sf))


@query("decode_long_key", """
select user_id as key, cast(user_id as varchar) || ',' || event_type as value from events
""")
def decode_long_key(spark, sf):
    rec = event_broker_records(spark, sf).withColumn(
        "key", long_to_bytes(F.col("key").cast("string").cast("bigint")))
    return ops.decode_kv(rec, key_type="long")


@query("values_only", """
select cast(user_id as varchar) || ',' || event_type as value from events
""")
def values_only(spark, sf):
    return ops.values_only(ops.decode_kv(event_broker_records(spark, sf)))


_DOC_LINES_SQL = """
with l as (
  select doc_id,
         generate_subscripts(string_split(text, chr(10)), 1) as line_no,
         unnest(string_split(text, chr(10))) as line
  from documents)
"""


def _doc_lines(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text")
    return ops.text_to_lines(docs, "text", keep=("doc_id",))


@query("parse_csv_kv", _DOC_LINES_SQL + """
select doc_id, line_no, split_part(line, ',', 1) as key, split_part(line, ',', 2) as value
from l where contains(rtrim(line, ','), ',')
""")
def parse_csv_kv(spark, sf):
    good, _ = ops.parse_csv_kv(_doc_lines(spark, sf), line="line", on_bad="quarantine",
                               keep=("doc_id", "line_no"))
    return good


@query("parse_csv_rejects", _DOC_LINES_SQL + """
select doc_id, line_no, line from l where not contains(rtrim(line, ','), ',')
""")
def parse_csv_rejects(spark, sf):
    _, bad = ops.parse_csv_kv(_doc_lines(spark, sf), line="line", on_bad="quarantine",
                              keep=("doc_id", "line_no"))
    return bad.select("doc_id", "line_no", "line")


@query("parse_csv_events", """
select event_id, cast(user_id as varchar) as key, event_type as value from events
""")
def parse_csv_events(spark, sf):
    # strict mode: every event line is well formed, a bad one fails the job
    return ops.parse_csv_kv(event_lines(spark, sf), line="line", on_bad="fail", keep=("event_id",))


@query("null_to_literal", """
select event_id, coalesce(nullif(event_type, 'error'), 'null') as key, coalesce(props, 'null') as value
from events
""")
def null_to_literal(spark, sf):
    ev = table(spark, sf, "events", "event_id", "event_type", "props")
    kv = ev.select("event_id", F.nullif(F.col("event_type"), F.lit("error")).alias("key"),
                   F.col("props").alias("value"))
    return ops.null_to_literal(kv, ("key", "value"))


_ROUTE_SQL = """
select event_id as "offset",
       case when event_id % 2 = 0 then 'topic2' else 'topic1' end as topic,
       cast(user_id as varchar) as key,
       cast(user_id as varchar) || ',' || event_type as value
from events
"""


@query("route_alternate", _ROUTE_SQL)
def route_alternate(spark, sf):
    kv = ops.decode_kv(event_broker_records(spark, sf), keep=("offset",))
    return ops.route_alternate(kv, "offset", ROUTE_TOPICS).select("offset", "topic", "key", "value")


@query("prefix_param", f"""
select p_partkey, '{USER_VALUE}_' || p_name as p_name from part
""")
def prefix_param(spark, sf):
    return ops.prefix(table(spark, sf, "part", "p_partkey", "p_name"), "p_name", USER_VALUE)


# ------------------------------------------------------------- windows

@query("fixed_window_20s", f"""
select time_bucket(interval '{JOIN_WINDOW}', ts) as window_start,
       time_bucket(interval '{JOIN_WINDOW}', ts) + interval '{JOIN_WINDOW}' as window_end,
       user_id, count(*) as n
from events group by all
""")
def fixed_window_20s(spark, sf):
    ev = table(spark, sf, "events", "ts", "user_id")
    return ops.window_counts(ev, "ts", JOIN_WINDOW, keys=("user_id",))


@query("fixed_window_5s", f"""
select time_bucket(interval '{FILE_WINDOW}', ts) as window_start,
       time_bucket(interval '{FILE_WINDOW}', ts) + interval '{FILE_WINDOW}' as window_end,
       count(*) as n
from events group by all
""")
def fixed_window_5s(spark, sf):
    return ops.window_counts(table(spark, sf, "events", "ts"), "ts", FILE_WINDOW)


@query("assign_event_time", f"""
select cast(c_custkey as varchar) as key, c_mktsegment as value,
       timestamp '{PIPELINE_START}' + interval '{BOUNDED_STAMP_OFFSET}' as ts
from customer
""")
def assign_event_time(spark, sf):
    kv = ops.parse_csv_kv(customer_lines(spark, sf), line="line")
    return ops.assign_event_time(kv, PIPELINE_START, BOUNDED_STAMP_OFFSET)


@query("event_time_policy", """
select event_id as "offset", ts as created, ts as appended, true as processed from events
""")
def event_time_policy(spark, sf):
    """The three policies: records stamped by their producer, by the broker at
    append (its time type), and by the clock of the run that processes them."""
    from tidewire.functions.time import instant_to_ntz
    created = ops.event_time_from_policy(event_broker_records(spark, sf), "create", out="created")
    appended = created.withColumn("timestampType", F.lit(1))
    both = ops.event_time_from_policy(appended, "log_append", out="appended")
    out = ops.event_time_from_policy(both, "processing", out="processed")
    return out.select("offset", instant_to_ntz("created").alias("created"), instant_to_ntz("appended").alias("appended"),
                      (F.col("processed") > F.col("timestamp")).alias("processed"))


# ------------------------------------------------------------- aggregates

@query("group_bracket_list", f"""
select user_id, string_agg('{BRACKET_ITEM[0]}' || event_type || '{BRACKET_ITEM[1]}', '' order by event_type) as value_list
from events group by user_id
""")
def group_bracket_list(spark, sf):
    ev = table(spark, sf, "events", "user_id", "event_type")
    return ops.bracket_list(ev, ["user_id"], "event_type", out="value_list")


@query("global_max", """
select max(length(p_name)) as max_len from part
""")
def global_max(spark, sf):
    return ops.global_max(table(spark, sf, "part", "p_name"),
                          F.length("p_name").cast("bigint"), out="max_len")


@query("length_cutoff", """
select p_partkey, p_name from part
where length(p_name) <= (select max(length(p_name)) from part where p_name like 'red %')
""")
def length_cutoff(spark, sf):
    part = table(spark, sf, "part", "p_partkey", "p_name")
    cutoff = ops.global_max(part.filter(F.col("p_name").startswith("red ")), F.length("p_name"))
    return ops.filter_by_global(part, F.length("p_name"), cutoff, "<=")


# ------------------------------------------------------------- lookups, joins

@query("unique_lookup", """
select cast(c_custkey as varchar) as key, c_mktsegment as value from customer
""")
def unique_lookup(spark, sf):
    kv = ops.parse_csv_kv(customer_lines(spark, sf), line="line")
    return ops.unique_lookup(kv, "key", "value")


@query("duplicate_keys", """
select o_custkey as key, count(*) as n from orders group by o_custkey having count(*) > 1
""")
def duplicate_keys(spark, sf):
    orders = table(spark, sf, "orders", "o_custkey").withColumnRenamed("o_custkey", "key")
    return ops.duplicate_keys(orders, "key")


_LOOKUP_SQL = f"""
with s as (select event_id, cast(user_id as varchar) as key, event_type as value from events),
     l as (select cast(s_suppkey as varchar) as key, s_name as lookup_value from supplier)
select s.event_id, s.key, s.value, coalesce(l.lookup_value, '{NULL_TEXT}') as lookup_value,
       '{COGROUP_LINE[0]}' || s.key || '{COGROUP_LINE[1]}' || s.value || '{COGROUP_LINE[2]}'
       || coalesce(l.lookup_value, '{NULL_TEXT}') as line
from s left join l on s.key = l.key
"""


def supplier_lookup(spark, sf):
    """All suppliers as a lookup; uniqueness is checked where it is joined."""
    return ops.unique_lookup(ops.parse_csv_kv(supplier_lines(spark, sf), line="line"), "key", "value")


@query("lookup_join", _LOOKUP_SQL)
def lookup_join(spark, sf):
    stream = ops.parse_csv_kv(event_lines(spark, sf), line="line", keep=("event_id",))
    return ops.lookup_join(stream, supplier_lookup(spark, sf), "key", "value") \
        .select("event_id", "key", "value", "lookup_value", "line")


def _cogroup_sql(window: str | None) -> str:
    w = f"time_bucket(interval '{window}', ts) as window_start, " if window else ""
    g = "group by window_start, key" if window else "group by key"
    return f"""
with u as (
  select cast(user_id as varchar) as key, event_type as value, ts, 0 as side from events
  union all
  select cast(c_custkey as varchar), c_mktsegment,
         timestamp '{PIPELINE_START}' + interval '{BOUNDED_STAMP_OFFSET}', 1 from customer)
select {w}key,
       '{COGROUP_LINE[0]}' || key || '{COGROUP_LINE[1]}'
       || coalesce(string_agg('{BRACKET_ITEM[0]}' || value || '{BRACKET_ITEM[1]}', '' order by value)
                   filter (where side = 0), '')
       || '{COGROUP_LINE[2]}'
       || coalesce(string_agg('{BRACKET_ITEM[0]}' || value || '{BRACKET_ITEM[1]}', '' order by value)
                   filter (where side = 1), '')
       as line
from u {g}
"""


def cogroup_inputs(spark, sf):
    stream = ops.parse_csv_kv(event_lines(spark, sf), line="line", keep=("ts",))
    bounded = ops.assign_event_time(ops.parse_csv_kv(customer_lines(spark, sf), line="line"),
                                    PIPELINE_START, BOUNDED_STAMP_OFFSET)
    return stream, bounded


@query("windowed_cogroup", _cogroup_sql(JOIN_WINDOW))
def windowed_cogroup(spark, sf):
    stream, bounded = cogroup_inputs(spark, sf)
    return ops.windowed_cogroup(stream, bounded, "key", "value", "ts", JOIN_WINDOW)


@query("windowed_cogroup_hourly", _cogroup_sql("1 hour"))
def windowed_cogroup_hourly(spark, sf):
    stream, bounded = cogroup_inputs(spark, sf)
    return ops.windowed_cogroup(stream, bounded, "key", "value", "ts", "1 hour")


@query("windowed_cogroup_counts", f"""
with u as (
  select cast(user_id as varchar) as key, event_type as value, ts, 0 as side from events
  union all
  select cast(c_custkey as varchar), c_mktsegment,
         timestamp '{PIPELINE_START}' + interval '{BOUNDED_STAMP_OFFSET}', 1 from customer)
select time_bucket(interval '{JOIN_WINDOW}', ts) as window_start,
       time_bucket(interval '{JOIN_WINDOW}', ts) + interval '{JOIN_WINDOW}' as window_end,
       key, side, value, count(*) as n
from u group by 1, 2, 3, 4, 5
""")
def windowed_cogroup_counts(spark, sf):
    """Long form of the co-group (one row per window, key, side, value)."""
    stream, bounded = cogroup_inputs(spark, sf)
    return ops.cogroup_counts(stream, bounded, "key", "value", "ts", JOIN_WINDOW)


@query("global_cogroup_counts", """
with u as (
  select cast(user_id as varchar) as key, event_type as value, 0 as side from events
  union all
  select cast(c_custkey as varchar), c_mktsegment, 1 from customer)
select key, side, value, count(*) as n from u group by 1, 2, 3
""")
def global_cogroup_counts(spark, sf):
    """Long form of the co-group over one global window: one shuffle, and a
    hot key is spread over its values."""
    stream, bounded = cogroup_inputs(spark, sf)
    return ops.cogroup_counts(stream, bounded, "key", "value", "ts", None)


@query("global_cogroup", _cogroup_sql(None))
def global_cogroup(spark, sf):
    stream, bounded = cogroup_inputs(spark, sf)
    return ops.windowed_cogroup(stream, bounded, "key", "value", "ts", None)


# ------------------------------------------------------------- records

_EMPLOYEE_SQL = """
with e as (
  select cast(c_custkey as varchar) as id,
         split_part(c_name || '_' || c_mktsegment, '_', 1) as emp_name,
         split_part(c_name || '_' || c_mktsegment, '_', 2) as emp_address
  from customer)
"""


def employee_records_df(spark, sf):
    c = table(spark, sf, "customer", "c_custkey", "c_name", "c_mktsegment")
    raw = c.select(F.col("c_custkey").cast("string").alias("id"),
                   F.concat_ws(EMPLOYEE_SEPARATOR, "c_name", "c_mktsegment").alias("raw"))
    return ops.parse_delimited(raw, "raw", EMPLOYEE_SEPARATOR, ["emp_name", "emp_address"], keep=("id",))


@query("employee_records", _EMPLOYEE_SQL + "select id, emp_name, emp_address from e")
def employee_records(spark, sf):
    return employee_records_df(spark, sf)


@query("parse_delimited", """
select p_partkey, split_part(p_name, ' ', 1) as p_adj, split_part(p_name, ' ', 2) as p_noun from part
""")
def parse_delimited(spark, sf):
    part = table(spark, sf, "part", "p_partkey", "p_name")
    return ops.parse_delimited(part, "p_name", " ", ["p_adj", "p_noun"], keep=("p_partkey",))




_EMPLOYEE_TEXT = [x.replace("'", "''") for x in EMPLOYEE_TEMPLATE.split("%s")]


@query("render_records", _EMPLOYEE_SQL + f"""
select id, '{_EMPLOYEE_TEXT[0]}' || id || '{_EMPLOYEE_TEXT[1]}' || emp_name || '{_EMPLOYEE_TEXT[2]}' || emp_address
           || '{_EMPLOYEE_TEXT[3]}' as text
from e
""")
def render_records(spark, sf):
    return ops.render_records(employee_records_df(spark, sf), EMPLOYEE_TEMPLATE,
                              ["id", "emp_name", "emp_address"], keep=("id",))


@query("payload_roundtrip", """
select doc_id, octet_length(encode(text)) as n_bytes, sha256(text) as payload_sha256, text
from documents
""")
def payload_roundtrip(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text")
    return ops.payload_roundtrip(docs, "text", keep=("doc_id",)) \
        .withColumn("n_bytes", F.col("n_bytes").cast("bigint"))


@query("record_equality", """
select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
       (nullif(l.l_returnflag, 'N') is not distinct from (case when o.o_totalprice > 150000 then 'R' end))
       and (l.l_linestatus is not distinct from nullif(o.o_orderstatus, 'P')) as same_record
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
""")
def record_equality(spark, sf):
    """Null-safe record equality: is each line's (flag, status) record equal
    to one built from its order?  One scan of each table and one join, whose hot
    orders AQE can split."""
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
               "l_linestatus")
    orders = table(spark, sf, "orders", "o_orderkey", "o_totalprice", "o_orderstatus")
    line = F.struct(F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"), F.col("l_linestatus").alias("status"))
    order = F.struct(F.when(F.col("o_totalprice") > 150000, "R").alias("flag"),
                     F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"))
    return (li.join(orders, li["l_orderkey"] == orders["o_orderkey"])
              .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                      same_record(line, order).alias("same_record")))


@query("registry_frame", """
select event_id, '00' as magic, cast(user_id as integer) as schema_id,
       cast(user_id as varchar) || ',' || event_type as payload
from events
""")
def registry_frame_q(spark, sf):
    ev = table(spark, sf, "events", "event_id", "user_id", "event_type")
    framed = ev.select("event_id", registry_frame(
        F.col("user_id"),
        F.encode(F.concat_ws(",", F.col("user_id").cast("string"), F.col("event_type")), "UTF-8")
    ).alias("value"))
    return ops.strip_registry_frame(framed, "value", keep=("event_id",)) \
        .select("event_id", "magic", "schema_id", F.decode("payload", "UTF-8").alias("payload"))


# ------------------------------------------------------------- sequences, caps



@query("sequence_lines", f"""
select event_id as value, replace('{SEQUENCE_LINE}', '%s', event_id::varchar) as "row" from events
""")
def sequence_lines(spark, sf):
    """The sequence source, as long as ``events``, as one-field line records."""
    from pyspark.sql import types as T

    from tidewire.sources.files import sequence
    ids = table(spark, sf, "events", "event_id")
    last = ids.agg(F.max("event_id")).first()[0]  # one number, from the file statistics
    seq = sequence(spark, end=0 if last is None else last + 1)
    lines = seq.select("value", F.format_string(SEQUENCE_LINE, F.col("value")).alias("row"))
    schema = T.StructType([T.StructField("row", T.StringType(), False)])
    return ops.to_record(lines, schema, keep=("value",)).select("value", "record.row")


@query("bounded_by_time", """
select event_id, ts from events where ts < (select min(ts) from events) + interval 1 day
""")
def bounded_by_time(spark, sf):
    ev = table(spark, sf, "events", "event_id", "ts")
    return ops.bounded_by_time(ev, "ts", "1 day")


@query("bounded_by_count", """
select event_id, user_id, event_type from events order by event_id limit 5
""")
def bounded_by_count(spark, sf):
    ev = table(spark, sf, "events", "event_id", "user_id", "event_type")
    return ops.bounded_by_count(ev, "event_id", 5)


@query("kinesis_records", """
select cast(user_id as varchar) as partition_key, hex(encode(cast(event_id as varchar))) as data_hex
from events
""")
def kinesis_records(spark, sf):
    """Framed records, spread over shards by the user they belong to."""
    from tidewire.sinks.kinesis import kinesis_records as frame
    ev = table(spark, sf, "events", "event_id", "user_id")
    out = frame(ev.select("user_id", decimal_bytes("event_id").alias("data")), "data", F.col("user_id"))
    return out.select("partition_key", F.hex("data").alias("data_hex"))
