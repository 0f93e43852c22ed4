"""Panes by timers, the co-group of two streams, complete windows and a running side input, over the
replayed ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.fixed import ALLOWED_LATENESS, FILE_WINDOW, JOIN_WINDOW
from tidewire.functions.time import instant_to_ntz
from tidewire.plans.inputs import event_broker_records
from tidewire.plans.registry import query
from tidewire.plans.stream_queries import REPLAY_SLICES, event_pairs, event_slices
from tidewire.session import scratch_path
from tidewire.sinks.replay_safe import latest_count, read_batches
from tidewire.sinks.windows import complete_windows_sink, read_complete_windows
from tidewire.sources.replay import read_slices, time_slices, write_slices
from tidewire.streaming import run_available, run_early, run_final, run_timers, stream_stream_cogroup
from tidewire.streaming.panes import late_panes, timer_panes
from tidewire.streaming.side_input import publish_max, with_side_input

#: Early firing of the registered query; the operator's own default is the original's.  A month arrives
#: in two micro-batches, so long spans share buckets.
TIMER_DELAY, TIMER_SPAN = "2 seconds", "1 day"

#: The late panes' window, lateness, slices, and how late every seventh record arrives.
LATE_WINDOW, LATE_BY, LATE_SLICES, LATE_DELAY, DELAYED = "1 day", "2 days", 6, "1 day", 7


@query("stream_timer_panes", f"""
select time_bucket(interval '{JOIN_WINDOW}', ts) as window_start,
       time_bucket(interval '{JOIN_WINDOW}', ts) + interval '{JOIN_WINDOW}' as window_end,
       cast(user_id as varchar) as key, event_type as value, count(*) as n
from events group by all
""")
def stream_timer_panes(spark, sf) -> DataFrame:
    """Early panes by processing-time timers, each fired a fixed time after its first element; the
    query is started twice, and what the panes hold last is the complete result."""
    path, slices = event_slices(spark, sf)
    base = scratch_path(spark, "timer-panes")
    for upto in (slices // 2 - 1, slices - 1):
        panes = timer_panes(event_pairs(read_slices(spark, path, upto)), delay=TIMER_DELAY, span=TIMER_SPAN)
        run_timers(panes, f"{base}/data", f"{base}/checkpoint", delay=TIMER_DELAY)
    return latest_count(read_batches(spark, f"{base}/data"), ["window_start", "window_end", "key", "value"])


@query("stream_late_panes", f"""
with e as (
  select event_type as key, cast(user_id as varchar) as value, ts,
         time_bucket(interval '{LATE_WINDOW}', ts) as window_start,
         ts + case when event_id % {DELAYED} = 0 then interval '{LATE_DELAY}' else interval '0 days' end as arrival
  from events),
b as (select min(epoch_us(arrival)) as lo, (max(epoch_us(arrival)) - min(epoch_us(arrival))) // {LATE_SLICES} + 1 as step from e),
s as (select e.*, window_start + interval '{LATE_WINDOW}' as window_end, (epoch_us(arrival) - lo) // step as slice from e, b),
m as (select slice, max(max(ts)) over (order by slice) as now from s group by slice),
x as (select *, lag(now) over (order by slice) as before from m),
a as (select s.*, now, before from s join x using (slice) where before is null or window_end > before - interval '{LATE_BY}'),
f as (
  select key, window_start, window_end, min(slice) as first,
         (select min(slice) from x where now >= g.window_end) as passed
  from a g group by key, window_start, window_end),
p as (
  select key, window_start, window_end, passed as slice, 'on-time' as kind from f where first <= passed
  union all
  select distinct f.key, f.window_start, f.window_end, a.slice, 'late'
  from f join a using (key, window_start, window_end) where a.slice > passed),
q as (select *, row_number() over (partition by key, window_start order by slice) - 1 as pane from p)
select q.window_start, q.window_end, q.key, a.value, count(*) as n, q.kind, q.pane
from q join a on a.key = q.key and a.window_start = q.window_start and a.slice <= q.slice
group by all
""")
def stream_late_panes(spark, sf) -> DataFrame:
    """On-time and late panes of every event type and day, one row per user: some records
    arrive a day late, inside the allowed lateness of two days."""
    path, base = scratch_path(spark, "replay-late"), scratch_path(spark, "late-panes")
    records = event_broker_records(spark, sf)
    arrival = F.when(F.col("offset") % DELAYED == 0, F.col("timestamp") + F.expr(f"INTERVAL {LATE_DELAY}"))
    write_slices(time_slices(records.withColumn("arrival", F.coalesce(arrival, "timestamp")), "arrival",
                             LATE_SLICES).drop("arrival"), path)
    for i in range(LATE_SLICES):
        panes = late_panes(event_pairs(read_slices(spark, path, i)), key="value", value="key",
                           window=LATE_WINDOW, lateness=LATE_BY)
        run_early(panes, f"{base}/data", f"{base}/checkpoint")
    return read_batches(spark, f"{base}/data").drop("query_id", "batch_id")


@query("stream_stream_cogroup", f"""
with e as (select *, event_id % 3 = 0 as is_right from events),
g as (
  select time_bucket(interval '{JOIN_WINDOW}', ts) as window_start,
         time_bucket(interval '{JOIN_WINDOW}', ts) + interval '{JOIN_WINDOW}' as window_end,
         cast(user_id as varchar) as key, is_right::integer as side, event_type as value, count(*) as n
  from e group by 1, 2, 3, 4, 5)
select * from g
where window_end <= (select least(max(ts) filter (is_right), max(ts) filter (not is_right)) from e) - interval '{ALLOWED_LATENESS}'
""")
def stream_stream_cogroup_q(spark, sf) -> DataFrame:
    """Both sides endless: two topics of ``events``, the second one a slice behind until the last run."""
    topics, base, schema = [], scratch_path(spark, "two-streams"), None
    for name, kept in (("left", F.col("offset") % 3 != 0), ("right", F.col("offset") % 3 == 0)):
        path = scratch_path(spark, f"replay-{name}")
        write_slices(time_slices(event_broker_records(spark, sf).where(kept), "timestamp", REPLAY_SLICES), path)
        topics.append(path)
    for i in range(REPLAY_SLICES):
        left = event_pairs(read_slices(spark, topics[0], i))
        right = event_pairs(read_slices(spark, topics[1], i if i == REPLAY_SLICES - 1 else max(0, i - 1)))
        both = stream_stream_cogroup(left, right)
        schema = both.schema
        run_final(both, f"{base}/data", f"{base}/checkpoint")
    return spark.read.schema(schema).parquet(f"{base}/data")


@query("complete_windows", f"""
select event_id as "offset", cast(user_id as varchar) as key, ts::timestamp as ts,
       time_bucket(interval '{FILE_WINDOW}', ts) as window_start,
       time_bucket(interval '{FILE_WINDOW}', ts) + interval '{FILE_WINDOW}' as window_end
from events
where time_bucket(interval '{FILE_WINDOW}', ts) + interval '{FILE_WINDOW}' <= (select max(ts) from events) - interval '{ALLOWED_LATENESS}'
""")
def complete_windows_q(spark, sf) -> DataFrame:
    """Windowed files: only windows that the watermark has passed are read; records inside
    the allowed lateness are in them."""
    path, slices = event_slices(spark, sf)
    base, schema = scratch_path(spark, "complete-windows"), None
    for i in range(slices):
        rows = event_pairs(read_slices(spark, path, i)).select("offset", "key", "ts")
        schema = rows.schema
        run_available(complete_windows_sink(rows, base, f"{base}/checkpoint"))
    return read_complete_windows(spark, base, schema).withColumn("ts", instant_to_ntz("ts"))


@query("stream_length_cutoff", f"""
with e as (select event_id, user_id, event_type, epoch_us(ts) as us from events),
b as (select min(us) as lo, (max(us) - min(us)) // {REPLAY_SLICES} + 1 as step from e),
s as (select e.*, (us - lo) // step as slice from e, b),
m as (select slice, max(max(length(event_type) + user_id % 5)) over (order by slice) as cutoff from s group by slice)
select event_id as "offset", event_type as value, cutoff::bigint as cutoff
from s join m using (slice) where 2 * length(event_type) <= cutoff
""")
def stream_length_cutoff(spark, sf) -> DataFrame:
    """The global cut-off as a running side input: one stream publishes the largest length so far, another
    keeps the records of at most half of it, as of each micro-batch."""
    path, base = scratch_path(spark, "replay-cutoff"), scratch_path(spark, "length-cutoff")
    write_slices(time_slices(event_broker_records(spark, sf), "timestamp", REPLAY_SLICES), path)

    def keep(batch: DataFrame, cutoff):
        return batch.where(2 * F.length("value") <= F.lit(cutoff)).select("offset", "value", F.lit(cutoff).cast("long").alias("cutoff"))
    for i in range(REPLAY_SLICES):
        rows = event_pairs(read_slices(spark, path, i))
        run_available(publish_max(rows, F.length("value") + F.col("key").cast("long") % 5, f"{base}/side", f"{base}/ck-side"))
        run_available(with_side_input(rows, f"{base}/side", keep, f"{base}/data", f"{base}/ck-main"))
    return read_batches(spark, f"{base}/data").select("offset", "value", "cutoff")
