"""How the headline batch operators grow with input size.

Usage: python tools/scale_check.py [sf_dir] [factors]   e.g. /root/testdata/sf0.1 1,4,16

``events`` is enlarged inside Spark by replicating every row ``f`` times
(``explode(sequence(...))``), with shifted event ids, users and times so
that the copies are new keys and windows; the enlarged table is written
once below the shared checkpoint folder.  For each factor the co-group,
the lookup join and the bracket list run into the ``noop`` sink; time and
shuffle bytes (from the event log) are printed as one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    factors = [int(x) for x in (argv[2] if len(argv) > 2 else "1,4,16").split(",")]
    from pyspark.sql import functions as F

    import bench
    from tidewire import operators as ops
    from tidewire.plans.inputs import PIPELINE_START
    from tidewire.session import build_session, scratch_path

    log_dir = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.compress": "false",
                                 "spark.eventLog.dir": f"file://{log_dir}"})
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    n_users = events.agg(F.max("user_id") + 1).first()[0]
    runs, times, sizes = {}, {}, {}
    for f in factors:
        path = scratch_path(spark, f"scale-events-x{f}")
        copies = events.select("*", F.explode(F.sequence(F.lit(0), F.lit(f - 1))).alias("copy"))
        (copies.select((F.col("event_id") * f + F.col("copy")).alias("event_id"),
                       (F.col("ts") + F.make_dt_interval(F.col("copy") * 31)).alias("ts"),
                       (F.col("user_id") + F.col("copy") * n_users).alias("user_id"), "event_type")
               .write.parquet(path))
        ev = spark.read.parquet(path)
        sizes[f] = ev.count()
        stream = ev.select(F.col("user_id").cast("string").alias("key"), F.col("event_type").alias("value"), "ts")
        bounded = ops.assign_event_time(
            customer.select(F.col("c_custkey").cast("string").alias("key"), F.col("c_mktsegment").alias("value")),
            PIPELINE_START)
        lookup = ops.checked_lookup(customer.select(
            F.col("c_custkey").cast("string").alias("key"), F.col("c_mktsegment").alias("value")))
        shapes = {
            "windowed_cogroup": lambda: ops.windowed_cogroup(stream, bounded),
            "lookup_join": lambda: ops.lookup_join(stream, lookup),
            "bracket_list": lambda: ops.bracket_list(stream, ["key"], "value"),
        }
        for name, build in shapes.items():
            build().write.format("noop").mode("overwrite").save()  # warm-up
            w0, t0 = time.time() * 1000, time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            times[(name, f)] = round(time.perf_counter() - t0, 3)
            runs[f"{name}@{f}"] = (w0, time.time() * 1000)
    spark.stop()
    io = bench._io_per_query(log_dir, runs)
    out = {name: {str(f): {"rows": sizes[f], "sec": times[(name, f)], "shuffle_bytes": io[f"{name}@{f}"][1]}
                  for f in factors} for name in ("windowed_cogroup", "lookup_join", "bracket_list")}
    print(json.dumps(out))


if __name__ == "__main__":
    main(sys.argv)
