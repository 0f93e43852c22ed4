"""UTC wall-clock <-> instant conversions must not depend on the session zone."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewire.functions.time import epoch_micros, instant_to_ntz, ntz_to_instant


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Kolkata"])
def test_round_trip_and_epoch_in_any_session_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([("2024-03-10 02:30:00.123456",), ("2024-01-01 00:00:07",)], "t string") \
            .select(F.col("t").cast("timestamp_ntz").alias("ts"))
        out = df.select("ts", instant_to_ntz(ntz_to_instant("ts")).alias("back"),
                        epoch_micros("ts").alias("us")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    for r in out:
        assert r.back == r.ts
        want = int((r.ts.replace(tzinfo=dt.timezone.utc) - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc))
                   / dt.timedelta(microseconds=1))
        assert r.us == want
