"""Event-time column helpers.

The test tables store wall-clock UTC times as ``TIMESTAMP_NTZ``.  A
watermark needs an instant (``TIMESTAMP``), so streams convert on the
way in and back on the way out.  The conversions name UTC explicitly,
so they do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ntz_to_instant(col) -> Column:
    """UTC wall-clock ``TIMESTAMP_NTZ`` -> ``TIMESTAMP`` instant."""
    local_wall = F.convert_timezone(F.lit("UTC"), F.current_timezone(), _c(col))
    return local_wall.cast("timestamp")


def instant_to_ntz(col) -> Column:
    """``TIMESTAMP`` instant -> UTC wall-clock ``TIMESTAMP_NTZ``."""
    local_wall = _c(col).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local_wall)


def epoch_micros(col) -> Column:
    """Microseconds since the epoch of a UTC wall-clock ``TIMESTAMP_NTZ``."""
    return F.unix_micros(ntz_to_instant(col))
