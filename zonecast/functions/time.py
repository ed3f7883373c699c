"""Time expressions that keep TIMESTAMP_NTZ columns zone-free.

``date_trunc`` on a TIMESTAMP_NTZ value goes through the session-zone
TIMESTAMP type, which shifts wall-clock hours around DST changes.  A tumbling
``window`` start is computed on the raw micros of the NTZ value and stays NTZ.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_GRAINS = {"hour": "1 hour", "day": "1 day", "minute": "1 minute"}


def grain_interval(grain: str) -> str:
    if grain not in _GRAINS:
        raise ValueError(f"grain must be one of {sorted(_GRAINS)}, got {grain!r}")
    return _GRAINS[grain]


def floor_time(ts: Column | str, grain: str = "hour") -> Column:
    """Floor a timestamp to the start of its hour (or day / minute)."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.window(col, grain_interval(grain)).start


def hour_of_day(ts: Column | str) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column | str) -> Column:
    """Monday = 0 … Sunday = 6 (``dayofweek`` would give Sunday = 1)."""
    return F.weekday(ts)


def is_weekend(ts: Column | str) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def hour_series(lo: Column | str, hi: Column | str, grain: str = "hour") -> Column:
    """Array of every grain step from ``lo`` to ``hi`` inclusive (NTZ, DST-free)."""
    return F.sequence(F.col(lo) if isinstance(lo, str) else lo,
                      F.col(hi) if isinstance(hi, str) else hi,
                      F.expr(f"INTERVAL {grain_interval(grain)}"))


def ntz_literal(value) -> Column:
    """A zone-free TIMESTAMP_NTZ literal for a Python datetime or date.

    ``lit(datetime)`` builds a session-zone TIMESTAMP from the *Python
    process's* local zone, which shifts wall-clock values when compared with
    TIMESTAMP_NTZ columns; casting the ISO text keeps the value as written.
    """
    text = value.isoformat(sep=" ") if hasattr(value, "hour") else value.isoformat()
    return F.lit(text).cast("timestamp_ntz")
