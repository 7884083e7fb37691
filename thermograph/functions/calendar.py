"""Calendar expressions over the reading time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from thermograph.constants import DAY_START_HOUR, NIGHT_START_HOUR


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_night(ts: Column | str, day_start: int = DAY_START_HOUR,
             night_start: int = NIGHT_START_HOUR) -> Column:
    h = F.hour(_col(ts))
    return (h < day_start) | (h >= night_start)


def is_daytime(ts: Column | str, day_start: int = DAY_START_HOUR,
               night_start: int = NIGHT_START_HOUR) -> Column:
    """True in [day_start, night_start), false otherwise, null for null time."""
    h = F.hour(_col(ts))
    return (h < night_start) & (h >= day_start)


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since the epoch for TIMESTAMP or TIMESTAMP_NTZ.

    NTZ values are read as UTC wall-clock time (the session runs in UTC).
    """
    return F.unix_micros(_col(ts).cast("timestamp"))


def floor_div(expr_sql: str, width: int) -> Column:
    """floor(expr / width) for a BIGINT SQL expression, in exact integer
    arithmetic (no rounding through DOUBLE), also for negative values."""
    return F.expr(f"(({expr_sql}) - pmod({expr_sql}, {int(width)})) div {int(width)}")
