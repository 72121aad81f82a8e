"""Time helpers. Session zone is UTC; wall-clock text is parsed as-is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boxoffice.params import PACIFIC

TS_FMT = "yyyy-MM-dd HH:mm:ss"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ts(x) -> Column:
    """``CAST(text AS TIMESTAMP)``: ``YYYY-MM-DD HH:MM:SS`` text, with a space or a ``T`` between."""
    return _c(x).cast("timestamp")


def week_start_mon(x) -> Column:
    """``date_trunc('week', ts)`` — Monday, as a date."""
    return F.to_date(F.date_trunc("week", _c(x)))


def week_start_sun(x) -> Column:
    """``d - d.wday`` — the Sunday on or before ``d``."""
    d = F.to_date(_c(x))
    return F.date_sub(d, F.dayofweek(d) - 1)


def to_pacific(x) -> Column:
    """UTC instant -> Pacific wall-clock."""
    return F.from_utc_timestamp(_c(x), PACIFIC)


def from_pacific(x) -> Column:
    """Pacific wall-clock -> UTC instant."""
    return F.to_utc_timestamp(_c(x), PACIFIC)


def iso_millis_z(x) -> Column:
    """ISO instant with milliseconds and ``Z`` (control-table timestamps)."""
    return F.date_format(_c(x), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def ts_lit(value) -> Column:
    """A timestamp literal parsed in the session zone (not the Python process's)."""
    return F.to_timestamp(F.lit(value.strftime("%Y-%m-%d %H:%M:%S")), TS_FMT)
