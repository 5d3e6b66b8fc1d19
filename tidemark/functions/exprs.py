"""Small column expressions shared by the operators."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: defaults of the reference ---------------------------------
DEFAULT_SCHEMA = "PUBLIC"
DEFAULT_WATERMARK_COLUMN = "updated_at"
DEFAULT_MERGE_KEY = "id"
DEFAULT_CRON = "0 2 * * *"
TERMINAL_STATUSES = ("complete", "failed", "success")
ERROR_TEXT_LIMIT = 2000
HEAL_ERROR_LIMIT = 200
# --- end of fixed values -----------------------------------------------------


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nonblank(c: Column | str) -> Column:
    """Null for null or empty text (what a Python ``or`` skips)."""
    return F.nullif(_c(c), F.lit(""))


def first_nonblank(*cols: Column | str, default: str | None = None) -> Column:
    parts = [nonblank(c) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def target_name(*cols: Column | str, default: str = DEFAULT_SCHEMA) -> Column:
    """Upper-cased first non-blank of ``cols``, else ``default``."""
    return F.upper(first_nonblank(*cols, default=default))


def ts_lit(value: _dt.datetime | str) -> Column:
    """Timestamp literal without zone (matches timestamp_ntz columns).

    Built from text, so neither the driver's nor the session's time zone
    can shift it."""
    if isinstance(value, _dt.datetime):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def minus_interval(ts: Column, days: int = 0, hours: int = 0, seconds: int = 0) -> Column:
    return ts - F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(0), F.lit(seconds))


def plus_seconds(ts: Column, seconds: Column) -> Column:
    """``ts`` plus a number of seconds (any integer width: the interval takes
    a decimal count of seconds, so large keys do not overflow an int)."""
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def duration_seconds(start: Column | str, end: Column | str) -> Column:
    """Whole seconds between two timestamps; null unless both are set, and a
    zero duration shows as null (as the monitor does)."""
    # zone-free difference: no session-zone conversion of timestamp_ntz values
    micros = F.timestamp_diff("MICROSECOND", _c(start), _c(end))
    secs = F.round(micros / F.lit(1_000_000.0)).cast("bigint")
    return F.nullif(secs, F.lit(0).cast("bigint"))


def month_day(d: Column | str) -> Column:
    return F.date_format(_c(d), "MM-dd")


def cut(c: Column | str, n: int) -> Column:
    """First ``n`` characters (substring is 1-based)."""
    return F.substring(_c(c), 1, n)
