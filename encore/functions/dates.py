"""Date and time expressions.  Business dates are ``yyyyMMdd`` strings."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cols import as_col, ColumnOrName

DAY_FMT = "yyyyMMdd"
TIME14_FMT = "yyyyMMddHHmmss"
TEXT_TIME_FMT = "yyyy-MM-dd HH:mm:ss"
# fixed value: what an unusable 14-digit time becomes
EPOCH_TIME14 = "19700101000000"


def days_before(day: str, n: int) -> str:
    """``yyyyMMdd`` minus ``n`` calendar days (driver-side, for partition bounds)."""
    return (datetime.strptime(day, "%Y%m%d") - timedelta(days=n)).strftime("%Y%m%d")


def days_between(first: str, last: str) -> list[str]:
    """The days of a range, both ends included (driver-side)."""
    days = [first]
    while days[-1] < last:
        days.append(days_before(days[-1], -1))
    return days


def days_before_col(c: ColumnOrName, n: int) -> Column:
    return F.date_format(F.date_sub(F.to_date(as_col(c), DAY_FMT), n), DAY_FMT)


def day_of(ts: ColumnOrName) -> Column:
    """``yyyyMMdd`` text of a timestamp, used as the ``data_dt`` partition value."""
    return F.date_format(as_col(ts), DAY_FMT)


def time14(c: ColumnOrName) -> Column:
    """14-digit time kept, 8-digit day padded with zeros, anything else the epoch."""
    col = as_col(c)
    n = F.length(col)
    return (
        F.when(n == 14, col)
        .when(n == 8, F.concat(col, F.lit("000000")))
        .otherwise(F.lit(EPOCH_TIME14))
    )


_TEXT_TIME_PREFIX = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}"
# epoch milliseconds accepted as a publish time: years 0001 .. 9999
_MIN_EPOCH_MS = -62135596800000.0
_MAX_EPOCH_MS = 253402300799000.0


def normalize_post_time(c: ColumnOrName, zone: str = "UTC") -> Column:
    """Publish time as ``yyyy-MM-dd HH:mm:ss`` text.

    Text that starts with a date-time keeps that prefix (re-formatted, no
    zone involved); otherwise a decimal number is read as epoch milliseconds
    and shown as wall time in ``zone`` -- a fixed zone, not the session's, so
    the result does not depend on who runs the job; otherwise ''.
    """
    col = F.trim(as_col(c))
    prefix = F.regexp_extract(col, _TEXT_TIME_PREFIX, 0)
    # parsed and formatted in the same (session) zone: the wall time is kept
    parsed_text = F.try_to_timestamp(F.nullif(prefix, F.lit("")), F.lit("y-M-d H:m:s"))
    as_number = col.try_cast("double")
    instant = F.when(
        as_number.between(_MIN_EPOCH_MS, _MAX_EPOCH_MS), F.timestamp_millis(as_number.cast("bigint"))
    )
    wall = F.convert_timezone(F.current_timezone(), F.lit(zone), instant.cast("timestamp_ntz"))
    return F.coalesce(
        F.date_format(parsed_text, TEXT_TIME_FMT),
        F.date_format(wall, TEXT_TIME_FMT),
        F.lit(""),
    )


def date_part(c: ColumnOrName) -> Column:
    """First 8 characters of a 14-digit time (``substring(t,1,8)``)."""
    return F.substring(as_col(c), 1, 8)


def clock_part(c: ColumnOrName) -> Column:
    """Characters 9-14 of a 14-digit time (``substring(t,9,6)``)."""
    return F.substring(as_col(c), 9, 6)
