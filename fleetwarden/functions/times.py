"""Time expressions. Every operator takes ``as_of`` instead of the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The day number of 1970-01-01 counted from year 0, the stamp inside backup paths.
EPOCH_DAY_NUMBER = 719528
BACKUP_STAMP = r"([0-9]{8}-[0-9]{6})"
BACKUP_STAMP_FORMAT = "yyyyMMdd-HHmmss"
REPORT_TIME_FORMAT = "yyyy/MM/dd HH:mm:ss"


def as_datetime(as_of: str | dt.date | dt.datetime) -> dt.datetime:
    if isinstance(as_of, str):
        return dt.datetime.fromisoformat(as_of)
    if isinstance(as_of, dt.datetime):
        return as_of
    return dt.datetime.combine(as_of, dt.time())


def midnight(as_of: str | dt.date | dt.datetime, days: int = 0) -> dt.datetime:
    """Midnight ``days`` after (before, if negative) the day of ``as_of``."""
    day = as_datetime(as_of).date() + dt.timedelta(days=days)
    return dt.datetime.combine(day, dt.time())


def time_literal(df: DataFrame, column: str, value: dt.datetime) -> Column:
    """A literal of the column's own time type, so that the comparison reaches the file scan."""
    return F.lit(value.isoformat(sep=" ")).cast(df.schema[column].dataType)


def epoch_seconds(value: dt.datetime) -> int:
    return int(value.replace(tzinfo=dt.timezone.utc).timestamp())


def from_day_number(n: Column) -> Column:
    """The date of a day number counted from year 0."""
    return F.date_add(F.lit("1970-01-01").cast("date"), (n - EPOCH_DAY_NUMBER).cast("int"))


def backup_start(path: Column) -> Column:
    """Start time from the stamp in a backup path; NULL where the path has none."""
    stamp = F.regexp_extract(path, BACKUP_STAMP, 1)
    return F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit(BACKUP_STAMP_FORMAT))


def log_prefixes(as_of: str | dt.datetime, interval: str) -> tuple[str, str]:
    """Line prefixes wanted for ``day``, ``hour`` or ``now``, in the old and the new date format.

    The old format pads the hour with a space.
    """
    now = as_datetime(as_of)
    if interval == "day":
        day = now - dt.timedelta(days=1)
        return day.strftime("%y%m%d"), day.strftime("%Y-%m-%d")
    if interval not in ("hour", "now"):
        raise ValueError(f"interval must be day, hour or now, not {interval!r}")
    hour = now - dt.timedelta(hours=1) if interval == "hour" else now
    return f"{hour:%y%m%d} {hour.hour:2d}", f"{hour:%Y-%m-%d %H}"


def log_time(line: Column) -> Column:
    """Event time of a log line in either format, NULL for lines without a date prefix."""
    new = F.try_to_timestamp(F.regexp_extract(line, r"^(\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2})", 1))
    old = F.regexp_extract(line, r"^(\d{6}) ([ \d]\d):(\d{2}):(\d{2})", 0)
    padded = F.concat(F.substring(old, 1, 7), F.translate(F.substring(old, 8, 8), " ", "0"))
    return F.coalesce(new, F.try_to_timestamp(F.nullif(padded, F.lit("")), F.lit("yyMMdd HH:mm:ss")))
