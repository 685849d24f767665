"""Date and time expressions. All wall-clock values are TIMESTAMP_NTZ."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripgrain.schemas import WEEKDAYS

SERVICE_TIME = r"^[0-9]{1,2}:[0-5][0-9]:[0-5][0-9]$"


def wall_literal(moment: datetime) -> Column:
    """A literal wall-clock timestamp, the same in every session and Python time zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def text_date(value: Column) -> Column:
    """``yyyyMMdd`` text to a date; anything else is NULL."""
    return F.try_to_date(value, "yyyyMMdd")


def date_key(day: Column) -> Column:
    """Integer key yyyymmdd."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def runs_on_weekday(day: Column) -> Column:
    """Whether the weekly flags of the calendar row allow ``day``; ``weekday`` counts Monday as 0."""
    return F.get(F.array(*[F.col(name) for name in WEEKDAYS]), F.weekday(day)) == 1


def service_seconds(text: Column) -> Column:
    """Seconds after midnight of the service date; hours may reach 24 and more. Malformed text is NULL."""
    hours = F.substring_index(text, ":", 1).cast("int")
    minutes, seconds = (F.substring(text, at, 2).cast("int") for at in (-5, -2))
    return F.when(text.rlike(SERVICE_TIME), hours * 3600 + minutes * 60 + seconds)


def wall_time(day: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, day.cast("timestamp_ntz"))


def day_offset(seconds: Column) -> Column:
    return F.floor(seconds / 86400).cast("int")


def compact_timestamp(text: Column) -> Column:
    """``yyMMddHHmm`` text to a timestamp; blank, missing or impossible values are NULL."""
    iso = F.regexp_replace(
        F.trim(text), r"^(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$", "20$1-$2-$3 $4:$5:00"
    )
    return F.when(F.trim(text).rlike(r"^\d{10}$"), iso.try_cast("timestamp_ntz"))


def delay_minutes(planned: Column, changed: Column) -> Column:
    """Whole minutes between two wall-clock times; NULL when either is missing, never 0 for it."""
    return (changed - planned).cast("interval minute").cast("int")


def is_cancelled(status: Column) -> Column:
    return F.coalesce(status == "c", F.lit(False))


def platform_changed(planned: Column, changed: Column) -> Column:
    """1 when both platforms are known and differ, else 0."""
    return F.when(planned.isNotNull() & changed.isNotNull() & (planned != changed), 1).otherwise(0)


def as_utc_instant(wall: Column) -> Column:
    """The wall clock read as UTC, for operators that need an instant (watermarks)."""
    return F.make_timestamp_ltz(
        F.year(wall), F.month(wall), F.dayofmonth(wall), F.hour(wall), F.minute(wall),
        F.extract(F.lit("SECOND"), wall), F.lit("UTC"),
    )


def as_wall_clock(instant: Column) -> Column:
    """Inverse of :func:`as_utc_instant`, to the second."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", F.unix_seconds(instant), epoch)
