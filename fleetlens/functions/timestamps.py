"""Timestamp conversions. Sessions run in UTC (see ``session.SETTINGS``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def parse_syslog_clock(month: Column, day: Column, clock: Column) -> Column:
    """Month, day and time of a syslog line as a wall clock in the year 2000; null when
    they are no date. 2000 is a leap year, so 29 February passes."""
    text = F.concat_ws(" ", F.lit("2000"), month, day, F.regexp_replace(clock, r"[.,]\d+$", ""))
    return F.try_to_timestamp(text, F.lit("yyyy MMM d H:mm:ss")).cast("timestamp_ntz")


def resolve_syslog_year(parsed: Column, ref_ts: Column, zone: str = "UTC") -> Column:
    """Instant of a parsed syslog time.

    The year is the one of ``ref_ts`` in ``zone``, or the year before when the month
    lies after the reference month. What did not parse yields ``ref_ts``. Counting days
    from the first of the month lets 29 February roll into March.
    """
    here = F.lit(zone)
    local_ref = F.convert_timezone(None, here, ref_ts.cast("timestamp_ntz"))
    year = F.year(local_ref) - (F.month(parsed) > F.month(local_ref)).cast("int")
    month_start = F.make_date(year, F.month(parsed), F.lit(1)).cast("timestamp_ntz")
    into_month = F.make_dt_interval(
        F.day(parsed) - 1, F.hour(parsed), F.minute(parsed), F.second(parsed).cast("decimal(18,6)")
    )
    wall = F.convert_timezone(here, F.current_timezone(), month_start + into_month)
    return F.coalesce(wall.cast("timestamp"), ref_ts)


def syslog_timestamp(month: Column, day: Column, clock: Column, ref_ts: Column, zone: str = "UTC") -> Column:
    """Year-less syslog time to an instant."""
    return resolve_syslog_year(parse_syslog_clock(month, day, clock), ref_ts, zone)


def rfc3339(text: Column) -> Column:
    """RFC 3339 text with any fraction; null when it is something else."""
    shape = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}([.,]\d+)?(Z|[+-]\d{2}:\d{2})$"
    return F.when(text.rlike(shape), F.replace(text, F.lit(","), F.lit(".")).try_cast("timestamp"))


def wall_clock_us(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp."""
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us)


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def from_seconds(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def unix_nanos(ts: Column) -> Column:
    return F.unix_micros(ts) * F.lit(1000)


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def slice_of(ts: Column, seconds: int) -> Column:
    """Start of the fixed time slice a timestamp falls in, in microseconds."""
    us = F.unix_micros(ts)
    return us - F.pmod(us, F.lit(seconds * 1_000_000))


def tick_of(ts: Column, seconds: int) -> Column:
    """Start of the interval a timestamp falls in."""
    return F.timestamp_micros(slice_of(ts, seconds))


def within_lookback(ts: Column, start: Column, minutes: int = 5) -> Column:
    """Whether a record is at most ``minutes`` older than the start of the job."""
    return ts >= start - F.expr(f"INTERVAL {minutes} MINUTES")
