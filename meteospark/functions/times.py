"""UTC time handling on TIMESTAMP_NTZ columns. Nothing here reads the clock."""

from __future__ import annotations

import math

from pyspark.sql import Column, SparkSession, functions as F

from meteospark.session import require_utc


def minutes(n: int) -> Column:
    return F.expr(f"INTERVAL '{int(n)}' MINUTE")


def instant(value) -> Column:
    """A UTC instant given as text, datetime or Column."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp_ntz")


def _in_utc() -> None:
    """Refuses a session of another zone where a cast goes through the session's zone."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        require_utc(spark.conf.get("spark.sql.session.timeZone"))


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970; the session must be in UTC."""
    _in_utc()
    return F.unix_seconds(ts.cast("timestamp"))


def from_epoch(seconds: Column) -> Column:
    _in_utc()
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end."""
    _in_utc()
    micros = lambda ts: F.unix_micros(ts.cast("timestamp"))
    return F.floor((micros(end) - micros(start)) / 1000000)


def floor_minute(ts: Column) -> Column:
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def floor_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def floor_slot(ts: Column, slot_minutes: int) -> Column:
    """The start of the slot of so many minutes, counted from the epoch."""
    step = slot_minutes * 60
    return from_epoch(F.floor(epoch_seconds(ts) / step) * step)


def epoch_to_minute(epoch: Column) -> Column:
    """Epoch seconds to a UTC timestamp floored to the minute."""
    return from_epoch(F.floor(epoch / 60) * 60)


def to_local(ts: Column, zone: str) -> Column:
    """UTC wall time to the wall time of a zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def to_utc(ts: Column, zone: str) -> Column:
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), ts)


def local_day_bounds(day: str, zone: str) -> tuple[Column, Column]:
    """UTC bounds [start, end) of a local calendar day; 23 or 25 hours on DST changes."""
    start = F.lit(f"{day} 00:00:00").cast("timestamp_ntz")
    return to_utc(start, zone), to_utc(start + F.expr("INTERVAL '1' DAY"), zone)


def in_month(ts: Column, month: str, as_of=None) -> Column:
    """Half-open calendar month, cut at as_of when given."""
    start = F.lit(f"{month}-01").cast("timestamp_ntz")
    inside = (ts >= start) & (ts < start + F.expr("INTERVAL '1' MONTH"))
    return inside if as_of is None else inside & (ts <= instant(as_of))


def in_extended_month(ts: Column, month: str, lookback: int, horizon: int) -> Column:
    """The month with the lookback before it and the horizon after it, in hours."""
    start = F.lit(f"{month}-01").cast("timestamp_ntz")
    end = start + F.expr("INTERVAL '1' MONTH")
    return (ts >= start - minutes(lookback * 60)) & (ts < end + minutes(horizon * 60))


def trailing(ts: Column, as_of, days: int) -> Column:
    """The last `days` days up to and including as_of."""
    end = instant(as_of)
    return (ts >= end - F.expr(f"INTERVAL '{int(days)}' DAY")) & (ts <= end)


def month_of(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def cyclic(ts: Column) -> dict[str, Column]:
    """Hour-of-day and day-of-year as points on a circle."""
    hour = F.hour(ts) + F.minute(ts) / 60.0
    day = F.dayofyear(ts).cast("double")
    return {
        "hour_sin": F.sin(2 * math.pi * hour / 24.0),
        "hour_cos": F.cos(2 * math.pi * hour / 24.0),
        "doy_sin": F.sin(2 * math.pi * day / 365.25),
        "doy_cos": F.cos(2 * math.pi * day / 365.25),
    }
