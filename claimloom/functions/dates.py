"""Dates and scores as column expressions. ``now`` is always a parameter."""

from __future__ import annotations

from datetime import UTC, datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000
# Fixed value: the zone of runs and schedules that name none, or none that exists.
DEFAULT_ZONE = "Asia/Manila"


def valid_zone(zone: str | None) -> str:
    try:
        return ZoneInfo(zone or DEFAULT_ZONE).key
    except (KeyError, ValueError, OSError):  # no such zone, or no name of one
        return DEFAULT_ZONE


def clock(now: str, zone: str | None) -> dict[str, str]:
    """Of a run's time (ISO; without zone UTC): local time with offset, UTC time, and the zone, or the default zone where
    there is none of that name."""
    name = valid_zone(zone)
    at = datetime.fromisoformat(now)
    at = at.replace(tzinfo=at.tzinfo or UTC).astimezone(ZoneInfo(name))
    return {"timestamp": at.isoformat(), "timestamp_utc": at.astimezone(UTC).isoformat().replace("+00:00", "Z"), "timezone": name}


def micros(c: Column) -> Column:
    """Microseconds since the epoch of an ISO time; a time without zone is UTC, anything else null."""
    zoned = F.when(c.rlike(r"(Z|[+-]\d{2}:?\d{2})\s*$"), c).otherwise(F.concat(c, F.lit("Z")))
    return F.unix_micros(F.try_to_timestamp(zoned))


def epoch(c: Column) -> Column:
    """Seconds since the epoch, 0 for what is no time."""
    return F.coalesce(micros(c) / 1e6, F.lit(0.0))


def days_since(c: Column, now: Column) -> Column:
    """Days as a number, never below 0; infinite for what is no time."""
    days = (micros(now) - micros(c)) / float(DAY_MICROS)
    return F.when(days.isNull(), float("inf")).otherwise(F.greatest(days, F.lit(0.0)))


def age_days(c: Column, now: Column) -> Column:
    """Whole days, 0 for what is no time or lies ahead."""
    return F.coalesce(F.greatest(F.floor((micros(now) - micros(c)) / DAY_MICROS), F.lit(0)), F.lit(0)).cast("long")


def time_triple(now: Column, zone: str) -> list[Column]:
    """Local time with offset, UTC time and zone (the default zone where there is none of that name)."""
    zone = valid_zone(zone)
    utc = F.timestamp_micros(micros(now))
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.to_timestamp_ntz(F.date_format(utc, "yyyy-MM-dd HH:mm:ss")))
    minutes = F.round((F.unix_micros(F.to_utc_timestamp(F.from_utc_timestamp(utc, zone), "UTC")) - F.unix_micros(utc)) / 60e6).cast("int")
    sign = F.when(minutes < 0, "-").otherwise("+")
    offset = F.concat(sign, F.lpad(F.floor(F.abs(minutes) / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((F.abs(minutes) % 60).cast("string"), 2, "0"))
    return [
        F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), offset).alias("timestamp"),
        F.concat(F.date_format(F.to_timestamp_ntz(F.date_format(utc, "yyyy-MM-dd HH:mm:ss")), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("timestamp_utc"),
        F.lit(zone).alias("timezone")
    ]


def recall_score(status: Column, age: Column, sources: Column, recurrence: Column) -> Column:
    """Age, state, support and recurrence of a claim, each bounded; round it half to even where it is shown."""
    weight = F.when(status == "contested", 3.0).when(status == "unresolved", 2.0).when(status == "retire_candidate", 1.0).otherwise(0.0)
    again = F.floor(F.coalesce(recurrence, F.lit(0.0))).cast("double")
    return F.least(age.cast("double"), F.lit(14.0)) * 0.1 + weight + F.least(sources.cast("double"), F.lit(5.0)) * 0.3 + F.least(again, F.lit(10.0)) * 0.2


def in_window(day_of_week: Column, hour: Column, schedules: list[str]) -> Column:
    """Does a local time (Sunday is 0) lie within an hour of one of the ``minute hour * * days`` schedules?"""
    found = F.lit(False)
    for fields in (s.split() for s in schedules):
        if len(fields) != 5 or not fields[1].isdigit():
            continue
        days = [int(d) for d in fields[4].split(",") if d.isdigit()]
        found = found | (day_of_week.isin(days) & (F.abs(hour - int(fields[1])) <= 1))
    return found
