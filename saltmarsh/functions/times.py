"""Dates and times: Column to Column. Instants are UTC; zones are arguments, never the session's."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_epoch_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms.cast("long"))


def localized(wall: Column, zone: str) -> Column:
    """The instant of a wall-clock time in a zone. An hour skipped by a clock change moves on; a repeated one is the first."""
    return F.to_utc_timestamp(wall, zone)


def in_zone(instant: Column, zone: str) -> Column:
    """The wall-clock time of an instant in a zone."""
    return F.from_utc_timestamp(instant, zone)


def report_hour(day: Column, hour: Column, offset_hours: int = -8) -> Column:
    """The instant of a report's hour h, which counts at a fixed offset from UTC all year."""
    return F.timestamp_add("HOUR", hour - offset_hours, day.cast("timestamp_ntz"))


def iso_week_monday(year: Column, week: Column) -> Column:
    """The Monday of an ISO week; null for a week that the year doesn't have."""
    first = F.date_trunc("week", F.make_date(year, F.lit(1), F.lit(4))).cast("date")
    monday = F.date_add(first, ((week - 1) * 7).cast("int"))
    thursday = F.date_add(monday, 3)
    return F.when((week >= 1) & (F.year(thursday) == year), monday)


def try_date(text: Column, pattern: str) -> Column:
    """Parses by a pattern; null where the text doesn't fit."""
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


def date_plus_time(day: Column, time: Column) -> Column:
    """A date and an 'HH:mm:ss' text as one wall-clock time; null if either is missing or unreadable."""
    return F.try_to_timestamp(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), time), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


def iso_text(instant: Column, zone: str = "UTC") -> Column:
    """ISO-8601 text with the zone's own offset, whatever the session's zone."""
    wall = F.from_utc_timestamp(instant.cast("timestamp_ntz"), zone)
    minutes = (F.unix_timestamp(wall.cast("timestamp")) - F.unix_timestamp(instant.cast("timestamp_ntz").cast("timestamp"))) / 60
    sign = F.when(minutes < 0, "-").otherwise("+")
    return F.concat(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"), sign, F.format_string("%02d:%02d", F.floor(F.abs(minutes) / 60), F.abs(minutes).cast("long") % 60))


def interval_text(start: Column, end: Column, not_before: Column) -> Column:
    """'start/end' as ISO text, the start no earlier than ``not_before``; null if either end is null."""
    shown = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(start.isNotNull() & end.isNotNull(), F.concat(shown(F.greatest(start, not_before)), F.lit("/"), shown(end)))


def regular_grid(start: Column, end: Column, seconds: int) -> Column:
    """array of instants start, start + step ... below end (left-closed)."""
    whole = F.sequence(start, end, F.expr(f"INTERVAL {int(seconds)} SECONDS"))
    return F.when(start < end, F.filter(whole, lambda t: t < end)).otherwise(F.expr("cast(array() as array<timestamp_ntz>)"))
