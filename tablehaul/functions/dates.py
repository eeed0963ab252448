"""Zoneless timestamps, lenient date parsing and durations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The weekday names that may open a date, and the patterns tried, in order, after the weekday is removed.
WEEKDAY = ("(?i)^(?:mon(?:day)?|tue(?:sday)?|wed(?:nesday)?|thu(?:rsday)?|fri(?:day)?|sat(?:urday)?|sun(?:day)?), "
           "(.*)$")
WITH_ZONE = "d MMM yyyy H:mm:ss z"
WITH_OFFSET = "d MMM yyyy H:mm:ss xx"
WITHOUT_ZONE = "d MMM yyyy H:mm:ss"
DATE_ONLY = "d MMM yyyy"


def ntz(value: dt.datetime | None) -> Column:
    """A zoneless timestamp literal."""
    return F.lit(None if value is None else value.isoformat(sep=" ")).cast("timestamp_ntz")


def same_zone_literal(value: dt.datetime | None, column_type: str) -> Column:
    """A literal of the compared column's own timestamp type, so that the comparison reaches the file scan."""
    return ntz(value).cast(column_type)


def parse_http_date(text: Column | str) -> Column:
    """Parse ``Mon, 01 Jan 2024 10:00:00 GMT``, the same without zone, or ``01 Jan 2024``.

    The result is zoneless; a text that names a zone or an offset such as ``+0200`` is converted to UTC. Blank or unreadable text, and days that do
    not exist, give null.
    """
    text = F.col(text) if isinstance(text, str) else text
    rest = F.regexp_extract(text, WEEKDAY, 1)
    in_session_zone = F.coalesce(*[F.try_to_timestamp(rest, F.lit(p)) for p in (WITH_ZONE, WITH_OFFSET)]).cast("timestamp_ntz")
    with_zone = F.convert_timezone(F.current_timezone(), F.lit("UTC"), in_session_zone)
    without_zone = F.try_to_timestamp(rest, F.lit(WITHOUT_ZONE)).cast("timestamp_ntz")
    date_only = F.try_to_timestamp(text, F.lit(DATE_ONLY)).cast("timestamp_ntz")
    return F.when(text.rlike(WEEKDAY), F.coalesce(with_zone, without_zone)).otherwise(date_only)


def duration_seconds(started: Column, ended: Column) -> Column:
    """Whole seconds between two timestamps; 0 when not started."""
    elapsed = (ended.cast("timestamp_ntz") - started.cast("timestamp_ntz")).cast("interval second").cast("bigint")
    return F.when(started.isNull(), F.lit(0).cast("bigint")).otherwise(elapsed)


def format_duration(started: Column, seconds: Column) -> Column:
    """``2h 03m 04s``, ``3m 04s`` or ``4s``; ``-`` when not started."""
    hours = F.floor(seconds / 3600)
    minutes = F.floor((seconds % 3600) / 60)
    rest = seconds % 60
    return (F.when(started.isNull(), F.lit("-"))
            .when(seconds >= 3600, F.format_string("%dh %02dm %02ds", hours, minutes, rest))
            .when(seconds >= 60, F.format_string("%dm %02ds", minutes, rest))
            .otherwise(F.format_string("%ds", rest)))
