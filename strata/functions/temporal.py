"""Time parsing and wall-clock conversion.

The ``try_`` forms are deliberate: with ANSI mode on, one malformed value would otherwise fail a whole job,
while the data model asks for a null that the row rules can then reject with a reason.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.types import whole_number

# The local zone of the trips and the accepted timestamp spellings.
LOCAL_TIME_ZONE = "America/New_York"
TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy HH:mm:ss")


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def utc_to_local(value: Column | str, zone: str = LOCAL_TIME_ZONE) -> Column:
    """Wall-clock time in ``zone`` of a UTC instant (in a session that runs in UTC)."""
    return F.from_utc_timestamp(_column(value), zone)


def first_timestamp(value: Column | str, formats: tuple[str, ...] = TIMESTAMP_FORMATS) -> Column:
    """The first reading that parses: Spark's own cast, then each explicit format."""
    col = _column(value)
    text = col.cast("string")
    return F.coalesce(col.try_cast("timestamp"), *[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def date_and_time(day: Column | str, clock: Column | str) -> Column:
    """A timestamp from a date column and an ``HH:mm`` or ``HH:mm:ss`` column; null when either is unusable."""
    text = F.concat(
        F.date_format(_column(day).try_cast("date"), "yyyy-MM-dd"), F.lit(" "), _column(clock).cast("string")
    )
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm")),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")),
    )


def timestamp_from_parts(year, month, day, hour) -> Column:
    """The top of the hour named by four integer columns; null for impossible dates."""
    parts = [whole_number(_column(c)) for c in (year, month, day, hour)]
    return F.try_make_timestamp(*parts, F.lit(0), F.lit(0))


def hour_start(value: Column | str) -> Column:
    """Truncate to the hour."""
    return F.date_trunc("hour", _column(value))


def month_start(value: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(_column(value), "MM")


def calendar_parts(value: Column | str) -> dict[str, Column]:
    """Weekday (Sunday is 1), month, hour, whether it is a weekend, and the hour as a point on a circle; all doubles."""
    at = _column(value)
    weekday, hour = F.dayofweek(at), F.hour(at)
    turn = hour * (2 * math.pi / 24)
    parts = {"day_of_week": weekday, "month": F.month(at), "hour_of_day": hour, "is_weekend": weekday.isin(1, 7).cast("int")}
    return {name: part.cast("double") for name, part in parts.items()} | {"sin_hour": F.sin(turn), "cos_hour": F.cos(turn)}


def shift_seconds(value: Column | str, seconds: Column | int) -> Column:
    """Move a timestamp by whole seconds; fractions below a second are dropped, as in epoch seconds."""
    seconds = F.lit(seconds) if isinstance(seconds, int) else seconds
    return F.timestamp_seconds(F.unix_timestamp(_column(value).cast("timestamp")) + seconds)
