"""Dates and times: strict ISO-8601 parsing that never throws, and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE = r"^\s*\d{4}-\d{2}-\d{2}\s*$"
_CLOCK = r"^\s*\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?"
ISO_LOCAL = _CLOCK + r"\s*$"
ISO_ZONED = _CLOCK + r"(?:[Zz]|[+-](?:0\d|1[0-7]):?[0-5]\d)\s*$"
_COMPACT_OFFSET = r"([+-]\d{2})(\d{2})(\s*)$"


def iso_date(c: Column) -> Column:
    """A ``YYYY-MM-DD`` text as a date; NULL when malformed or impossible."""
    return F.when(c.rlike(ISO_DATE), c).try_cast("date")


def iso_timestamp(c: Column) -> Column:
    """An ISO-8601 date-time as a zone-less timestamp; NULL when malformed or impossible.

    A bare year or date is not a date-time. A text with an offset is read as an instant and given in
    UTC by way of its microseconds, so the result does not depend on the session time zone; a text
    without one is kept as written.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    spelled = F.upper(F.regexp_replace(c, _COMPACT_OFFSET, "$1:$2"))
    instant = F.unix_micros(spelled.try_cast("timestamp"))
    return F.when(c.rlike(ISO_LOCAL), F.upper(c).try_cast("timestamp_ntz")).when(
        c.rlike(ISO_ZONED), F.timestamp_add("MICROSECOND", instant, epoch)
    )


def iso_day_of_week(d: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(d) + 1


def is_weekend(d: Column) -> Column:
    return F.weekday(d) >= 5
