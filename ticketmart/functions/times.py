"""Time functions. Texts without a zone are read in the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_to_date_text(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd")


def epoch_seconds(time: Column) -> Column:
    return F.unix_micros(time) / 1e6


def slash_time_to_epoch(text: Column) -> Column:
    """`2023/04/22 15:47:04` as epoch seconds; blank or malformed text is missing."""
    return epoch_seconds(F.try_to_timestamp(text, F.lit("yyyy/M/d H:m:s")))


def offset_time(text: Column) -> Column:
    """ISO-8601 with an offset (`+0000`, `+00:00` or `Z`)."""
    return F.to_timestamp(text, "yyyy-MM-dd'T'HH:mm:ss[XXX][XX]")


def offset_time_text(text: Column) -> Column:
    """The same with a blank for the T, and UTC for a zero offset."""
    return F.regexp_replace(F.regexp_replace(text, "T", " "), r"\+0000$", "UTC")


def zulu_time(text: Column) -> Column:
    return F.to_timestamp(text, "yyyy-MM-dd'T'HH:mm:ssX")


def millis_to_seconds(millis: Column) -> Column:
    return millis / 1000


def year_of_date_text(text: Column, strict: bool = False) -> Column:
    """Year of a `yyyy-MM-dd` text; malformed text fails the job if strict, else is missing."""
    date = F.to_date(text, "yyyy-MM-dd") if strict else F.try_to_date(text, "yyyy-MM-dd")
    return F.year(date).cast("long")
