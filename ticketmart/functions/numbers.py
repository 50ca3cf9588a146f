"""Number functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def long_or_null(text: Column) -> Column:
    return text.try_cast("long")


def double_or_null(text: Column) -> Column:
    return text.try_cast("double")


def strict_number(text: Column) -> Column:
    """Number from text: blank is missing, anything else that is no number fails the job."""
    return F.nullif(F.trim(text.cast("string")), F.lit("")).cast("double")


def offline_event_id(year: int | Column, group: Column, groups: tuple[str, ...]) -> Column:
    """Event id for imports without one: 999000, the year, and 0 plus the group's number."""
    code = F.array_position(F.array(*[F.lit(g) for g in groups]), group) - 1
    year = year if isinstance(year, Column) else F.lit(year)
    event_id = F.concat(
        F.lit("999000"), year.cast("string"), F.lit("0"), code.cast("string")
    ).cast("long")
    return F.when(code >= 0, event_id).otherwise(
        F.raise_error(F.concat(F.lit("unknown ticket group: "), group)).cast("long")
    )
