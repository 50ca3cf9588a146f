"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmart.config import moment
from ticketmart.functions.text import contains_ignoring_case


def in_interval(column: Column, start: object, end: object, closed: str = "neither") -> Column:
    """Strictly between the bounds; `closed="left"` also takes the lower bound."""
    lower = column >= F.lit(start) if closed == "left" else column > F.lit(start)
    return lower & (column < F.lit(end))


def is_registration(name: Column, year: int) -> Column:
    """Event name holds the year, and `registration` in any case."""
    return F.contains(name, F.lit(str(year))) & contains_ignoring_case(name, "registration")


def name_like(name: Column, year: int | str, ticket_type: str) -> Column:
    return F.lower(name).like(f"%{year}%{ticket_type}%")


def parse_update_after(text: str) -> tuple[int, float]:
    """Year and epoch seconds of a `2023-01-01 09:15:32` job parameter, taken as UTC."""
    time = datetime.strptime(text, "%Y-%m-%d %H:%M:%S").replace(tzinfo=timezone.utc)
    return time.year, time.timestamp()


def updated_since(rows: DataFrame, column: Column, since: float | None) -> DataFrame:
    """Rows at or after a time; no time, or zero, keeps all."""
    return rows.where(column >= F.lit(since)) if since else rows


def is_live(refunded: Column) -> Column:
    return ~F.coalesce(refunded, F.lit(False))


def paid_only(rows: DataFrame, flag: Column) -> DataFrame:
    return rows.where(flag)


def rows_if_any(rows: DataFrame, witnesses: DataFrame) -> DataFrame:
    """All rows if there is at least one witness, else none."""
    seen = witnesses.limit(1).agg(F.count("*"))
    return rows.where(seen.scalar() > 0)


def newer_than(rows: DataFrame, time: Column, known: DataFrame, known_time: str) -> DataFrame:
    """Rows later than the newest known one; all rows if none is known.

    The newest time is a scalar subquery: computed once, with no join.
    """
    newest = known.agg(F.max(known_time)).scalar()
    return rows.where(newest.isNull() | (time > newest))


def recent_values(
    rows: DataFrame,
    column: str,
    time_column: str,
    as_of: datetime | str | None = None,
    days: int = 1,
) -> DataFrame:
    """Distinct values that are present and were updated within the last days."""
    since = moment(as_of) - F.make_dt_interval(F.lit(days))
    return (
        rows.where(F.col(column).isNotNull() & (F.col(time_column) > since))
        .select(column)
        .distinct()
    )


def trailing_year_start(as_of: datetime | str | None = None) -> Column:
    """Midnight 365 days before."""
    return F.date_sub(F.to_date(moment(as_of)), 365).cast("timestamp")


def newer_id(id_text: Column, last_id: Column | str) -> Column:
    """Ids compare as text, so "10" is not newer than "9"."""
    last = last_id if isinstance(last_id, Column) else F.lit(last_id)
    return id_text.cast("string") > last


def complete_rows(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return rows.na.drop("any", subset=list(columns) if columns else None)
