"""Landed replies of the ticket system.

`events/`            {"data": [{"id", "name", ...}, ...]}
`attendance_books/`  {"event_id", "books": [{"id", "signin_status": [[attendee, ...], ...]}]}
`attendees/`         {"event_id", "attendee_info": {...}}

A long attendance book may be landed in several lines of the same event.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmart.operators.joins import join_on

EVENTS = "data array<struct<id:bigint,name:string>>"
BOOKS = (
    "event_id bigint, books array<struct<id:bigint,signin_status:array<array<string>>>>"
)
# the payload stays text, so that no field is lost to a schema
ATTENDEES = "event_id bigint, attendee_info string"


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return events(spark.read.schema(EVENTS).json(f"{folder}/events"))


def events(replies: DataFrame) -> DataFrame:
    """Id and name of each event, once, however often it was landed."""
    found = replies.select(F.explode("data").alias("event"))
    return found.groupBy(F.col("event.id").alias("event_id")).agg(
        F.max("event.name").alias("name")
    )


def read_books(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(BOOKS).json(f"{folder}/attendance_books")


def first_book_id(books: DataFrame) -> DataFrame:
    return books.select("event_id", F.get("books", F.lit(0))["id"].alias("book_id"))


def attendee_ids(books: DataFrame) -> DataFrame:
    """(event_id, attendee_id) of the first attendance book of each event."""
    signed = F.get("books", F.lit(0))["signin_status"]
    ids = F.transform(signed, lambda status: F.get(status, F.lit(0)).cast("long"))
    return books.select("event_id", F.explode(ids).alias("attendee_id"))


def read_attendees(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(ATTENDEES).json(f"{folder}/attendees")


def tickets(
    event_rows: DataFrame, attendees: DataFrame, keep: Sequence[str] = ()
) -> DataFrame:
    """(id, name, attendee_info): every attendee under its event's id and name.

    One event may have much of the attendees; the join can split it. `keep` names
    further columns of the attendees.
    """
    placed = attendees.where(F.col("event_id").isNotNull())
    return join_on(placed, event_rows, ["event_id"], "inner").select(
        F.col("event_id").alias("id"), "name", "attendee_info", *keep
    )
