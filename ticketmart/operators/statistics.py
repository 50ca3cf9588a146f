"""Registration statistics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmart.operators.filters import is_live
from ticketmart.operators.joins import price_of
from ticketmart.operators.payload import json_value


def registration_statistics(orders: DataFrame, name_prefix: str) -> DataFrame:
    """Number of live tickets per event name and ticket name, each ticket counted once."""
    tickets = orders.where(is_live(F.col("refunded")) & F.col("name").startswith(name_prefix))
    return ticket_counts(
        tickets,
        F.col("name"),
        json_value("attendee_info", "$.id"),
        json_value("attendee_info", "$.ticket_name"),
    )


def ticket_counts(tickets: DataFrame, name: Column, ticket_id: Column, kind: Column) -> DataFrame:
    unique = tickets.select(
        name.alias("name"), ticket_id.alias("order_id"), kind.alias("ticket_name")
    ).distinct()
    return unique.groupBy("name", "ticket_name").agg(F.count("*").alias("counts"))


def sales_totals(counts: DataFrame, prices: Mapping[str, int]) -> DataFrame:
    """Tickets sold and income over all groups, as one row."""
    income = price_of(F.col("ticket_name"), prices) * F.col("counts")
    return counts.agg(
        F.coalesce(F.sum("counts"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(income), F.lit(0)).cast("long").alias("total_income"),
    )


def attendees_per_event(known: DataFrame) -> DataFrame:
    """Number of known attendees per event; the ids themselves stay rows."""
    return (
        known.select("event_id", "attendee_id")
        .distinct()
        .groupBy("event_id")
        .agg(F.count("*").alias("attendees"))
    )
