"""Exports loaded from files: orders and attendees, and the older attendee lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmart import vocab
from ticketmart.functions.numbers import offline_event_id
from ticketmart.operators import harmonise, joins
from ticketmart.operators.payload import build_payload, to_payload_text
from ticketmart.operators.pii import hash_sensitive


def exported_orders(
    attendees: DataFrame,
    orders: DataFrame,
    year: int,
    group: str,
    event_name: str,
    answers: Sequence[str],
    meta_fields: dict[str, str] = vocab.OFFLINE_META_FIELDS,
    only_live: bool = False,
) -> DataFrame:
    """Rows of the raw table from an attendee export and an order export."""
    if year <= 2020:
        raise ValueError("year must be after 2020")
    key, status = vocab.OFFLINE_ORDER_KEY, vocab.OFFLINE_STATUS
    harmonise.require_columns(orders, [key, status])
    harmonise.require_columns(attendees, [key])
    merged = joins.left_join_orders(
        attendees, orders, key, status, vocab.OFFLINE_LIVE_STATUS, only_live
    )
    harmonise.require_columns(merged, [*meta_fields.values(), *answers])
    payload = build_payload(merged.columns, answers, meta_fields)
    hashed = F.col("payload").withField("data", hash_sensitive(F.col("payload.data")))
    return merged.select(payload.alias("payload")).select(
        offline_event_id(year, F.lit(group), vocab.TICKET_GROUPS).alias("id"),
        F.lit(event_name).alias("name"),
        to_payload_text(hashed).alias("attendee_info"),
        F.lit(False).alias("refunded"),
    )


def older_attendees(export: DataFrame) -> DataFrame:
    """Attendee lists up to 2021 under canonical names, with emails hashed."""
    return harmonise.hash_emails(
        harmonise.harmonise(
            harmonise.drop_columns(export, ["Email"]), harmonise.UNTIL_2021
        )
    )
