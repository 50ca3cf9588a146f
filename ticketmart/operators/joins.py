"""Joins, snapshot differences and upserts.

No side is broadcast by hint here: every side grows with the data, so the
choice is left to Spark's own size check, and a large left side with a hot key
is split by adaptive execution. Sides that only say "this key exists" are made
distinct first, which sends one row per key and task into the shuffle.

Adaptive execution splits a partition only if both sides of the join come
straight from a shuffle made for it. A distinct side would instead be joined as
the aggregation left it, so such joins compare keys null-safely: the keys then
are not the aggregation's, and Spark shuffles its (small) result once more.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmart.config import moment
from ticketmart.functions.text import missing_as
from ticketmart.operators.filters import rows_if_any


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a & b, [left[f"`{name}`"].eqNullSafe(right[f"`{name}`"]) for name in columns]
    )


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Joins on keys of the same name, of which the left ones are kept.

    Keys are compared null-safely, for the reason given above.
    """
    if how in ("left_anti", "left_semi"):
        return left.join(right, _same(left, right, keys), how)
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    same = reduce(
        lambda a, b: a & b, [left[key].eqNullSafe(renamed[f"_right_{key}"]) for key in keys]
    )
    return left.join(renamed, same, how).drop(*[f"_right_{key}" for key in keys])


def left_join_orders(
    attendees: DataFrame,
    orders: DataFrame,
    key: str,
    status: str | None = None,
    live_status: str | None = None,
    only_live: bool = False,
) -> DataFrame:
    """Attendees with the columns of their order that they lack themselves.

    A missing order number matches a missing one, and an attendee row repeats
    for repeated orders. With a status column, no live order at all gives an
    empty result; only with `only_live` are the other orders left out.
    """
    if status is not None:
        live = orders.where(F.col(f"`{status}`") == live_status)
        attendees = rows_if_any(attendees, live)
        orders = live if only_live else orders
    extra = [name for name in orders.columns if name not in attendees.columns]
    right = orders.select(
        F.col(f"`{key}`").alias("_order_key"), *[F.col(f"`{name}`") for name in extra]
    )
    return attendees.join(
        right, attendees[f"`{key}`"].eqNullSafe(right["_order_key"]), "left"
    ).drop("_order_key")


def left_only_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows with no equal row on the right, over all common columns; repeats are kept."""
    common = [name for name in left.columns if name in right.columns]
    known = right.select(*[F.col(f"`{name}`") for name in common]).distinct()
    return join_on(left, known, common, "left_anti")


def refunded_attendees(
    known: DataFrame, latest: DataFrame, snapshot_events: DataFrame | None = None
) -> DataFrame:
    """(event_id, attendee_id) known as live but absent from the event's latest list.

    An event without a landed list says nothing about its attendees and is left
    out; pass the landed events if a list can be empty.
    """
    keys = ["event_id", "attendee_id"]
    named = known.where("attendee_id IS NOT NULL").select(*keys).distinct()
    gone = named.join(latest.select(*keys).distinct(), keys, "left_anti")
    landed = (snapshot_events if snapshot_events is not None else latest).select("event_id")
    return join_on(gone, landed.distinct(), ["event_id"], "left_semi")


def mark_refunded(
    orders: DataFrame,
    refunded: DataFrame,
    attendee_id: Column,
    event_id: Column | None = None,
) -> DataFrame:
    """Sets `refunded` where the attendee is in the set; all else stays as it is.

    By attendee id alone, of any event, unless the event id is given too.
    """
    names = ["attendee_id"] if event_id is None else ["attendee_id", "event_id"]
    keyed = orders.withColumn("_attendee_id", attendee_id)
    if event_id is not None:
        keyed = keyed.withColumn("_event_id", event_id)
    hits = refunded.select(*[F.col(name).alias(f"_{name}") for name in names]).distinct()
    hits = hits.withColumn("_hit", F.lit(True))
    return join_on(keyed, hits, [f"_{name}" for name in names], "left").select(
        *[
            F.when(F.col("_hit"), True).otherwise(F.col("refunded")).alias("refunded")
            if name == "refunded"
            else F.col(f"`{name}`")
            for name in orders.columns
        ]
    )


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    as_of: datetime | str | None = None,
    time_column: str = "update_time",
) -> DataFrame:
    """Target rows updated from the source row of their key, and the other source rows.

    A missing key part matches nothing, so such rows never take part in a
    shuffle. Two source rows for one target row fail the job. Matched target
    rows, however many share a key, are on the left of the join, where a hot key
    can be split.
    """
    keys, attributes = list(keys), list(attributes)
    now = moment(as_of)
    keyed = reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])
    unkeyed = ~keyed

    offers = (
        source.where(keyed)
        .groupBy(*keys)
        .agg(F.count("*").alias("_offers"), F.first(F.struct(*attributes)).alias("_new"))
    )
    ambiguous = F.raise_error(F.lit("several source rows match one target row")).cast("boolean")
    hit = F.when(F.col("_offers") > 1, ambiguous).otherwise(F.col("_offers") == 1)
    joined = join_on(target.where(keyed), offers, keys, "left").withColumn("_hit", hit)
    updated = joined.select(
        *keys,
        *[
            F.when(F.col("_hit"), F.col("_new")[name]).otherwise(F.col(name)).alias(name)
            for name in attributes
        ],
        F.when(F.col("_hit"), now).otherwise(F.col(time_column)).alias(time_column),
    )
    present = target.where(keyed).select(*keys).distinct()
    fresh = join_on(source.where(keyed), present, keys, "left_anti").unionByName(
        source.where(unkeyed)
    )
    inserted = fresh.select(*keys, *attributes, now.alias(time_column))
    columns = target.columns
    kept = target.where(unkeyed).select(*columns)
    return kept.unionByName(updated.select(*columns)).unionByName(inserted.select(*columns))


def price_of(ticket: Column, prices: Mapping[str, int]) -> Column:
    """Price from the price list, which is a job parameter; unlisted tickets cost nothing."""
    table = F.create_map(*[F.lit(part) for pair in prices.items() for part in pair])
    return missing_as(table[ticket], 0)


def groups_named(name: Column, groups: Sequence[str]) -> Column:
    """The ticket groups a name mentions, joined by `+`; `none` if there are none."""
    mentioned = F.filter(
        F.array(*[F.lit(group) for group in groups]),
        lambda group: F.contains(F.lower(name), group),
    )
    return F.when(F.size(mentioned) > 0, F.array_join(mentioned, "+")).otherwise("none")


def in_group(ticket_groups: Column, group: str) -> Column:
    return F.array_contains(F.split(ticket_groups, r"\+"), group)


def route(rows: DataFrame, name: Column, groups: Sequence[str], forced: str | None = None) -> DataFrame:
    """One copy of a row for every ticket group its name mentions, or for a forced group."""
    if forced is not None:
        return rows.withColumn("ticket_group", F.lit(forced))
    mentioned = F.filter(
        F.array(*[F.lit(group) for group in groups]),
        lambda group: F.contains(F.lower(name), group),
    )
    return rows.withColumn("ticket_group", F.explode(mentioned))
