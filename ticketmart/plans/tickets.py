"""Ticket orders: landing to raw table, raw to wide tables, refunds."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmart import schemas, vocab
from ticketmart.config import remove, scratch
from ticketmart.functions.text import contains_ignoring_case, paid_flag
from ticketmart.functions.times import epoch_to_date_text
from ticketmart.operators import filters, harmonise, joins, reshape
from ticketmart.operators.dedupe import distinct_rows, latest_per_key
from ticketmart.operators.payload import (
    answer_pairs,
    json_value,
    odd_pairs,
    pair_questions,
    parse_payload,
    unknown_fields,
    unknown_names,
)
from ticketmart.operators.pii import SEARCH_TEXT, deidentify, extract_sensitive, readable
from ticketmart.plans.current import KEYS, keep_current, latest_order, of_partitions
from ticketmart.sinks import tables
from ticketmart.sources import tickets as landed


def selected_tickets(
    event_rows: DataFrame,
    attendees: DataFrame,
    year: int,
    start: float,
    end: float,
    closed: str = "neither",
) -> DataFrame:
    """Paid tickets of the year's registrations, updated within the interval."""
    state = F.from_json("attendee_info", "is_paid boolean, updated_at double")
    # one condition over one parse; as separate filters Spark would parse for each of them
    wanted = filters.paid_only(
        attendees,
        F.exists(
            F.array(state),
            lambda s: filters.in_interval(s["updated_at"], start, end, closed) & s["is_paid"],
        ),
    )
    return landed.tickets(
        event_rows.where(filters.is_registration(F.col("name"), year)), wanted
    )


#: What a run asks for; an attendee is judged by the run it landed in, however long its event takes.
RUN = ("run_year", "run_start", "run_end")


def under_run(attendees: DataFrame, year: int, start: float, end: float) -> DataFrame:
    """Attendees with what their run asks for, which those that have waited keep from theirs."""
    values = {"run_year": F.lit(year), "run_start": F.lit(start), "run_end": F.lit(end)}
    kinds = {"run_year": "int", "run_start": "double", "run_end": "double"}
    return attendees.withColumns(
        {
            name: F.coalesce(*([F.col(name)] if name in attendees.columns else []), value).cast(kinds[name])
            for name, value in values.items()
        }
    )


def _is_asked_for() -> Column:
    state = F.from_json("attendee_info", "is_paid boolean, updated_at double")
    inside = lambda s: filters.in_interval(
        s["updated_at"], F.col("run_start"), F.col("run_end")
    )
    # one condition over one parse; as separate filters Spark would parse for each of them
    return F.exists(F.array(state), lambda s: inside(s) & s["is_paid"])


def asked_for(attendees: DataFrame) -> DataFrame:
    """Paid attendees that were updated within the interval of their own run."""
    return filters.paid_only(attendees, _is_asked_for())


def of_concern(attendees: DataFrame) -> DataFrame:
    """Attendees that a run rejects, or loads or lets wait: those it asks for.

    All others a run leaves out, so its steps need not read them again.
    """
    asked = F.coalesce(_is_asked_for(), F.lit(False))
    return attendees.where(asked | _reject_reason().isNotNull())


def selected_by_run(event_rows: DataFrame, attendees: DataFrame) -> DataFrame:
    """Paid tickets of registrations of the year, in the interval, of each attendee's own run."""
    named = event_rows.where(contains_ignoring_case(F.col("name"), "registration"))
    met = landed.tickets(named, asked_for(attendees), keep=["run_year"])
    return met.where(F.contains("name", F.col("run_year").cast("string"))).drop("run_year")


def sort_out(event_rows: DataFrame, attendees: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Attendees that no load can take: (rejected with the reason, waiting for their event).

    Rejected are those whose payload is no JSON object or has no time, and those
    without an event id; as such a payload cannot be hashed, its table is for
    those who may see personal data. All other attendees are either loaded or
    left out by the selection's own conditions.
    """
    rejected = attendees.withColumn("reason", _reject_reason()).where(F.col("reason").isNotNull())
    waiting = joins.join_on(takeable(attendees), event_rows, ["event_id"], "left_anti")
    return rejected, waiting


def _reject_reason() -> Column:
    """Why no load can take an attendee; null if one can."""
    timed = F.get_json_object("attendee_info", "$.updated_at").try_cast("double").isNotNull()
    return (
        F.when(F.col("event_id").isNull(), "no event id")
        .when(~readable(), "payload is no JSON object")
        .when(~timed, "no time of update")
    )


def takeable(attendees: DataFrame) -> DataFrame:
    """Attendees that `sort_out` does not reject, known from their own row."""
    return attendees.where(_reject_reason().isNull())


def order_rows(tickets: DataFrame) -> DataFrame:
    """Rows of the raw table: personal data hashed, nobody refunded yet.

    Payloads that are no JSON objects are left out; `sort_out` gives them.
    """
    return deidentify(tickets.where(readable())).select(
        F.col("id").cast("long"), "name", "attendee_info", F.lit(False).alias("refunded")
    )


def held_rows(spark: SparkSession, orders: DataFrame) -> tuple[DataFrame, str]:
    """Orders written to the shared folder, so that several loads hash them once, and the path."""
    held = scratch(spark, "hashed")
    orders.write.parquet(held)
    return spark.read.schema(orders.schema).parquet(held), held


def sensitive_answers(tickets: DataFrame) -> DataFrame:
    """Unhashed personal answers per ticket, for a job that may see them."""
    return parse_payload(tickets).select(
        "id", extract_sensitive(F.col("payload.data")).alias("answers")
    )


def split_timed(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Orders that have a time, and those to put aside since nothing can date them."""
    time = F.get_json_object("attendee_info", "$.updated_at").try_cast("double")
    # as the raw table stores it, which need not be read from the payload again
    undated = (F.col("updated_at") if "updated_at" in orders.columns else time).isNull()
    return orders.where(~undated), orders.where(undated)


YEAR = "(?:19|20)[0-9]{2}"
FORCED = "forced"


def orders_of(orders: DataFrame, year: int | str, ticket_type: str) -> DataFrame:
    """Orders of events whose name is like the year and the type, in this order.

    On the raw table, both also choose folders. A folder's year is the only one
    that its names mention, or 0; its groups are all that they mention, unless the
    load has forced one. So a name that holds a year is in the folder of this year
    or of 0, and a type that holds a group's name is in folders of that group or in
    forced ones.
    """
    wanted = filters.name_like(F.col("name"), year, ticket_type)
    if set(schemas.RAW_PARTITIONS) <= set(orders.columns):
        if re.fullmatch(YEAR, str(year)):
            wanted = wanted & F.col("year").isin(int(year), 0)
        for group in vocab.TICKET_GROUPS:
            if group in ticket_type:
                held = joins.in_group(F.col("ticket_groups"), group)
                wanted = wanted & (held | joins.in_group(F.col("ticket_groups"), FORCED))
    return orders.where(wanted)


# the payload's fields that become columns; the paid flag may be a truth value, a number or
# text, and numbers may be given as text
_TEXTS = {"is_paid boolean": "is_paid string", "reg_no bigint": "reg_no string", "price double": "price string"}
_WIDE_FIELDS = [name for name in schemas.PAYLOAD_FIELDS if name not in vocab.UNUSED_PAYLOAD_FIELDS]
_WIDE_SCHEMA = ", ".join(
    part
    for part in [_TEXTS.get(part, part) for part in schemas.PAYLOAD.split(", ")]
    if part.split()[0] in ("id", "data", *_WIDE_FIELDS)
)


def _not_a_number(reg_no: Column, price: Column) -> Column:
    """Why a ticket cannot become a row of a wide table; null if it can."""
    blank = F.trim(price) == ""
    return F.when(
        reg_no.isNotNull() & reg_no.try_cast("long").isNull(), "registration number is no number"
    ).when(price.isNotNull() & ~blank & price.try_cast("double").isNull(), "price is no number")


def wide_rejects(orders: DataFrame) -> DataFrame:
    """Orders that `wide_rows` leaves out, with the reason."""
    payload = F.array(F.from_json("attendee_info", "reg_no string, price string"))
    reasons = F.transform(payload, lambda p: _not_a_number(p["reg_no"], p["price"]))
    # generated, as a filter on a reason would parse once for each field that it names
    reason = F.explode(F.array(F.get(reasons, F.lit(0))))
    return orders.withColumn("reason", reason).where(F.col("reason").isNotNull())


# fields that are no questions
_KNOWN = (*schemas.PAYLOAD_FIELDS, SEARCH_TEXT)


def wide_records(
    orders: DataFrame, update_after: float | None = None, strict: bool = False
) -> DataFrame:
    """Payloads of orders that a wide table can take: their fields, typed, and `data`.

    `_event` is the id of the order's event. Tickets whose numbers are none are
    left out or, if strict, fail the job.
    """
    if "updated_at" in orders.columns:  # reaches the scan, unlike a field of the payload
        orders = filters.updated_since(orders, F.col("updated_at"), update_after)
    info = F.col("attendee_info")
    # generated, as a filter on a parsed column would parse once more
    parsed = F.explode(F.array(F.from_json(info, _WIDE_SCHEMA)))
    records = orders.select(info, F.col("id").alias("_event"), parsed.alias("payload"))
    # one condition over one parse; on the single fields Spark would parse for each of them
    number = lambda p: _not_a_number(p["reg_no"], p["price"]).isNull()
    if not strict:
        records = records.where(F.exists(F.array("payload"), number))
    records = records.select(
        "attendee_info", "_event", *[f"payload.{name}" for name in ("id", "data", *_WIDE_FIELDS)]
    )
    records = filters.updated_since(records, F.col("updated_at"), update_after)
    if strict:
        reason = _not_a_number(F.col("reg_no"), F.col("price"))
        fail = F.raise_error(F.concat(reason, F.lit(": "), info)).cast("boolean")
        records = records.where(F.when(reason.isNotNull(), fail).isNull())
    return records.withColumns(
        {
            "reg_no": F.col("reg_no").cast("long"),
            "price": F.nullif(F.trim("price"), F.lit("")).cast("double"),
        }
    )


def record_pairs(added: bool) -> Column:
    """All pairs of a record; with `added`, fields that the ticket system adds come first."""
    info = F.col("attendee_info")
    pairs = F.coalesce(
        answer_pairs(info, F.col("data")), F.array().cast("array<array<string>>")
    )
    if not added:
        return pairs
    extra = F.map_entries(unknown_fields(info, _KNOWN))
    return F.concat(F.transform(extra, lambda entry: F.array(entry["key"], entry["value"])), pairs)


def record_names(records: DataFrame) -> DataFrame:
    """Distinct names of added fields and of questions, with where each is seen first."""
    questions = pair_questions(F.col("attendee_info"), F.col("data"))
    asked = F.coalesce(questions, F.array().cast("array<string>"))
    added = unknown_names(F.col("attendee_info"), _KNOWN)
    return reshape.question_names(records, added, asked, F.col("updated_at"))


def wide_rows(
    orders: DataFrame,
    update_after: float | None = None,
    rules: harmonise.NameRules = harmonise.CURRENT,
    questions: Sequence[str] | None = None,
    strict: bool = False,
    events: bool = False,
    odd: bool = False,
) -> DataFrame:
    """One row per registration number, one column per harmonised question.

    The columns are planned from the distinct questions of all orders, however
    many, which is one aggregation over the data. Pass the questions if a form
    lists them: answers to others fill the column of their target name or are
    whole under it in the map `other_answers`, private ones left out. Numbers may
    be given as text. A ticket whose registration number or price is no number is
    left out (`wide_rejects` gives it) or, if strict, fails the job. `events` adds
    the id of the event, each of which has its own numbers, and `odd` the column `odd_answers`: JSON texts of pairs
    that are no question with one answer, of which the other answers lose nothing.
    """
    records = wide_records(orders, update_after, strict)
    fields = {
        "registration_no": F.col("reg_no"),
        **{vocab.PAYLOAD_RENAMES.get(name, name): F.col(name) for name in _WIDE_FIELDS},
        "payment_status": paid_flag(F.col("is_paid"), vocab.PAID_TEXTS),
        "paid_date": epoch_to_date_text(F.col("updated_at")),
        "_record": F.col("id"),
        **({"event_id": F.col("_event")} if events else {}),
    }
    if odd:
        fields["odd_answers"] = odd_pairs(F.col("attendee_info"), F.col("data"))
    added, listed = [], questions is not None
    if questions is None:
        # fields that the ticket system adds are taken as questions too, before the others
        added, questions = reshape.names_in_order(record_names(records))
        questions = [*added, *questions]
    records = records.withColumn("pairs", record_pairs(bool(added or listed)))

    wide = reshape.pairs_to_wide(
        records,
        F.col("pairs"),
        harmonise.plan_names(questions, rules),
        fields,
        "other_answers" if listed else None,
        rules.unwanted,
        lambda name: harmonise.target_name(name, rules),
        vocab.PRIVATE_COLUMNS,
    )
    wide = harmonise.drop_private(harmonise.to_numbers(wide))
    keys = ["event_id", "registration_no"] if events else ["registration_no"]
    return latest_per_key(wide, keys, [F.desc("updated_at"), F.desc("_record")]).drop("_record")


def load_orders(
    spark: SparkSession,
    orders: DataFrame,
    ods: str,
    dwd_prefix: str,
    group: str | None = None,
    current: bool = False,
) -> dict[str, int]:
    """Appends orders to the raw table and, per ticket group, to the wide tables.

    The orders are written to the shared folder once, and every step reads them
    from there, each group from its own folder, instead of hashing the payloads
    again. Orders that nothing can date, and those whose numbers are none, are
    put aside in tables of their own. With `current`, the latest row per event and
    registration number is kept in `<dwd_prefix>_<group>_current`.
    """
    held = scratch(spark, "orders")
    stored = raw_rows(orders, group)
    stored.write.partitionBy(*schemas.RAW_PARTITIONS).parquet(held)
    # read with its schema, which an empty load would not have on disk
    stored, undated = split_timed(spark.read.schema(stored.schema).parquet(held))
    loaded = {}
    for table, rows, schema, folders in (
        (ods, stored, schemas.RAW_ORDERS, schemas.RAW_PARTITIONS),
        (f"{ods}_undated", undated, schemas.TICKET_ORDERS, ()),
        (f"{ods}_rejected", wide_rejects(stored), schemas.REJECTED_ORDERS, ()),
    ):
        tables.create_table(spark, table, schema, partition_by=folders)
        if count := tables.append(rows, table, schema):
            loaded[table] = count
    # a few names of folders, whatever the size of the load
    present = [row[0] for row in stored.select("ticket_groups").distinct().collect()]
    for ticket_group in vocab.TICKET_GROUPS:
        if any(ticket_group in names.split("+") for names in present):
            table = f"{dwd_prefix}_{ticket_group}"
            of_group = stored.where(joins.in_group(F.col("ticket_groups"), ticket_group))
            wide = wide_rows(of_group, events=True, odd=True)
            if current:
                wide_held = scratch(spark, "wide")
                wide.write.parquet(wide_held)
                wide = spark.read.schema(wide.schema).parquet(wide_held)
            loaded[table] = tables.append_evolving(wide, table)
            if current:
                keep_current(spark, wide, f"{table}_current")
                remove(spark, wide_held)
    remove(spark, held)
    return loaded


def raw_rows(orders: DataFrame, group: str | None = None) -> DataFrame:
    """Orders as the raw table stores them, its columns of the payload read once.

    The year is the one that the event's name mentions, 0 without any or with
    several; the ticket groups are those the name mentions, or the forced one.
    """
    # a match of no length, so that years which overlap are found too
    years = F.array_distinct(F.regexp_extract_all("name", F.lit(f"(?=({YEAR}))"), 1))
    year = F.when(F.size(years) == 1, F.get(years, F.lit(0)).try_cast("int"))
    forced = F.lit(f"{FORCED}+{group}")
    groups = forced if group else joins.groups_named(F.col("name"), vocab.TICKET_GROUPS)
    return orders.select(
        *schemas.TICKET_ORDERS.fieldNames(),
        F.get_json_object("attendee_info", "$.id").try_cast("long").alias("attendee_id"),
        F.get_json_object("attendee_info", "$.updated_at").try_cast("double").alias("updated_at"),
        F.coalesce(year, F.lit(0)).alias("year"),
        groups.alias("ticket_groups"),
    )


def current_rows(wide: DataFrame) -> DataFrame:
    """Latest row per event and registration number over all loads of a wide table."""
    keys = [name for name in KEYS if name in wide.columns]
    return latest_per_key(wide, keys, latest_order(wide.columns, keys))


def dedupe_orders(spark: SparkSession, ods: str, folder: str, since: float | None = None) -> None:
    """Full-row dedupe, which makes repeated loads of one interval harmless.

    Only partitions that hold a row twice are written again; which ones these are
    is found from hashes of the rows, of those updated since the given time. A
    table without partitions is written again whole.
    """
    orders = spark.table(ods)
    names = tables.partition_columns(spark, ods)
    if not names:
        tables.replace_table(spark, ods, distinct_rows(orders), folder)
        return
    columns = [F.col(name) for name in orders.columns]
    digests = filters.updated_since(orders, F.col("updated_at"), since).select(
        *names, F.xxhash64(*columns).alias("one"), F.xxhash64(F.lit(1), *columns).alias("two")
    )
    twice = digests.groupBy(*names, "one", "two").agg(F.count("*").alias("n")).where("n > 1")
    tables.replace_partitions(spark, ods, distinct_rows(of_partitions(orders, twice, names)))


def _attendee_id(orders: DataFrame) -> Column:
    """The column, where the table has one, else the payload's id."""
    if "attendee_id" in orders.columns:
        return F.col("attendee_id")
    return json_value("attendee_info", "$.id", "long")


def live_attendees(orders: DataFrame) -> DataFrame:
    return orders.where(filters.is_live(F.col("refunded"))).select(
        F.col("id").alias("event_id"), _attendee_id(orders).alias("attendee_id")
    )


def refunded(orders: DataFrame, books: DataFrame) -> DataFrame:
    """Live attendees that left their event's attendance book."""
    return joins.refunded_attendees(
        live_attendees(orders), landed.attendee_ids(books), books.select("event_id")
    )


def mark(orders: DataFrame, gone: DataFrame, by_event: bool = False) -> DataFrame:
    """Orders with `refunded` set for these attendees, of any event unless told."""
    attendee_id = _attendee_id(orders)
    return joins.mark_refunded(orders, gone, attendee_id, F.col("id") if by_event else None)


def reconcile_refunds(
    spark: SparkSession, ods: str, books: DataFrame, folder: str, by_event: bool = False
) -> bool:
    """Updates the raw table; only partitions with a refund are written again."""
    orders = spark.table(ods)
    held = scratch(spark, "refunded")
    refunded(orders, books).write.parquet(held)
    gone = spark.read.parquet(held)
    if not gone.limit(1).count():
        remove(spark, held)
        return False
    names = tables.partition_columns(spark, ods)
    if names:
        keys = ["attendee_id", *(["id"] if by_event else [])]
        hits = gone.select("attendee_id", F.col("event_id").alias("id")).select(*keys).distinct()
        touched = joins.join_on(orders, hits, keys, "left_semi")
        marked = mark(of_partitions(orders, touched, names), gone, by_event)
        tables.replace_partitions(spark, ods, marked)
    else:
        tables.replace_table(spark, ods, mark(orders, gone, by_event), folder)
    remove(spark, held)
    return True
