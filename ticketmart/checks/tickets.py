"""Ticket orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmart import schemas, vocab
from ticketmart.checks import derive
from ticketmart.checks.derive import TICKETS_SQL
from ticketmart.checks.registry import check, new_table_name, table
from ticketmart.config import remove, scratch
from ticketmart.operators import filters, harmonise, joins, payload, pii, reshape, statistics
from ticketmart.plans import answers
from ticketmart.plans import tickets as plan
from ticketmart.sinks import tables
from ticketmart.sources import tickets as landed
from ticketmart.streaming.ingest import copy_available, ingest_tickets, read_output

PREFIX = "Conf 1997 Registration"

PRICES = {
    "1-URGENT / BUILDING": 5800,
    "2-HIGH / BUILDING": 2590,
    "3-MEDIUM / FURNITURE": 3790,
    "4-NOT SPECIFIED / HOUSEHOLD": 1895,
}

_STATISTICS = f"""
WITH {TICKETS_SQL},
unique_tickets AS (
  SELECT DISTINCT name, id, ticket_name FROM tickets
  WHERE (refunded IS NULL OR NOT refunded) AND starts_with(name, '{PREFIX}')
),
counts AS (
  SELECT name, ticket_name, count(*) AS counts FROM unique_tickets GROUP BY ALL
)
"""


@check(f"{_STATISTICS} SELECT name, ticket_name, counts FROM counts")
def registration_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return statistics.registration_statistics(derive.order_rows(spark, folder), PREFIX)


@check(f"""{_STATISTICS},
prices(ticket_name, price) AS (
  VALUES {", ".join(f"('{name}', {price})" for name, price in PRICES.items())}
)
SELECT CAST(sum(counts) AS BIGINT) AS total,
       CAST(sum(coalesce(price, 0) * counts) AS BIGINT) AS total_income
FROM counts LEFT JOIN prices USING (ticket_name)
""")
def registration_revenue(spark: SparkSession, folder: str) -> DataFrame:
    counts = statistics.registration_statistics(derive.order_rows(spark, folder), PREFIX)
    return statistics.sales_totals(counts, PRICES)


# noon of 1 March 1997 to the last second of 1 September 1997
START, END = 857217600.0, 873158399.0


@check(f"""WITH {TICKETS_SQL}
SELECT event_id AS id, name, id AS attendee_id, updated_at FROM tickets
WHERE is_paid AND updated_at > {START} AND updated_at < {END}
  AND contains(name, '1997') AND contains(lower(name), 'registration')
""")
def selected_tickets(spark: SparkSession, folder: str) -> DataFrame:
    chosen = plan.selected_tickets(
        derive.events(spark, folder), derive.attendees(spark, folder), 1997, START, END
    )
    return payload.parse_payload(chosen).select(
        "id",
        "name",
        F.col("payload.id").alias("attendee_id"),
        F.col("payload.updated_at").alias("updated_at"),
    )


@check("""
SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events
WHERE ts > TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 12:00:00'
  AND event_type <> 'error'
""")
def interval_ingest(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events")
    start, end = (
        F.to_timestamp_ntz(F.lit(text)) for text in ("2024-01-05 00:00:00", "2024-01-20 12:00:00")
    )
    inside = rows.where(filters.in_interval(F.col("ts"), start, end))
    return filters.paid_only(inside, F.col("event_type") != "error").select(
        "event_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at")
    )


@check("""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-11 00:00:00'
""")
def interval_closed_left(spark: SparkSession, folder: str) -> DataFrame:
    start, end = (
        F.to_timestamp_ntz(F.lit(text)) for text in ("2024-01-10 00:00:00", "2024-01-11 00:00:00")
    )
    rows = table(spark, folder, "events")
    return rows.where(filters.in_interval(F.col("ts"), start, end, closed="left")).select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("day")
    )


@check(f"""WITH {TICKETS_SQL}
SELECT event_id, id, updated_at FROM tickets
WHERE lower(name) LIKE '%1999%corporate%' AND updated_at >= 930787200
""")
def orders_by_year_and_type(spark: SparkSession, folder: str) -> DataFrame:
    year, since = filters.parse_update_after("1999-07-01 00:00:00")
    chosen = payload.parse_payload(
        plan.orders_of(derive.order_rows(spark, folder), year, "corporate")
    )
    return filters.updated_since(chosen, F.col("payload.updated_at"), since).select(
        F.col("id").alias("event_id"),
        F.col("payload.id").alias("id"),
        F.col("payload.updated_at").alias("updated_at"),
    )


@check("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
""")
def json_extract_cast(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id", payload.json_value("props", "$.k", "long").alias("k")
    )


@check(f"""WITH {TICKETS_SQL}
SELECT event_id, id, sha256(c_name) AS hashed_name, sha256(email) AS hashed_email,
       c_name AS nickname, false AS has_search_text, false AS refunded
FROM tickets
""")
def hash_pii(spark: SparkSession, folder: str) -> DataFrame:
    tickets = landed.tickets(derive.events(spark, folder), derive.attendees(spark, folder))
    rows = payload.parse_payload(plan.order_rows(tickets))
    return reshape.with_answers(rows, F.col("payload.data")).select(
        F.col("id").alias("event_id"),
        F.col("payload.id").alias("id"),
        F.col("answers")["聯絡人 姓名"].alias("hashed_name"),
        F.col("answers")["聯絡人 Email"].alias("hashed_email"),
        F.col("answers")["Nickname / 暱稱"].alias("nickname"),
        F.contains("attendee_info", F.lit("search_string")).alias("has_search_text"),
        "refunded",
    )


@check(f"""WITH {TICKETS_SQL}
SELECT event_id, id, c_name AS full_name, email, 2 AS kept FROM tickets
""")
def extract_sensitive(spark: SparkSession, folder: str) -> DataFrame:
    tickets = landed.tickets(derive.events(spark, folder), derive.attendees(spark, folder))
    rows = tickets.select(
        "id", payload.json_value("attendee_info", "$.id", "long").alias("ticket"), "attendee_info"
    )
    return (
        payload.parse_payload(rows)
        .select("id", "ticket", pii.extract_sensitive(F.col("payload.data")).alias("answers"))
        .select(
            F.col("id").alias("event_id"),
            F.col("ticket").alias("id"),
            F.col("answers")["聯絡人 姓名"].alias("full_name"),
            F.col("answers")["聯絡人 Email"].alias("email"),
            F.size("answers").alias("kept"),
        )
    )


_WIDE = """
SELECT reg_no AS registration_no, ticket_name AS ticket_type, 'qr' || id AS qrcode,
       CASE WHEN is_paid THEN 'paid' ELSE 'not' END AS payment_status, price, payment_method,
       updated_at, strftime(make_timestamp(CAST(updated_at * 1000000 AS BIGINT)), '%Y-%m-%d')
         AS paid_date,
       diet AS dietary_habit, country AS country_or_region, company AS organization,
       job AS job_title, email
FROM (
  SELECT *, row_number() OVER (PARTITION BY reg_no ORDER BY updated_at DESC, id DESC) AS place
  FROM tickets {where}
) WHERE place = 1
"""


@check(f"WITH {TICKETS_SQL} " + _WIDE.format(where="WHERE contains(lower(name), 'individual')"))
def pairs_to_wide(spark: SparkSession, folder: str) -> DataFrame:
    routed = joins.route(derive.order_rows(spark, folder), F.col("name"), ["individual"])
    return plan.wide_rows(routed)


@check(
    f"WITH {TICKETS_SQL} "
    + _WIDE.format(where="WHERE lower(name) LIKE '%1998%reserved%' AND updated_at >= 896659200")
)
def wide_rows_updated_after(spark: SparkSession, folder: str) -> DataFrame:
    year, since = filters.parse_update_after("1998-06-01 00:00:00")
    return plan.wide_rows(plan.orders_of(derive.order_rows(spark, folder), year, "reserved"), since)


def _asked(orders: DataFrame) -> DataFrame:
    """Questions of all pairs; of equal lists of them, as versions of a form have, one is taken apart."""
    asked = F.transform("payload.data", reshape.question_of).alias("asked")
    lists = payload.parse_payload(orders).select(asked).distinct()
    return lists.select(F.explode("asked").alias("question"))


@check(f"""WITH {TICKETS_SQL}, raw_names AS (
  SELECT DISTINCT unnest(['dietary_habit', 'country_or_region']) AS target, unnest([
    CASE WHEN year % 2 = 0 THEN '{derive.DIET_EVEN}' ELSE '{derive.DIET_ODD}' END,
    CASE WHEN year < 1998 THEN '{derive.FROM_OLD}' ELSE '{derive.FROM_NEW}' END]) AS raw_name
  FROM tickets
)
SELECT target, raw_name FROM raw_names
""")
def shared_targets(spark: SparkSession, folder: str) -> DataFrame:
    return harmonise.shared_targets(_asked(derive.order_rows(spark, folder)), "question")


@check(f"""WITH {TICKETS_SQL}
SELECT unnest(['Nickname / 暱稱', '{derive.COMPANY}', '{derive.JOB}',
  '聯絡人 姓名', '聯絡人 Email']) AS question
FROM (SELECT count(*) FROM tickets)
EXCEPT SELECT 'Nickname / 暱稱'
""")
def cross_year_core(spark: SparkSession, folder: str) -> DataFrame:
    rows = payload.parse_payload(derive.order_rows(spark, folder))
    names = rows.select(
        F.regexp_extract("name", r"\d{4}", 0).cast("int").alias("year"),
        F.explode("payload.data").alias("pair"),
    ).select("year", F.col("pair")[0].alias("question"))
    return harmonise.names_of_all_years(
        names, "question", "year", range(1995, 2002), leave_out=["Nickname / 暱稱"]
    )


@check(f"""WITH {TICKETS_SQL}
SELECT event_id AS id, id AS attendee_id, CASE WHEN year % 2 = 0 THEN '{derive.DIET_ODD}'
  ELSE '{derive.DIET_EVEN}' END AS missing FROM tickets
UNION ALL SELECT event_id, id, 'Gender' FROM tickets
""")
def required_answers(spark: SparkSession, folder: str) -> DataFrame:
    rows = payload.parse_payload(derive.order_rows(spark, folder))
    required = [derive.DIET_EVEN, derive.DIET_ODD, derive.COMPANY, "Gender"]
    return rows.select(
        "id",
        F.col("payload.id").alias("attendee_id"),
        F.explode(reshape.missing_answers(F.col("payload.data"), required)).alias("missing"),
    )


@check(f"""WITH {TICKETS_SQL}
SELECT event_id AS id, id AS attendee_id, 'search_string' AS field, c_name AS value FROM tickets
""")
def unknown_payload_fields(spark: SparkSession, folder: str) -> DataFrame:
    rows = derive.order_rows(spark, folder)
    return rows.select(
        "id",
        payload.json_value("attendee_info", "$.id", "long").alias("attendee_id"),
        F.explode(payload.unknown_fields(F.col("attendee_info"))).alias("field", "value"),
    )


@check("""
SELECT p_partkey, p_name, unnest(list_filter(['small', 'ring', 'red'],
  lambda word: contains(lower(p_name), word))) AS ticket_group
FROM part
""")
def group_routing(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").select("p_partkey", "p_name")
    return joins.route(rows, F.col("p_name"), ["small", "ring", "red"])


_LATEST_IDS = """
latest AS (SELECT DISTINCT o_orderkey AS id FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
"""


def _books(spark: SparkSession, folder: str) -> DataFrame:
    """A landed attendance book per lineitem: an order without one has left its event."""
    orders = derive._event(table(spark, folder, "orders"))
    lines = table(spark, folder, "lineitem").select("l_orderkey")
    signed = F.array(F.array(F.col("o_orderkey").cast("string"), F.lit("in")))
    book = F.struct(F.col("event_id").alias("id"), signed.alias("signin_status"))
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "event_id", F.array(book).alias("books")
    )


@check(f"""WITH {TICKETS_SQL}, {_LATEST_IDS}
SELECT event_id, id AS attendee_id FROM tickets
WHERE (refunded IS NULL OR NOT refunded) AND id NOT IN (SELECT id FROM latest)
""")
def refund_detect(spark: SparkSession, folder: str) -> DataFrame:
    return plan.refunded(derive.order_rows(spark, folder), _books(spark, folder))


@check(f"""WITH {TICKETS_SQL}, {_LATEST_IDS}
SELECT event_id AS id, id AS attendee_id,
  CASE WHEN (refunded IS NULL OR NOT refunded) AND id NOT IN (SELECT id FROM latest)
    THEN true ELSE refunded END AS refunded
FROM tickets
""")
def refund_mark(spark: SparkSession, folder: str) -> DataFrame:
    orders = derive.order_rows(spark, folder)
    marked = plan.mark(orders, plan.refunded(orders, _books(spark, folder)), by_event=True)
    return marked.select(
        "id", payload.json_value("attendee_info", "$.id", "long").alias("attendee_id"), "refunded"
    )


@check(f"""WITH {TICKETS_SQL}
SELECT event_id, count(DISTINCT id) AS attendees FROM tickets
WHERE refunded IS NULL OR NOT refunded GROUP BY event_id
""")
def attendees_per_event(spark: SparkSession, folder: str) -> DataFrame:
    return statistics.attendees_per_event(plan.live_attendees(derive.order_rows(spark, folder)))


@check("""
SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events
WHERE event_type <> 'error' AND ts > TIMESTAMP '2024-01-02 00:00:00'
""")
def stream_equals_batch(spark: SparkSession, folder: str) -> DataFrame:
    source = table(spark, folder, "events")
    stream = spark.readStream.schema(source.schema).parquet(f"{folder}/events.parq*")
    start, end = (
        F.to_timestamp_ntz(F.lit(text)) for text in ("2024-01-02 00:00:00", "2100-01-01 00:00:00")
    )
    chosen = filters.paid_only(
        stream.where(filters.in_interval(F.col("ts"), start, end)), F.col("event_type") != "error"
    ).select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))
    target = scratch(spark, "stream")
    copy_available(chosen, target)
    return copy_available(chosen, target)


@check(f"""WITH {TICKETS_SQL}
SELECT event_id AS id, name, id AS attendee_id, price FROM tickets
""")
def repeated_load_deduped(spark: SparkSession, folder: str) -> DataFrame:
    """All tickets loaded twice into a raw table, then full-row dedupe in place."""
    name, where = new_table_name("orders"), scratch(spark, "ods")
    tables.create_table(spark, name, schemas.TICKET_ORDERS, f"{where}/first")
    tickets = landed.tickets(derive.events(spark, folder), derive.attendees(spark, folder))
    rows, held = plan.held_rows(spark, plan.order_rows(tickets))
    for _ in range(2):
        tables.append(rows, name, schemas.TICKET_ORDERS)
    remove(spark, held)
    plan.dedupe_orders(spark, name, where)
    return spark.table(name).select(
        "id",
        "name",
        payload.json_value("attendee_info", "$.id", "long").alias("attendee_id"),
        payload.json_value("attendee_info", "$.price", "double").alias("price"),
    )





def _odd_attendees(spark: SparkSession, folder: str) -> DataFrame:
    """Attendees of which some have no event id, a cut payload, or no time."""
    rows = derive.attendees(spark, folder)
    key = F.get_json_object("attendee_info", "$.id").cast("long")
    info = F.col("attendee_info")
    odd = (
        F.when(key % 7 == 3, F.substr(info, F.lit(1), F.length(info) - 5))
        .when(key % 13 == 2, F.regexp_replace(info, '"updated_at":[^,]*,', ""))
        .otherwise(info)
    )
    # generated, so that filters on the text do not make it anew
    return rows.select(
        F.when(key % 11 != 1, F.col("event_id")).alias("event_id"),
        F.explode(F.array(odd)).alias("attendee_info"),
    )


@check(f"""WITH {TICKETS_SQL},
sorted AS (SELECT CASE WHEN id % 11 = 1 THEN 'no event id'
  WHEN id % 7 = 3 THEN 'payload is no JSON object' WHEN id % 13 = 2 THEN 'no time of update'
  WHEN event_id % 10 = 3 THEN 'waiting' ELSE 'loaded' END AS outcome FROM tickets)
SELECT outcome, count(*) AS attendees FROM sorted GROUP BY outcome
""")
def ticket_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Every landed attendee is loaded, rejected with a reason, or waits for its event."""
    rows = _odd_attendees(spark, folder)
    events = derive.events(spark, folder).where("event_id % 10 <> 3")
    rejected, waiting = plan.sort_out(events, rows)
    good = plan.takeable(rows)
    outcome = (
        rejected.select(F.col("reason").alias("outcome"))
        .unionByName(waiting.select(F.lit("waiting").alias("outcome")))
        .unionByName(
            plan.order_rows(landed.tickets(events, good)).select(F.lit("loaded").alias("outcome"))
        )
    )
    return outcome.groupBy("outcome").agg(F.count("*").alias("attendees"))


@check(f"""WITH {TICKETS_SQL},
given AS (
  SELECT id, reg_no, price, updated_at, reg_no % 5 = 1 AS odd_number, id % 9 = 4 AS odd_price
  FROM tickets WHERE contains(lower(name), 'reserved'))
SELECT CAST(reg_no AS VARCHAR) AS ticket, price, NULL AS reason FROM given
WHERE NOT odd_number AND NOT odd_price
QUALIFY row_number() OVER (PARTITION BY reg_no ORDER BY updated_at DESC, id DESC) = 1
UNION ALL
SELECT 'A-' || reg_no, NULL, 'registration number is no number' FROM given WHERE odd_number
UNION ALL
SELECT CAST(reg_no AS VARCHAR), NULL, 'price is no number' FROM given WHERE odd_price AND NOT odd_number
""")
def wide_rows_text_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers given as text are read; what is none is rejected, not lost."""
    info = F.col("attendee_info")
    key = F.get_json_object(info, "$.id").cast("long")
    number = F.get_json_object(info, "$.reg_no").cast("long")
    marked = F.when(number % 5 == 1, '"reg_no":"A-$1"').otherwise('"reg_no":"$1"')
    texts = F.regexp_replace(info, F.lit('"reg_no":([0-9]+)'), marked)
    texts = F.when(key % 9 == 4, F.regexp_replace(texts, '"price":[0-9.E]+', '"price":"free"')).otherwise(
        F.regexp_replace(texts, '"price":([0-9.E]+)', '"price":" $1 "')
    )
    orders = derive.order_rows(spark, folder).where(F.contains(F.lower("name"), F.lit("reserved")))
    orders = orders.withColumn("attendee_info", texts)
    wide = plan.wide_rows(orders).select(
        F.col("registration_no").cast("string").alias("ticket"),
        "price",
        F.lit(None).cast("string").alias("reason"),
    )
    rejects = plan.wide_rejects(orders).select(
        F.get_json_object("attendee_info", "$.reg_no").alias("ticket"),
        F.lit(None).cast("double").alias("price"),
        "reason",
    )
    return wide.unionByName(rejects)


@check(f"""WITH {TICKETS_SQL}
SELECT id, reg_no FROM tickets
WHERE event_id % 10 <> 3 AND year = 1997 AND is_paid AND updated_at > {START} AND updated_at < {END}
""")
def stream_tickets(spark: SparkSession, folder: str) -> DataFrame:
    """Attendees that land before and after their events, through two runs of the stream."""
    landing, out = scratch(spark, "landing"), scratch(spark, "tickets-out")
    parts = derive.attendees(spark, folder).select(
        F.to_json(F.struct("event_id", "attendee_info")).alias("value"),
        (F.get_json_object("attendee_info", "$.id").cast("long") % 2).alias("part"),
    )
    events = derive.events(spark, folder).where("event_id % 10 <> 3")
    names = events.select(
        F.to_json(
            F.struct(F.array(F.struct(F.col("event_id").alias("id"), "name")).alias("data"))
        ).alias("value"),
        (F.col("event_id") % 2).alias("part"),
    )
    for part in (0, 1):
        names.where(F.col("part") == part).select("value").write.mode("append").text(
            f"{landing}/events"
        )
        parts.where(F.col("part") == part).select("value").write.mode("append").text(
            f"{landing}/attendees"
        )
        ingest_tickets(spark, landing, out, 1997, START, END)
    orders = read_output(spark, out, "orders")
    return orders.select(
        F.get_json_object("attendee_info", "$.id").cast("long").alias("id"),
        F.get_json_object("attendee_info", "$.reg_no").cast("long").alias("reg_no"),
    )


@check(f"""WITH {TICKETS_SQL}
SELECT event_id AS id, id AS attendee_id, count(*) AS copies FROM tickets GROUP BY ALL
""")
def loaded_twice_deduped(spark: SparkSession, folder: str) -> DataFrame:
    """The load job run twice over all tickets, then deduped by partition."""
    ods, wide = new_table_name("orders"), new_table_name("wide")
    tickets = landed.tickets(derive.events(spark, folder), derive.attendees(spark, folder))
    orders, held = plan.held_rows(spark, plan.order_rows(tickets))
    for _ in range(2):
        plan.load_orders(spark, orders, ods, wide)
    remove(spark, held)
    plan.dedupe_orders(spark, ods, scratch(spark, "unused"), since=0.0)
    return spark.table(ods).groupBy("id", "attendee_id").agg(F.count("*").alias("copies"))


@check(f"""WITH {TICKETS_SQL}, {_LATEST_IDS}
SELECT event_id AS id, id AS attendee_id, id NOT IN (SELECT id FROM latest) AS refunded FROM tickets
""")
def refund_reconciled(spark: SparkSession, folder: str) -> DataFrame:
    """The refund job on the raw table: only its partitions with a refund are written again."""
    ods, wide = new_table_name("orders"), new_table_name("wide")
    tickets = landed.tickets(derive.events(spark, folder), derive.attendees(spark, folder))
    plan.load_orders(spark, plan.order_rows(tickets), ods, wide)
    plan.reconcile_refunds(spark, ods, _books(spark, folder), scratch(spark, "unused"), True)
    return spark.table(ods).select("id", "attendee_id", "refunded")


MIDDLE = 865000000.0

# attendees of an even id land in a first run, up to the middle, with the events of odd years; the
# others in a second one, from there on, with those of even years and with some of the first again;
# reserved events never land
_TWO_RUNS = f"""
asked AS (
  SELECT *, is_paid AND CASE WHEN id % 2 = 0 THEN updated_at > {START} AND updated_at < {MIDDLE} END AS first,
    is_paid AND CASE WHEN id % 2 = 1 OR id % 10 = 0 THEN updated_at > {MIDDLE} AND updated_at < {END} END AS second,
    event_id % 10 <> 2 AS landed FROM tickets),
loaded AS (
  SELECT * FROM asked WHERE landed AND (first OR second)
    AND contains(name, '1997') AND contains(lower(name), 'registration'))
"""


@check(f"""WITH {TICKETS_SQL}, {_TWO_RUNS}
SELECT 'loaded' AS outcome, event_id, id AS number, NULL AS updated_at FROM loaded
UNION ALL
SELECT 'waiting', event_id, id, NULL FROM asked WHERE NOT landed AND (first OR second)
UNION ALL
SELECT 'current', event_id, reg_no, max(updated_at) FROM loaded
WHERE contains(lower(name), 'individual') GROUP BY event_id, reg_no
""")
def stream_tickets_two_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Attendees that land before and after their events, and again, in runs of two intervals."""
    landing, out = scratch(spark, "landing"), scratch(spark, "tickets-out")
    current = new_table_name("current")
    key = F.get_json_object("attendee_info", "$.id").cast("long")
    rows = derive.attendees(spark, folder)
    value = F.to_json(F.struct("event_id", "attendee_info")).alias("value")
    known = derive.events(spark, folder).where("event_id % 10 <> 2")
    listed = F.array(F.struct(F.col("event_id").alias("id"), "name")).alias("data")
    event = F.to_json(F.struct(listed)).alias("value")
    year = F.floor(F.col("event_id") / 10) % 2
    runs = (
        (rows.where(key % 2 == 0), known.where(year == 1), START, MIDDLE),
        # one condition over one look at the payload
        (rows.where(F.exists(F.array(key), lambda k: (k % 2 == 1) | (k % 10 == 0))), known.where(year == 0), MIDDLE, END),
    )
    for attendees, events, start, end in runs:
        events.select(event).write.mode("append").text(f"{landing}/events")
        attendees.select(value).write.mode("append").text(f"{landing}/attendees")
        ingest_tickets(spark, landing, out, 1997, start, end, current)
    number = key.alias("number")
    nothing = F.lit(None).cast("double").alias("updated_at")
    waiting = read_output(spark, out, "waiting").where("batch_id = 1")
    return (
        read_output(spark, out, "orders")
        .select(F.lit("loaded").alias("outcome"), F.col("id").alias("event_id"), number, nothing)
        .unionByName(waiting.select(F.lit("waiting").alias("outcome"), "event_id", number, nothing))
        .unionByName(
            spark.table(f"{current}_individual").select(
                F.lit("current").alias("outcome"),
                "event_id",
                F.col("registration_no").alias("number"),
                "updated_at",
            )
        )
    )


@check(f"""WITH {TICKETS_SQL},
latest AS (
  SELECT * FROM tickets WHERE contains(lower(name), 'individual')
  QUALIFY row_number() OVER (PARTITION BY reg_no ORDER BY updated_at DESC, id DESC) = 1)
SELECT reg_no AS registration_no, email, company AS organization, diet AS dietary_habit,
  country AS country_or_region, CASE id % 4 WHEN 0 THEN 6 WHEN 1 THEN 3 ELSE 0 END AS odd
FROM latest
""")
def odd_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads whose pairs are mixed with empty, single, missing, object and scalar ones."""
    info = F.col("attendee_info")
    key = F.get_json_object(info, "$.id").cast("long")
    more = F.when(key % 4 == 0, '{"k":["v"]},["alone"],5,"text",null,[],').when(
        key % 4 == 1, '["alone"],[],null,'
    )
    start = '"data":['
    mixed = F.replace(info, F.lit(start), F.concat(F.lit(start), F.coalesce(more, F.lit(""))))
    orders = derive.order_rows(spark, folder).withColumn("attendee_info", mixed)
    routed = joins.route(orders, F.col("name"), ["individual"])
    return plan.wide_rows(routed, odd=True).select(
        "registration_no",
        "email",
        "organization",
        "dietary_habit",
        "country_or_region",
        F.coalesce(F.size("odd_answers"), F.lit(0)).alias("odd"),
    )


@check(f"""WITH {TICKETS_SQL}
SELECT event_id, reg_no AS registration_no, max(updated_at) AS updated_at FROM tickets
WHERE contains(lower(name), 'corporate') GROUP BY event_id, reg_no
""")
def current_kept_by_load(spark: SparkSession, folder: str) -> DataFrame:
    """Current rows, merged from two loads of which the second repeats some of the first."""
    ods, wide = new_table_name("orders"), new_table_name("wide")
    tickets = landed.tickets(derive.events(spark, folder), derive.attendees(spark, folder))
    corporate = F.contains(F.lower("name"), F.lit("corporate"))
    key = F.get_json_object("attendee_info", "$.id").cast("long")
    # chosen before they are hashed, as a filter on the hashed text would hash all of them once more
    for part in (tickets.where(corporate & (key % 3 != 0)), tickets.where(corporate & (key % 3 != 1))):
        plan.load_orders(spark, plan.order_rows(part), ods, wide, current=True)
    kept = spark.table(f"{wide}_corporate_current")
    return kept.select("event_id", "registration_no", "updated_at")


@check(f"""WITH {TICKETS_SQL}
SELECT event_id, id FROM tickets WHERE lower(name) LIKE '%1999%corporate%'
""")
def orders_of_folders(spark: SparkSession, folder: str) -> DataFrame:
    """Year and type of the events choose folders of the raw table."""
    ods = new_table_name("orders")
    tickets = landed.tickets(derive.events(spark, folder), derive.attendees(spark, folder))
    tables.create_table(spark, ods, schemas.RAW_ORDERS, partition_by=schemas.RAW_PARTITIONS)
    tables.append(plan.raw_rows(plan.order_rows(tickets)), ods, schemas.RAW_ORDERS)
    found = plan.orders_of(spark.table(ods), 1999, "corporate")
    return found.select(F.col("id").alias("event_id"), F.col("attendee_id").alias("id"))


@check("""
SELECT year(o_orderdate) * 10 + CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 2
  WHEN '5-LOW' THEN 3 ELSE 1 END AS event_id, CASE WHEN o_custkey % 5 <> 0 THEN o_orderkey END AS book_id
FROM orders
""")
def first_books(spark: SparkSession, folder: str) -> DataFrame:
    """The first attendance book of each landed reply; some replies have none."""
    orders = derive._event(table(spark, folder, "orders"))
    nobody = F.array().cast("array<array<string>>").alias("signin_status")
    books = [F.struct(F.col(name).alias("id"), nobody) for name in ("o_orderkey", "event_id")]
    some = F.when(F.col("o_custkey") % 5 != 0, F.array(*books)).otherwise(F.slice(F.array(*books), 1, 0))
    return landed.first_book_id(orders.select("event_id", some.alias("books")))


_CANONICAL = [
    (year, group, name)
    for year, group in vocab.CANONICAL_EXTRA
    for name in harmonise.canonical_columns(year, group)
]


@check(f"""WITH {TICKETS_SQL},
asked AS (
  SELECT DISTINCT unnest(['dietary_habit', 'country_or_region', 'organization', 'job_title', 'nickname', 'email']) AS name
  FROM (SELECT count(*) FROM tickets)),
canonical(year, ticket_group, name) AS (
  VALUES {", ".join(f"({year}, '{group}', '{name}')" for year, group, name in _CANONICAL)})
SELECT CAST(year AS BIGINT) AS year, ticket_group, name, asked.name IS NOT NULL AS is_asked
FROM canonical LEFT JOIN asked USING (name)
""")
def canonical_sets(spark: SparkSession, folder: str) -> DataFrame:
    """The canonical columns of every year and group, and whether the tickets' questions fill them."""
    raw = _asked(derive.order_rows(spark, folder)).distinct()
    target = harmonise.target_name(F.col("question")).alias("name")
    # counted, as Spark would leave out the first of two bare distincts and name every pair
    asked = raw.groupBy(target).agg((F.count("*") > 0).alias("found"))
    sets = spark.createDataFrame(_CANONICAL, "year long, ticket_group string, name string")
    met = sets.join(asked, "name", "left")
    return met.select(
        "year", "ticket_group", "name", F.coalesce("found", F.lit(False)).alias("is_asked")
    )


@check(f"""WITH {TICKETS_SQL},
latest AS (
  SELECT * FROM tickets WHERE contains(lower(name), 'corporate')
  QUALIFY row_number() OVER (PARTITION BY event_id, reg_no ORDER BY updated_at DESC, id DESC) = 1)
SELECT * FROM (
  SELECT event_id, reg_no AS registration_no, unnest(['dietary_habit', 'country_or_region',
    'organization', 'job_title', 'email']) AS name, unnest([diet, country, company, job, email]) AS value
  FROM latest)
WHERE value IS NOT NULL
""")
def answers_encoded(spark: SparkSession, folder: str) -> DataFrame:
    """Answers by ids of names, and the names of the ids."""
    rows = derive.order_rows(spark, folder).where(F.contains(F.lower("name"), F.lit("corporate")))
    names, found = answers.encoded_answers(rows)
    return found.join(names, "name_id").select("event_id", "registration_no", "name", "value")
