"""Ticket data that Spark derives from the driver's tables.

Every order is an attendee's ticket: its year and priority name the event, its
customer is the registration number, and the customer's attributes answer the
questions, under headers that change over the years. `TICKETS_SQL` is the same
derivation, flat, for the SQL side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmart.checks.registry import table, tasks_for
from ticketmart.operators.payload import to_payload_text

# of one task: hashing takes it some seconds, so that the last tasks keep few cores waiting
PAYLOADS = 100_000

COMPANY = "Company  / 服務單位 (For students or teachers, fill in the School + Department Name)"
JOB = 'Job Title / 職稱 (If you are a student, fill in "student")'
DIET_EVEN, DIET_ODD = "Dietary Habit / 餐點偏好", "Dietary Preference / 飲食偏好"
FROM_OLD, FROM_NEW = "Come From / 國家或地區", "Where are you from? / 來自國家、地區或縣市"

TICKETS_SQL = """
tickets AS (
  SELECT
    year(o_orderdate) * 10 + CASE o_orderpriority
      WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 2 WHEN '5-LOW' THEN 3 ELSE 1 END AS event_id,
    'Conf ' || year(o_orderdate) || CASE o_orderpriority
      WHEN '1-URGENT' THEN ' Registration: Corporate'
      WHEN '2-HIGH' THEN ' Registration: Reserved'
      WHEN '5-LOW' THEN ' Meetup'
      ELSE ' Registration: Individual' END AS name,
    year(o_orderdate) AS year,
    o_orderkey AS id,
    o_custkey AS reg_no,
    o_orderpriority || ' / ' || c_mktsegment AS ticket_name,
    o_orderstatus <> 'P' AS is_paid,
    o_totalprice AS price,
    o_orderstatus AS payment_method,
    epoch(o_orderdate) + o_orderkey % 86400 AS updated_at,
    c_name,
    lower(c_name) || '@example.org' AS email,
    nullif(replace(c_mktsegment, 'MACHINERY', 'null'), 'null') AS diet,
    n_name AS country,
    'Company ' || (c_custkey % 50) AS company,
    CASE WHEN c_acctbal > 5000 THEN 'Lead ' ELSE 'Engineer ' END || (c_custkey % 7) AS job,
    CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS refunded
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
)
"""


def _event(rows: DataFrame) -> DataFrame:
    year = F.year("o_orderdate")
    priority = F.col("o_orderpriority")
    code = (
        F.when(priority == "1-URGENT", 0).when(priority == "2-HIGH", 2).when(priority == "5-LOW", 3)
    ).otherwise(1)
    title = (
        F.when(priority == "1-URGENT", " Registration: Corporate")
        .when(priority == "2-HIGH", " Registration: Reserved")
        .when(priority == "5-LOW", " Meetup")
    ).otherwise(" Registration: Individual")
    return rows.withColumns(
        {
            "event_id": (year * 10 + code).cast("long"),
            "name": F.concat(F.lit("Conf "), year.cast("string"), title),
        }
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    return _event(table(spark, folder, "orders")).select("event_id", "name").distinct()


def _registrations(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    rows = (
        orders.repartition(tasks_for(orders, PAYLOADS))
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return _event(rows)


def _pair(question: object, answer: object) -> F.Column:
    parts = [part if isinstance(part, F.Column) else F.lit(part) for part in (question, answer)]
    return F.array(*parts)


def _payload() -> F.Column:
    year = F.year("o_orderdate")
    diet = F.replace(F.col("c_mktsegment"), F.lit("MACHINERY"), F.lit("null"))
    title = F.when(F.col("c_acctbal") > 5000, "Lead ").otherwise("Engineer ")
    pairs = F.array(
        _pair("Nickname / 暱稱", F.col("c_name")),
        _pair(F.when(year % 2 == 0, DIET_EVEN).otherwise(DIET_ODD), diet),
        _pair(F.when(year < 1998, FROM_OLD).otherwise(FROM_NEW), F.col("n_name")),
        _pair(COMPANY, F.concat(F.lit("Company "), (F.col("c_custkey") % 50).cast("string"))),
        _pair(JOB, F.concat(title, (F.col("c_custkey") % 7).cast("string"))),
        _pair("聯絡人 姓名", F.col("c_name")),
        _pair("聯絡人 Email", F.concat(F.lower("c_name"), F.lit("@example.org"))),
    )
    no_map = F.create_map().cast("map<string,string>")
    seconds = F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 86400
    return F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("ticket_id"),
        F.concat_ws(" / ", "o_orderpriority", "c_mktsegment").alias("ticket_name"),
        F.col("o_custkey").alias("reg_no"),
        F.lit("activated").alias("state"),
        F.lit(None).cast("string").alias("checkin_code"),
        F.concat(F.lit("qr"), F.col("o_orderkey").cast("string")).alias("qrcode"),
        (F.col("o_orderstatus") != "P").alias("is_paid"),
        F.col("o_totalprice").alias("price"),
        F.lit("TWD").alias("currency"),
        F.col("o_orderstatus").alias("payment_method"),
        pairs.alias("data"),
        no_map.alias("kyc"),
        F.lit(None).cast("string").alias("id_number"),
        F.col("c_name").alias("search_string"),
        seconds.cast("double").alias("updated_at"),
        F.lit("qrcode").alias("ticket_type"),
        no_map.alias("slot"),
        F.col("o_orderkey").alias("order_no"),
    )


def _landed() -> F.Column:
    """The payload's text, generated, as Spark would write it anew for every filter on it."""
    return F.explode(F.array(to_payload_text(_payload())))


def attendees(spark: SparkSession, folder: str) -> DataFrame:
    """Landed attendees, not yet de-identified: (event_id, attendee_info)."""
    return _registrations(spark, folder).select(
        "event_id", _landed().alias("attendee_info")
    )


def order_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows in the raw table's shape, with some refunded and some never asked."""
    status = F.col("o_orderstatus")
    return _registrations(spark, folder).select(
        F.col("event_id").alias("id"),
        "name",
        _landed().alias("attendee_info"),
        F.when(status == "F", True).when(status == "O", False).alias("refunded"),
    )
