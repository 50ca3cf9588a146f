"""Column names, reshaping and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmart import vocab
from ticketmart.checks.registry import TASKS, check, table
from ticketmart.functions import numbers, text, times
from ticketmart.operators import harmonise, payload, reshape
from ticketmart.operators.pii import extract_sensitive as sensitive_of
from ticketmart.operators.pii import hash_sensitive
from ticketmart.plans import offline, surveys


@check("""
SELECT p_partkey AS registration_no, p_name AS organization,
       coalesce(nullif(p_brand, 'Brand#7'), p_type) AS email_from_sponsor,
       p_retailprice AS price, p_size AS years_of_using_python,
       p_type AS dietary_habit
FROM part
""")
def harmonise_names(spark: SparkSession, folder: str) -> DataFrame:
    """Messy headers of several years; two of them have one purpose, two are unwanted."""
    parts = table(spark, folder, "part")
    messy = parts.select(
        F.col("p_partkey").alias("Registration No."),
        F.col("p_name").alias(
            "Company / 服務單位 (For students or teachers, fill in the School + Department Name)"
        ),
        F.when(F.col("p_brand") == "Brand#7", "null")
        .otherwise(F.col("p_brand"))
        .alias("是否願意收到贊助商轉發 Email 訊息"),
        F.col("p_type").alias("Would you like to receive an email from sponsors?"),
        F.col("p_retailprice").cast("string").alias("Price"),
        F.col("p_size").alias("Years of Using Python / 使用 Python 多久"),
        F.col("p_name").alias("Contact Name"),
        F.col("p_brand").alias("Nickname / 暱稱"),
        F.col("p_brand").alias("標籤"),
        F.col("p_type").alias("Dietary Preference / 飲食偏好"),
    )
    return harmonise.drop_private(harmonise.to_numbers(harmonise.harmonise(messy)))


@check("""
SELECT doc_id, lower(regexp_replace(trim(regexp_replace(text, '[^a-zA-Z 0-9_]', '', 'g'), ' '),
  ' +', '_', 'g')) AS styled FROM documents
""")
def style_names(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        "doc_id", text.style_name_column(F.col("text")).alias("styled")
    )


@check("""
SELECT p_partkey, CASE p_type
  WHEN 'ECONOMY' THEN 'country_or_region' WHEN 'SMALL' THEN 'size_of_tshirt'
  ELSE lower(p_type) || '_' || p_size END AS target FROM part
""")
def mapped_names(spark: SparkSession, folder: str) -> DataFrame:
    raw = (
        F.when(F.col("p_type") == "ECONOMY", "Come From / 國家或地區")
        .when(F.col("p_type") == "SMALL", "Size of T-shirt / T恤尺寸")
        .otherwise(F.concat(F.col("p_type"), F.lit("  "), F.col("p_size").cast("string")))
    )
    return table(spark, folder, "part").select(
        "p_partkey", harmonise.target_name(raw).alias("target")
    )


@check("""
SELECT c_custkey, coalesce(nullif(c_mktsegment, 'MACHINERY'), c_name) AS merged,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS price
FROM customer
""")
def coalesce_same_purpose(spark: SparkSession, folder: str) -> DataFrame:
    segment = F.replace(F.col("c_mktsegment"), F.lit("MACHINERY"), F.lit("null"))
    blank_third = F.when(F.col("c_custkey") % 3 == 0, " ").otherwise(
        F.col("c_acctbal").cast("string")
    )
    rows = table(spark, folder, "customer").select(
        "c_custkey",
        harmonise.first_value([segment, F.col("c_name")]).alias("merged"),
        blank_third.alias("price"),
    )
    return harmonise.to_numbers(rows)


@check("""
SELECT c_custkey, unnest(['c_name', 'c_mktsegment', 'absent']) AS question,
  unnest([c_name, c_mktsegment, NULL]) AS answer FROM customer
""")
def wide_to_pairs(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    pairs = payload.wide_to_pairs(customers.columns, ["c_name", "c_mktsegment", "absent"])
    return customers.select("c_custkey", F.explode(pairs).alias("pair")).select(
        "c_custkey", F.col("pair")[0].alias("question"), F.col("pair")[1].alias("answer")
    )


@check("""
SELECT c_custkey, sha256(c_name) AS hashed, c_mktsegment AS plain, c_name AS taken FROM customer
""")
def hash_and_extract_pairs(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    pairs = F.array(
        F.array(F.lit("收件 Address / 地址"), F.col("c_name")),
        F.array(F.lit("segment"), F.col("c_mktsegment")),
        F.array(F.lit("聯絡人 Email"), F.col("c_name")),
    )
    return customers.select("c_custkey", pairs.alias("pairs")).select(
        "c_custkey",
        hash_sensitive(F.col("pairs"))[0][1].alias("hashed"),
        hash_sensitive(F.col("pairs"))[1][1].alias("plain"),
        sensitive_of(F.col("pairs"))["聯絡人 Email"].alias("taken"),
    )


def _exports(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Order lines as an attendee export, orders as an order export."""
    lines = table(spark, folder, "lineitem").repartition(TASKS)
    orders = table(spark, folder, "orders")
    attendees = lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("Id"),
        F.col("l_returnflag").alias("票種"),
        F.col("l_partkey").cast("string").alias("報名序號"),
        F.lit("c").alias("檢查碼"),
        F.col("l_linestatus").alias("QR Code 序號"),
        F.col("l_extendedprice").cast("string").alias("票面價格"),
        F.lit("qrcode").alias("選用的取票方式"),
        F.col("l_orderkey").alias("訂單編號"),
        F.col("l_returnflag").alias("Come From / 國家或地區"),
        F.col("l_linestatus").alias("聯絡人 Email"),
    )
    paid = F.when(F.col("o_orderstatus") == "F", " 已繳費 ").otherwise("未繳費")
    time = F.date_format("o_orderdate", "yyyy/MM/dd HH:mm:ss")
    export = orders.where("o_orderpriority <> '5-LOW'").select(
        F.col("o_orderkey").alias("訂單編號"),
        F.when(F.col("o_orderstatus") == "P", "cancelled").otherwise("activated").alias("票券狀態"),
        paid.alias("付款狀態"),
        F.when(F.col("o_orderstatus") == "O", "soon").otherwise(time).alias("付款時間"),
        F.col("o_orderpriority").alias("付款方式"),
        F.lit("unused").alias("檢查碼"),
    )
    return attendees, export


@check("""
SELECT 999000202302 AS event_id, l_partkey AS reg_no, l_orderkey AS order_no,
  CASE WHEN o_orderkey IS NULL THEN NULL ELSE o_orderstatus = 'F' END AS is_paid,
  l_extendedprice AS price,
  CASE WHEN o_orderstatus IN ('F', 'P') THEN epoch(o_orderdate) END AS updated_at,
  CASE WHEN o_orderstatus = 'P' THEN 'cancelled' WHEN o_orderkey IS NOT NULL THEN 'activated' END
    AS state,
  o_orderpriority AS payment_method, CAST(NULL AS BIGINT) AS id, 'TWD' AS currency,
  l_returnflag AS country, sha256(l_linestatus) AS email, false AS refunded
FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW') o
  ON l_orderkey IS NOT DISTINCT FROM o_orderkey
""")
def exported_orders(spark: SparkSession, folder: str) -> DataFrame:
    attendees, export = _exports(spark, folder)
    rows = offline.exported_orders(
        attendees,
        export,
        2023,
        "reserved",
        "Conf 2023 Registration",
        ["Come From / 國家或地區", "聯絡人 Email"],
    )
    info = F.col("payload")
    return payload.parse_payload(rows).select(
        F.col("id").alias("event_id"),
        info["reg_no"].alias("reg_no"),
        info["order_no"].alias("order_no"),
        info["is_paid"].alias("is_paid"),
        info["price"].alias("price"),
        info["updated_at"].alias("updated_at"),
        info["state"].alias("state"),
        info["payment_method"].alias("payment_method"),
        info["id"].alias("id"),
        info["currency"].alias("currency"),
        info["data"][0][1].alias("country"),
        info["data"][1][1].alias("email"),
        "refunded",
    )


@check("""
SELECT c_custkey AS registration_no, c_mktsegment AS ticket_type,
  CAST(c_acctbal AS VARCHAR) AS price, c_name AS organization, sha256(c_name) AS email,
  c_mktsegment AS pynight_attending_or_not
FROM customer
""")
def older_attendees(spark: SparkSession, folder: str) -> DataFrame:
    export = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("Id"),
        F.col("c_custkey").alias("Registration No."),
        F.col("c_mktsegment").alias("Ticket Type"),
        F.col("c_acctbal").cast("string").alias("Price"),
        F.col("c_name").alias("Contact Name"),
        F.col("c_name").alias("Email"),
        F.col("c_name").alias("Contact Email"),
        F.col("c_name").alias(
            "Company  / 服務單位 (For students or teachers, fill in the School + Department Name)"
        ),
        F.col("c_mktsegment").alias("PyNight 參加意願"),
    )
    return offline.older_attendees(export)


_SUPPLIER_COLUMNS = ("s_suppkey", "s_name", "s_nationkey", "s_acctbal")

_QUESTIONS = """
known(question, question_id) AS (
  SELECT 's_name', 3 UNION ALL SELECT DISTINCT n_name, n_nationkey + 10 FROM nation
),
header(place, question) AS (
  VALUES (0, 's_suppkey'), (1, 's_name'), (3, 's_nationkey'), (4, 's_acctbal')
),
ids AS (
  SELECT coalesce(known.question_id, (SELECT max(question_id) FROM known) + 1 + place)
    AS question_id, question, known.question_id IS NULL AS is_new
  FROM header LEFT JOIN known USING (question)
)
"""


def _survey(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    answers = table(spark, folder, "supplier").select(
        F.col("s_suppkey"),
        F.col("s_name"),
        F.lit("x").alias("備註"),
        F.col("s_nationkey"),
        F.col("s_acctbal"),
    )
    nations = table(spark, folder, "nation").select(
        F.col("n_name").alias("question"), (F.col("n_nationkey") + 10).cast("long").alias("question_id")
    )
    known = nations.unionByName(
        spark.range(1).select(F.lit("s_name").alias("question"), F.lit(3).cast("long").alias("question_id"))
    )
    return answers, known


@check(f"""WITH {_QUESTIONS}, long AS (
  SELECT s_suppkey AS ip, unnest({list(_SUPPLIER_COLUMNS)}) AS question,
    unnest([CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR),
      CAST(s_acctbal AS VARCHAR)]) AS answer FROM supplier
)
SELECT CAST(ip AS VARCHAR) AS ip, CAST(question_id AS BIGINT) AS question_id, answer,
  CAST(2146 AS BIGINT) AS year
FROM long JOIN ids USING (question)
""")
def survey_fact(spark: SparkSession, folder: str) -> DataFrame:
    answers, known = _survey(spark, folder)
    ids = reshape.question_ids(known, answers.columns)
    return reshape.survey_fact(reshape.unpivot_survey(answers, 2146, key="s_suppkey"), ids)


@check(f"""WITH {_QUESTIONS}
SELECT CAST(question_id AS BIGINT) AS question_id, question, CAST(2146 AS BIGINT) AS year
FROM ids WHERE is_new
""")
def new_survey_questions(spark: SparkSession, folder: str) -> DataFrame:
    answers, known = _survey(spark, folder)
    renamed = answers.withColumnRenamed("s_suppkey", vocab.SURVEY_KEY)
    _, questions = surveys.fact_and_questions(renamed, known, 2146)
    return questions.withColumn(
        "question",
        F.when(F.col("question") == vocab.SURVEY_KEY, "s_suppkey").otherwise(F.col("question")),
    )


@check("""
SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'paid' ELSE 'not' END AS payment_status,
  strftime(ts, '%Y-%m-%d') AS paid_date, year(ts) AS paid_year
FROM events
""")
def paid_flag_and_date(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").withColumn(
        "paid_date", times.epoch_to_date_text(times.epoch_seconds(F.col("ts").cast("timestamp")))
    )
    return rows.select(
        "event_id",
        text.paid_flag(F.col("event_type") == "purchase", vocab.PAID_TEXTS).alias("payment_status"),
        "paid_date",
        times.year_of_date_text(F.col("paid_date")).alias("paid_year"),
    )


@check("""
SELECT doc_id, CASE WHEN lang = 'en' THEN n_chars END AS whole,
  CAST(CASE WHEN lang <> 'en' THEN n_chars + 0.5 ELSE n_chars END AS DOUBLE) AS decimal,
  CAST(CASE WHEN lang = 'en' THEN 1704067200 + doc_id % 60 END AS DOUBLE) AS seconds,
  trim(text, chr(32) || chr(9) || chr(10) || chr(13)) = text AS is_stripped
FROM documents
""")
def parse_or_null(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    number = F.when(F.col("lang") == "en", F.col("n_chars").cast("string")).otherwise(
        F.concat(F.col("n_chars").cast("string"), F.lit(".5"))
    )
    time = F.when(
        F.col("lang") == "en", F.format_string("2024/01/01 00:00:%02d", F.col("doc_id") % 60)
    ).otherwise("2024-01-01")
    return docs.select(
        "doc_id",
        numbers.long_or_null(number).alias("whole"),
        numbers.double_or_null(number).alias("decimal"),
        times.slash_time_to_epoch(time).alias("seconds"),
        (text.strip(F.col("text")) == F.col("text")).alias("is_stripped"),
    )


@check("""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS feed_time,
  strftime(ts, '%Y-%m-%d %H:%M:%S') || 'UTC' AS feed_text,
  strftime(ts - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS shifted,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS zulu, floor(epoch(ts)) AS seconds
FROM events
""")
def parse_zoned_times(spark: SparkSession, folder: str) -> DataFrame:
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    plain = "yyyy-MM-dd HH:mm:ss"
    millis = F.unix_seconds(F.col("ts").cast("timestamp")) * 1000
    return table(spark, folder, "events").select(
        "event_id",
        F.date_format(times.offset_time(F.concat(iso, F.lit("+0000"))), plain).alias("feed_time"),
        times.offset_time_text(F.concat(iso, F.lit("+0000"))).alias("feed_text"),
        F.date_format(times.offset_time(F.concat(iso, F.lit("+08:00"))), plain).alias("shifted"),
        F.date_format(times.zulu_time(F.concat(iso, F.lit("Z"))), plain).alias("zulu"),
        times.millis_to_seconds(millis).alias("seconds"),
    )


@check("""
SELECT o_orderkey, CAST('999000' || year(o_orderdate) || '0' ||
  CASE WHEN o_orderstatus = 'F' THEN 0 WHEN o_orderstatus = 'O' THEN 1 ELSE 2 END AS BIGINT)
  AS event_id, format('{:,}', o_custkey * 1000) AS separated,
  'https://www.youtube.com/watch?v=' || o_orderkey AS url, sha256(o_orderstatus) AS digest
FROM orders
""")
def built_values(spark: SparkSession, folder: str) -> DataFrame:
    status = F.col("o_orderstatus")
    group = F.when(status == "F", "corporate").when(status == "O", "individual").otherwise("reserved")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        numbers.offline_event_id(F.year("o_orderdate"), group, vocab.TICKET_GROUPS).alias("event_id"),
        text.thousands(F.col("o_custkey") * 1000).alias("separated"),
        text.video_url(F.col("o_orderkey").cast("string")).alias("url"),
        text.sha256_text(status).alias("digest"),
    )


@check("""
SELECT 'c' || c_custkey AS label, c_acctbal AS amount, NULL AS name FROM customer
UNION ALL SELECT 's' || s_suppkey, s_acctbal, s_name FROM supplier
""")
def union_of_drifting_tables(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("label"),
        F.col("c_acctbal").alias("amount"),
    )
    suppliers = table(spark, folder, "supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("label"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("amount"),
    )
    return harmonise.union_by_name([customers, suppliers])
