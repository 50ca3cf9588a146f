"""Joins, dedupe, upserts and warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmart.checks.registry import check, new_table_name, table
from ticketmart.config import scratch
from ticketmart.operators import dedupe, filters, joins
from ticketmart.plans import profiles
from ticketmart.sinks import tables
from ticketmart.sources import files

AS_OF = "2024-02-01 00:00:00"


@check("""
SELECT l_orderkey AS order_no, l_linenumber, l_extendedprice, o_orderstatus, o_totalprice
FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW') o
  ON l_orderkey IS NOT DISTINCT FROM o_orderkey
""")
def left_join_orders(spark: SparkSession, folder: str) -> DataFrame:
    attendees = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_no"), "l_linenumber", "l_extendedprice"
    )
    orders = (
        table(spark, folder, "orders")
        .where("o_orderpriority <> '5-LOW'")
        .select(
            F.col("o_orderkey").alias("order_no"),
            "o_orderstatus",
            "o_totalprice",
            F.lit(0).alias("l_linenumber"),
        )
    )
    return joins.left_join_orders(attendees, orders, "order_no", "o_orderstatus", "F")


@check("""
SELECT l_orderkey AS order_no, l_linenumber, o_orderstatus
FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') o
  ON l_orderkey IS NOT DISTINCT FROM o_orderkey
""")
def left_join_live_orders(spark: SparkSession, folder: str) -> DataFrame:
    attendees = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_no"), "l_linenumber"
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_no"), "o_orderstatus"
    )
    return joins.left_join_orders(
        attendees, orders, "order_no", "o_orderstatus", "F", only_live=True
    )


@check("SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate) FROM orders WHERE o_orderstatus = 'P'")
def left_only_rows(spark: SparkSession, folder: str) -> DataFrame:
    left = table(spark, folder, "orders").withColumn(
        "o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    return joins.left_only_rows(left, left.where("o_orderstatus <> 'P'"))


@check("SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders")
def full_row_distinct(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority")
    return dedupe.distinct_rows(rows.unionByName(rows))


@check("""
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place
  FROM events) WHERE place = 1
""")
def latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    rows = dedupe.latest_per_key(
        table(spark, folder, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]
    )
    return rows.select("user_id", "event_id", "event_type", "value")


@check("SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS newest FROM events")
def newest_time(spark: SparkSession, folder: str) -> DataFrame:
    newest = dedupe.newest(table(spark, folder, "events"), "ts")
    return newest.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("newest"))


@check("SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 5")
def newest_five(spark: SparkSession, folder: str) -> DataFrame:
    rows = dedupe.top_rows(
        table(spark, folder, "events"), [F.desc("ts"), F.desc("event_id")], 5
    )
    return rows.select("event_id", "event_type")


@check("""
SELECT DISTINCT user_id FROM events
WHERE user_id IS NOT NULL AND ts > TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 1 DAY
""")
def recent_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return filters.recent_values(
        table(spark, folder, "events"), "user_id", "ts", "2024-01-30 00:00:00"
    )


@check("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
WHERE o_orderdate >= TIMESTAMP '2000-03-15 00:00:00' - INTERVAL 365 DAY
""")
def trailing_year(spark: SparkSession, folder: str) -> DataFrame:
    start = filters.trailing_year_start("2000-03-15 10:30:00")
    rows = table(spark, folder, "orders").where(F.col("o_orderdate") >= start)
    return rows.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@check("SELECT event_id FROM events WHERE CAST(event_id AS VARCHAR) > '75'")
def newer_id_string_compare(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events")
    return rows.where(filters.newer_id(F.col("event_id"), "75")).select("event_id")


_PROFILES = """
slices AS (
  SELECT year(o_orderdate) AS year,
    CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE c_name END AS email,
    c_mktsegment AS organization, o_orderpriority AS job_title, o_orderstatus AS age_range,
    n_name AS country_or_region, CAST(o_orderkey AS VARCHAR) AS gender, o_orderkey
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
target AS (
  SELECT * REPLACE ('old' AS job_title) FROM slices WHERE age_range <> 'F'
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY year, email ORDER BY o_orderkey) AS place FROM slices
),
source AS (SELECT * FROM ranked WHERE place = 1 OR email IS NULL)
"""


def _slices(spark: SparkSession, folder: str) -> DataFrame:
    rows = (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return rows.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("paid_date"),
        F.when(F.col("o_custkey") % 10 != 0, F.col("c_name")).alias("email"),
        F.col("c_mktsegment").alias("organization"),
        F.col("o_orderpriority").alias("job_title"),
        F.col("o_orderstatus").alias("age_range"),
        F.col("n_name").alias("country_or_region"),
        F.col("o_orderkey").cast("string").alias("gender"),
        "o_orderkey",
    )


@check("""
SELECT year(o_orderdate) AS year, c_name AS email, c_mktsegment AS organization,
  CASE o_orderstatus WHEN 'F' THEN o_orderpriority END AS job_title,
  CAST(NULL AS VARCHAR) AS country_or_region, CAST(NULL AS VARCHAR) AS age_range,
  CAST(NULL AS VARCHAR) AS gender
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority <> '5-LOW'
""")
def profile_union(spark: SparkSession, folder: str) -> DataFrame:
    """One wide table per status, of which only one has job titles; some dates are no dates."""
    rows = table(spark, folder, "orders").join(
        table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    wide = rows.select(
        F.when(F.col("o_orderpriority") == "5-LOW", "soon")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("paid_date"),
        F.col("c_name").alias("email"),
        F.col("c_mktsegment").alias("organization"),
        F.col("o_orderpriority").alias("job_title"),
        "o_orderstatus",
    )
    titled, *others = [wide.where(F.col("o_orderstatus") == status) for status in "FOP"]
    return profiles.profile_rows(
        [titled, *[other.drop("job_title") for other in others]], strict=False
    )


@check(f"""WITH {_PROFILES}
SELECT t.year, t.email, coalesce(s.organization, t.organization) AS organization,
  coalesce(s.job_title, t.job_title) AS job_title,
  coalesce(s.country_or_region, t.country_or_region) AS country_or_region,
  coalesce(s.age_range, t.age_range) AS age_range, coalesce(s.gender, t.gender) AS gender,
  CASE WHEN s.email IS NULL THEN '2020-01-01' ELSE '2024-02-01' END AS updated
FROM target t LEFT JOIN source s ON t.year = s.year AND t.email = s.email
UNION ALL
SELECT year, email, organization, job_title, country_or_region, age_range, gender, '2024-02-01'
FROM source s WHERE NOT EXISTS (
  SELECT 1 FROM target t WHERE t.year = s.year AND t.email = s.email)
""")
def profile_upsert(spark: SparkSession, folder: str) -> DataFrame:
    rows = _slices(spark, folder)
    target = (
        profiles.profile_rows([rows.where("age_range <> 'F'")])
        .withColumn("job_title", F.lit("old"))
        .withColumn("update_time", F.lit("2020-01-01").cast("timestamp"))
    )
    keyed = dedupe.latest_per_key(
        rows.where("email IS NOT NULL"),
        [F.substring("paid_date", 1, 4), "email"],
        [F.asc("o_orderkey")],
    )
    source = profiles.profile_rows([keyed, rows.where("email IS NULL")])
    merged = profiles.upsert_profiles(target, source, AS_OF)
    return merged.withColumn("updated", F.date_format("update_time", "yyyy-MM-dd")).drop(
        "update_time"
    )


@check("""
SELECT o_orderkey AS id, o_orderpriority AS name, o_orderstatus AS vat_number,
  CAST(NULL AS VARCHAR) AS added FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, NULL, CAST(o_custkey AS VARCHAR), o_orderstatus FROM orders
  WHERE o_orderstatus <> 'F'
""")
def append_evolving(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads into one table, the second with a new column and without an old one."""
    orders = table(spark, folder, "orders")
    name, where = new_table_name("evolving"), scratch(spark, "evolving")
    first = orders.where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("vat_number"),
    )
    second = orders.where("o_orderstatus <> 'F'").select(
        F.col("o_custkey").alias("vat_number"),
        F.col("o_orderstatus").alias("added"),
        F.col("o_orderkey").alias("id"),
    )
    tables.append_evolving(first, name, where)
    tables.append_evolving(second, name, where)
    return spark.table(name)


@check("""
SELECT l_orderkey AS id, l_shipdate >= TIMESTAMP '1998-01-01' AS refunded FROM lineitem
""")
def append_fixed_schema(spark: SparkSession, folder: str) -> DataFrame:
    name, where = new_table_name("fixed"), scratch(spark, "fixed")
    schema = T.StructType().add("id", "long", False).add("refunded", "boolean", False)
    tables.create_table(spark, name, schema, where)
    tables.create_table(spark, name, schema, where)
    rows = table(spark, folder, "lineitem").select(
        (F.col("l_shipdate") >= F.to_timestamp_ntz(F.lit("1998-01-01 00:00:00"))).alias("refunded"),
        F.col("l_orderkey").cast("string").alias("id"),
    )
    tables.append(rows, name, schema)
    tables.append(rows.limit(0), name, schema)
    return spark.table(name)


@check("""
SELECT doc_id AS id, CASE WHEN lang = 'en' THEN source END AS message,
  lang <> 'en' OR source IS NULL AS put_aside FROM documents
""")
def split_required(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.when(F.col("lang") == "en", F.col("source")).alias("message")
    )
    schema = T.StructType().add("id", "long", False).add("message", "string", False)
    good, aside = tables.split_required(rows, schema)
    return good.withColumn("put_aside", F.lit(False)).unionByName(
        aside.withColumn("put_aside", F.lit(True))
    )


@check("""
SELECT doc_id, lang, nullif(text, '') AS text FROM documents
""")
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts, with their quotes, commas and line breaks, through an exported CSV."""
    path = scratch(spark, "export")
    rows = table(spark, folder, "documents").select("doc_id", "lang", "text")
    tables.export_csv(rows, path)
    back = files.missing_to_null(files.read_cells(spark, path), ("",))
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")


@check("""
SELECT p_name AS "Reason", CAST(p_retailprice AS VARCHAR) AS "Price", p_brand AS "Remarks",
  p_type AS "Team_name", p_name AS "Details", CAST(p_size AS VARCHAR) AS "To_who", 'Y' AS "Yes_or_No"
FROM part WHERE p_size <> 7
""")
def expense_sheet(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    sheet = parts.select(
        F.col("p_name").alias("a"),
        F.col("p_retailprice").alias("b"),
        F.col("p_brand").alias("c"),
        F.col("p_type").alias("d"),
        F.col("p_name").alias("e"),
        F.when(F.col("p_size") == 7, "").otherwise(F.col("p_size").cast("string")).alias("f"),
        F.lit("Y").alias("g"),
    )
    return files.expense_rows(sheet)


@check("""
SELECT DISTINCT o_orderpriority AS value FROM orders WHERE o_orderstatus = 'F'
INTERSECT SELECT o_orderpriority FROM orders WHERE o_orderstatus = 'O'
EXCEPT SELECT o_orderpriority FROM orders WHERE o_orderpriority = '5-LOW'
""")
def set_operations(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("value"), "o_orderstatus"
    )
    return (
        orders.where("o_orderstatus = 'F'")
        .select("value")
        .intersect(orders.where("o_orderstatus = 'O'").select("value"))
        .subtract(orders.where("value = '5-LOW'").select("value"))
    )


@check("""
SELECT event_id, event_type || chr(10) || '"' || chr(10) || ', ' || props AS told, event_type AS kind FROM events
""")
def split_csv_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One exported file with quotes, commas and line breaks in its cells, read in blocks."""
    path = scratch(spark, "export")
    told = F.concat("event_type", F.lit('\n"\n, '), "props")
    rows = table(spark, folder, "events").select("event_id", told.alias("told"), "event_type")
    tables.export_csv(rows.coalesce(1), path)
    back = files.read_split_cells(spark, path)
    return back.select(
        F.col("event_id").cast("long").alias("event_id"), "told", F.col("event_type").alias("kind")
    )


@check("""
SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS segment,
  'c_custkey, c_name, segment' AS as_is, 'registration_no, full_name, segment' AS to_be
FROM customer
""")
def dry_run(spark: SparkSession, folder: str) -> DataFrame:
    """The whole payload of a trial load as JSON files, missing values too, and its columns."""
    path = scratch(spark, "trial")
    rows = table(spark, folder, "customer").select(
        "c_custkey",
        "c_name",
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("segment"),
    )
    shown = tables.preview(rows, path)
    changes = tables.column_changes(shown.columns, ["registration_no", "full_name", "segment"])
    named = [F.lit(", ".join(names)).alias(label) for label, names in changes.items()]
    return spark.read.schema(rows.schema).json(path).select("*", *named)


@check("""
WITH listed AS (SELECT n_name, row_number() OVER (ORDER BY n_nationkey) - 1 AS place FROM nation)
SELECT n_name AS nation, place, 'column ' || r_regionkey AS "column"
FROM listed JOIN nation USING (n_name) JOIN region ON n_regionkey = r_regionkey
""")
def mapping_files(spark: SparkSession, folder: str) -> DataFrame:
    """A JSON file of fields and columns and a file of names, one a line, some lines blank."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    names, fields = scratch(spark, "names"), scratch(spark, "fields")
    blank = F.when(F.col("n_nationkey") % 4 == 0, "\n  ").otherwise("")
    listed = nation.coalesce(1).sortWithinPartitions("n_nationkey")
    listed.select(F.concat(F.lit(" "), "n_name", blank).alias("value")).write.text(names)
    pair = F.struct("r_name", F.concat(F.lit("column "), F.col("r_regionkey").cast("string")))
    region.agg(F.to_json(F.map_from_entries(F.collect_list(pair))).alias("value")).write.text(fields)
    mapping = files.read_meta_fields(spark, fields)
    order = files.read_field_names(spark, names)
    places = F.create_map(*[F.lit(x) for place, name in enumerate(order) for x in (name, place)])
    columns = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("nation"),
        places[F.col("n_name")].cast("long").alias("place"),
        columns[F.col("r_name")].alias("column"),
    )
