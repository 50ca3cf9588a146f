"""Messages and labelling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmart.checks import derive
from ticketmart.checks.registry import check, new_table_name, table
from ticketmart.config import scratch
from ticketmart.checks.tickets import _STATISTICS, PREFIX, PRICES
from ticketmart.operators import joins, labelling, payload, statistics
from ticketmart.plans import expenses, profiles, reports, surveys
from ticketmart.sources import files

KEYWORDS = [("red", 3), ("ring", 6), ("bolt", 7), ("small", 2)]

_CATEGORY = """CASE WHEN contains(lower({0}), 'red') THEN 3 WHEN contains(lower({0}), 'ring') THEN 6
  WHEN contains(lower({0}), 'bolt') THEN 7 WHEN contains(lower({0}), 'small') THEN 2 ELSE 0 END"""


def _expenses(spark: SparkSession, folder: str) -> DataFrame:
    text = {
        "Reason": F.col("p_name"),
        "Price": (F.col("p_size") * 100).cast("string"),
        "Remarks": F.col("p_brand"),
        "Team_name": F.col("p_type"),
        "Details": F.col("p_brand"),
        "To_who": F.lit("all"),
        "Yes_or_No": F.lit("Y"),
    }
    return table(spark, folder, "part").select(*[v.alias(k) for k, v in text.items()])


_EXPENSES = """
expenses AS (
  SELECT p_name AS reason, CAST(p_size * 100 AS VARCHAR) AS price, p_brand AS remarks,
    p_type AS team FROM part WHERE p_type <> 'ECONOMY'
),
numbered AS (
  SELECT reason || ', 花費: ' || price || ', ' || team || ', ' || remarks AS line,
    row_number() OVER (ORDER BY reason, price, remarks, team) - 1 AS place FROM expenses
)
"""


@check(f"""WITH {_EXPENSES}
SELECT place // 50 AS part, string_agg(line, chr(10) ORDER BY place) AS content
FROM numbered GROUP BY 1
""")
def expense_message(spark: SparkSession, folder: str) -> DataFrame:
    sheet = _expenses(spark, folder)
    known = sheet.where("Team_name = 'ECONOMY'")
    return reports.expense_message(joins.left_only_rows(sheet, known), lines_per_message=50)


@check("SELECT CAST(0 AS BIGINT) AS part, 'no data' AS content FROM (SELECT count(*) FROM part)")
def expense_message_of_nothing(spark: SparkSession, folder: str) -> DataFrame:
    sheet = _expenses(spark, folder)
    return reports.expense_message(joins.left_only_rows(sheet, sheet), lines_per_message=50)


@check(f"""{_STATISTICS},
prices(ticket_name, price) AS (
  VALUES {", ".join(f"('{name}', {price})" for name, price in PRICES.items())}
),
totals AS (
  SELECT CAST(sum(counts) AS BIGINT) AS total,
    CAST(sum(coalesce(price, 0) * counts) AS BIGINT) AS income
  FROM counts LEFT JOIN prices USING (ticket_name)
),
lines AS (
  SELECT 0 AS section, '' AS name, 'Tickets sold up to 1997-09-01' AS line
  UNION ALL
  SELECT 1, name, '  ' || ticket_name || ': ' || counts FROM counts
  UNION ALL
  SELECT 2, '', 'https://dashboard.example.org/142?year=1997' || chr(10) || total
    || ' tickets in all, worth TWD ' || format('{{:,}}', income) FROM totals
)
SELECT CAST(0 AS BIGINT) AS part, string_agg(line, chr(10) ORDER BY section, line, name) AS content
FROM lines
""")
def sales_message(spark: SparkSession, folder: str) -> DataFrame:
    counts = statistics.registration_statistics(derive.order_rows(spark, folder), PREFIX)
    return reports.sales_message(
        counts,
        1997,
        "https://dashboard.example.org/142",
        "1997-09-01",
        PRICES,
        lines_per_message=100_000,
    )


@check("""
SELECT p_name, (row_number() OVER (ORDER BY p_name) - 1) // 10 AS batch
FROM (SELECT DISTINCT p_name FROM part)
""")
def label_batches(spark: SparkSession, folder: str) -> DataFrame:
    return labelling.chunk(table(spark, folder, "part"), "p_name", 10)


@check("""
WITH batches AS (
  SELECT c_name, (row_number() OVER (ORDER BY c_name) - 1) // 100 AS batch
  FROM (SELECT DISTINCT c_name FROM customer)
)
SELECT batch, count(*) AS items,
  '[' || string_agg('"' || c_name || '"', ', ' ORDER BY c_name) || ']' AS listed,
  length('[' || string_agg('"' || c_name || '"', ', ') || ']') > 2000 AS near_limit
FROM batches GROUP BY batch
""")
def label_prompts(spark: SparkSession, folder: str) -> DataFrame:
    chunks = labelling.chunk(table(spark, folder, "customer"), "c_name", 100)
    prompts = labelling.batch_prompts(chunks, "c_name", "organization", token_limit=2500)
    return prompts.select(
        "batch",
        F.size("items").cast("long").alias("items"),
        F.substring_index("prompt", "資料列表:\n", -1).alias("listed"),
        "near_limit",
    )


@check(f"SELECT p_partkey, {_CATEGORY.format('p_name')} AS category FROM part")
def label_by_keyword(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        "p_partkey", labelling.keyword_category(F.col("p_name"), KEYWORDS).alias("category")
    )


def _profiles(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_name").alias("job_title"),
        F.when(F.col("p_size") > 10, F.lit("2024-01-31 12:00:00"))
        .otherwise("2023-01-01 00:00:00")
        .cast("timestamp")
        .alias("update_time"),
    )


@check(f"""
SELECT p_name AS job_title, CAST({_CATEGORY.format("p_name")} AS BIGINT) AS category
FROM (SELECT DISTINCT p_name FROM part WHERE p_size > 10)
""")
def label_values(spark: SparkSession, folder: str) -> DataFrame:
    labels, _, _ = profiles.label_values(
        _profiles(spark, folder),
        "job_title",
        labelling.keyword_labeller("job_title", KEYWORDS),
        batch_size=7,
        as_of="2024-02-01 00:00:00",
    )
    return labels


@check("""
WITH numbered AS (
  SELECT p_name, row_number() OVER (ORDER BY p_name) - 1 AS place
  FROM (SELECT DISTINCT p_name FROM part WHERE p_size > 10)
)
SELECT place // 7 AS batch, 'ConnectionError: no answer' AS error
FROM numbered GROUP BY 1 HAVING bool_or(contains(p_name, 'red'))
""")
def failed_label_batches(spark: SparkSession, folder: str) -> DataFrame:
    """A labeller that fails for some batches: those are listed, the others are labelled."""
    answer = labelling.keyword_labeller("job_title", KEYWORDS)

    def unsteady(prompt: str, items: list[str]) -> str | None:
        if any("red" in item for item in items):
            raise ConnectionError("no answer")
        return answer(prompt, items)

    _, failed, _ = profiles.label_values(
        _profiles(spark, folder), "job_title", unsteady, batch_size=7, as_of="2024-02-01 00:00:00"
    )
    return failed.select("batch", "error")


@check("""
WITH numbered AS (
  SELECT p_name, row_number() OVER (ORDER BY p_name) - 1 AS place
  FROM (SELECT DISTINCT p_name FROM part WHERE p_size > 10)
)
SELECT place // 7 AS batch, p_name AS job_title FROM numbered WHERE contains(p_name, 'ring')
""")
def unlabelled_values(spark: SparkSession, folder: str) -> DataFrame:
    """A labeller whose replies leave some values out."""
    answer = labelling.keyword_labeller("job_title", KEYWORDS)

    def forgetful(prompt: str, items: list[str]) -> str | None:
        return answer(prompt, [item for item in items if "ring" not in item])

    _, _, left_out = profiles.label_values(
        _profiles(spark, folder), "job_title", forgetful, batch_size=7, as_of="2024-02-01 00:00:00"
    )
    return left_out


@check("""
SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN p_name END AS organization,
  CASE WHEN p_size % 5 <> 0 THEN CAST(p_size AS VARCHAR) END AS category FROM part
""")
def parse_reply(spark: SparkSession, folder: str) -> DataFrame:
    item = F.struct(F.col("p_name").alias("organization"), F.col("p_size").alias("category"))
    whole = F.concat(F.lit("\n```json\n"), F.to_json(F.array(item)), F.lit("\n```\n "))
    reply = F.when(F.col("p_size") % 5 != 0, whole).otherwise("```json [broken ```")
    rows = table(spark, folder, "part").select(
        "p_partkey", F.get(payload.parse_reply(reply, "organization"), F.lit(0)).alias("row")
    )
    return rows.select("p_partkey", "row.organization", "row.category")


@check("""
SELECT p_name AS "Reason", CAST(p_size * 100 AS VARCHAR) AS "Price", count(*) AS rows
FROM part GROUP BY ALL
""")
def expense_load(spark: SparkSession, folder: str) -> DataFrame:
    """The expense job run over a part of the sheet and then over all of it."""
    sheet, name = _expenses(spark, folder), new_table_name("finance")
    for rows in (sheet.where("Price <> '100'"), sheet):
        expenses.save(spark, rows, 50, name)
    return spark.table(name).groupBy("Reason", "Price").agg(F.count("*").alias("rows"))


@check("""
SELECT year(o_orderdate) AS year, 'c' || o_custkey AS email,
  max_by(o_orderstatus, (o_orderdate, o_orderkey)) AS organization
FROM orders GROUP BY ALL
""")
def profile_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The profile job over a first and a second wide table."""
    newest = F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey"))
    orders = (
        table(spark, folder, "orders")
        .groupBy(F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("key"))
        .agg(newest.alias("organization"))
    )
    wide = orders.select(
        F.concat(F.col("year").cast("string"), F.lit("-05-01")).alias("paid_date"),
        F.concat(F.lit("c"), F.col("key").cast("string")).alias("email"),
        "organization",
        *[
            F.lit(None).cast("string").alias(name)
            for name in ("job_title", "country_or_region", "age_range", "gender")
        ],
    )
    name, where = new_table_name("profiles"), scratch(spark, "profiles")
    old = wide.where("paid_date < '1996'").withColumn("organization", F.lit("old"))
    profiles.refresh(spark, [old], where, "2024-01-01 00:00:00", name)
    profiles.refresh(spark, [wide], where, "2024-02-01 00:00:00", name)
    return spark.table(name).select("year", "email", "organization")


@check("""
WITH answers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS ip, unnest([
    {'question': 'IP紀錄', 'answer': CAST(c_custkey AS VARCHAR)},
    {'question': 'Why?', 'answer': '  ' || c_mktsegment || chr(10)},
    {'question': 'Who, "you"?', 'answer': CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END}]) AS a
  FROM customer)
SELECT ip, a.question AS question, a.answer AS answer FROM answers
""")
def survey_load(spark: SparkSession, folder: str) -> DataFrame:
    """The survey job from an exported file, with blanks and line ends at the ends of cells."""
    path = scratch(spark, "survey")
    sheet = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("IP紀錄"),
        F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit("\n")).alias("Why?"),
        F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_name")).alias('Who, "you"?'),
        F.lit("x").alias("備註"),
    )
    (
        sheet.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    domain = new_table_name("survey")
    answers = files.read_survey(spark, path)
    loaded = surveys.save(spark, answers, 2024, f"{path}-out", domain)
    fact, questions = (spark.table(name) for name in loaded)
    return fact.join(questions.drop("year"), "question_id").select("ip", "question", "answer")
