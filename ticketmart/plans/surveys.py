"""Survey exports: answers as a fact table, questions as a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticketmart import schemas
from ticketmart.operators import reshape
from ticketmart.sinks import tables


def fact_and_questions(
    answers: DataFrame, known_questions: DataFrame, year: int
) -> tuple[DataFrame, DataFrame]:
    ids = reshape.question_ids(known_questions, answers.columns)
    fact = reshape.survey_fact(reshape.unpivot_survey(answers, year), ids)
    return fact, reshape.new_questions(ids, year)


def save(
    spark: SparkSession,
    answers: DataFrame,
    year: int,
    folder: str,
    domain: str = "questionnaire",
    prod: bool = True,
    contributor: str = "",
) -> dict[str, int]:
    """Exports both as CSV, then appends what was exported, so both tables see the same ids."""
    naming = {"prod": prod, "contributor": contributor}
    fact_table = tables.table_name("ods", domain, "ip", "datetime", **naming)
    question_table = tables.table_name("dim", domain, "questionId", "year", **naming)
    tables.create_table(spark, fact_table, schemas.SURVEY_FACT)
    tables.create_table(spark, question_table, schemas.SURVEY_QUESTION)
    fact, questions = fact_and_questions(answers, spark.table(question_table), year)
    loaded = {}
    for rows, table, schema in (
        (fact, fact_table, schemas.SURVEY_FACT),
        (questions, question_table, schemas.SURVEY_QUESTION),
    ):
        path = f"{folder}/{table}"
        tables.export_csv(rows, path)
        exported = (
            spark.read.schema(schema)
            .option("header", True)
            .option("multiLine", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("nullValue", "\u0001")  # so that only an unquoted cell is missing
            .csv(path)
        )
        loaded[table] = tables.append(exported, table, schema)
    return loaded
