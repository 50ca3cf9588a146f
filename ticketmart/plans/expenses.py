"""Expense sheet against the warehouse: load and report what is new."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticketmart import schemas
from ticketmart.config import scratch
from ticketmart.operators.joins import left_only_rows
from ticketmart.plans.reports import expense_message
from ticketmart.sinks import tables

TABLE = "ods.finance"


def new_expenses(sheet: DataFrame, known: DataFrame) -> DataFrame:
    return left_only_rows(sheet, known)


def save(
    spark: SparkSession, sheet: DataFrame, lines_per_message: int, table: str = TABLE
) -> DataFrame:
    """Appends the new expenses and gives their report.

    They are held in the shared folder first, as after the load nothing is new.
    """
    tables.create_table(spark, table, schemas.FINANCE)
    held = scratch(spark, "new-expenses")
    new_expenses(sheet, spark.table(table)).write.parquet(held)
    fresh = spark.read.parquet(held)
    tables.append(fresh, table, schemas.FINANCE)
    return expense_message(fresh, lines_per_message)
