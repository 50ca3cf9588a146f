"""Registered queries and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

# the given tables are few files; rows are spread over so many tasks before heavy work
TASKS = 16
# over more tasks for larger tables, so that what one of them sorts stays the same
TASK_ROWS = 500_000

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def check(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name."""

    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql:
            SQL[query.__name__] = sql
        return query

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tasks_for(rows: DataFrame, task_rows: int = TASK_ROWS) -> int:
    """Number of tasks for a table as it is read, by its number of rows, which its files tell."""
    return max(TASKS, -(-rows.count() // task_rows))


def new_table_name(label: str) -> str:
    """Name for a table of one query run."""
    return f"{label}_{uuid.uuid4().hex}"
