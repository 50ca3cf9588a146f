"""Newest, latest and distinct."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(rows: DataFrame, time_column: str) -> DataFrame:
    return rows.agg(F.max(time_column).alias(time_column))


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row of each key that comes first in the order; rows without a key are one group.

    `row_number() = 1` lets Spark keep one row per key before the shuffle, so a
    key that holds much of the data does not reach one task whole. The order has
    to be total for a repeatable result.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def distinct_rows(rows: DataFrame) -> DataFrame:
    return rows.dropDuplicates()


def top_rows(rows: DataFrame, order: Sequence[Column], count: int) -> DataFrame:
    return rows.orderBy(*order).limit(count)
