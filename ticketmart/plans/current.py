"""Tables of current rows, kept as loads come in instead of ranked whole each time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmart.config import remove, scratch
from ticketmart.operators.dedupe import latest_per_key
from ticketmart.sinks import tables

KEYS = ("event_id", "registration_no")
#: Parts of an event, so that a hot one is written by several tasks and in part.
PARTS = 8


def latest_order(columns: Sequence[str], keys: Sequence[str]) -> list[Column]:
    """Newest first; rows of one time by all their values, so that the order is total."""
    others = [name for name in columns if name not in (*keys, "updated_at", "part")]
    return [F.desc("updated_at"), *[F.desc(tables.quoted(name)) for name in others]]


def of_partitions(rows: DataFrame, touched: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows of the touched partitions, whose names (a few) become a filter of the scan."""
    found = [tuple(row) for row in touched.select(*names).distinct().collect()]
    wanted = F.lit(False)
    for values in found:
        same = [F.col(name).eqNullSafe(F.lit(value)) for name, value in zip(names, values, strict=True)]
        wanted = wanted | reduce(Column.__and__, same)
    return rows.where(wanted)


def part_of(names: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*names), F.lit(parts)).cast("int")


def keep_current(
    spark: SparkSession, rows: DataFrame, table: str, keys: Sequence[str] = KEYS, parts: int = PARTS
) -> None:
    """Merges rows into a table of the latest row per key.

    The table is divided by the first key and a hash of all of them. Only the
    partitions that the rows fall into are read and written again, so a load costs
    what its own events hold. Merging rows twice changes nothing. Columns that the
    table lacks are added.
    """
    held = scratch(spark, "current")
    rows.withColumn("part", part_of(keys, parts)).write.parquet(held)
    fresh = spark.read.parquet(held)
    folders = [keys[0], "part"]
    fields = [field for field in fresh.schema if field.name not in folders]
    schema = T.StructType([*fields, *[fresh.schema[name] for name in folders]])
    tables.create_table(spark, table, schema, partition_by=folders)
    tables.add_columns(spark, table, fresh.schema)
    known = spark.table(table)
    met = of_partitions(known, fresh, folders).unionByName(tables.in_schema(fresh, known.schema))
    latest = latest_per_key(met, [*keys], latest_order(known.columns, keys))
    tables.replace_partitions(spark, table, latest)
    remove(spark, held)
