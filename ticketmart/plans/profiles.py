"""User profiles from the wide tables, and labels for their free-text attributes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmart import schemas
from ticketmart.config import moment, remove, scratch
from ticketmart.functions.times import year_of_date_text
from ticketmart.operators import filters, joins, labelling
from ticketmart.operators.harmonise import union_by_name
from ticketmart.plans.current import of_partitions, part_of
from ticketmart.sinks import tables

TABLE = "dwd.user_profile"
KEYS = ["year", "email"]
PARTS = 32
ATTRIBUTES = ["organization", "job_title", "country_or_region", "age_range", "gender"]


def profile_rows(wide_tables: Sequence[DataFrame], strict: bool = True) -> DataFrame:
    """Profile columns of all wide tables, for rows whose paid date has a year."""
    rows = union_by_name(
        [
            table.select(
                year_of_date_text(F.col("paid_date"), strict).alias("year"),
                "email",
                *[
                    F.col(name) if name in table.columns else F.lit(None).cast("string").alias(name)
                    for name in ATTRIBUTES
                ],
            )
            for table in wide_tables
        ]
    )
    return rows.where(F.col("year").isNotNull())


def upsert_profiles(
    profiles: DataFrame, rows: DataFrame, as_of: datetime | str | None = None
) -> DataFrame:
    return joins.merge_upsert(profiles, rows, KEYS, ATTRIBUTES, as_of)


def refresh(
    spark: SparkSession,
    wide_tables: Sequence[DataFrame],
    folder: str,
    as_of: datetime | str | None = None,
    table: str = TABLE,
    parts: int = PARTS,
) -> None:
    """Upserts the rows of the wide tables, which are read once and held for the upsert.

    The table is divided by a hash of its key. Only the parts that the rows fall
    into are read, joined and written again; rows with a missing key part, which
    match nothing, are appended to a part of their own. A table without parts, as
    earlier versions have made it, is written again whole in the given folder.
    """
    tables.create_table(spark, table, schemas.USER_PROFILE_BY_PART, partition_by=["part"])
    held = scratch(spark, "profiles")
    keyed = F.col("year").isNotNull() & F.col("email").isNotNull()
    rows = profile_rows(wide_tables).withColumn(
        "part", F.when(keyed, part_of(KEYS, parts)).otherwise(-1)
    )
    rows.write.parquet(held)
    rows = spark.read.schema(rows.schema).parquet(held)
    profiles = spark.table(table)
    if "part" not in tables.partition_columns(spark, table):
        merged = upsert_profiles(profiles, rows.drop("part"), as_of)
        tables.replace_table(spark, table, merged, folder)
    else:
        keyed_rows = rows.where("part >= 0")
        touched = of_partitions(profiles, keyed_rows, ["part"])
        merged = upsert_profiles(touched.drop("part"), keyed_rows.drop("part"), as_of)
        tables.replace_partitions(spark, table, merged.withColumn("part", part_of(KEYS, parts)))
        loose = rows.where("part < 0").withColumn("update_time", moment(as_of))
        tables.append(loose, table, schemas.USER_PROFILE_BY_PART)
    remove(spark, held)


def label_values(
    profiles: DataFrame,
    task: str,
    labeller: labelling.Labeller,
    batch_size: int = 100,
    token_limit: int = 8192,
    as_of: datetime | str | None = None,
    parallel: int | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Labels of the recently updated values, the batches that failed, and values left out.

    Every value asked for is labelled, in a failed batch, or left out by its
    reply. Replies are written to the shared folder before they are read, so that
    no batch is asked for twice.
    """
    recent = filters.recent_values(profiles, task, "update_time", as_of)
    prompts = labelling.batch_prompts(
        labelling.chunk(recent, task, batch_size), task, task, token_limit
    )
    path = scratch(profiles.sparkSession, f"replies-{task}")
    labelling.ask(prompts, labeller, parallel).write.parquet(path)
    replies = profiles.sparkSession.read.parquet(path)
    labelled, failed = labelling.labels(replies, task), labelling.failed_batches(replies, task)
    return labelled, failed, labelling.unlabelled(prompts, labelled, failed, task)


def save_labels(spark: SparkSession, labels: DataFrame, task: str) -> int:
    table, schema = f"dwd.{task}_updates", schemas.label_updates(task)
    tables.create_table(spark, table, schema)
    return tables.append(labels, table, schema)
