"""Video metrics of the last year: counters and descriptions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmart import schemas
from ticketmart.config import moment
from ticketmart.operators.filters import trailing_year_start
from ticketmart.operators.joins import join_on
from ticketmart.sinks import tables
from ticketmart.sources import videos as landed


def videos_of_last_year(pages: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """Listed videos published within 365 days, each once."""
    videos = landed.listed_videos(pages)
    return (
        videos.where(F.col("published") >= trailing_year_start(as_of))
        .select("videoId", "title")
        .distinct()
    )


def undated_videos(pages: DataFrame) -> DataFrame:
    """Listed videos that no search page gives a time for, with the reason."""
    listed = landed.listed_videos(pages).groupBy("videoId")
    found = listed.agg(F.max("title").alias("title"), F.max("published").alias("published"))
    return found.where("published IS NULL").select(
        "videoId", "title", F.lit("no time of publication").alias("reason")
    )


def without_details(videos: DataFrame, details: DataFrame, reason: str) -> DataFrame:
    """Videos for which no details have landed."""
    known = details.select(F.explode("items").alias("item")).select(
        F.col("item.id").alias("videoId")
    )
    left = join_on(landed.titles(videos), known.distinct(), ["videoId"], "left_anti")
    return left.withColumn("reason", F.lit(reason))


def incomplete(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows that lack a required value, such as a counter the owner hides, and which."""
    _, aside = tables.split_required(rows, schema)
    missing = [F.when(F.col(f.name).isNull(), f.name) for f in schema if not f.nullable]
    return aside.select(
        "videoId", "title", F.concat(F.lit("missing: "), F.concat_ws(", ", *missing)).alias("reason")
    )


def save(
    spark: SparkSession,
    pages: DataFrame,
    statistics: DataFrame,
    info: DataFrame,
    as_of: datetime | str | None = None,
    layer: str = "ods",
) -> dict[str, int]:
    """Loads counters and descriptions; videos that a table cannot take are put aside.

    `<layer>.video_aside` has videos without a time, without landed details, and
    with missing values, each with the reason.
    """
    videos = videos_of_last_year(pages, as_of)
    counted = landed.video_statistics(videos, statistics, as_of)
    described = landed.video_info(videos, info, as_of)
    aside = undated_videos(pages)
    for rows in (
        without_details(videos, statistics, "no statistics have landed"),
        without_details(videos, info, "no description has landed"),
        incomplete(counted, schemas.VIDEO_STATISTICS),
        incomplete(described, schemas.VIDEO_INFO),
    ):
        aside = aside.unionByName(rows)
    outputs = {
        f"{layer}.video_statistics": (counted, schemas.VIDEO_STATISTICS),
        f"{layer}.video_info": (described, schemas.VIDEO_INFO),
    }
    loaded = {}
    for table, (rows, schema) in outputs.items():
        tables.create_table(spark, table, schema)
        loaded[table] = tables.append(tables.split_required(rows, schema)[0], table, schema)
    table = f"{layer}.video_aside"
    tables.create_table(spark, table, schemas.VIDEO_ASIDE)
    kept = aside.withColumn("created_at", moment(as_of))
    if count := tables.append(kept, table, schemas.VIDEO_ASIDE):
        loaded[table] = count
    return loaded
