"""Social posts: new posts once, counters of all posts at every run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmart import schemas
from ticketmart.config import moment
from ticketmart.operators.filters import newer_than
from ticketmart.sinks import tables
from ticketmart.sources import posts as landed


UNDATED = T.StructType().add("id", "string").add("query_time", "timestamp").add("post", "string")


@dataclass(frozen=True)
class Network:
    """How a network's posts are read, and what is kept of their counters."""

    name: str
    read: Callable[..., DataFrame]
    insights: T.StructType = schemas.POST_INSIGHTS

    @property
    def posts_table(self) -> str:
        return f"ods.posts_{self.name}"

    @property
    def insights_table(self) -> str:
        return f"ods.posts_insights_{self.name}"


NETWORKS = {
    network.name: network
    for network in (
        Network("fb", landed.feed_posts, schemas.FEED_INSIGHTS),
        Network("ig", landed.media_posts),
        Network("linkedin", landed.company_posts),
        Network("twitter", landed.tweets),
    )
}


def new_posts(posts: DataFrame, known: DataFrame) -> DataFrame:
    """Posts later than the newest known post."""
    return newer_than(posts, F.col("created_at"), known, "created_at").select(
        "id", "created_at", "message"
    )


def insight_snapshot(
    posts: DataFrame,
    as_of: datetime | str | None = None,
    schema: T.StructType = schemas.POST_INSIGHTS,
) -> DataFrame:
    """Counters of all posts at one time."""
    fixed = {
        "post_id": F.col("id"),
        "query_time": moment(as_of),
        "period": F.lit("lifetime"),
    }
    return posts.select(
        *[fixed.get(name, F.col(name)).alias(name) for name in schema.fieldNames()]
    )


def undated_posts(aside: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """Posts put aside, as JSON text with all their counters, and when they were seen."""
    return aside.select(
        "id", moment(as_of).alias("query_time"), F.to_json(F.struct("*")).alias("post")
    )


def save(
    spark: SparkSession,
    network: Network,
    posts: DataFrame,
    as_of: datetime | str | None = None,
) -> dict[str, int]:
    """Appends to the network's own tables; posts that lack a required value have their own."""
    tables.create_table(spark, network.posts_table, schemas.POSTS)
    tables.create_table(spark, network.insights_table, network.insights)
    undated = f"{network.posts_table}_undated"
    tables.create_table(spark, undated, UNDATED)
    dated, aside = tables.split_required(posts, schemas.POSTS)
    fresh = new_posts(dated, spark.table(network.posts_table))
    return {
        network.posts_table: tables.append(fresh, network.posts_table, schemas.POSTS),
        network.insights_table: tables.append(
            insight_snapshot(dated, as_of, network.insights),
            network.insights_table,
            network.insights,
        ),
        undated: tables.append(undated_posts(aside, as_of), undated, UNDATED),
    }
