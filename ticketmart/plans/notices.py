"""Notifications as rows: proposals, new tweets, and the check before sending."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmart import schemas
from ticketmart.config import scratch
from ticketmart.functions.text import status_url
from ticketmart.operators.filters import newer_id
from ticketmart.sinks import tables
from ticketmart.sources.notices import newest_tweets

STATE = "ods.newest_tweet"


def proposal_message(counts: DataFrame) -> DataFrame:
    return counts.select(
        F.format_string(
            "目前投稿議程數: %d; 課程數: %d", "num_proposed_talk", "num_proposed_tutorial"
        ).alias("content")
    )


def tweet_message(account: str, rest_id: Column, full_text: Column) -> Column:
    return F.concat(
        F.lit("new twitter post: "), status_url(account, rest_id), F.lit("\n\n"), full_text
    )


def tweet_notices(replies: DataFrame, state: DataFrame, account: str) -> DataFrame:
    """A message per reply with a newer tweet than the stored id; a reply that cannot be
    read is the message itself."""
    stored = state.agg(F.max("rest_id")).scalar()
    tweets = newest_tweets(replies)
    unread = F.col("rest_id").isNull()
    return tweets.where(
        unread | newer_id(F.col("rest_id"), F.coalesce(stored, F.lit("")))
    ).select(
        "rest_id",
        F.when(unread, F.col("reply"))
        .otherwise(tweet_message(account, F.col("rest_id"), F.col("full_text")))
        .alias("content"),
    )


def newest_state(replies: DataFrame, state: DataFrame) -> DataFrame:
    """The id to store next: the largest, as text, of the stored and the new ones."""
    ids = newest_tweets(replies).select("rest_id").unionByName(state.select("rest_id"))
    return ids.agg(F.max("rest_id").alias("rest_id")).where("rest_id IS NOT NULL")


def save_tweet_notices(
    spark: SparkSession, replies: DataFrame, account: str, folder: str
) -> DataFrame:
    """Notices of one run, after which the stored id is the newest one.

    They are written to the shared folder before the stored id changes.
    """
    tables.create_table(spark, STATE, schemas.NEWEST_TWEET)
    held = scratch(spark, "tweet-notices")
    state = spark.table(STATE)
    tweet_notices(replies, state, account).write.parquet(held)
    tables.replace_table(spark, STATE, newest_state(replies, state), folder)
    return spark.read.parquet(held)


def check_outbox(outbox: DataFrame, extra: str = "extra") -> DataFrame:
    """Adds `problem`, missing for a notification that can be sent."""
    details = F.from_json(extra, "map<string,string>")
    empty = details.isNull() | (F.size(details) == 0)
    endpoint = F.coalesce(details["webhook_endpoint_key"], F.lit(""))
    return outbox.withColumn(
        "problem",
        F.when(empty, "extra is empty").when(endpoint == "", "webhook_endpoint_key is missing"),
    )
