"""Landed replies that only feed notifications."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROPOSALS = "num_proposed_talk bigint, num_proposed_tutorial bigint"

_NEWEST_TWEET = (
    "$.data.user.result.timeline_v2.timeline.instructions[1].entries[0]"
    ".content.itemContent.tweet_results.result"
)


def proposal_counts(replies: DataFrame) -> DataFrame:
    return replies.select("num_proposed_talk", "num_proposed_tutorial")


def newest_tweets(replies: DataFrame, reply: str = "value") -> DataFrame:
    """Id and text of the newest tweet in each timeline reply; a step that is missing leaves
    both missing."""
    found = F.struct(
        F.get_json_object(reply, f"{_NEWEST_TWEET}.rest_id").alias("rest_id"),
        F.get_json_object(reply, f"{_NEWEST_TWEET}.legacy.full_text").alias("full_text"),
    )
    complete = F.col("tweet.rest_id").isNotNull() & F.col("tweet.full_text").isNotNull()
    return replies.select(F.col(reply).alias("reply"), found.alias("tweet")).select(
        "reply",
        F.when(complete, F.col("tweet.rest_id")).alias("rest_id"),
        F.when(complete, F.col("tweet.full_text")).alias("full_text"),
    )
