"""Landed replies of the social networks, as one row per post.

Every reader gives `id`, `created_at`, `message` and the network's counters.
A post without a time has a missing `created_at`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmart.functions.text import missing_as
from ticketmart.functions.times import millis_to_seconds, offset_time
from ticketmart.operators.joins import join_on

FEED = (
    "data array<struct<id:string,created_time:string,message:string,"
    "comments:struct<summary:struct<total_count:bigint>>,"
    "reactions:struct<summary:struct<total_count:bigint>>,shares:struct<count:bigint>>>"
)
MEDIA_LIST = "data array<struct<id:string>>"
MEDIA_DETAIL = (
    "id string, media_type string, caption string, timestamp string, "
    "comments_count bigint, like_count bigint"
)
COMPANY_POSTS = (
    "data array<struct<urn:string,postedDateTimestamp:bigint,text:string,"
    "totalReactionCount:bigint,commentsCount:bigint,repostsCount:bigint>>"
)
TWEETS = (
    "results array<struct<tweet_id:string,timestamp:bigint,text:string,"
    "favorite_count:bigint,reply_count:bigint,retweet_count:bigint,views:bigint>>"
)

NO_MESSAGE = "No message found"
NO_CONTENT = "No Content"


def feed_posts(replies: DataFrame) -> DataFrame:
    post = F.col("post")
    return replies.select(F.explode("data").alias("post")).select(
        post["id"].alias("id"),
        offset_time(post["created_time"]).alias("created_at"),
        missing_as(post["message"], NO_MESSAGE).alias("message"),
        post["comments"]["summary"]["total_count"].alias("comments"),
        post["reactions"]["summary"]["total_count"].alias("reactions"),
        missing_as(post["shares"]["count"], 0).cast("long").alias("share"),
    )


def media_posts(media_list: DataFrame, details: DataFrame) -> DataFrame:
    """Listed media with their details; what the network does not tell is counted as 0.

    Of details landed several times the greatest is taken, by time and counters.
    """
    listed = media_list.select(F.explode("data").alias("media")).select("media.id").distinct()
    nothing = F.lit(0).cast("long")
    newest = F.max(
        F.struct("timestamp", "like_count", "comments_count", "caption", "media_type")
    ).alias("detail")
    found = join_on(listed, details.groupBy("id").agg(newest), ["id"], "inner")
    return found.select("id", "detail.*").select(
        "id",
        offset_time(F.col("timestamp")).alias("created_at"),
        missing_as(F.col("caption"), NO_CONTENT).alias("message"),
        missing_as(F.col("media_type"), NO_CONTENT).alias("media_type"),
        F.coalesce("like_count", nothing).alias("favorite"),
        F.coalesce("comments_count", nothing).alias("reply"),
        nothing.alias("retweet"),
        nothing.alias("views"),
    )


def company_posts(replies: DataFrame) -> DataFrame:
    """Posts of a company page; a reply whose list is null has none."""
    post = F.col("post")
    nothing = F.lit(0).cast("long")
    return replies.select(F.explode("data").alias("post")).select(
        missing_as(post["urn"], "0").alias("id"),
        F.timestamp_seconds(millis_to_seconds(post["postedDateTimestamp"])).alias("created_at"),
        missing_as(post["text"], NO_CONTENT).alias("message"),
        F.coalesce(post["totalReactionCount"], nothing).alias("favorite"),
        F.coalesce(post["commentsCount"], nothing).alias("reply"),
        F.coalesce(post["repostsCount"], nothing).alias("retweet"),
        nothing.alias("views"),
    )


def tweets(replies: DataFrame) -> DataFrame:
    post = F.col("post")
    return replies.select(F.explode("results").alias("post")).select(
        post["tweet_id"].alias("id"),
        F.timestamp_seconds(post["timestamp"]).alias("created_at"),
        post["text"].alias("message"),
        post["favorite_count"].alias("favorite"),
        post["reply_count"].alias("reply"),
        post["retweet_count"].alias("retweet"),
        post["views"].alias("views"),
    )
