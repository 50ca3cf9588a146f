"""Landed replies of the video platform: search pages and per-video details."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmart.config import moment
from ticketmart.functions.text import video_url
from ticketmart.functions.times import zulu_time
from ticketmart.operators.joins import join_on

SEARCH_PAGES = (
    "nextPageToken string, items array<struct<id:struct<videoId:string>,"
    "snippet:struct<title:string,publishedAt:string>>>"
)
STATISTICS = (
    "items array<struct<id:string,statistics:struct<viewCount:string,likeCount:string,"
    "favoriteCount:string,commentCount:string>>>"
)
COUNTERS = ("viewCount", "likeCount", "favoriteCount", "commentCount")
INFO = (
    "items array<struct<id:string,snippet:struct<publishedAt:string,description:string,"
    "thumbnails:struct<`default`:struct<url:string>>>>>"
)


def listed_videos(pages: DataFrame) -> DataFrame:
    """Videos of all search pages; items that are no video have no video id."""
    item = F.col("item")
    return (
        pages.select(F.explode("items").alias("item"))
        .where(item["id"]["videoId"].isNotNull())
        .select(
            item["id"]["videoId"].alias("videoId"),
            item["snippet"]["title"].alias("title"),
            zulu_time(item["snippet"]["publishedAt"]).alias("published"),
        )
    )


def _items(details: DataFrame) -> DataFrame:
    """(videoId, item) of all items of all replies, one per video.

    Replies do not say when they were made; of several the greatest is taken,
    which for counters, as they grow, is the newest.
    """
    items = details.select(F.explode("items").alias("item")).where("item.id IS NOT NULL")
    return items.groupBy(F.col("item.id").alias("videoId")).agg(F.max("item").alias("item"))


def titles(videos: DataFrame) -> DataFrame:
    """One title per video, also if search pages show several."""
    return videos.groupBy("videoId").agg(F.max("title").alias("title"))


def video_statistics(
    videos: DataFrame, details: DataFrame, as_of: datetime | str | None = None
) -> DataFrame:
    """One typed row per listed video. The platform no longer tells the dislikes."""
    counts = F.col("item.statistics")
    details = details.select(
        F.transform(
            "items",
            lambda item: F.struct(
                item["id"].alias("id"),
                F.struct(
                    *[item["statistics"][name].try_cast("long").alias(name) for name in COUNTERS]
                ).alias("statistics"),
            ),
        ).alias("items")
    )
    found = join_on(titles(videos), _items(details), ["videoId"], "inner")
    return found.select(
        moment(as_of).alias("created_at"),
        "videoId",
        "title",
        counts["viewCount"].alias("viewCount"),
        counts["likeCount"].alias("likeCount"),
        F.lit(0).cast("long").alias("dislikeCount"),
        counts["favoriteCount"].alias("favoriteCount"),
        counts["commentCount"].alias("commentCount"),
    )


def video_info(
    videos: DataFrame, details: DataFrame, as_of: datetime | str | None = None
) -> DataFrame:
    snippet = F.col("item.snippet")
    found = join_on(titles(videos), _items(details), ["videoId"], "inner")
    return found.select(
        moment(as_of).alias("created_at"),
        "videoId",
        "title",
        snippet["thumbnails"]["default"]["url"].alias("image_url"),
        snippet["description"].alias("subtitle"),
        zulu_time(snippet["publishedAt"]).alias("time"),
        video_url(F.col("videoId")).alias("url"),
    )
