"""Social posts, videos, and notifications made from replies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmart import schemas
from ticketmart.checks.registry import check, new_table_name, table
from ticketmart.config import scratch
from ticketmart.plans import notices, videos
from ticketmart.plans import posts as plan
from ticketmart.sources import notices as notice_sources
from ticketmart.sources import posts as landed
from ticketmart.sources import videos as video_sources
from ticketmart.streaming import ingest

AS_OF = "2024-02-01 00:00:00"
_TIME = "yyyy-MM-dd HH:mm:ss"


def _text(rows: DataFrame, *columns: str) -> DataFrame:
    """Time columns as text."""
    return rows.withColumns({name: F.date_format(name, _TIME) for name in columns})


def _feed(spark: SparkSession, folder: str) -> DataFrame:
    """A feed reply per event; errors have no message, views no shares."""
    kind = F.col("event_type")
    post = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+0000")).alias("created_time"),
        F.when(kind != "error", kind).alias("message"),
        F.struct(F.struct(F.col("user_id").alias("total_count")).alias("summary")).alias("comments"),
        F.struct(
            F.struct((F.col("user_id") * 2).alias("total_count")).alias("summary")
        ).alias("reactions"),
        F.when(kind != "view", F.struct(F.col("user_id").alias("count"))).alias("shares"),
    )
    return table(spark, folder, "events").select(F.array(post).alias("data"))


_FEED = """
feed AS (
  SELECT CAST(event_id AS VARCHAR) AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at,
    CASE event_type WHEN 'error' THEN 'No message found' ELSE event_type END AS message,
    user_id AS comments, user_id * 2 AS reactions,
    CASE event_type WHEN 'view' THEN 0 ELSE user_id END AS share
  FROM events
)
"""


@check(f"WITH {_FEED} SELECT * FROM feed")
def feed_posts(spark: SparkSession, folder: str) -> DataFrame:
    return _text(landed.feed_posts(_feed(spark, folder)), "created_at")


@check(f"""WITH {_FEED}
SELECT id, created_at, message FROM feed WHERE created_at > (
  SELECT max(created_at) FROM feed WHERE message <> 'view' AND created_at < '2024-01-20 00:00:00')
""")
def new_posts(spark: SparkSession, folder: str) -> DataFrame:
    posts = landed.feed_posts(_feed(spark, folder))
    known = posts.where("message <> 'view' AND created_at < TIMESTAMP '2024-01-20 00:00:00'")
    return _text(plan.new_posts(posts, known), "created_at")


@check(f"WITH {_FEED} SELECT id, created_at, message FROM feed")
def new_posts_of_empty_table(spark: SparkSession, folder: str) -> DataFrame:
    posts = landed.feed_posts(_feed(spark, folder))
    known = spark.createDataFrame([], schemas.POSTS)
    return _text(plan.new_posts(posts, known), "created_at")


@check(f"""WITH {_FEED}
SELECT id AS post_id, '2024-02-01 00:00:00' AS query_time, comments, reactions, share FROM feed
""")
def insight_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    posts = landed.feed_posts(_feed(spark, folder))
    return _text(plan.insight_snapshot(posts, AS_OF, schemas.FEED_INSIGHTS), "query_time")


@check(f"WITH {_FEED} SELECT id, created_at, message FROM feed")
def streamed_posts(spark: SparkSession, folder: str) -> DataFrame:
    """The feed landed as JSON, taken by the streaming job, twice."""
    landing, target = scratch(spark, "feed"), scratch(spark, "posts")
    _feed(spark, folder).write.json(landing)
    for _ in range(2):
        replies = spark.readStream.schema(landed.FEED).json(landing)
        ingest.ingest_posts(plan.NETWORKS["fb"], replies, target, AS_OF)
    return _text(ingest.read_output(spark, target, "posts").drop("batch_id"), "created_at")


@check("""
SELECT CAST(vec_id AS VARCHAR) AS id, '2024-01-01 00:00:00' AS created_at,
  CASE WHEN label % 2 = 0 THEN 'No Content' ELSE 'caption ' || label END AS message,
  'IMAGE' AS media_type, CAST(CASE WHEN label = 3 THEN 0 ELSE label END AS BIGINT) AS favorite,
  CAST(label AS BIGINT) AS reply, CAST(0 AS BIGINT) AS retweet, CAST(0 AS BIGINT) AS views
FROM embeddings WHERE label <> 5
""")
def media_posts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", F.col("label").cast("long").alias("label"))
    name = F.col("vec_id").cast("string")
    listed = rows.where("label <> 5").select(F.array(F.struct(name.alias("id"))).alias("data"))
    details = rows.select(
        name.alias("id"),
        F.lit("IMAGE").alias("media_type"),
        F.when(F.col("label") % 2 != 0, F.format_string("caption %d", "label")).alias("caption"),
        F.lit("2024-01-01T00:00:00+0000").alias("timestamp"),
        F.col("label").alias("comments_count"),
        F.when(F.col("label") != 3, F.col("label")).alias("like_count"),
    )
    return _text(landed.media_posts(listed, details), "created_at")


@check("""
SELECT CAST(event_id AS VARCHAR) AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at,
  CASE event_type WHEN 'click' THEN 'No Content' ELSE event_type END AS message,
  CASE event_type WHEN 'view' THEN 0 ELSE user_id END AS favorite, user_id AS reply,
  event_id AS retweet, CAST(0 AS BIGINT) AS views
FROM events WHERE event_type <> 'signup'
""")
def company_posts(spark: SparkSession, folder: str) -> DataFrame:
    """A reply per event; the replies of signups have a null list."""
    kind = F.col("event_type")
    post = F.struct(
        F.col("event_id").cast("string").alias("urn"),
        (F.unix_seconds(F.col("ts").cast("timestamp")) * 1000).alias("postedDateTimestamp"),
        F.when(kind != "click", kind).alias("text"),
        F.when(kind != "view", F.col("user_id")).alias("totalReactionCount"),
        F.col("user_id").alias("commentsCount"),
        F.col("event_id").alias("repostsCount"),
    )
    replies = table(spark, folder, "events").select(
        F.when(kind != "signup", F.array(post)).alias("data")
    )
    return _text(landed.company_posts(replies), "created_at")


@check("""
SELECT CAST(event_id AS VARCHAR) AS post_id, '2024-02-01 00:00:00' AS query_time,
  'lifetime' AS period, user_id AS favorite, user_id + 1 AS reply, user_id + 2 AS retweet,
  event_id AS views
FROM events
""")
def tweet_insights(spark: SparkSession, folder: str) -> DataFrame:
    post = F.struct(
        F.col("event_id").cast("string").alias("tweet_id"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.col("event_type").alias("text"),
        F.col("user_id").alias("favorite_count"),
        (F.col("user_id") + 1).alias("reply_count"),
        (F.col("user_id") + 2).alias("retweet_count"),
        F.col("event_id").alias("views"),
    )
    replies = table(spark, folder, "events").select(F.array(post).alias("results"))
    return _text(plan.insight_snapshot(landed.tweets(replies), AS_OF), "query_time")


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    """A search page per order, with one item that is a video and one that is none."""
    title = F.col("o_orderpriority")
    published = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    snippet = F.struct(title.alias("title"), published.alias("publishedAt"))

    def item(video_id: F.Column) -> F.Column:
        return F.struct(F.struct(video_id.alias("videoId")).alias("id"), snippet.alias("snippet"))

    return table(spark, folder, "orders").select(
        F.lit("next").alias("nextPageToken"),
        F.array(
            item(F.col("o_orderkey").cast("string")), item(F.lit(None).cast("string"))
        ).alias("items"),
    )


@check("""
SELECT '2000-03-15 00:00:00' AS created_at, CAST(o_orderkey AS VARCHAR) AS "videoId",
  o_orderpriority AS title, o_custkey AS "viewCount", o_custkey + 1 AS "likeCount",
  CAST(0 AS BIGINT) AS "dislikeCount", o_custkey + 2 AS "favoriteCount", o_custkey + 3 AS "commentCount"
FROM orders WHERE o_orderdate >= TIMESTAMP '2000-03-15 00:00:00' - INTERVAL 365 DAY
""")
def video_statistics(spark: SparkSession, folder: str) -> DataFrame:
    count = F.col("o_custkey")
    details = table(spark, folder, "orders").select(
        F.array(
            F.struct(
                F.col("o_orderkey").cast("string").alias("id"),
                F.struct(
                    count.cast("string").alias("viewCount"),
                    (count + 1).cast("string").alias("likeCount"),
                    (count + 2).cast("string").alias("favoriteCount"),
                    (count + 3).cast("string").alias("commentCount"),
                ).alias("statistics"),
            )
        ).alias("items")
    )
    as_of = "2000-03-15 00:00:00"
    listed = videos.videos_of_last_year(_pages(spark, folder), as_of)
    return _text(video_sources.video_statistics(listed, details, as_of), "created_at")


@check("""
SELECT '2000-03-15 00:00:00' AS created_at, CAST(o_orderkey AS VARCHAR) AS "videoId",
  o_orderpriority AS title, 'img' || o_orderkey AS image_url, o_orderstatus AS subtitle,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS time,
  'https://www.youtube.com/watch?v=' || o_orderkey AS url
FROM orders WHERE o_orderdate >= TIMESTAMP '2000-03-15 00:00:00' - INTERVAL 365 DAY
""")
def video_info(spark: SparkSession, folder: str) -> DataFrame:
    image = F.struct(F.concat(F.lit("img"), F.col("o_orderkey").cast("string")).alias("url"))
    details = table(spark, folder, "orders").select(
        F.array(
            F.struct(
                F.col("o_orderkey").cast("string").alias("id"),
                F.struct(
                    F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
                    F.col("o_orderstatus").alias("description"),
                    F.struct(image.alias("default")).alias("thumbnails"),
                ).alias("snippet"),
            )
        ).alias("items")
    )
    as_of = "2000-03-15 00:00:00"
    listed = videos.videos_of_last_year(_pages(spark, folder), as_of)
    return _text(video_sources.video_info(listed, details, as_of), "created_at", "time")


def _timelines(spark: SparkSession, folder: str) -> DataFrame:
    """A timeline reply per conversation turn; replies of the system role are cut short."""
    tweet = (
        '{"data":{"user":{"result":{"timeline_v2":{"timeline":{"instructions":[{},{"entries":'
        '[{"content":{"itemContent":{"tweet_results":{"result":'
    )
    rest_id = (F.col("conv_id") * 1000 + F.col("turn")).cast("string")
    result = F.to_json(
        F.struct(rest_id.alias("rest_id"), F.struct(F.col("text").alias("full_text")).alias("legacy"))
    )
    whole = F.concat(F.lit(tweet), result, F.lit("}}}}]}]}}}}}}"))
    return table(spark, folder, "conversations").select(
        F.when(F.col("turn") % 5 == 4, F.lit('{"data":{}}')).otherwise(whole).alias("value")
    )


@check("""
SELECT rest_id, content FROM (
  SELECT CASE WHEN turn % 5 <> 4 THEN CAST(conv_id * 1000 + turn AS VARCHAR) END AS rest_id,
    CASE WHEN turn % 5 = 4 THEN '{"data":{}}' ELSE 'new twitter post: https://twitter.com/conf/status/'
      || CAST(conv_id * 1000 + turn AS VARCHAR) || chr(10) || chr(10) || text END AS content
  FROM conversations)
WHERE rest_id IS NULL OR rest_id > '30'
""")
def tweet_notices(spark: SparkSession, folder: str) -> DataFrame:
    state = spark.createDataFrame([("30",)], "rest_id string")
    return notices.tweet_notices(_timelines(spark, folder), state, "conf")


@check("""
SELECT max(CAST(conv_id * 1000 + turn AS VARCHAR)) AS rest_id FROM conversations WHERE turn % 5 <> 4
""")
def newest_tweet_state(spark: SparkSession, folder: str) -> DataFrame:
    state = spark.createDataFrame([("30",)], "rest_id string")
    return notices.newest_state(_timelines(spark, folder), state)


@check("""
SELECT '目前投稿議程數: ' || o_custkey || '; 課程數: ' || o_orderkey AS content FROM orders
""")
def proposal_message(spark: SparkSession, folder: str) -> DataFrame:
    replies = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("num_proposed_talk"),
        F.col("o_orderkey").alias("num_proposed_tutorial"),
    )
    return notices.proposal_message(notice_sources.proposal_counts(replies))


@check("""
SELECT event_id, CASE event_type WHEN 'error' THEN 'extra is empty' WHEN 'view' THEN 'extra is empty'
  WHEN 'click' THEN 'webhook_endpoint_key is missing' END AS problem
FROM events
""")
def outbox_validate(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    extra = (
        F.when(kind == "error", "{}")
        .when(kind == "click", F.col("props"))
        .when(kind != "view", F.lit('{"webhook_endpoint_key": "team", "content": "x"}'))
    )
    outbox = table(spark, folder, "events").select("event_id", extra.alias("extra"))
    return notices.check_outbox(outbox).drop("extra")


@check("""
SELECT 'urn' || o_orderkey AS id, o_custkey AS favorite FROM orders WHERE o_orderkey % 3 = 0
""")
def undated_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Posts without a time, as the job stores them beside its own tables."""
    post = F.struct(
        F.concat(F.lit("urn"), F.col("o_orderkey").cast("string")).alias("urn"),
        F.when(F.col("o_orderkey") % 3 != 0, F.unix_millis(F.col("o_orderdate").cast("timestamp")))
        .alias("postedDateTimestamp"),
        F.col("o_orderpriority").alias("text"),
        F.col("o_custkey").alias("totalReactionCount"),
        F.col("o_custkey").alias("commentsCount"),
        F.col("o_custkey").alias("repostsCount"),
    )
    replies = table(spark, folder, "orders").select(F.array(post).alias("data"))
    network = plan.Network(new_table_name("company"), landed.company_posts)
    plan.save(spark, network, landed.company_posts(replies), AS_OF)
    return spark.table(f"{network.posts_table}_undated").select(
        "id", F.get_json_object("post", "$.favorite").cast("long").alias("favorite")
    )


@check("""
SELECT CAST(o_orderkey AS VARCHAR) AS "videoId", o_custkey AS "viewCount", o_orderstatus AS subtitle
FROM orders WHERE o_orderdate >= TIMESTAMP '2000-03-15 00:00:00' - INTERVAL 365 DAY
""")
def video_load(spark: SparkSession, folder: str) -> DataFrame:
    """The video job from landed JSON files to its two tables."""
    orders, where = table(spark, folder, "orders"), scratch(spark, "videos")
    key = F.col("o_orderkey").cast("string").alias("id")
    counts = [F.col("o_custkey").cast("string").alias(name) for name in video_sources.COUNTERS]
    image = F.struct(F.lit("u").alias("url"))
    snippet = F.struct(
        F.lit("2000-01-01T00:00:00Z").alias("publishedAt"),
        F.col("o_orderstatus").alias("description"),
        F.struct(image.alias("default")).alias("thumbnails"),
    )
    replies = {
        "pages": _pages(spark, folder),
        "statistics": orders.select(
            F.array(F.struct(key, F.struct(*counts).alias("statistics"))).alias("items")
        ),
        "info": orders.select(F.array(F.struct(key, snippet.alias("snippet"))).alias("items")),
    }
    forms = (video_sources.SEARCH_PAGES, video_sources.STATISTICS, video_sources.INFO)
    for name, rows in replies.items():
        rows.write.json(f"{where}/{name}")
    landed_files = [
        spark.read.schema(form).json(f"{where}/{name}")
        for name, form in zip(replies, forms, strict=True)
    ]
    layer = new_table_name("videos")
    videos.save(spark, *landed_files, "2000-03-15 00:00:00", layer)
    info = spark.table(f"{layer}.video_info").select("videoId", "subtitle")
    counted = spark.table(f"{layer}.video_statistics").select("videoId", "viewCount")
    return counted.join(info, "videoId")


@check("""
SELECT CAST(o_orderkey AS VARCHAR) AS "videoId", 'title 2' AS title, o_custkey + 9 AS "viewCount"
FROM orders
""")
def video_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Videos listed under two titles, with details landed twice, two videos to a reply."""
    key = F.col("o_orderkey").cast("string")
    listed = table(spark, folder, "orders").select(
        key.alias("videoId"), F.explode(F.array(F.lit("title 1"), F.lit("title 2"))).alias("title")
    )

    def item(views: F.Column) -> F.Column:
        counts = [views.cast("string").alias(name) for name in video_sources.COUNTERS]
        return F.struct(key.alias("id"), F.struct(*counts).alias("statistics"))

    details = table(spark, folder, "orders").select(
        F.array(item(F.col("o_custkey")), item(F.col("o_custkey") + 9)).alias("items")
    )
    return video_sources.video_statistics(listed, details).select("videoId", "title", "viewCount")


@check("""
WITH video AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, o_custkey % 7 = 0 AS undated, o_custkey % 5 = 0 AS uncounted,
    o_custkey % 3 = 0 AS hidden, o_custkey % 11 = 0 AS undescribed
  FROM orders WHERE o_orderdate >= TIMESTAMP '2000-03-15 00:00:00' - INTERVAL 365 DAY OR o_custkey % 7 = 0)
SELECT id AS "videoId", 'counted' AS outcome FROM video WHERE NOT undated AND NOT uncounted AND NOT hidden
UNION ALL SELECT id, 'described' FROM video WHERE NOT undated AND NOT undescribed
UNION ALL SELECT id, 'no time of publication' FROM video WHERE undated
UNION ALL SELECT id, 'no statistics have landed' FROM video WHERE NOT undated AND uncounted
UNION ALL SELECT id, 'missing: likeCount' FROM video WHERE NOT undated AND NOT uncounted AND hidden
UNION ALL SELECT id, 'no description has landed' FROM video WHERE NOT undated AND undescribed
""")
def video_aside(spark: SparkSession, folder: str) -> DataFrame:
    """Videos without a time, without details, or with a hidden counter are put aside, not lost."""
    orders, layer = table(spark, folder, "orders"), new_table_name("videos")
    customer, key = F.col("o_custkey"), F.col("o_orderkey").cast("string")
    time = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    listed = F.struct(
        F.struct(key.alias("videoId")).alias("id"),
        F.struct(
            F.lit("t").alias("title"), F.when(customer % 7 != 0, time).alias("publishedAt")
        ).alias("snippet"),
    )
    counts = {name: F.lit("1") for name in video_sources.COUNTERS}
    counts["likeCount"] = F.when(customer % 3 != 0, "2")
    image = F.struct(F.struct(F.lit("u").alias("url")).alias("default"))
    described = F.struct(
        time.alias("publishedAt"), F.lit("d").alias("description"), image.alias("thumbnails")
    )
    counted = F.struct(*[value.alias(name) for name, value in counts.items()])
    videos.save(
        spark,
        orders.select(F.array(listed).alias("items")),
        orders.where(customer % 5 != 0).select(
            F.array(F.struct(key.alias("id"), counted.alias("statistics"))).alias("items")
        ),
        orders.where(customer % 11 != 0).select(
            F.array(F.struct(key.alias("id"), described.alias("snippet"))).alias("items")
        ),
        "2000-03-15 00:00:00",
        layer,
    )
    outcome = lambda name, label: spark.table(f"{layer}.{name}").select(
        "videoId", label.alias("outcome")
    )
    return (
        outcome("video_statistics", F.lit("counted"))
        .unionByName(outcome("video_info", F.lit("described")))
        .unionByName(outcome("video_aside", F.col("reason")))
    )
