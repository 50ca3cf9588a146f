import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmart import schemas
from ticketmart.config import scratch
from ticketmart.operators import filters, joins, labelling
from ticketmart.operators.numbering import number_in_order
from ticketmart.plans import expenses, notices, posts, profiles, reports, videos
from ticketmart.sinks import tables
from ticketmart.sources import posts as landed_posts
from ticketmart.sources import videos as landed_videos
from ticketmart.streaming import ingest

AS_OF = "2024-02-01 00:00:00"


def feed(*entries):
    return [
        {
            "id": number,
            "created_time": time,
            "comments": {"summary": {"total_count": 1}},
            "reactions": {"summary": {"total_count": 2}},
            **more,
        }
        for number, time, more in entries
    ]


def land(spark, folder, replies):
    lines = [(json.dumps(reply, ensure_ascii=False),) for reply in replies]
    spark.createDataFrame(lines, "value string").write.mode("append").text(folder)


FIRST = feed(
    ("1", "2024-01-01T00:00:00+0000", {"message": "hello", "shares": {"count": 4}}),
    ("2", "2024-01-02T00:00:00+0800", {}),
)
SECOND = [*FIRST, *feed(("3", "2024-01-03T00:00:00+0000", {"message": "third"}))]


def test_posts_are_loaded_once_and_counters_every_time(spark):
    network = posts.Network("fb_test", landed_posts.feed_posts, schemas.FEED_INSIGHTS)
    for replies, new, all_posts in ((FIRST, 2, 2), (SECOND, 1, 3), (SECOND, 0, 3)):
        folder = scratch(spark, "feed")
        land(spark, folder, [{"data": replies}, {"data": None}])
        read = landed_posts.feed_posts(spark.read.schema(landed_posts.FEED).json(folder))
        assert posts.save(spark, network, read, AS_OF) == {
            "ods.posts_fb_test": new,
            "ods.posts_insights_fb_test": all_posts,
            "ods.posts_fb_test_undated": 0,
        }
    rows = {r.id: r for r in spark.table("ods.posts_fb_test").collect()}
    assert rows["2"].message == "No message found"
    assert rows["2"].created_at == datetime(2024, 1, 1, 16)
    shares = spark.table("ods.posts_insights_fb_test").where("post_id = '1'").first()
    assert (shares.comments, shares.reactions, shares.share) == (1, 2, 4)


def test_streamed_posts_equal_the_batch(spark):
    folder, out = scratch(spark, "feed"), scratch(spark, "out")
    for replies in (FIRST, SECOND):
        land(spark, folder, [{"data": replies}])
        stream = spark.readStream.schema(landed_posts.FEED).json(folder)
        ingest.ingest_posts(posts.NETWORKS["fb"], stream, out, AS_OF)
    found = ingest.read_output(spark, out, "posts")
    assert sorted(r.id for r in found.collect()) == ["1", "2", "3"]
    assert ingest.read_output(spark, out, "insights").count() == 5


def test_undated_company_posts_are_put_aside(spark):
    replies = spark.createDataFrame(
        [([("u1", 1654754243126, None, 6, 20, None)],), ([("u2", None, "t", 1, 1, 1)],), (None,)],
        landed_posts.COMPANY_POSTS,
    )
    read = landed_posts.company_posts(replies)
    good, aside = tables.split_required(read, schemas.POSTS)
    row = good.first()
    assert (row.id, row.message, row.favorite, row.reply, row.retweet, row.views) == (
        "u1",
        "No Content",
        6,
        20,
        0,
        0,
    )
    assert [r.id for r in aside.collect()] == ["u2"]
    network = posts.Network("undated_test", landed_posts.company_posts)
    assert posts.save(spark, network, read, AS_OF)["ods.posts_undated_test_undated"] == 1
    kept = spark.table("ods.posts_undated_test_undated").first()
    assert kept.id == "u2" and json.loads(kept.post)["favorite"] == 1


def test_videos_of_the_last_year(spark):
    pages, stats, info = (scratch(spark, name) for name in ("pages", "stats", "info"))

    def item(video, time):
        return {"id": {"videoId": video} if video else {}, "snippet": {"title": "t", "publishedAt": time}}

    land(
        spark,
        pages,
        [
            {"nextPageToken": "p2", "items": [item("v1", "2023-06-01T00:00:00Z"), item(None, "2023-06-01T00:00:00Z")]},
            {"items": [item("v1", "2023-06-01T00:00:00Z"), item("old", "2022-06-01T00:00:00Z")]},
        ],
    )
    counts = {"viewCount": "10", "likeCount": "2", "favoriteCount": "0", "commentCount": "1"}
    land(spark, stats, [{"items": [{"id": "v1", "statistics": counts}]}, {"items": []}])
    snippet = {
        "publishedAt": "2023-06-01T00:00:00Z",
        "description": "d",
        "thumbnails": {"default": {"url": "u"}},
    }
    land(spark, info, [{"items": [{"id": "v1", "snippet": snippet}]}])
    loaded = videos.save(
        spark,
        spark.read.schema(landed_videos.SEARCH_PAGES).json(pages),
        spark.read.schema(landed_videos.STATISTICS).json(stats),
        spark.read.schema(landed_videos.INFO).json(info),
        AS_OF,
    )
    assert loaded == {"ods.video_statistics": 1, "ods.video_info": 1}
    assert spark.table("ods.video_statistics").first()[3:] == (10, 2, 0, 0, 1)
    assert spark.table("ods.video_info").first()[3:] == (
        "u",
        "d",
        datetime(2023, 6, 1),
        "https://www.youtube.com/watch?v=v1",
    )


def expense(spark, *rows):
    full = [(*row, "x", "ops", "d", "me", "Y") for row in rows]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in schemas.FINANCE.names))


def test_new_expenses_are_loaded_and_reported(spark):
    first = expenses.save(spark, expense(spark, ("Taxi", "100"), ("Bus", "20"), ("Bus", "20")), 100)
    assert [r.content for r in first.collect()] == [
        "Bus, 花費: 20, ops, d\nBus, 花費: 20, ops, d\nTaxi, 花費: 100, ops, d"
    ]
    second = expenses.save(spark, expense(spark, ("Taxi", "100"), ("Cab", "7")), 100)
    assert [r.content for r in second.collect()] == ["Cab, 花費: 7, ops, d"]
    third = expenses.save(spark, expense(spark, ("Taxi", "100")), 100)
    assert [r.content for r in third.collect()] == ["no data"]
    assert spark.table("ods.finance").count() == 4


def test_messages_hold_every_line_of_a_very_common_one(spark):
    lines = [("a",)] + [("b",)] * 5003 + [("c",)] * 2
    rows = spark.createDataFrame(lines, "line string")
    found = reports.messages(rows, [], "line", 2).orderBy("part").collect()
    assert [r.part for r in found] == list(range(2503))
    whole = "\n".join(r.content for r in found).split("\n")
    assert whole == ["a"] + ["b"] * 5003 + ["c"] * 2


def test_sales_message_without_sales(spark):
    counts = spark.createDataFrame([], "name string, ticket_name string, counts bigint")
    row = reports.sales_message(
        counts, 2024, "https://d.example.org/1", "2024-05-01", lines_per_message=10
    ).first()
    assert row.content.startswith("Tickets sold up to 2024-05-01\n")
    assert row.content.endswith("0 tickets in all, worth TWD 0")


def test_numbering_is_dense_over_all_partitions(spark):
    values = spark.range(1000).select(F.format_string("v%04d", F.col("id")).alias("v"))
    found = number_in_order(values.repartition(7), ["v"]).orderBy("v").collect()
    assert [r.start for r in found] == list(range(1000))


@pytest.mark.parametrize(
    "values, size, expected",
    [
        ("1234", 2, [["1", "2"], ["3", "4"]]),
        ("123", 2, [["1", "2"], ["3"]]),
        ("12", 10, [["1", "2"]]),
        ("", 5, []),
        ("abc", 1, [["a"], ["b"], ["c"]]),
    ],
)
def test_chunks(spark, values, size, expected):
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    chunks = labelling.chunk(rows, "v", size)
    prompts = labelling.batch_prompts(chunks, "v", "job_title", 8192).orderBy("batch")
    assert [r["items"] for r in prompts.collect()] == expected


def test_task_texts():
    assert "產業類別對照表" in labelling.task_text("organization")
    assert "職位類別對照表" in labelling.task_text("job_title")
    with pytest.raises(ValueError, match="不支援的工作類型"):
        labelling.task_text("unknown_type")


def test_labels_skip_failing_and_unreadable_batches(spark):
    rows = [(v, datetime(2024, 1, 31, 12)) for v in "abcdef"] + [("old", datetime(2020, 1, 1))]
    source = spark.createDataFrame(rows, "organization string, update_time timestamp")

    def labeller(prompt, items):
        assert prompt.endswith(json.dumps(items))
        if "a" in items:
            raise TimeoutError("late")
        if "c" in items:
            return "```json not json```"
        if "f" in items:
            return None
        return "```json" + json.dumps([{"organization": i, "category": "6"} for i in items]) + "```"

    labels, failed, left_out = profiles.label_values(
        source, "organization", labeller, 2, 8192, AS_OF, parallel=3
    )
    assert labels.collect() == [] and left_out.collect() == []
    assert sorted((r.batch, r.error) for r in failed.collect()) == [
        (0, "TimeoutError: late"),
        (1, "unreadable reply"),
        (2, "empty reply"),
    ]

    def forgetful(prompt, items):
        rows = [{"organization": i, "category": "6"} for i in items if i != "b"]
        return "```json" + json.dumps(rows) + "```"

    labels, failed, left_out = profiles.label_values(source, "organization", forgetful, 4, 8192, AS_OF)
    assert sorted(map(tuple, labels.collect())) == [(v, 6) for v in "acdef"]
    assert [tuple(r) for r in left_out.collect()] == [(0, "b")]
    assert profiles.save_labels(spark, labels, "organization") == 5
    assert profiles.save_labels(spark, labels.limit(0), "organization") == 0
    bad = spark.createDataFrame([(0, '```json[{"organization":"x","category":"six"}]```', None)],
                                "batch bigint, reply string, error string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        labelling.labels(bad, "organization").collect()


WIDE = "paid_date string, email string, organization string, job_title string, country_or_region string, age_range string, gender string"


def wide(spark, *rows):
    return spark.createDataFrame([(d, e, o, None, None, None, None) for d, e, o in rows], WIDE)


def test_profiles_are_upserted(spark):
    folder = scratch(spark, "profiles")
    one = wide(spark, ("2023-05-01", "a", "A"), ("2023-05-01", None, "N"), (None, "x", "X"))
    profiles.refresh(spark, [one], folder, "2024-01-01 00:00:00")
    two = wide(spark, ("2023-07-01", "a", None), ("2024-07-01", "a", "A2"), ("2023-05-01", None, "N"))
    profiles.refresh(spark, [two], folder, AS_OF)
    found = spark.table(profiles.TABLE).select(
        "year", "email", "organization", F.month("update_time")
    )
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(2023, "a", None, 2), (2024, "a", "A2", 2), (2023, None, "N", 1), (2023, None, "N", 2)],
        key=str,
    )


def test_two_source_rows_for_one_profile_fail(spark):
    schema = schemas.USER_PROFILE
    target = spark.createDataFrame([(2023, "a", *[None] * 5, datetime(2024, 1, 1))], schema)
    twice = profiles.profile_rows([wide(spark, ("2023-01-01", "a", "A"), ("2023-02-01", "a", "B"))])
    with pytest.raises(Exception, match="several source rows"):
        profiles.upsert_profiles(target, twice, AS_OF).collect()
    fresh = twice.withColumn("email", F.lit("new"))
    assert profiles.upsert_profiles(target, fresh, AS_OF).count() == 3


def test_joins_with_missing_keys(spark):
    left = spark.createDataFrame([(1, "x"), (None, "y"), (1, "z")], "k int, a string")
    right = spark.createDataFrame([(1, "b1"), (None, "b2"), (None, "b3")], "k int, b string")
    joined = joins.left_join_orders(left, right, "k")
    assert sorted((r.a, r.b) for r in joined.collect()) == [
        ("x", "b1"),
        ("y", "b2"),
        ("y", "b3"),
        ("z", "b1"),
    ]
    same = spark.createDataFrame([(None, "y"), (2, "q"), (2, "q")], "k int, a string")
    only = joins.left_only_rows(same, left)
    assert sorted(map(tuple, only.collect())) == [(2, "q"), (2, "q")]


def test_required_values_are_enforced(spark):
    schema = T.StructType().add("id", "long", False).add("v", "string", True)
    rows = spark.createDataFrame([(1, None), (None, "x")], "id long, v string")
    tables.create_table(spark, "ods.required", schema)
    with pytest.raises(Exception, match="required value id is missing"):
        tables.append(rows, "ods.required", schema)
    assert tables.append(rows.where("id = 1"), "ods.required", schema) == 1


def test_a_partitioned_table_takes_rows_by_name(spark):
    schema = T.StructType().add("year", "long", False).add("v", "string", False)
    tables.create_table(spark, "ods.by_year", schema, partition_by=["year"])
    rows = spark.createDataFrame([("a", 2023), ("b", 2024)], "v string, year long")
    tables.append(rows, "ods.by_year", schema)
    found = spark.table("ods.by_year").where("year = 2024")
    assert [r.v for r in found.collect()] == ["b"]


def test_a_failed_replacement_leaves_the_table(spark):
    tables.create_table(spark, "ods.kept", T.StructType().add("v", "string"))
    tables.append_evolving(spark.createDataFrame([("1",), ("x",)], "v string"), "ods.kept")
    broken = spark.table("ods.kept").withColumn("v", F.col("v").cast("int").cast("string"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.replace_table(spark, "ods.kept", broken, scratch(spark, "kept"))
    assert spark.table("ods.kept").count() == 2


def test_evolving_table_and_dry_run(spark):
    tables.append_evolving(spark.createDataFrame([(1,)], "a int"), "ods.evolve")
    tables.append_evolving(spark.createDataFrame([("b", 7)], "b string, vat_number int"), "ods.evolve")
    rows = sorted(map(tuple, spark.table("ods.evolve").collect()), key=str)
    assert rows == [(1, None, None), (None, "b", "7")]
    assert dict(spark.table("ods.evolve").dtypes)["vat_number"] == "string"
    path = scratch(spark, "preview")
    shown = tables.preview(spark.range(9), path)
    assert (shown.count(), spark.read.json(path).count()) == (5, 9)
    assert tables.column_changes(["A b"], ["a_b"]) == {"as_is": ["A b"], "to_be": ["a_b"]}


def test_table_names():
    assert tables.table_name("ods", "q", "ip", "datetime") == "ods.ods_q_ip_datetime"
    named = tables.table_name("dim", "q", "id", "year", prod=False, contributor="me")
    assert named == "test.test_me_q_id_year"


def test_filters(spark):
    assert filters.parse_update_after("2023-01-01 09:15:32") == (2023, 1672564532.0)
    flags = spark.createDataFrame([(True,), (False,), (None,)], "f boolean")
    assert filters.paid_only(flags, F.col("f")).count() == 1
    assert flags.where(filters.is_live(F.col("f"))).count() == 2
    ids = spark.createDataFrame([("9",), ("10",)], "id string")
    assert [r.id for r in ids.where(filters.newer_id(F.col("id"), "5")).collect()] == ["9"]


def tweet(rest_id, text):
    result = {"rest_id": rest_id, "legacy": {"full_text": text}}
    entry = {"content": {"itemContent": {"tweet_results": {"result": result}}}}
    timeline = {"instructions": [{}, {"entries": [entry]}]}
    return {"data": {"user": {"result": {"timeline_v2": {"timeline": timeline}}}}}


def test_tweet_notices(spark):
    lines = [json.dumps(r) for r in (tweet("12", "old"), tweet("13", "n\new"), {"error": 1})]
    replies = spark.createDataFrame([(line,) for line in lines], "value string")
    state = spark.createDataFrame([("12",)], "rest_id string")
    found = {r.content for r in notices.tweet_notices(replies, state, "conf").collect()}
    assert found == {
        "new twitter post: https://twitter.com/conf/status/13\n\nn\new",
        '{"error": 1}',
    }
    assert notices.newest_state(replies, state).first().rest_id == "13"
    empty = state.limit(0)
    assert notices.tweet_notices(replies, empty, "conf").count() == 3
    where = scratch(spark, "tweet-state")
    assert notices.save_tweet_notices(spark, replies, "conf", where).count() == 3
    assert notices.save_tweet_notices(spark, replies, "conf", where).count() == 1
    assert spark.table(notices.STATE).first().rest_id == "13"


def test_outbox(spark):
    outbox = spark.createDataFrame(
        [(None,), ("{}",), ('{"username": "u"}',), ('{"webhook_endpoint_key": "k"}',)], "extra string"
    )
    assert [r.problem for r in notices.check_outbox(outbox).collect()] == [
        "extra is empty",
        "extra is empty",
        "webhook_endpoint_key is missing",
        None,
    ]
