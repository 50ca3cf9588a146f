"""A key that holds a third of all rows must not end in one task."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ticketmart import schemas
from ticketmart.operators import dedupe, joins
from ticketmart.plans import profiles
from ticketmart.sources import tickets as landed


@pytest.fixture()
def adaptive(spark):
    """Thresholds low enough that the skew of small test data is one."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key in settings:
        spark.conf.unset(key)


def final_plan(rows):
    count = len(rows.collect())
    return count, rows._jdf.queryExecution().executedPlan().toString()


def hot(spark, rows=60000):
    """Every third row has key 0."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    return spark.range(0, rows, 1, 16).select(
        key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )


def test_left_join_splits_a_hot_order(adaptive):
    orders = adaptive.range(0, 30000).select(F.col("id").alias("k"), F.lit("o").alias("o"))
    count, plan = final_plan(joins.left_join_orders(hot(adaptive), orders, "k"))
    assert count == 60000
    assert "skew=true" in plan


def test_left_only_rows_split_a_hot_group_of_copies(adaptive):
    left = hot(adaptive).withColumn("v", F.when(F.col("k") == 0, "copy").otherwise(F.col("v")))
    right = left.where("k % 2 = 1")
    count, plan = final_plan(joins.left_only_rows(left, right))
    assert count == 20000 + sum(1 for i in range(60000) if i % 3 and i % 2 == 0)
    # equal rows compress too well to be skew here, but both sides can be split
    assert plan.split("Initial Plan")[0].count("Exchange hashpartitioning(coalesce(") == 2


def test_refund_update_splits_a_hot_attendee(adaptive):
    orders = hot(adaptive).withColumn("refunded", F.lit(False))
    gone = adaptive.range(0, 20000).select(F.col("id").alias("attendee_id"))
    marked = joins.mark_refunded(orders, gone, F.col("k"))
    assert marked.columns == ["k", "v", "refunded"]
    count, plan = final_plan(marked)
    assert count == 60000
    assert "skew=true" in plan


def test_upsert_splits_a_hot_profile(adaptive):
    target = hot(adaptive).select(
        F.lit(2023).cast("long").alias("year"),
        F.concat(F.lit("mail"), F.col("k").cast("string")).alias("email"),
        *[F.col("v").alias(name) for name in profiles.ATTRIBUTES],
        F.lit(datetime(2020, 1, 1)).alias("update_time"),
    )
    source = (
        target.where("email <> 'mail0'").select("year", "email", *profiles.ATTRIBUTES)
    ).unionByName(
        target.limit(1).select(
            "year", F.lit("mail0").alias("email"), *profiles.ATTRIBUTES
        )
    )
    merged = profiles.upsert_profiles(target, source, "2024-01-01 00:00:00")
    assert merged.columns == schemas.USER_PROFILE.names
    count, plan = final_plan(merged)
    assert count == 60000
    assert "skew=true" in plan


def test_tickets_split_a_hot_event(adaptive):
    attendees = hot(adaptive).select(
        F.col("k").alias("event_id"), F.col("v").alias("attendee_info")
    )
    replies = adaptive.range(0, 60000).select(
        F.array(F.struct("id", F.lit("n").alias("name"))).alias("data")
    )
    count, plan = final_plan(landed.tickets(landed.events(replies), attendees))
    assert count == 60000
    assert "skew=true" in plan


def test_latest_row_trims_a_hot_key_before_the_shuffle(spark):
    rows = dedupe.latest_per_key(hot(spark), ["k"], [F.desc("v")])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert rows.count() == 40001
