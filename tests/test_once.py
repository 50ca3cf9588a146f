"""Costly expressions are evaluated once for a row, and only for rows that need them."""

from pyspark.sql import functions as F

from ticketmart.checks import derive, tickets
from ticketmart.operators.pii import deidentify, readable
from ticketmart.plans import tickets as plan

SMOKE = "/root/testdata/sf0.001"


def plan_of(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_a_filter_does_not_write_the_payload_anew(spark):
    rows = derive.attendees(spark, SMOKE).where(readable())
    assert "jsonObjectKeys(attendee_info#" in plan_of(rows)


def test_hashing_reads_pairs_by_path(spark):
    rows = spark.createDataFrame([('{"data":[["聯絡人 姓名",2600.0,{"a":1}],["b",null],["Address"]],"id":1}',)], "attendee_info string")
    hashed = deidentify(rows)
    assert plan_of(hashed).count("array<variant>") <= 6
    digest = spark.range(1).select(F.sha2(F.lit("2600.0"), 256)).first()[0]
    assert hashed.first()[0] == (
        f'{{"data":[["聯絡人 姓名","{digest}",{{"a":1}}],["b",null],["Address"]],"id":1}}'
    )


def test_attendees_are_taken_without_a_join(spark):
    rows = spark.createDataFrame(
        [(1, '{"id":1,"updated_at":1.0}'), (None, '{"id":2,"updated_at":1.0}'), (1, '{"id":'), (1, '{"id":4}')],
        "event_id long, attendee_info string",
    )
    taken = plan.takeable(rows)
    assert [row.attendee_info for row in taken.collect()] == ['{"id":1,"updated_at":1.0}']
    assert "Join LeftAnti, ((event_id" not in plan_of(tickets.ticket_rejects(spark, SMOKE))


def test_targets_are_named_for_distinct_questions(spark):
    text = plan_of(tickets.canonical_sets(spark, SMOKE))
    assert "found" in text and text.count("Aggregate [") >= 3


def test_orders_are_parsed_once_for_a_wide_table(spark):
    rows = spark.createDataFrame([(1, '{"id":1,"reg_no":"2"}')], "id long, attendee_info string")
    assert plan_of(plan.wide_records(rows)).count("from_json") == 1


def test_larger_tables_have_more_tasks(spark):
    from ticketmart.checks import registry

    assert registry.tasks_for(spark.range(10)) == registry.TASKS
    assert registry.tasks_for(spark.range(20_000_001)) == 41
