"""State that jobs keep: waiting attendees, stored orders, partitions and current rows."""

import json

import pytest
from conftest import EVENT, payload
from pyspark.sql import functions as F
from test_tickets import ids, raw

from ticketmart import schemas
from ticketmart.config import exists, scratch
from ticketmart.plans import tickets as plan
from ticketmart.plans.current import keep_current
from ticketmart.sinks import tables
from ticketmart.streaming import ingest

LATE = {"data": [{"id": 7, "name": "Conf 2022 registration reserved"}]}


class Landing:
    def __init__(self, spark):
        self.spark = spark
        self.folder, self.out = scratch(spark, "landing"), scratch(spark, "out")
        self.put("events", {"data": [{"id": EVENT[0], "name": EVENT[1]}]})

    def put(self, kind, *replies):
        rows = [(json.dumps(reply, ensure_ascii=False),) for reply in replies]
        frame = self.spark.createDataFrame(rows, "value string")
        frame.write.mode("append").text(f"{self.folder}/{kind}")

    def attend(self, *numbers, event=EVENT[0], time=50.0, **changes):
        infos = [payload(id=n, reg_no=n, updated_at=time, **changes) for n in numbers]
        self.put("attendees", *[{"event_id": event, "attendee_info": info} for info in infos])

    def run(self, start, end, year=2022, **more):
        ingest.ingest_tickets(self.spark, self.folder, self.out, year, start, end, **more)

    def output(self, name):
        return ingest.read_output(self.spark, self.out, name, evolving=True)


def test_waiting_attendees_are_judged_by_their_own_run(spark):
    landing = Landing(spark)
    landing.attend(1, event=7)
    landing.attend(2, event=7, time=150.0)  # not asked for by the run it lands in
    landing.attend(3, event=7, is_paid=False)
    landing.attend(4)
    landing.run(0.0, 100.0)
    waiting = landing.output("waiting").collect()
    assert [(json.loads(r.attendee_info)["id"], r.run_start, r.run_end, r.run_year) for r in waiting] == [
        (1, 0.0, 100.0, 2022)
    ]
    landing.attend(5, event=7, time=150.0)
    landing.run(100.0, 200.0, year=2023)  # 5 waits for an event of another year
    landing.put("events", LATE)
    landing.attend(6, event=7, time=250.0)
    landing.run(200.0, 300.0)
    assert ids(landing.output("orders")) == [1, 4, 6]
    assert sorted(r.registration_no for r in landing.output("wide_reserved").collect()) == [1, 6]
    last = landing.output("waiting").where("batch_id = 2")
    assert last.count() == 0 and landing.output("rejected").count() == 0


def test_orders_that_land_again_are_stored_once(spark):
    landing = Landing(spark)
    landing.attend(1, 1, 2)
    landing.run(0.0, 100.0, current="dwd.streamed_again")
    landing.attend(1, 3)
    landing.attend(2, time=60.0)  # a later state of 2
    landing.run(0.0, 100.0, current="dwd.streamed_again")
    landing.attend(2, time=60.0)
    landing.attend(3)
    landing.run(0.0, 100.0, current="dwd.streamed_again")
    orders = landing.output("orders")
    found = [(json.loads(r.attendee_info)["id"], json.loads(r.attendee_info)["updated_at"]) for r in orders.collect()]
    assert sorted(found) == [(1, 50.0), (2, 50.0), (2, 60.0), (3, 50.0)]
    current = spark.table("dwd.streamed_again_individual")
    rows = current.select("event_id", "registration_no", "updated_at").collect()
    assert sorted(map(tuple, rows)) == [(5150, 1, 50.0), (5150, 2, 60.0), (5150, 3, 50.0)]


def partitioned(spark, table):
    schema = schemas._table(("a", "long", True), ("b", "string", False), ("p", "integer", False))
    tables.create_table(spark, table, schema, partition_by=["p"])
    rows = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (3, "z", 3), (4, "n", None)], schema)
    tables.append(rows, table, schema)
    return schema


def rows_of(spark, table):
    return sorted(map(tuple, spark.table(table).collect()), key=str)


def test_a_swap_that_fails_leaves_every_partition_readable(spark, monkeypatch):
    table = "dwd.swapped"
    schema = partitioned(spark, table)
    files = spark.table(table).where("p = 3").inputFiles()
    point = tables.point_partition
    calls = []

    def breaks(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost between two partitions")
        point(*args)

    doubled = spark.table(table).where("p < 3 OR p IS NULL").withColumn("b", F.concat("b", "b"))
    monkeypatch.setattr(tables, "point_partition", breaks)
    with pytest.raises(RuntimeError, match="between"):
        tables.replace_partitions(spark, table, doubled)
    now = rows_of(spark, table)
    assert [len(row[1]) for row in now].count(2) == 1 and len(now) == 4  # one is new, all are there
    monkeypatch.undo()
    again = spark.table(table).where("p <> 3").withColumn("b", F.upper(F.substr("b", F.lit(1), F.lit(1))))
    fresh = again.unionByName(spark.createDataFrame([(5, "q'", 5)], again.schema))
    tables.replace_partitions(spark, table, fresh)
    assert rows_of(spark, table) == [(1, "X", 1), (2, "Y", 2), (3, "z", 3), (4, "n", None), (5, "q'", 5)]
    assert spark.table(table).where("p = 3").inputFiles() == files
    tables.append(spark.createDataFrame([(6, "r", 1)], schema), table, schema)
    assert [r.a for r in spark.table(table).where("p = 1").orderBy("a").collect()] == [1, 6]


def test_retired_folders_are_removed_when_told(spark):
    table = "dwd.retired"
    partitioned(spark, table)
    assert tables.remove_retired(spark, table, "2100-01-01") == []
    old = tables.replace_partitions(spark, table, spark.table(table).where("p = 1"))
    assert sorted(r.path for r in tables.retired(spark, table).collect()) == sorted(old)
    assert len(old) == 1 and exists(spark, old[0])
    assert tables.remove_retired(spark, table, "2000-01-01") == []
    assert tables.remove_retired(spark, table, "2100-01-01") == old
    assert not exists(spark, old[0]) and len(rows_of(spark, table)) == 4
    assert tables.remove_retired(spark, table, "2100-01-01") == []


def test_one_load_keeps_the_same_number_of_two_events(spark):
    orders = plan.order_rows(
        raw(spark, payload()).unionByName(raw(spark, payload(), event=(9, "Conf 2023 individual")))
    )
    loaded = plan.load_orders(spark, orders, "ods.orders_two", "dwd.wide_two", current=True)
    assert loaded["dwd.wide_two_individual"] == 2
    assert spark.table("dwd.wide_two_individual_current").count() == 2


def test_current_rows_kept_by_load_equal_those_ranked_at_once(spark):
    prefix = "dwd.wide_current"
    loads = [
        [payload(id=1, reg_no=1, updated_at=10.0), payload(id=2, reg_no=2, updated_at=10.0)],
        [payload(id=3, reg_no=1, updated_at=30.0, data=[["New one", "a"]])],
        [payload(id=4, reg_no=1, updated_at=20.0), payload(id=5, reg_no=3, updated_at=10.0)],
        [payload(id=4, reg_no=1, updated_at=20.0)],
    ]
    for place, load in enumerate(loads):
        events = [EVENT] if place < 2 else [EVENT, (9, "Conf 2023 individual")]
        for event in events:
            orders = plan.order_rows(raw(spark, *load, event=event))
            plan.load_orders(spark, orders, "ods.orders_current", prefix, current=True)
    table = f"{prefix}_individual"
    kept = spark.table(f"{table}_current")
    ranked = plan.current_rows(spark.table(table))
    names = sorted(ranked.columns)
    assert sorted(map(str, kept.select(names).collect())) == sorted(map(str, ranked.select(names).collect()))
    assert kept.count() == 5 and kept.where("new_one = 'a'").count() == 1
    untouched = kept.where(f"event_id = {EVENT[0]}").inputFiles()
    keep_current(spark, ranked.where("event_id = 9"), f"{table}_current")
    after = spark.table(f"{table}_current")
    assert after.where(f"event_id = {EVENT[0]}").inputFiles() == untouched and after.count() == 5


@pytest.mark.parametrize(
    ("year", "kind"),
    [(2022, "individual"), (2023, "reserved"), ("2022", "indiv"), (2024, "reserved"), ("", "corporate")],
)
def test_orders_of_reads_only_folders_that_can_hold_them(spark, year, kind):
    names = [
        (1, "Conf 2022 Registration: Individual"),
        (2, "2023 after 2022 reserved"),
        (3, "Conf 2023 reserved individual"),
        (4, "no year, CORPORATE"),
        (5, "Conf 12022024 reserved"),  # years that overlap
        (6, "Conf 2022 forced"),
    ]
    table = "ods.orders_pruned"
    if not spark.catalog.tableExists(table):
        for event in names:
            orders = plan.order_rows(raw(spark, payload(id=event[0]), event=event))
            group = "individual" if event[0] == 6 else None
            plan.load_orders(spark, orders, table, "dwd.wide_pruned", group=group)
    orders = spark.table(table)
    found = plan.orders_of(orders, year, kind)
    plain = orders.select("id", "name", "attendee_info", "refunded")
    assert ids(found) == ids(plan.orders_of(plain, year, kind))
    text = found._jdf.queryExecution().executedPlan().toString()
    used = text.split("PartitionFilters: [")[1].split("]")[0]
    assert ("year#" in used) == bool(year) and ("ticket_groups#" in used) == (kind != "indiv")
