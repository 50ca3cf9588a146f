"""Loads hash a payload once, and read it no oftener than their steps need."""

import json

from conftest import payload
from test_once import SMOKE, plan_of
from test_state import Landing
from test_tickets import ids, raw

from ticketmart.checks import derive, tickets
from ticketmart.checks.registry import tasks_for
from ticketmart.operators.pii import deidentify
from ticketmart.plans import tickets as plan
from ticketmart.sinks import tables


def test_repeated_loads_hash_payloads_once(spark, monkeypatch):
    loaded, append = [], tables.append

    def noted(rows, *more):
        loaded.append(plan_of(rows))
        return append(rows, *more)

    monkeypatch.setattr(tables, "append", noted)
    assert tickets.repeated_load_deduped(spark, SMOKE).count() == 1500
    assert len(loaded) == 2
    assert not any("sha2" in text for text in loaded)


def test_an_answer_is_read_once_to_be_hashed(spark):
    rows = spark.createDataFrame([('{"data":[["Address","a"]]}',)], "attendee_info string")
    assert plan_of(deidentify(rows)).count("$[1], StringType") == 1


def test_hashing_of_large_tables_is_spread(spark):
    assert tasks_for(spark.range(10), derive.PAYLOADS) == 16
    assert tasks_for(spark.range(2_000_001), derive.PAYLOADS) == 21


def test_a_load_run_twice_hashes_payloads_once(spark, monkeypatch):
    loaded, load = [], plan.load_orders

    def noted(spark, orders, *more):
        loaded.append(plan_of(orders))
        return load(spark, orders, *more)

    monkeypatch.setattr(plan, "load_orders", noted)
    assert tickets.loaded_twice_deduped(spark, SMOKE).where("copies = 1").count() == 1500
    assert len(loaded) == 2
    assert not any("sha2" in text for text in loaded)


def test_stored_times_are_not_read_from_payloads(spark):
    orders = plan.raw_rows(plan.order_rows(raw(spark, payload(id=1), payload(id=2, updated_at=None), payload(id=3, updated_at="x"))))
    held, _ = plan.held_rows(spark, orders)
    timed, undated = plan.split_timed(held)
    assert "get_json_object" not in plan_of(timed) + plan_of(undated)
    assert (ids(timed), ids(undated)) == ([1], [2, 3])


def test_rejects_parse_a_payload_once(spark):
    rows = raw(spark, payload(), payload(reg_no="A-1"), payload(reg_no="7", price="free"), payload(price=" "))
    rejects = plan.wide_rejects(rows)
    assert plan_of(rejects).count("from_json") == 1
    assert sorted(row.reason for row in rejects.collect()) == [
        "price is no number",
        "registration number is no number",
    ]


def test_a_batch_reads_landed_replies_once(spark, monkeypatch):
    seen, sort_out = [], plan.sort_out

    def noted(events, attendees):
        seen.append((attendees.inputFiles(), attendees.collect()))
        return sort_out(events, attendees)

    monkeypatch.setattr(plan, "sort_out", noted)
    landing = Landing(spark)
    landing.attend(1)
    landing.attend(2, time=500.0)
    landing.attend(3, is_paid=False)
    landing.attend(4, time=None)
    landing.attend(5, event=7)
    landing.put("attendees", {"event_id": None, "attendee_info": payload(id=6)})
    landing.run(0.0, 100.0)
    ((files, rows),) = seen
    assert files and all(name.endswith(".parquet") for name in files)
    assert sorted(json.loads(row.attendee_info)["id"] for row in rows) == [1, 4, 5, 6]
    assert ids(landing.output("orders")) == [1]
    assert ids(landing.output("rejected")) == [4, 6]
    assert ids(landing.output("waiting")) == [5]
