import json

import pytest
from conftest import EVENT, PAIRS, payload
from pyspark.sql import functions as F

from ticketmart import schemas
from ticketmart.config import scratch
from ticketmart.operators import pii, reshape
from ticketmart.plans import answers
from ticketmart.plans import tickets as plan
from ticketmart.sinks import tables
from ticketmart.sources import tickets as landed
from ticketmart.streaming import ingest

HASHES = {
    "聯絡人 姓名": "2150750f32ee8dcd40537be8b5bee7c26e893a77cb23049eb3a0ca49a7512791",
    "聯絡人 Email": "26a695fcd9d98ffa1fba78cb5a1eacf0fbe19e40bf9de0cafa0080cdf4c14514",
    "聯絡人 手機": "86f3abfffd2f714a6d611429f82fac9264e8036b0fb490320bfe3e56c494a0e0",
    PAIRS[4][0]: "36190b79eb7396cfb91e413fecef9707bca87f32012fb01fc38caa236fb053d0",
    PAIRS[3][0]: "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855",
}
EXPECTED_HASHED = [[question, HASHES.get(question, answer)] for question, answer in PAIRS]


def raw(spark, *payloads, event=EVENT):
    rows = [(*event, json.dumps(p, ensure_ascii=False)) for p in payloads]
    return spark.createDataFrame(rows, "id bigint, name string, attendee_info string")


def test_deidentified_payload_keeps_everything_else(spark):
    source = payload(novel={"nested": [1, 2.5, None]}, flag=True)
    row = plan.order_rows(raw(spark, source)).first()
    expected = {key: value for key, value in source.items() if key != "search_string"}
    expected["data"] = EXPECTED_HASHED
    assert json.loads(row.attendee_info) == expected
    assert (row.id, row.name, row.refunded) == (*EVENT, False)
    assert "暱稱" in row.attendee_info


def test_answers_are_hashed_as_their_python_text(spark):
    pairs = [["聯絡人 手機", None], ["聯絡人 姓名", True], ["Address", 7], ["n", 7]]
    row = plan.order_rows(raw(spark, payload(data=pairs))).first()
    digest = lambda text: spark.range(1).select(F.sha2(F.lit(text), 256)).first()[0]
    assert json.loads(row.attendee_info)["data"] == [
        ["聯絡人 手機", digest("None")],
        ["聯絡人 姓名", digest("True")],
        ["Address", digest("7")],
        ["n", 7],
    ]


def test_hash_sensitive_on_pairs(spark):
    pairs = spark.createDataFrame([(PAIRS,)], "pairs array<array<string>>")
    assert pairs.select(pii.hash_sensitive(F.col("pairs"))).first()[0] == EXPECTED_HASHED


def test_extract_sensitive_takes_exact_keys_and_the_last_answer(spark):
    pairs = PAIRS + [["聯絡人 Email", "second@example.org"]]
    row = plan.sensitive_answers(raw(spark, payload(data=pairs))).first()
    assert row.answers == {
        "聯絡人 姓名": "李xx",
        "聯絡人 Email": "second@example.org",
        "聯絡人 手機": "0900000000",
    }


def test_wide_row_of_the_sample_payload(spark):
    wide = plan.wide_rows(plan.order_rows(raw(spark, payload())))
    assert set(wide.columns) == {
        "registration_no",
        "ticket_type",
        "qrcode",
        "payment_status",
        "price",
        "payment_method",
        "updated_at",
        "paid_date",
        "gender",
        "size_of_tshirt",
        "country_or_region",
        "age_range",
        "job_title",
        "organization",
        "years_of_using_python",
        "area_of_interest",
        "email_from_sponsor",
        "which_hall_do_you_like_best",
        "do_you_bring_a_friend",
        "email",
    }
    row = wide.first()
    assert row.registration_no == 321
    assert row.paid_date == "2022-08-08"
    assert row.payment_status == "paid"
    assert row.organization == "Example Ltd"
    assert row.country_or_region == "Utopia"
    assert row.price == 1800.0


def test_wide_rows_merge_drifting_questions_and_keep_the_latest(spark):
    def one(reg_no, time, **answers):
        return payload(id=time, reg_no=reg_no, updated_at=float(time), data=list(answers.items()))

    records = [
        one(1, 100, **{"Dietary Habit / 餐點偏好": "old", "Come From / 國家或地區": "TW"}),
        one(1, 200, **{"Dietary Preference / 飲食偏好": "new", "Come From / 國家或地區": "null"}),
        one(2, 150, **{"Dietary Habit / 餐點偏好": "", "Dietary Preference / 飲食偏好": "x"}),
        one(None, 10, **{"Where are you from? / 來自國家、地區或縣市": "JP"}),
        one(None, 20, **{"Come From / 國家或地區": "null", "來自國家、地區或縣市": "KR"}),
    ]
    wide = plan.wide_rows(raw(spark, *records))
    rows = {r.registration_no: r for r in wide.collect()}
    assert len(rows) == 3
    assert (rows[1].dietary_habit, rows[1].country_or_region) == ("new", None)
    assert rows[2].dietary_habit == ""
    assert rows[None].country_or_region == "KR"


def test_repeated_question_keeps_the_last_answer(spark):
    pairs = [["Come From / 國家或地區", "first"], ["Come From / 國家或地區", "last"]]
    wide = plan.wide_rows(raw(spark, payload(data=pairs)))
    assert wide.first().country_or_region == "last"


def test_questions_beyond_the_columns_follow_the_rules_of_names(spark):
    def one(reg_no, *data, **more):
        return payload(id=reg_no, reg_no=reg_no, updated_at=float(reg_no), data=[*data], **more)

    records = [
        one(1, ["Q one", "a"], ["Q two", "b"], ["Dietary Habit / 餐點偏好", "meat"]),
        one(2, ["Dietary Preference / 飲食偏好", "fish"], ["q  ONE?", "c"], ["Nickname / 暱稱", "Robin"]),
        one(3, ["Come From / 國家或地區", "null"], ["來自國家、地區或縣市", "KR"], ["Invoice Policy", " 5 "]),
        one(4, ["New here?", "null"], ["new HERE", "yes"], ["Rare", None], ["Nickname", "Ann"]),
    ]
    whole = {r.registration_no: r for r in plan.wide_rows(raw(spark, *records)).collect()}
    form = ["Q one", "Q two", "Come From / 國家或地區", "Invoice Policy"]
    given = plan.wide_rows(raw(spark, *records), questions=form)
    rows = {r.registration_no: r.asDict() for r in given.collect()}
    assert "nickname" not in given.columns and "q_two" in given.columns
    assert (rows[2]["other_answers"], rows[2]["q_one"]) == ({"dietary_habit": "fish"}, "c")
    assert (rows[3]["country_or_region"], rows[3]["invoice_policy"]) == ("KR", 5.0)
    assert rows[4]["other_answers"] == {"new_here": "yes", "rare": None}
    for number, row in rows.items():
        other = row.pop("other_answers")
        expected = {k: v for k, v in whole[number].asDict().items()}
        assert {**{k: None for k in expected}, **row, **other} == expected


def test_many_questions_change_neither_schema_nor_types(spark):
    """3,000 names give what 30 give, with a number and a private name among the last."""

    def tables(count):
        last = [["Invoice Policy", " 7 "], ["Nickname", "Ann"], ["來自國家、地區或縣市", "KR"]]
        asked = [[f"Question {i}", str(i)] for i in range(count)]
        return plan.wide_rows(raw(spark, payload(data=[*asked[:9], *asked[9:], *last])))

    few, many = tables(30), tables(3000)
    kinds = dict(many.dtypes)
    assert [name for name, _ in few.dtypes if name in kinds] == few.columns
    assert all(kinds[name] == kind for name, kind in few.dtypes)
    assert set(many.columns) - set(few.columns) == {f"question_{i}" for i in range(30, 3000)}
    row = many.first()
    assert (row.question_2999, row.invoice_policy, row.country_or_region) == ("2999", 7.0, "KR")


def test_encoded_answers_are_those_of_the_wide_table(spark):
    def one(reg_no, *data, **more):
        return payload(id=reg_no, reg_no=reg_no, updated_at=float(reg_no), data=[*data], **more)

    records = [
        one(1, ["Q one", "a"], ["Q two", "b"], ["Dietary Habit / 餐點偏好", "meat"]),
        one(2, ["Dietary Preference / 飲食偏好", "fish"], ["q  ONE?", "c"], ["Nickname / 暱稱", "Robin"]),
        one(3, ["Come From / 國家或地區", "null"], ["來自國家、地區或縣市", "KR"], {"k": "v"}, ["Q one", "z"]),
        one(4, ["new HERE", "yes"], ["New here?", "no"], ["Rare", None], campaign="spring"),
        payload(id=9, reg_no=1, updated_at=50.0, data=[["Q one", "later"], ["Q two", "d"]]),
    ]
    orders = raw(spark, *records)
    kept, found = answers.encoded_answers(orders)
    wide = plan.wide_rows(orders)
    known = [r.name for r in kept.orderBy("name_id").collect()]
    assert known == sorted(known) and "nickname" not in known and "campaign" in known
    view = {r.registration_no: r for r in answers.wide_view(kept, found, known).collect()}
    for row in wide.collect():
        assert [view[row.registration_no][name] for name in known] == [row[name] for name in known]
    many = [[f"Question {i}", str(i)] for i in range(3000)]
    more, values = answers.encoded_answers(raw(spark, payload(data=many)))
    assert (more.schema, values.schema) == (kept.schema, found.schema)
    assert (more.count(), values.count()) == (3000, 3000)
    assert answers.encoded_answers(orders.limit(0))[1].collect() == []


ODD = [["q", "a"], None, [], ["z"], {"k": "v"}, 5, "text", ["t", "a", "b"], [None, "x"], [7, 2600.5]]


def test_odd_pairs_lose_neither_the_load_nor_other_answers(spark):
    email = ["聯絡人 Email", "x@example.org"]
    records = [
        payload(id=1, reg_no=1, data=[*ODD, email, [email[0]], ["Invoice Policy", 1.5]]),
        payload(id=2, reg_no=2, data=[["q", "b"], [], None, ["z"]]),
        payload(id=3, reg_no=3, data={"k": "v"}),
        payload(id=4, reg_no=4, data=None),
        payload(id=5, reg_no=5, data=[["q", "c"], email]),
    ]
    orders = plan.order_rows(raw(spark, *records))
    rows = {r.registration_no: r for r in plan.wide_rows(orders, odd=True).collect()}
    assert [rows[i].q for i in range(1, 6)] == ["a", "b", None, None, "c"]
    assert (rows[1].t, rows[1]["7"], rows[1].invoice_policy, rows[1].z) == ("a", "2600.5", 1.5, None)
    found = [[json.loads(text) for text in rows[i].odd_answers or []] for i in range(1, 6)]
    assert found == [[*ODD[1:9], [email[0]]], [[], None, ["z"]], [{"k": "v"}], [], []]
    sensitive = plan.sensitive_answers(raw(spark, *records))
    assert [r.answers for r in sensitive.collect()] == [
        {email[0]: None}, {}, None, None, {email[0]: email[1]}
    ]
    given = plan.wide_rows(orders, questions=["q"]).collect()
    assert {r.registration_no: r.q for r in given}[1] == "a"
    assert plan.load_orders(spark, orders, "ods.orders_odd", "dwd.wide_odd") == {
        "ods.orders_odd": 5,
        "dwd.wide_odd_individual": 5,
    }
    pairs = spark.createDataFrame([([email, [email[0]], [], None],)], "pairs array<array<string>>")
    assert pairs.select(pii.hash_sensitive(F.col("pairs"))).first()[0][1:] == [[email[0]], [], None]
    required = reshape.missing_answers(F.col("pairs"), [email[0], "other"])
    assert pairs.select(required).first()[0] == ["other"]


def test_unknown_payload_fields_become_columns(spark):
    wide = plan.wide_rows(raw(spark, payload(data=[["q", "a"]], campaign="spring")))
    assert wide.first().campaign == "spring"


def test_update_after_and_undated_rows(spark):
    orders = raw(spark, payload(updated_at=100.0), payload(reg_no=5, updated_at=200.0))
    assert [r.registration_no for r in plan.wide_rows(orders, update_after=200.0).collect()] == [5]
    both = plan.wide_rows(orders, update_after=0)
    assert both.count() == 2
    good, aside = plan.split_timed(raw(spark, payload(), payload(updated_at=None)))
    assert (good.count(), aside.count()) == (1, 1)


def test_wide_plan_has_no_pivot_and_trims_before_the_shuffle(spark):
    wide = plan.wide_rows(raw(spark, payload()))
    text = wide._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1
    assert "WindowGroupLimit" in text and "Partial" in text


def land(spark, folder, payloads, run=0):
    events = {"data": [{"id": EVENT[0], "name": EVENT[1]}, {"id": 1, "name": "Meetup 2022"}]}
    if run == 0:
        spark.createDataFrame([(json.dumps(events),)], "value string").write.text(
            f"{folder}/events"
        )
    lines = [
        (json.dumps({"event_id": event, "attendee_info": info}, ensure_ascii=False),)
        for event, info in payloads
    ]
    spark.createDataFrame(lines, "value string").write.mode("append").text(f"{folder}/attendees")


LANDED = [
    (EVENT[0], payload(id=1, reg_no=1, updated_at=150.0)),
    (EVENT[0], payload(id=2, reg_no=2, updated_at=100.0)),
    (EVENT[0], payload(id=3, reg_no=3, updated_at=200.0)),
    (EVENT[0], payload(id=4, reg_no=4, updated_at=150.0, is_paid=False)),
    (1, payload(id=5, reg_no=5, updated_at=150.0)),
    (EVENT[0], payload(id=6, reg_no=6, updated_at=199.5)),
]


def batch_orders(spark, folder, **options):
    chosen = plan.selected_tickets(
        landed.read_events(spark, folder),
        landed.read_attendees(spark, folder),
        2022,
        100.0,
        200.0,
        **options,
    )
    return plan.order_rows(chosen)


def ids(orders):
    return sorted(json.loads(r.attendee_info)["id"] for r in orders.collect())


def test_selection_is_strict_at_both_ends_unless_told(spark):
    folder = scratch(spark, "landing")
    land(spark, folder, LANDED)
    assert ids(batch_orders(spark, folder)) == [1, 6]
    assert ids(batch_orders(spark, folder, closed="left")) == [1, 2, 6]


def test_stream_gives_what_the_batch_gives_and_nothing_twice(spark):
    folder, out = scratch(spark, "landing"), scratch(spark, "out")
    land(spark, folder, LANDED[:3])
    ingest.ingest_tickets(spark, folder, out, 2022, 100.0, 200.0)
    land(spark, folder, LANDED[3:], run=1)
    ingest.ingest_tickets(spark, folder, out, 2022, 100.0, 200.0)
    ingest.ingest_tickets(spark, folder, out, 2022, 100.0, 200.0)
    streamed = ingest.read_output(spark, out, "orders").drop("batch_id")
    batch = batch_orders(spark, folder)
    assert sorted(streamed.collect()) == sorted(batch.collect())
    wide = ingest.read_output(spark, out, "wide_individual", evolving=True)
    assert sorted(r.registration_no for r in wide.collect()) == [1, 6]


def test_stream_loses_no_ticket_whose_event_comes_last_or_whose_number_is_none(spark):
    folder, out = scratch(spark, "landing"), scratch(spark, "out")

    def put(kind, *replies):
        rows = [(json.dumps(reply),) for reply in replies]
        spark.createDataFrame(rows, "value string").write.mode("append").text(f"{folder}/{kind}")

    def one(number, **changes):
        info = payload(id=number, reg_no=number, updated_at=150.0, **changes)
        return {"event_id": EVENT[0] if number < 9 else 77, "attendee_info": info}

    put("events", {"data": [{"id": 1, "name": "Meetup 2022"}]})
    put("attendees", one(1), one(2, price="free"), one(9))
    # progress of an earlier version, which read attendees alone, is carried on
    only = spark.readStream.schema(landed.ATTENDEES).json(f"{folder}/attendees")
    ingest.run_available(only, lambda rows, _, store: store("waiting", rows), out)
    put("events", {"data": [{"id": EVENT[0], "name": EVENT[1]}]})
    for _ in range(2):
        ingest.ingest_tickets(spark, folder, out, 2022, 100.0, 200.0)
    assert ids(ingest.read_output(spark, out, "orders")) == [1, 2]
    put("events", {"data": [{"id": 77, "name": EVENT[1]}]})
    for _ in range(2):
        ingest.ingest_tickets(spark, folder, out, 2022, 100.0, 200.0)
    assert ids(ingest.read_output(spark, out, "orders")) == [1, 2, 9]
    wide = ingest.read_output(spark, out, "wide_individual", evolving=True)
    assert sorted(r.registration_no for r in wide.collect()) == [1, 9]
    rejects = ingest.read_output(spark, out, "wide_rejected")
    assert [r.reason for r in rejects.collect()] == ["price is no number"] and ids(rejects) == [2]
    assert ingest.read_output(spark, out, "rejected").count() == 0


def test_a_repeated_batch_has_its_effect_once(spark):
    folder, out = scratch(spark, "landing"), scratch(spark, "out")
    land(spark, folder, LANDED)
    stream = lambda: spark.readStream.schema(landed.ATTENDEES).json(f"{folder}/attendees")

    def breaks_after_writing(batch, batch_id, store):
        store("rows", batch)
        raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        ingest.run_available(stream(), breaks_after_writing, out)
    assert ingest.copy_available(stream(), out).count() == len(LANDED)
    assert ingest.copy_available(stream(), out).count() == len(LANDED)


def test_load_dedupe_and_current(spark):
    orders = plan.order_rows(
        raw(spark, payload(), payload(id=7, reg_no=7))
    )
    plan.load_orders(spark, orders, "ods.orders_t1", "dwd.wide_t1")
    loaded = plan.load_orders(spark, orders, "ods.orders_t1", "dwd.wide_t1")
    assert loaded == {"ods.orders_t1": 2, "dwd.wide_t1_individual": 2}
    assert spark.table("ods.orders_t1").count() == 4
    plan.dedupe_orders(spark, "ods.orders_t1", scratch(spark, "ods"))
    assert spark.table("ods.orders_t1").count() == 2
    assert spark.table("dwd.wide_t1_individual").count() == 4
    assert plan.current_rows(spark.table("dwd.wide_t1_individual")).count() == 2
    other = plan.order_rows(raw(spark, payload(id=7, reg_no=7), event=(9, "Conf 2023 Reserved individual")))
    plan.load_orders(spark, other, "ods.orders_t1", "dwd.wide_t1")
    current = plan.current_rows(spark.table("dwd.wide_t1_individual"))
    assert sorted((r.event_id, r.registration_no) for r in current.collect()) == [
        (9, 7),
        (EVENT[0], 7),
        (EVENT[0], 321),
    ]
    assert spark.table("dwd.wide_t1_reserved").count() == 1
    raw_table = spark.table("ods.orders_t1")
    assert {(r.year, r.ticket_groups) for r in raw_table.collect()} == {
        (2022, "individual"),
        (2023, "individual+reserved"),
    }
    kept = [name for name in raw_table.inputFiles() if "year=2022" in name]
    plan.load_orders(spark, other, "ods.orders_t1", "dwd.wide_t5")
    plan.dedupe_orders(spark, "ods.orders_t1", scratch(spark, "ods"), since=0.0)
    books = spark.createDataFrame([(9, [(5, [])])], landed.BOOKS)
    assert plan.reconcile_refunds(spark, "ods.orders_t1", books, "unused", by_event=True)
    after = spark.table("ods.orders_t1")
    assert sorted((r.id, r.attendee_id, r.refunded) for r in after.collect()) == [
        (9, 7, True),
        (EVENT[0], 7, False),
        (EVENT[0], 5001, False),
    ]
    assert sorted(name for name in after.inputFiles() if "year=2022" in name) == sorted(kept)
    filtered = plan.wide_rows(after.where("year = 2022"), update_after=1.0, questions=["q"])
    text = filtered._jdf.queryExecution().executedPlan().toString()
    assert "(year#" in text.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "GreaterThan" in text.split("PushedFilters")[1]
    mixed = plan.order_rows(raw(spark, payload(updated_at=None), payload(id=8)))
    assert plan.load_orders(spark, mixed, "ods.orders_t4", "dwd.wide_t4") == {
        "ods.orders_t4": 1,
        "ods.orders_t4_undated": 1,
        "dwd.wide_t4_individual": 1,
    }
    forced = plan.load_orders(spark, orders, "ods.orders_t2", "dwd.wide_t2", group="reserved")
    assert forced["dwd.wide_t2_reserved"] == 2
    empty = orders.limit(0)
    assert plan.load_orders(spark, empty, "ods.orders_t3", "dwd.wide_t3") == {}


def test_refunds_follow_the_attendance_book(spark):
    orders = raw(spark, payload(id=1), payload(id=2)).unionByName(
        raw(spark, payload(id=2), payload(id=3), event=(9, "Other 2022 registration"))
    )
    orders = orders.withColumn("refunded", F.lit(None).cast("boolean"))
    book = {"id": 5, "signin_status": [[1, True, "2022-08-08"], ["1", None]]}
    reply = {"event_id": EVENT[0], "books": [book, {"id": 6, "signin_status": [[2, True]]}]}
    folder = scratch(spark, "landing")
    spark.createDataFrame([(json.dumps(reply),)], "value string").write.text(
        f"{folder}/attendance_books"
    )
    books = landed.read_books(spark, folder)
    assert landed.first_book_id(books).first().book_id == 5

    def refunded(by_event):
        marked = plan.mark(orders, plan.refunded(orders, books), by_event)
        assert marked.schema.fieldNames() == schemas.TICKET_ORDERS.fieldNames()
        return sorted(
            (r.id, json.loads(r.attendee_info)["id"], r.refunded) for r in marked.collect()
        )

    # attendee 2 left the first event; the other event has no landed book
    assert refunded(by_event=False) == [(9, 2, True), (9, 3, None), (5150, 1, None), (5150, 2, True)]
    assert refunded(by_event=True) == [(9, 2, None), (9, 3, None), (5150, 1, None), (5150, 2, True)]


def test_empty_book_refunds_everyone(spark):
    orders = raw(spark, payload(id=1)).withColumn("refunded", F.lit(False))
    books = spark.createDataFrame([(EVENT[0], [(5, [])])], landed.BOOKS)
    tables.create_table(spark, "ods.refunds", schemas.TICKET_ORDERS)
    tables.append(orders, "ods.refunds", schemas.TICKET_ORDERS)
    where = scratch(spark, "refunds")
    assert plan.reconcile_refunds(spark, "ods.refunds", books, where) is True
    assert spark.table("ods.refunds").first().refunded is True
    assert plan.reconcile_refunds(spark, "ods.refunds", books, where) is False
