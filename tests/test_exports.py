import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ticketmart import vocab
from ticketmart.config import scratch
from ticketmart.plans import offline, surveys, tickets
from ticketmart.sources import files

QUESTIONS = ["Come From / 國家或地區", "聯絡人 Email", "聯絡人 姓名"]
ATTENDEE_HEADER = (
    "Id,票種,報名序號,票券狀態,檢查碼,QR Code 序號,付款狀態,票面價格,選用的取票方式,訂單編號,"
    "Come From / 國家或地區,聯絡人 Email,聯絡人 姓名"
)
ORDER_HEADER = "訂單編號,票券狀態,付款狀態,付款時間,付款方式,姓名"


def write(spark, label, text):
    path = Path(scratch(spark, label))
    path.mkdir(parents=True)
    (path / "export.csv").write_text(text, encoding="utf-8", newline="")
    return str(path)


@pytest.fixture()
def exports(spark):
    attendees = write(
        spark,
        "attendees",
        ATTENDEE_HEADER
        + '\n1,"A, ""B""",7,activated,c1,q1,已繳費 ,2790,qrcode,100,Taiwan,a@x.org,王'
        + "\nx,T,8,activated,c2,q2,未繳費,free,qrcode,200,NA,,李\n",
    )
    orders = write(
        spark,
        "orders",
        ORDER_HEADER
        + "\n100,activated,已繳費,2023/04/22 15:47:04,ATM,姓名\n300,cancelled,未繳費,,ATM,姓名\n",
    )
    return files.read_export(spark, attendees), files.read_export(spark, orders)


def payloads(rows):
    found = [json.loads(r.attendee_info) for r in rows.collect()]
    return {p["reg_no"]: p for p in found}


def test_export_becomes_raw_rows(spark, exports):
    attendees, orders = exports
    rows = offline.exported_orders(
        attendees, orders, 2023, "individual", "Conf 2023 Registration", QUESTIONS
    )
    row = rows.first()
    assert (row.id, row.name, row.refunded) == (999000202301, "Conf 2023 Registration", False)
    found = payloads(rows)
    digest = lambda t: spark.range(1).select(F.sha2(F.lit(t), 256)).first()[0]
    assert found[7] == {
        "id": 1,
        "ticket_name": 'A, "B"',
        "reg_no": 7,
        "state": "activated",
        "checkin_code": "c1",
        "qrcode": "q1",
        "is_paid": True,
        "price": 2790.0,
        "payment_method": "ATM",
        "updated_at": 1682178424.0,
        "ticket_type": "qrcode",
        "order_no": 100,
        "ticket_id": None,
        "currency": "TWD",
        "kyc": {},
        "id_number": None,
        "slot": {},
        "data": [
            ["Come From / 國家或地區", "Taiwan"],
            ["聯絡人 Email", digest("a@x.org")],
            ["聯絡人 姓名", digest("王")],
        ],
    }
    unpaid = found[8]
    assert (unpaid["id"], unpaid["price"], unpaid["is_paid"], unpaid["updated_at"]) == (
        None,
        None,
        False,
        None,
    )
    assert unpaid["data"][:2] == [
        ["Come From / 國家或地區", None],
        ["聯絡人 Email", digest("None")],
    ]
    good, aside = tickets.split_timed(rows)
    assert (good.count(), aside.count()) == (1, 1)
    assert tickets.wide_rows(good).first().payment_status == "paid"


def test_without_a_live_order_nothing_is_loaded(spark, exports):
    attendees, orders = exports
    dead = orders.where(F.col(vocab.OFFLINE_STATUS) != "activated")
    rows = offline.exported_orders(attendees, dead, 2023, "individual", "n", QUESTIONS)
    assert rows.count() == 0


def test_export_checks(spark, exports):
    attendees, orders = exports
    with pytest.raises(ValueError, match="2020"):
        offline.exported_orders(attendees, orders, 2020, "individual", "n", QUESTIONS)
    with pytest.raises(ValueError, match="missing columns: no such"):
        offline.exported_orders(attendees, orders, 2023, "individual", "n", ["no such"])
    with pytest.raises(ValueError, match="訂單編號"):
        offline.exported_orders(
            attendees.drop("訂單編號"), orders, 2023, "individual", "n", QUESTIONS
        )


def test_config_files(spark):
    mapping = write(spark, "mapping", json.dumps(vocab.OFFLINE_META_FIELDS, ensure_ascii=False))
    assert files.read_meta_fields(spark, mapping) == vocab.OFFLINE_META_FIELDS
    double = write(spark, "double", '{"a": "x", "b": "x"}')
    with pytest.raises(ValueError, match="mapped twice"):
        files.read_meta_fields(spark, double)
    names = write(spark, "names", "a\n\n  b b \r\n")
    assert files.read_field_names(spark, names) == ["a", "b b"]


def test_expense_sheet(spark):
    path = write(
        spark, "sheet", 'r,p,m,t,d,w,y\nTaxi,100,x,ops,"a,\nb",me,Y\nBus,,x,ops,d,me,Y\n'
    )
    rows = files.read_expense_sheet(spark, path).collect()
    assert [tuple(r) for r in rows] == [("Taxi", "100", "x", "ops", "a,\nb", "me", "Y")]
    assert rows[0].__fields__ == list(vocab.EXPENSE_COLUMNS)


SURVEY = (
    "﻿你是從哪裡過來呢？,填答時間, 填答秒數 ,IP紀錄,額滿結束註記,使用者紀錄,會員時間,會員編號,自訂ID,備註\n"
    "台灣南部,\"2021-07-03 15:34:50\",311,36.226.4.68,,,,',,\n"
    "台灣北部,\"2021-07-03 16:13:18\",5,36.226.4.68,,,,',,\n"
    "其他,\"2021-07-03 16:55:40\",8,2001:b400:e23c:9eb4:90b4:98ef:33:8eee,,,,',,\n"
)


def test_survey_fact_and_dimension(spark):
    answers = files.read_survey(spark, write(spark, "survey", SURVEY))
    assert answers.columns[:4] == ["你是從哪裡過來呢？", "填答時間", "填答秒數", "IP紀錄"]
    known = spark.createDataFrame([("placeholder", 1)], "question string, question_id bigint")
    fact, questions = surveys.fact_and_questions(answers, known, 2146)
    assert fact.columns == ["ip", "question_id", "answer", "year"]
    assert fact.count() == 12
    assert sorted((r.question_id, r.question) for r in questions.collect()) == [
        (2, "你是從哪裡過來呢？"),
        (3, "填答時間"),
        (4, "填答秒數"),
        (5, "IP紀錄"),
    ]
    rows = {(r.ip, r.question_id, r.answer) for r in fact.collect()}
    assert ("36.226.4.68", 2, "台灣南部") in rows
    assert ("36.226.4.68", 5, "36.226.4.68") in rows


def test_survey_tables_reuse_ids_at_the_next_load(spark):
    answers = files.read_survey(spark, write(spark, "survey", SURVEY))
    names = {"domain": "q1", "prod": False, "contributor": "me"}
    first = surveys.save(spark, answers, 2021, scratch(spark, "csv"), **names)
    assert first == {"test.test_me_q1_ip_datetime": 12, "test.test_me_q1_questionId_year": 4}
    again = surveys.save(
        spark, answers.withColumn("new", F.lit("n")), 2022, scratch(spark, "csv"), **names
    )
    assert again == {"test.test_me_q1_ip_datetime": 15, "test.test_me_q1_questionId_year": 1}
    ids = spark.table("test.test_me_q1_questionId_year")
    assert ids.count() == ids.select("question_id").distinct().count() == 5


CELLS = ["a", "", '"x"', '"x,y"', '"l1{0}l2"', '"q""q"', '5" disk', '"a"b', '"{0}{0}"', '"""{0}"""', ' "s', '""', "z" * 70]


@pytest.mark.parametrize("seed", range(4))
def test_split_reading_equals_plain_reading(spark, seed):
    """Files of many blocks, cut inside of cells, with quotes also where none belong."""
    choose = random.Random(seed)
    folder = Path(scratch(spark, "cells"))
    folder.mkdir(parents=True)
    for place in range(2):
        end = choose.choice(["\n", "\r\n"])
        cell = lambda: choose.choice(CELLS).format(end)  # noqa: B023, E731
        rows = [",".join(cell() for _ in range(choose.choice([3, 3, 2, 4]))) for _ in range(30)]
        rows.insert(choose.randint(0, 30), "")
        last = end + 'x,"open' + end + "end,," if seed == 3 else choose.choice(["", end])
        text = end.join([f'h1,"h{end}2",h3', *rows]) + last
        (folder / f"{place}.csv").write_text(text, newline="")
    sizes = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1"}
    for key, value in sizes.items():
        spark.conf.set(key, value)
    try:
        plain = files.read_cells(spark, str(folder))
        split = files.read_split_cells(spark, str(folder))
        assert split.columns == plain.columns
        assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))
        lines = files._records(spark, str(folder))
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 10 and lines.count() > 40
    finally:
        for key in sizes:
            spark.conf.unset(key)


def test_split_reading_of_empty_files(spark):
    folder = write(spark, "empty", "a,b\n")
    assert files.read_split_cells(spark, folder).columns == ["a", "b"]
    assert files.read_split_cells(spark, folder).count() == 0
    assert files.read_split_cells(spark, write(spark, "nothing", "")).columns == []
