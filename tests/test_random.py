"""Random records against a plain restatement of what should come out."""

import hashlib
import json
import random

import pytest
from conftest import EVENT, payload
from pyspark.sql import functions as F

from ticketmart.functions.text import style_name, style_name_column
from ticketmart.operators import harmonise
from ticketmart.plans import tickets as plan
from ticketmart.vocab import SENSITIVE_MARKERS

QUESTIONS = [
    "Come From / 國家或地區",
    "來自國家、地區或縣市",
    "Where are you from? / 來自國家、地區或縣市",
    "Dietary Habit / 餐點偏好",
    "Dietary Preference / 飲食偏好",
    "Gender / 性別",
    "Gender / 生理性別",
    "標籤",
    "地點",
    "payment method",
]
ANSWERS = ["a", "b", "", "null", None, "x y"]


def raw(spark, payloads):
    rows = [(*EVENT, json.dumps(p, ensure_ascii=False)) for p in payloads]
    return spark.createDataFrame(rows, "id bigint, name string, attendee_info string")


def expected_wide(records):
    first_seen, best = {}, {}
    for record in sorted(records, key=lambda r: r["updated_at"]):
        for question, _ in record["data"]:
            first_seen.setdefault(question, len(first_seen))
        best[record["reg_no"]] = record
    rows = {}
    for reg_no, record in best.items():
        answers = dict(map(tuple, record["data"]))
        row = {"payment_method": record["payment_method"]}
        for question in first_seen:
            if question in harmonise.CURRENT.unwanted:
                continue
            target = harmonise.CURRENT.target(question)
            answer = answers.get(question)
            row.setdefault(target, None)
            if row[target] is None and answer != "null":
                row[target] = answer
        rows[reg_no] = row
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_wide_rows(spark, seed):
    rng = random.Random(seed)
    times = rng.sample(range(1, 10**6), 150)
    records = [
        payload(
            id=number,
            reg_no=rng.choice([None, *range(40)]),
            updated_at=float(time),
            payment_method=rng.choice(["ATM", None]),
            data=[
                [rng.choice(QUESTIONS), rng.choice(ANSWERS)] for _ in range(rng.randint(1, 8))
            ],
        )
        for number, time in enumerate(times)
    ]
    wide = plan.wide_rows(raw(spark, records))
    expected = expected_wide(records)
    found = {row.registration_no: row.asDict() for row in wide.collect()}
    assert found.keys() == expected.keys()
    for reg_no, row in expected.items():
        assert {name: found[reg_no][name] for name in row} == row


def random_value(rng, depth=0):
    kinds = ["text", "int", "float", "bool", "none"] + (["list", "object"] if depth < 2 else [])
    kind = rng.choice(kinds)
    if kind == "list":
        return [random_value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    if kind == "object":
        return {f"k{i}": random_value(rng, depth + 1) for i in range(rng.randint(0, 3))}
    return {
        "text": lambda: "".join(rng.choices('ab"\\/ \n\t，{}[]李:,', k=rng.randint(0, 9))),
        "int": lambda: rng.randint(-(10**12), 10**12),
        "float": lambda: rng.choice([0.5, 1e-7, 2600.0, 1656921502.5667331, 1e20]),
        "bool": lambda: rng.random() < 0.5,
        "none": lambda: None,
    }[kind]()


def test_deidentified_payloads(spark):
    rng = random.Random(7)
    questions = [*SENSITIVE_MARKERS, "x Address y", "plain", 'q "uoted" \\ question']
    payloads, expected = [], []
    for number in range(300):
        pairs = []
        for _ in range(rng.randint(0, 5)):
            value = random_value(rng, depth=2)
            # numbers in hashed answers have one text only if they are whole
            value = 12 if isinstance(value, float) else value
            pairs.append([rng.choice(questions), value])
        source = {"id": number, "search_string": "s", "data": pairs}
        source |= {f"extra{i}": random_value(rng) for i in range(rng.randint(0, 3))}
        if number % 10 == 0:
            del source["data"]
        payloads.append(source)
        hashed = {key: value for key, value in source.items() if key != "search_string"}
        if "data" in hashed:
            hashed["data"] = [
                [q, hashlib.sha256(str(v).encode()).hexdigest()]
                if any(marker in q for marker in SENSITIVE_MARKERS)
                else [q, v]
                for q, v in pairs
            ]
        expected.append(hashed)
    found = [json.loads(r.attendee_info) for r in plan.order_rows(raw(spark, payloads)).collect()]
    assert sorted(found, key=lambda p: p["id"]) == expected


def test_styled_names(spark):
    rng = random.Random(3)
    names = ["".join(rng.choices("aB3_ -/\t\n(李", k=rng.randint(0, 15))) for _ in range(500)]
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    found = rows.select("n", style_name_column(F.col("n")).alias("s")).collect()
    assert [r.s for r in found] == [style_name(n) for n in names]
