import hashlib
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ticketmart import vocab
from ticketmart.functions import numbers, text, times
from ticketmart.operators import harmonise
from ticketmart.plans.offline import older_attendees

_ROWS = json.loads(Path(__file__).with_name("headers.json").read_text("utf-8"))
HEADERS = {
    (int(key.split()[0]), key.split()[1]): row for key, row in _ROWS.items() if key != "note"
}
COUNTS = {
    2018: {"corporate": 20, "individual": 18, "reserved": 20},
    2019: {"corporate": 20, "individual": 17, "reserved": 18},
    2020: {"corporate": 28, "individual": 25, "reserved": 20},
}


@pytest.mark.parametrize("rules", [harmonise.UNTIL_2021, harmonise.CURRENT])
@pytest.mark.parametrize("year, group", list(HEADERS))
def test_headers_of_three_years_come_to_the_canonical_columns(year, group, rules):
    planned = harmonise.plan_names(HEADERS[year, group], rules)
    assert len(planned) == COUNTS[year][group]
    assert set(planned) == set(harmonise.canonical_columns(year, group))


def test_core_columns_are_those_of_all_years(spark):
    rows = [(year, name) for year, names in vocab.CANONICAL_BY_YEAR.items() for name in names]
    names = spark.createDataFrame(rows, "year int, name string")
    core = harmonise.names_of_all_years(
        names, "name", "year", [2018, 2019, 2020], vocab.CROSS_YEAR_EXTRAS
    )
    assert sorted(r.name for r in core.collect()) == sorted(vocab.CANONICAL_CORE)


def test_older_attendees_values_and_hashes(spark):
    header = HEADERS[2020, "corporate"]
    cells = {
        "Ticket Type": "Regular 原價",
        "Contact Email": "xxx@gmail.com",
        "Come From / 國家或地區": "Taiwan 台灣",
    }
    rows = [[cells.get(name) for name in header], [None] * len(header)]
    schema = ", ".join(f"`{name}` string" for name in header)
    found = older_attendees(spark.createDataFrame(rows, schema)).collect()
    assert len(found[0]) == 28
    assert found[0].ticket_type == "Regular 原價"
    assert found[0].country_or_region == "Taiwan 台灣"
    assert found[0].email == "26a695fcd9d98ffa1fba78cb5a1eacf0fbe19e40bf9de0cafa0080cdf4c14514"
    assert found[1].email == hashlib.sha256(b"nan").hexdigest()


def test_known_hash(spark):
    row = spark.range(1).select(text.sha256_text(F.lit("1234567890-=qwertyuiop[]"))).first()
    assert row[0] == "aefefa43927b374a9af62ab60e4512e86f974364919d1b09d0013254c667e512"


@pytest.mark.parametrize(
    "raw, styled",
    [
        ("Age range / 年齡區間", "age_range"),
        ("  Paid   Date ", "paid_date"),
        ("# invoice policy #", "invoice_policy"),
        ("Size of T-shirt / T恤尺寸", "size_of_tshirt_t"),
        ("標籤", ""),
        ("a_b__C", "a_b__c"),
    ],
)
def test_style_name_on_schema_and_on_data(spark, raw, styled):
    assert text.style_name(raw) == styled
    assert spark.range(1).select(text.style_name_column(F.lit(raw))).first()[0] == styled


def test_target_name_on_data_equals_the_plan(spark):
    raws = [*vocab.NAME_MAPPING, *[name for header in HEADERS.values() for name in header], "地點"]
    names = spark.createDataFrame([(raw,) for raw in raws], "raw string")
    found = names.select("raw", harmonise.target_name(F.col("raw")).alias("target")).collect()
    assert {r.raw: r.target for r in found} == {raw: harmonise.CURRENT.target(raw) for raw in raws}
    assert harmonise.CURRENT.target("地點") == "地點"


def test_merged_columns_take_the_first_value_that_is_there(spark):
    table = spark.createDataFrame(
        [("null", "b", 1), ("", "b", 2), (None, None, 3), ("a", "null", None)],
        "`Come From / 國家或地區` string, `來自國家、地區或縣市` string, `標籤x1` int",
    )
    rows = harmonise.harmonise(table).collect()
    assert [r.country_or_region for r in rows] == ["b", "", None, "a"]
    assert [r.x1 for r in rows] == [1, 2, 3, None]


def test_shared_targets(spark):
    names = spark.createDataFrame(
        [("Come From / 國家或地區",), ("Come From / 國家或地區",), ("來自國家、地區或縣市",), ("Tags",)],
        "raw string",
    )
    found = harmonise.shared_targets(names, "raw").collect()
    assert sorted((r.target, r.raw_name) for r in found) == [
        ("country_or_region", "Come From / 國家或地區"),
        ("country_or_region", "來自國家、地區或縣市"),
    ]


def test_numbers_are_strict_and_private_columns_go(spark):
    table = spark.createDataFrame([("10", "n"), (" ", "n")], "price string, nickname string")
    rows = harmonise.drop_private(harmonise.to_numbers(table)).collect()
    assert [tuple(r) for r in rows] == [(10.0,), (None,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        harmonise.to_numbers(spark.createDataFrame([("ten",)], "price string")).collect()


def test_required_columns(spark):
    assert harmonise.missing_columns(["a"], ["b", "a", "b", "c"]) == ["b", "c"]
    with pytest.raises(ValueError, match="missing columns: id2"):
        harmonise.require_columns(spark.range(1), ["id", "id2"])


def test_scalar_functions(spark):
    row = (
        spark.range(1)
        .select(
            text.strip(F.lit("　\n a b \t")).alias("stripped"),
            times.slash_time_to_epoch(F.lit("2023/04/22 15:47:04")).alias("time"),
            times.slash_time_to_epoch(F.lit("2023-04-22")).alias("bad_time"),
            times.slash_time_to_epoch(F.lit("")).alias("no_time"),
            times.offset_time_text(F.lit("2024-01-01T10:00:00+0000")).alias("feed"),
            times.offset_time_text(F.lit("2024-01-01T10:00:00+0800")).alias("kept_offset"),
            times.epoch_to_date_text(F.lit(1656921502.566)).alias("date"),
            numbers.long_or_null(F.lit("2.0")).alias("no_whole"),
            numbers.offline_event_id(2023, F.lit("reserved"), vocab.TICKET_GROUPS).alias("event"),
            times.year_of_date_text(F.lit("2022-13-01")).alias("no_year"),
            text.paid_flag(F.lit(None).cast("boolean"), vocab.PAID_TEXTS).alias("unpaid"),
            text.paid_flag(F.lit(1), vocab.PAID_TEXTS).alias("paid"),
        )
        .first()
    )
    assert tuple(row) == (
        "a b",
        1682178424.0,
        None,
        None,
        "2024-01-01 10:00:00UTC",
        "2024-01-01 10:00:00+0800",
        "2022-07-04",
        None,
        999000202302,
        None,
        "not",
        "paid",
    )
    with pytest.raises(Exception, match="unknown ticket group"):
        spark.range(1).select(
            numbers.offline_event_id(2023, F.lit("vip"), vocab.TICKET_GROUPS)
        ).collect()
    with pytest.raises(Exception):
        spark.range(1).select(times.year_of_date_text(F.lit("soon"), strict=True)).collect()
