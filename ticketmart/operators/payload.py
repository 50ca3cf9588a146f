"""Payloads that are JSON text in a string column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmart import schemas
from ticketmart.functions import numbers, times
from ticketmart.functions.text import strip
from ticketmart.vocab import OFFLINE_META_FIELDS, OFFLINE_PAID_TEXT


def to_payload_text(payload: Column) -> Column:
    """JSON text of a struct; missing fields are kept as null, text is kept as it is."""
    return F.to_json(payload, {"ignoreNullFields": "false"})


def _text_of(value: Column) -> Column:
    """A JSON value as the typed view gives it: text as it is, null as missing, all else as JSON."""
    scalar = F.try_variant_get(value, "$", "string")
    text = F.coalesce(scalar, F.to_json(value))
    # the kind is looked up only for texts that it can change
    whole_float = scalar.rlike("^-?[0-9]+$") & F.schema_of_variant(value).rlike(
        "^(DECIMAL|DOUBLE|FLOAT)"
    )
    return F.when(~F.is_variant_null(value), F.when(whole_float, F.concat(text, F.lit(".0"))).otherwise(text))


def _parts(pair: Column) -> Column:
    """Elements of a pair; missing if it is no list."""
    return F.try_variant_get(pair, "$", "array<variant>")


def answer_pairs(document: Column, typed: Column) -> Column:
    """All pairs of a payload's `data` that are lists, as text.

    `typed` is the list as a typed view reads it, which is nothing at all if one
    element is no list; only then are the elements read one by one. A pair may have
    any number of parts.
    """
    listed = _listed(document)
    return F.coalesce(
        typed, F.transform(listed, lambda parts: F.transform(parts, _text_of))
    )


def pair_questions(document: Column, typed: Column) -> Column:
    """Questions of `answer_pairs`, without the texts of the answers."""
    first = lambda parts: F.get(parts, F.lit(0))
    return F.coalesce(
        F.transform(typed, first),
        F.transform(_listed(document), lambda parts: _text_of(first(parts))),
    )


def _listed(document: Column) -> Column:
    """Parts of all elements of `data` that are lists."""
    return F.filter(
        F.transform(_parts(F.from_json(document, "data variant")["data"]), _parts),
        lambda parts: parts.isNotNull(),
    )


def odd_pairs(document: Column, typed: Column) -> Column:
    """JSON texts of what is in `data` and is no question with one answer; missing if there is none.

    A `data` that is no list is odd as a whole.
    """
    usual = F.forall(
        typed,
        lambda pair: pair.isNotNull() & (F.size(pair) == 2) & F.get(pair, F.lit(0)).isNotNull(),
    )

    def is_odd(pair: Column) -> Column:
        question = F.try_variant_get(pair, "$[0]", "variant")
        good = (F.size(_parts(pair)) == 2) & ~F.is_variant_null(question)
        return ~F.coalesce(good, F.lit(False))

    data = F.from_json(document, "data variant")["data"]
    texts = F.transform(F.filter(_parts(data), is_odd), lambda pair: F.to_json(pair))
    odd = F.when(F.size(texts) > 0, texts).when(
        _parts(data).isNull() & ~F.is_variant_null(data), F.array(F.to_json(data))
    )
    return F.when(~F.coalesce(usual, F.lit(False)), odd)


def parse_payload(tickets: DataFrame, column: str = "attendee_info") -> DataFrame:
    """Adds `payload`, the typed view of the JSON text. An odd pair costs no other answer."""
    typed = tickets.withColumn("payload", F.from_json(column, schemas.PAYLOAD))
    pairs = answer_pairs(F.col(column), F.col("payload.data"))
    return typed.withColumn("payload", F.col("payload").withField("data", pairs))


def json_value(document: Column | str, path: str, kind: str = "string") -> Column:
    """Value at a JSON path, unquoted, then cast (a malformed value fails the job)."""
    return F.get_json_object(document, path).cast(kind)


def unknown_fields(document: Column, known: Sequence[str] = schemas.PAYLOAD_FIELDS) -> Column:
    """Top-level fields the typed view leaves out, as a map of text.

    Without it, a field that the ticket system adds would vanish unnoticed.
    """
    return F.map_filter(
        F.from_json(document, "map<string,string>"), lambda key, _: ~key.isin(*known)
    )


def unknown_names(document: Column, known: Sequence[str] = schemas.PAYLOAD_FIELDS) -> Column:
    """Names of those fields; much cheaper than their values."""
    return F.array_except(F.json_object_keys(document), F.array(*[F.lit(k) for k in known]))


def build_payload(
    row_columns: Sequence[str],
    answers: Sequence[str],
    meta_fields: dict[str, str] = OFFLINE_META_FIELDS,
) -> Column:
    """Payload struct of one row of an exported table.

    Values that cannot be read become missing; fields that exports lack get the
    defaults of the ticket system.
    """
    present = set(row_columns)
    converters = {
        "id": numbers.long_or_null,
        "reg_no": numbers.long_or_null,
        "order_no": numbers.long_or_null,
        "price": numbers.double_or_null,
        "updated_at": times.slash_time_to_epoch,
        "is_paid": lambda text: strip(text) == OFFLINE_PAID_TEXT,
    }
    fields = []
    for field, column in meta_fields.items():
        text = F.col(f"`{column}`") if column in present else F.lit(None)
        convert = converters.get(field, lambda value: value)
        fields.append(convert(text.cast("string")).alias(field))
    empty = F.create_map().cast("map<string,string>")
    defaults = {
        "ticket_id": F.lit(None).cast("bigint"),
        "currency": F.lit("TWD"),
        "kyc": empty,
        "id_number": F.lit(None).cast("string"),
        "slot": empty,
    }
    fields += [value.alias(name) for name, value in defaults.items() if name not in meta_fields]
    fields.append(wide_to_pairs(row_columns, answers).alias("data"))
    return F.struct(*fields)


def wide_to_pairs(row_columns: Sequence[str], names: Sequence[str]) -> Column:
    """Every listed column as a `[name, value]` pair; an absent column gives a missing value."""
    present = set(row_columns)
    return F.array(
        *[
            F.array(
                F.lit(name),
                (F.col(f"`{name}`") if name in present else F.lit(None)).cast("string"),
            )
            for name in names
        ]
    )


def parse_reply(reply: Column, value_name: str) -> Column:
    """Rows of a labeller's reply: a JSON list between a seven- and a three-letter fence.

    A reply that is no such list is missing.
    """
    opened = strip(F.substr(strip(reply), F.lit(len("```json") + 1)))
    length = F.char_length(opened) - 3
    body = strip(F.substring(opened, F.lit(1), F.greatest(length, F.lit(0))))
    return F.from_json(body, f"array<struct<`{value_name}` string, category string>>")
