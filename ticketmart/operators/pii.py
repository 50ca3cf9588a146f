"""Removal and extraction of personal data in question/answer pairs.

Pairs are `[question, answer]`, a two-element array, as the ticket system
delivers them. All work is done inside one row, so hashing needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmart.functions.text import sha256_text
from ticketmart.vocab import SENSITIVE_MARKERS

SEARCH_TEXT = "search_string"


def _is_sensitive(question: Column, markers: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.contains(question, F.lit(m)) for m in markers], F.lit(False))


def hash_sensitive(pairs: Column, markers: Sequence[str] = SENSITIVE_MARKERS) -> Column:
    """Pairs of text, with the answer hashed once where the question contains a marker."""
    return F.transform(
        pairs,
        lambda pair: F.when(
            _is_sensitive(F.get(pair, F.lit(0)), markers) & (F.size(pair) >= 2),
            F.concat(
                F.array(F.get(pair, F.lit(0)), sha256_text(F.get(pair, F.lit(1)))),
                F.slice(pair, 3, F.greatest(F.size(pair), F.lit(3))),
            ),
        ).otherwise(pair),
    )


def extract_sensitive(pairs: Column, markers: Sequence[str] = SENSITIVE_MARKERS) -> Column:
    """Map of the unhashed pairs whose question equals a marker; the last of a repeat wins.

    A question without an answer has a missing one.
    """
    question_of = lambda pair: F.get(pair, F.lit(0))
    present = F.array_distinct(
        F.filter(F.transform(pairs, question_of), lambda question: question.isin(*markers))
    )
    return F.map_from_entries(
        F.transform(
            present,
            lambda question: F.struct(
                question,
                F.get(
                    F.element_at(F.filter(pairs, lambda pair: question_of(pair) == question), -1),
                    F.lit(1),
                ),
            ),
        )
    )


def _text_of(text: Column, value: Column) -> Column:
    """Text of a JSON value as the hashes expect it: True, False, and 2600.0 for a whole float.

    Its kind is looked up only for texts that it can change.
    """
    kind = F.schema_of_variant(value)
    whole_float = text.rlike("^-?[0-9]+$") & kind.rlike("^(DECIMAL|DOUBLE|FLOAT)")
    return (
        F.when(text.isin("true", "false") & (kind == "BOOLEAN"), F.initcap(text))
        .when(whole_float, F.concat(text, F.lit(".0")))
        .otherwise(text)
    )


def _hashed_pair_text(pair: Column, question: Column, markers: Sequence[str]) -> Column:
    """Text of a pair with its answer hashed; what is no such pair stays as it is.

    Inside a function over an array Spark evaluates an expression as often as it is
    named, so parts are read by their paths, the answer's text once, and all parts
    only where a sensitive question has more than one answer.
    """
    part = lambda at, kind: F.try_variant_get(pair, f"$[{at}]", kind)
    parts = F.try_variant_get(pair, "$", "array<variant>")
    digest = lambda text: sha256_text(_text_of(text, part(1, "variant")))
    answer = F.get(F.transform(F.array(part(1, "string")), digest), F.lit(0))
    more = F.transform(
        F.slice(parts, 3, F.greatest(F.size(parts), F.lit(3))),
        lambda value: F.concat(F.lit(","), F.to_json(value)),
    )
    hashed = F.concat(
        F.lit("["), F.to_json(part(0, "variant")), F.lit(',"'), answer, F.lit('"'),
        F.when(part(2, "variant").isNotNull(), F.array_join(more, "")).otherwise(""), F.lit("]"),
    )
    wanted = F.coalesce(_is_sensitive(question, markers), F.lit(False)) & part(1, "variant").isNotNull()
    return F.when(wanted, hashed).otherwise(
        F.coalesce(F.to_json(pair), F.lit("null"))
    )


def readable(column: Column | str = "attendee_info") -> Column:
    """Whether a payload is a JSON object."""
    return F.coalesce(F.json_object_keys(column).isNotNull(), F.lit(False))


def deidentify(
    tickets: DataFrame, column: str = "attendee_info", markers: Sequence[str] = SENSITIVE_MARKERS
) -> DataFrame:
    """Payloads as JSON text without the search text and with sensitive answers hashed.

    A payload is taken apart as variants, so fields that no schema knows, and the
    types of all answers, come through unchanged; so do pairs of another form and
    a `data` that is no list. It is parsed once; the steps are separate columns so
    that none is evaluated twice. Text that is no JSON object becomes null:
    `readable` tells such payloads, which are to be put aside.
    """
    opened = tickets.withColumn("_fields", F.from_json(column, "map<string,variant>"))
    steps = opened.withColumn(
        "_pairs", F.try_variant_get(F.col("_fields")["data"], "$", "array<variant>")
    ).withColumns(
        {
            "_rest": F.to_json(
                F.map_filter(
                    "_fields",
                    lambda key, _: (key != SEARCH_TEXT)
                    & ((key != "data") | F.col("_pairs").isNull()),
                ),
                {"ignoreNullFields": "false"},
            ),
            "_pairs": F.array_join(
                F.zip_with(
                    "_pairs",
                    F.transform("_pairs", lambda pair: F.try_variant_get(pair, "$[0]", "string")),
                    lambda pair, question: _hashed_pair_text(pair, question, markers),
                ),
                ",",
            ),
        }
    )
    comma = F.when(F.col("_rest") == "{}", "").otherwise(",")
    rest = F.substr("_rest", F.lit(2))
    whole = F.concat(F.lit('{"data":['), "_pairs", F.lit("]"), comma, rest)
    return steps.withColumn(column, F.coalesce(whole, "_rest")).drop("_fields", "_rest", "_pairs")
