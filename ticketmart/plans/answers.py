"""Answers as a table of their own, with the names of questions in a dictionary.

The two tables have the same columns and types for any number of questions, and
no name reaches the driver: a wide table of chosen columns is a view of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmart import vocab
from ticketmart.operators import harmonise, reshape
from ticketmart.operators.dedupe import latest_per_key
from ticketmart.operators.joins import join_on
from ticketmart.operators.numbering import number_in_order
from ticketmart.plans import tickets

KEYS = ("event_id", "registration_no")


def encoded_answers(
    orders: DataFrame, rules: harmonise.NameRules = harmonise.CURRENT
) -> tuple[DataFrame, DataFrame]:
    """(name_id, name) of all columns, and (event_id, registration_no, name_id, value).

    Names are those that the columns of a wide table would have, numbered in
    code-point order; unwanted and private ones are left out. Of each ticket the
    latest record counts. Where several questions have one name, the first answer
    that is there counts, in the order in which the questions are first seen;
    missing answers, and those that are "null", have no row.
    """
    records = tickets.wide_records(orders)
    latest = latest_per_key(
        records.withColumnsRenamed({"_event": "event_id", "reg_no": "registration_no"}),
        KEYS,
        [F.desc("updated_at"), F.desc("id")],
    )
    held = reshape.with_answers(
        latest.withColumn("pairs", tickets.record_pairs(True)), F.col("pairs")
    )
    given = held.select(*KEYS, F.explode("answers").alias("question", "value"))
    given = given.where(F.col("value").isNotNull() & (F.col("value") != "null"))

    seen = tickets.record_names(records).select("is_question", "first_seen", "name")
    placed = number_in_order(seen, ["is_question", "first_seen", "name"])
    named = placed.select(
        F.col("name").alias("question"),
        F.col("start").alias("place"),
        harmonise.target_name(F.col("name"), rules).alias("name"),
    ).where(~F.col("question").isin(*rules.unwanted) & ~F.col("name").isin(*vocab.PRIVATE_COLUMNS))
    names = number_in_order(named.select("name").distinct(), ["name"]).select(
        F.col("start").alias("name_id"), "name"
    )
    # a name that is an added field and a question counts at its first place
    known = join_on(named, names, ["name"], "inner").groupBy("question").agg(
        F.min("place").alias("place"), F.min("name_id").alias("name_id")
    )
    answers = (
        join_on(given, known, ["question"], "inner")
        .groupBy(*KEYS, "name_id")
        .agg(F.min_by("value", "place").alias("value"))
    )
    return names, answers


def wide_view(names: DataFrame, answers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per ticket with any answer, with these columns as text."""
    chosen = names.where(F.col("name").isin(*columns))
    met = answers.join(chosen, "name_id", "left")
    return met.groupBy(*KEYS).agg(
        *[F.max(F.when(F.col("name") == name, F.col("value"))).alias(name) for name in columns]
    )
