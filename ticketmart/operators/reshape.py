"""Pairs to wide rows, wide rows to facts, and the question dimension."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmart.operators.harmonise import first_value
from ticketmart.vocab import SURVEY_KEY, SURVEY_UNUSED_COLUMNS


def question_of(pair: Column) -> Column:
    """Question of a pair, missing if the pair is empty or missing."""
    return F.get(pair, F.lit(0))


def answer_of(pair: Column) -> Column:
    return F.get(pair, F.lit(1))


def with_answers(records: DataFrame, pairs: Column, name: str = "answers") -> DataFrame:
    """Adds a map of question to answer; of a repeated question the last answer counts.

    Pairs without a question are left out, a question without an answer has a missing one.

    The steps are separate columns, so that Spark evaluates each of them once.
    """
    steps = (
        records.withColumn("_named", F.filter(pairs, lambda pair: question_of(pair).isNotNull()))
        .withColumn("_questions", F.transform("_named", question_of))
        .withColumn("_distinct", F.array_distinct("_questions"))
    )
    last_answers = F.transform(
        "_distinct",
        lambda question: answer_of(
            F.element_at(F.filter("_named", lambda pair: question_of(pair) == question), -1)
        ),
    )
    answers = F.transform("_named", answer_of)
    no_repeat = F.size("_distinct") == F.size("_questions")
    return steps.withColumn(
        name,
        F.when(no_repeat, F.map_from_arrays("_questions", answers)).otherwise(
            F.map_from_arrays("_distinct", last_answers)
        ),
    ).drop("_named", "_questions", "_distinct")


def missing_answers(pairs: Column, required: Sequence[str]) -> Column:
    """Required questions that a record's pairs do not hold."""
    return F.array_except(
        F.array(*[F.lit(name) for name in required]), F.transform(pairs, question_of)
    )


def question_names(
    records: DataFrame, added: Column, asked: Column, time: Column
) -> DataFrame:
    """Distinct names of added fields and of questions, with where each is seen first.

    Records are first grouped by their whole lists of names, of which there are
    about as many as versions of the form; only those lists are exploded.
    """
    forms = records.groupBy(added.alias("added"), asked.alias("asked")).agg(
        F.min(time).alias("time")
    )

    def named(list_name: str, is_question: bool) -> Column:
        return F.transform(
            list_name,
            lambda name, place: F.struct(
                F.lit(is_question).alias("is_question"), place.alias("place"), name.alias("name")
            ),
        )

    shown = forms.select(
        "time", "asked", F.explode(F.concat(named("added", False), named("asked", True))).alias("q")
    )
    return (
        shown.where("q.name IS NOT NULL")
        .groupBy("q.is_question", "q.name")
        .agg(F.min(F.struct("time", "asked", "q.place")).alias("first_seen"))
    )


def names_in_order(names: DataFrame) -> tuple[list[str], list[str]]:
    """Added fields, and questions, by first appearance: the columns of a wide table.

    They are the table's schema, so they reach the driver, however many forms ask.
    """
    found = names.orderBy("first_seen", "name").select("is_question", "name").collect()
    return (
        [row.name for row in found if not row.is_question],
        [row.name for row in found if row.is_question],
    )


def _without(answers: Column, names: Sequence[str]) -> Column:
    known = F.array(*[F.lit(name) for name in dict.fromkeys(names)]).cast("array<string>")
    return F.map_filter(answers, lambda name, _: ~F.array_contains(known, name))


def _renamed(records: DataFrame, name: str, rename: Callable[[Column], Column]) -> DataFrame:
    """A map of answers under their target names, of which the first value that is there counts."""
    steps = (
        records.withColumn("_values", F.transform(F.map_values(name), lambda v: first_value([v])))
        .withColumn("_targets", F.transform(F.map_keys(name), rename))
        .withColumn("_named", F.arrays_zip("_targets", "_values"))
        .withColumn("_distinct", F.array_distinct("_targets"))
    )
    first = F.transform(
        "_distinct",
        lambda target: F.get(
            F.filter(
                "_named", lambda one: (one["_targets"] == target) & one["_values"].isNotNull()
            ),
            F.lit(0),
        )["_values"],
    )
    no_repeat = F.size("_distinct") == F.size("_targets")
    merged = F.when(no_repeat, F.map_from_arrays("_targets", "_values")).otherwise(
        F.map_from_arrays("_distinct", first)
    )
    return steps.withColumn(name, merged).drop("_values", "_targets", "_named", "_distinct")


def pairs_to_wide(
    records: DataFrame,
    pairs: Column,
    plan: Mapping[str, Sequence[str]],
    fields: Mapping[str, Column],
    other: str | None = None,
    unwanted: Sequence[str] = (),
    rename: Callable[[Column], Column] | None = None,
    private: Sequence[str] = (),
) -> DataFrame:
    """One column per target name, next to the record's own fields.

    `other` names a map of all answers that have no column, apart from the
    unwanted ones; without it the plan has to hold every question. `rename` gives
    the target names of questions outside the plan: their answers fill the column
    of that name after the planned ones, or are in the map under that name, the
    first in the record's order, unless it is a private one.

    All pairs of a record are in its row, so this is a projection: no pivot and
    no shuffle. A field comes before the answers of the same target name.
    """
    held = with_answers(records, pairs, "_answers")
    late = lambda target: []
    if other:
        planned = [question for questions in plan.values() for question in questions]
        held = held.withColumn("_other", _without(F.col("_answers"), [*planned, *unwanted]))
    if other and rename:
        held = _renamed(held, "_other", rename)
        late = lambda target: [F.col("_other")[target]]
    columns = []
    for target, questions in plan.items():
        answers = [F.col("_answers")[question] for question in questions]
        if target in fields:
            continue
        columns.append(first_value([*answers, *late(target)]).alias(target))
    own = []
    for name, value in fields.items():
        kind = records.select(value.alias("v")).schema["v"].dataType
        answers = [F.col("_answers")[question] for question in plan.get(name, ())] + late(name)
        if answers:
            value = F.coalesce(value, first_value(answers).try_cast(kind))
        own.append(value.alias(name))
    if other:
        gone = [*plan, *fields, *private] if rename else []
        columns.append(_without(F.col("_other"), gone).alias(other))
    return held.select(*own, *columns)


def unpivot_survey(
    answers: DataFrame, year: int, key: str = SURVEY_KEY, unused: Sequence[str] = SURVEY_UNUSED_COLUMNS
) -> DataFrame:
    """One row per answer; the key column is also an answer of its own."""
    questions = [name for name in answers.columns if name not in unused]
    text = answers.select(*[F.col(f"`{name}`").cast("string").alias(name) for name in questions])
    return text.unpivot(
        F.col(f"`{key}`").alias("ip"),
        [F.col(f"`{name}`") for name in questions],
        "question",
        "answer",
    ).withColumn("year", F.lit(year).cast("long"))


def question_ids(
    known: DataFrame, columns: Sequence[str], unused: Sequence[str] = SURVEY_UNUSED_COLUMNS
) -> DataFrame:
    """Id of every column of a survey: the known one, else numbered after the largest.

    The result has at most one row per column of the survey.
    """
    asked = [
        F.struct(F.lit(place).cast("bigint").alias("place"), F.lit(name).alias("question"))
        for place, name in enumerate(columns)
        if name not in unused
    ]
    header = known.sparkSession.range(1).select(F.inline(F.array(*asked)))
    reused = (
        known.where(F.col("question").isin(*columns))
        .groupBy("question")
        .agg(F.max("question_id").cast("long").alias("known_id"))
    )
    largest = known.agg(F.coalesce(F.max("question_id").cast("long"), F.lit(0))).scalar()
    return header.join(reused, "question", "left").select(
        F.coalesce("known_id", largest + 1 + F.col("place")).alias("question_id"),
        "question",
        F.col("known_id").isNull().alias("is_new"),
    )


def new_questions(ids: DataFrame, year: int) -> DataFrame:
    return ids.where("is_new").select(
        "question_id", "question", F.lit(year).cast("long").alias("year")
    )


def survey_fact(unpivoted: DataFrame, ids: DataFrame) -> DataFrame:
    """Answers with question ids; `ids` has one row per survey column, so it is broadcast."""
    return unpivoted.join(F.broadcast(ids), "question").select(
        "ip", "question_id", "answer", "year"
    )
