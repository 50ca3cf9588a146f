"""One column vocabulary for questionnaires whose headers drift from year to year.

Names are planned on the driver when they are a table's columns (a schema is
small), and are computed as column expressions when they are data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketmart import vocab
from ticketmart.functions.numbers import strict_number
from ticketmart.functions.text import sha256_text, style_name, style_name_column


@dataclass(frozen=True)
class NameRules:
    mapping: Mapping[str, str]
    unwanted: Sequence[str]

    def target(self, raw: str) -> str:
        """Mapped, styled and mapped again; a name with nothing left by styling stays raw."""
        name = self.mapping.get(raw, raw)
        name = style_name(name) or name
        return self.mapping.get(name, name)


CURRENT = NameRules(vocab.NAME_MAPPING, vocab.UNWANTED_COLUMNS)
UNTIL_2021 = NameRules(vocab.NAME_MAPPING_2021, vocab.UNWANTED_COLUMNS_2021)


def _mapped(name: Column, mapping: Mapping[str, str]) -> Column:
    table = F.create_map(*[F.lit(text) for pair in mapping.items() for text in pair])
    return F.coalesce(table[name], name)


def target_name(raw: Column, rules: NameRules = CURRENT) -> Column:
    """`NameRules.target` for names that are data."""
    name = _mapped(raw, rules.mapping)
    styled = style_name_column(name)
    return _mapped(F.when(styled == "", name).otherwise(styled), rules.mapping)


def plan_names(columns: Sequence[str], rules: NameRules = CURRENT) -> dict[str, list[str]]:
    """Target names, in first-seen order, each with the raw columns that fill it."""
    plan: dict[str, list[str]] = {}
    for raw in columns:
        if raw not in rules.unwanted:
            plan.setdefault(rules.target(raw), []).append(raw)
    return plan


def vocabulary(rules: NameRules = CURRENT) -> list[str]:
    """All target names that have a meaning of their own."""
    by_year = [*vocab.CANONICAL_BY_YEAR.values(), *vocab.CANONICAL_EXTRA.values()]
    names = [name for names in (vocab.CANONICAL_CORE, *by_year) for name in names]
    fixed = [*vocab.CROSS_YEAR_EXTRAS, *vocab.NUMERIC_COLUMNS, *vocab.PRIVATE_COLUMNS]
    return list(dict.fromkeys([*rules.mapping.values(), *names, *fixed]))


def first_value(values: Sequence[Column]) -> Column:
    """First value that is there, taking the text "null" as missing and "" as a value."""
    return F.coalesce(*[F.nullif(value, F.lit("null")) for value in values])


def harmonise(table: DataFrame, rules: NameRules = CURRENT) -> DataFrame:
    """Drops unwanted columns, renames the others, and merges those of one purpose."""
    kinds = dict(table.dtypes)
    columns = []
    for target, raws in plan_names(table.columns, rules).items():
        values = [F.col(f"`{raw}`") for raw in raws]
        if {kinds[raw] for raw in raws} == {kinds[raws[0]]} and kinds[raws[0]] != "string":
            columns.append(F.coalesce(*values).alias(target))
        else:
            columns.append(first_value([v.cast("string") for v in values]).alias(target))
    return table.select(*columns)


def shared_targets(names: DataFrame, raw: str, rules: NameRules = CURRENT) -> DataFrame:
    """Raw names that share their target name with another raw name."""
    distinct = names.select(F.col(raw).alias("raw_name")).distinct()
    pairs = distinct.select(target_name(F.col("raw_name"), rules).alias("target"), "raw_name")
    names_of_target = F.count("*").over(Window.partitionBy("target"))
    return pairs.withColumn("_names", names_of_target).where("_names > 1").drop("_names")


def drop_columns(table: DataFrame, names: Sequence[str]) -> DataFrame:
    return table.drop(*[name for name in names if name in table.columns])


def drop_private(table: DataFrame) -> DataFrame:
    return drop_columns(table, vocab.PRIVATE_COLUMNS)


def to_numbers(table: DataFrame, names: Sequence[str] = vocab.NUMERIC_COLUMNS) -> DataFrame:
    """Price-like columns as numbers; blank is missing, other text fails the job."""
    present = {
        name: strict_number(F.col(name))
        for name in names
        if name in table.columns
    }
    return table.withColumns(present) if present else table


def hash_emails(table: DataFrame) -> DataFrame:
    """Hashes the `email` column of an export, where a missing cell reads as nan."""
    if "email" not in table.columns:
        return table
    return table.withColumn("email", sha256_text(F.col("email"), missing="nan"))


def missing_columns(present: Sequence[str], required: Sequence[str]) -> list[str]:
    return [name for name in dict.fromkeys(required) if name not in set(present)]


def require_columns(table: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = missing_columns(table.columns, required)
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))
    return table


def canonical_columns(year: int, group: str) -> list[str]:
    return [*vocab.CANONICAL_BY_YEAR[year], *vocab.CANONICAL_EXTRA[year, group]]


def names_of_all_years(
    names: DataFrame, name: str, year: str, years: Sequence[int], leave_out: Sequence[str] = ()
) -> DataFrame:
    """Names that occur in every one of the years, apart from those left out."""
    return (
        names.where(F.col(year).isin(*years) & ~F.col(name).isin(*leave_out))
        .select(name, year)
        .distinct()
        .groupBy(name)
        .agg(F.count("*").alias("years"))
        .where(F.col("years") == len(set(years)))
        .select(name)
    )


def union_by_name(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows under all columns; a column that a table lacks is missing in its rows."""
    first, *rest = tables
    for table in rest:
        first = first.unionByName(table, allowMissingColumns=True)
    return first
