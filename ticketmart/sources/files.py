"""Exported files and small configuration files."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmart.operators.filters import complete_rows
from ticketmart.vocab import EXPENSE_COLUMNS

# fixed values: cell texts that count as missing
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_cells(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """CSV with a header row, every cell as text.

    Cells may hold quoted commas, quotes and line breaks. One task reads a file
    with line breaks inside cells in its order; `read_split_cells` divides it.
    """
    return (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .csv(path)
    )


def _inside(line: str, inside: bool) -> bool:
    """Whether a line leaves its reader inside a quoted cell.

    A quote opens a cell only as its first character. A quoted cell goes on to a
    quote that is not doubled; what follows up to the next comma belongs to it.
    """
    at, end = 0, len(line)
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('""', at):
                at += 2
                continue
            inside, at = False, at + 1
            if at == end or line[at] != ",":  # at the end, or characters after the cell
                at = line.find(",", at)
                if at < 0:
                    return False
            at += 1
        elif at < end and line[at] == '"':
            inside, at = True, at + 1
        else:
            at = line.find(",", at)
            if at < 0:
                return False
            at += 1


@F.pandas_udf(T.IntegerType())
def _effects(lines: pd.Series) -> pd.Series:
    """Where a line leaves its reader: 1 if inside a cell when begun outside, and 2 when begun inside."""
    return lines.map(
        lambda line: _inside(line, False) + 2 * _inside(line, True) if '"' in line else 2
    ).astype("int32")


def _records(spark: SparkSession, path: str) -> DataFrame:
    """(file, number, text) of the records of CSV files, which may hold line breaks in cells.

    Every file is read in blocks, by lines. A line keeps its reader where it is,
    moves it to the other side of a quote, or leaves it on one side in any case; so
    what lines before it do to a line is a running sum of moves since the last
    line that decides. From how a block's lines move readers that begin outside
    and inside of a cell, sums over the blocks of a file give where each block
    begins and how many records began before it.
    """
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
            "value",
        )
        .withColumn("effect", _effects("value"))
    )
    in_block = Window.partitionBy("file", "block").orderBy("line")
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    moves = F.when(F.col("effect") == 1, 1).otherwise(0)  # outside to inside, inside to outside
    decided = F.when(F.col("effect") == 0, 0).when(F.col("effect") == 3, 1)
    placed = (
        lines.withColumn("moved", F.coalesce(F.sum(moves).over(before), F.lit(0)))
        .withColumn("decided", decided.bitwiseXOR((F.col("moved") % 2).cast("int")))
        .withColumn("ruled", F.last("decided", ignorenulls=True).over(before))
        .withColumn("empty", F.rtrim(F.col("value"), F.lit("\r")) == "")
    )

    def inside(begun: Column) -> Column:
        """Whether a line begins inside a cell, if its block begins there."""
        return F.coalesce("ruled", begun).bitwiseXOR((F.col("moved") % 2).cast("int"))

    def starts(begun: Column) -> Column:
        return (inside(begun) == 0) & ~F.col("empty")

    def left(begun: int) -> Column:
        """Where a block's last line leaves a reader that begins the block there."""
        return F.max_by(F.getbit("effect", inside(F.lit(begun))), F.col("line")).cast("int")

    blocks = placed.groupBy("file", "block").agg(
        *[left(begun).alias(f"left_{begun}") for begun in (0, 1)],
        *[F.count_if(starts(F.lit(begun))).alias(f"starts_{begun}") for begun in (0, 1)],
        F.min_by(F.endswith("value", F.lit("\r")), F.col("line")).alias("crlf"),
    )
    # the same sums again, over blocks
    in_file = Window.partitionBy("file").orderBy("block")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    swaps = (F.col("left_0") == 1) & (F.col("left_1") == 0)
    known = F.when(F.col("left_0") == F.col("left_1"), F.col("left_0"))
    blocks = (
        blocks.withColumn("moves", F.coalesce(F.sum(swaps.cast("int")).over(earlier), F.lit(0)) % 2)
        .withColumn("fixed", known.bitwiseXOR(F.col("moves").cast("int")))
        .withColumn("fixed", F.last("fixed", ignorenulls=True).over(earlier))
        .withColumn("begun", F.coalesce("fixed", F.lit(0)).bitwiseXOR(F.col("moves").cast("int")))
        .withColumn("own", F.when(F.col("begun") == 1, F.col("starts_1")).otherwise(F.col("starts_0")))
        .withColumn("records", F.coalesce(F.sum("own").over(earlier), F.lit(0)))
        .withColumn("crlf", F.first("crlf").over(in_file))  # as the first line of a file ends, all do
        .select("file", "block", "begun", "records", "crlf")
    )
    so_far = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = (
        placed.join(blocks, ["file", "block"])
        .withColumn("starts", starts(F.col("begun")))
        .withColumn("within", inside(F.col("begun")))
        .withColumn("number", F.col("records") + F.count_if("starts").over(so_far))
        .where(F.col("starts") | (F.col("within") == 1))
    )
    whole = F.col("starts") & (F.col("effect").bitwiseAND(F.lit(1)) == 0)
    cut = numbered.where(~whole).groupBy("file", "number", "crlf").agg(  # the lines of one record
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("block", "line", "value"))),
                lambda line: line["value"],
            ),
            "\n",
        ).alias("text")
    )
    records = numbered.where(whole).select("file", "number", "crlf", F.col("value").alias("text"))
    plain = F.regexp_replace("text", r"\r(\n|\z)", "$1")
    text = F.when(F.col("crlf"), plain).otherwise(F.col("text"))
    return records.unionByName(cut).select("file", "number", text.alias("text"))


def read_split_cells(spark: SparkSession, path: str) -> DataFrame:
    """What `read_cells` gives, from files that are divided among tasks also inside of cells.

    The header is read by itself. Lines end with a line feed, after a carriage return
    if the first line of their file does. The order of the rows is lost.
    """
    names = read_cells(spark, path).columns
    if not names:
        return read_cells(spark, path)
    holders = [f"c{place}" for place in range(len(names))]
    cells = F.from_csv(
        "text",
        ", ".join(f"{name} string" for name in holders),
        {"quote": '"', "escape": '"', "multiLine": "true"},
    )
    rows = _records(spark, path).where("number > 1").select(cells.alias("cells"))
    return rows.select(
        *[F.col("cells")[h].alias(name) for h, name in zip(holders, names, strict=True)]
    )


def missing_to_null(table: DataFrame, texts: Sequence[str] = MISSING_TEXTS) -> DataFrame:
    return table.select(
        *[
            F.when(~F.col(f"`{name}`").cast("string").isin(*texts), F.col(f"`{name}`")).alias(name)
            for name in table.columns
        ]
    )


def read_export(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """Exported table as text, with missing cells as null. Casts are made where types matter.

    A large file is read by many tasks. `tasks` spreads the rows for heavy work after.
    """
    cells = read_split_cells(spark, path)
    return missing_to_null(cells.repartition(tasks) if tasks else cells)


def read_survey(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Survey export: byte order mark skipped, header cells stripped, blank cells kept."""
    table = read_cells(spark, path, multi_line)
    return table.toDF(*[name.lstrip("﻿").strip() for name in table.columns]).na.fill("")


def read_expense_sheet(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Complete rows of an expense sheet under the warehouse's names, by position."""
    return expense_rows(read_cells(spark, path, multi_line))


def expense_rows(sheet: DataFrame) -> DataFrame:
    cells = missing_to_null(sheet, ("",))
    text = cells.select(*[F.col(f"`{name}`").cast("string") for name in cells.columns])
    return complete_rows(text.toDF(*EXPENSE_COLUMNS))


def _whole_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first().value


def read_meta_fields(spark: SparkSession, path: str) -> dict[str, str]:
    """Payload field to export column, as JSON; two fields must not share a column."""
    fields = json.loads(_whole_text(spark, path))
    if len(set(fields.values())) != len(fields):
        raise ValueError(f"{path}: an export column is mapped twice")
    return fields


def read_field_names(spark: SparkSession, path: str) -> list[str]:
    """Question names, one per line; blank lines are skipped."""
    lines = [line.strip() for line in _whole_text(spark, path).splitlines()]
    return [line for line in lines if line]
