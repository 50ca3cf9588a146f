"""Reports as message rows.

A message is one text, so it cannot grow with the data: lines are numbered in
order over all partitions and joined into messages of a number of lines that
the caller sets. With no more lines than that, the report is one message.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmart.config import moment
from ticketmart.functions.text import thousands
from ticketmart.operators.numbering import number_in_order
from ticketmart.operators.statistics import sales_totals
from ticketmart.vocab import EXPENSE_COLUMNS, TICKET_PRICES

# messages whose lines one task repeats at a time, when a line occurs very often
_BLOCK = 1000


def messages(
    lines: DataFrame, order: Sequence[str], text: str, lines_per_message: int
) -> DataFrame:
    """(part, content): the lines in order, newline-joined, a bounded number per message."""
    size = lines_per_message
    counted = lines.groupBy(*order, text).agg(F.count("*").alias("copies"))
    keys = [*order, text]
    numbered = number_in_order(counted, keys, weight="copies").select(
        F.col(text).alias("line"),
        "start",
        (F.col("start") + F.col("copies")).alias("stop"),
    )
    first = F.floor(F.col("start") / size)
    last = F.floor((F.col("stop") - 1) / size)
    blocks = numbered.select(
        "*",
        first.alias("first"),
        last.alias("last"),
        F.explode(F.sequence(F.floor(first / _BLOCK), F.floor(last / _BLOCK))).alias("block"),
    ).repartition("block")
    parts = blocks.select(
        "*",
        F.explode(
            F.sequence(
                F.greatest("first", F.col("block") * _BLOCK),
                F.least("last", F.col("block") * _BLOCK + (_BLOCK - 1)),
            )
        ).alias("part"),
    )
    copies = F.least("stop", (F.col("part") + 1) * size) - F.greatest(
        "start", F.col("part") * size
    )
    entry = F.struct("start", "line", copies.cast("int").alias("copies"))
    joined = F.flatten(
        F.transform(
            F.array_sort(F.collect_list(entry)),
            lambda item: F.array_repeat(item["line"], item["copies"]),
        )
    )
    return (
        parts.groupBy("block", "part")
        .agg(F.array_join(joined, "\n").alias("content"))
        .select(F.col("part").cast("long"), "content")
    )


def expense_lines(expenses: DataFrame) -> DataFrame:
    text = F.format_string("%s, 花費: %s, %s, %s", "Reason", "Price", "Team_name", "Details")
    return expenses.select(*EXPENSE_COLUMNS, text.alias("line"))


def expense_message(expenses: DataFrame, lines_per_message: int) -> DataFrame:
    """New expenses as messages, in the order of all columns; `no data` if there are none."""
    lines = expense_lines(expenses)
    none = (
        lines.limit(1)
        .agg(F.count("*").alias("n"))
        .where("n = 0")
        .select(F.lit(0).cast("long").alias("part"), F.lit("no data").alias("content"))
    )
    return messages(lines, EXPENSE_COLUMNS, "line", lines_per_message).unionByName(none)


@dataclass(frozen=True)
class SalesWords:
    """Wording of the sales message: header, a line per ticket, and totals."""

    head: str = "Tickets sold up to "
    ticket: str = "  %s: %d"
    total: str = "%d tickets in all, worth TWD %s"


def _sales_lines(
    counts: DataFrame,
    day: Column,
    year: int,
    dashboard: str,
    prices: Mapping[str, int],
    words: SalesWords,
) -> DataFrame:
    one = counts.sparkSession.range(1)
    head = F.concat(F.lit(words.head), F.date_format(day, "yyyy-MM-dd"))
    ticket = F.format_string(words.ticket, "ticket_name", "counts")
    foot = F.format_string(
        f"{dashboard}?year={year}\n{words.total}", "total", thousands(F.col("total_income"))
    )

    def lines(rows: DataFrame, section: int, name: Column, text: Column) -> DataFrame:
        return rows.select(F.lit(section).alias("section"), name.alias("name"), text.alias("line"))

    return (
        lines(one, 0, F.lit(""), head)
        .unionByName(lines(counts, 1, F.col("name"), ticket))
        .unionByName(lines(sales_totals(counts, prices), 2, F.lit(""), foot))
    )


def sales_message(
    counts: DataFrame,
    year: int,
    dashboard: str,
    as_of: datetime | str | None = None,
    prices: Mapping[str, int] = TICKET_PRICES,
    *,
    lines_per_message: int,
    words: SalesWords = SalesWords(),
) -> DataFrame:
    """Header, one line per ticket of each event, and totals."""
    lines = _sales_lines(counts, moment(as_of), year, dashboard, prices, words)
    return messages(lines, ["section", "line", "name"], "line", lines_per_message)
