"""Mixing of sources to target weights by subset sums over exact document lengths.

The sources share the words of all documents by weight; a source that would need
more than `most` times its own words stops there, and the others share the rest.
A target that is larger than its source takes the source whole, once or more
often; what remains is a budget of words that some documents of the source fill.

Documents are counted by source and exact length. All but a few of the longest
documents' words are shared out: a running share, from the longest to the
shortest, takes from every length its part and leaves less than one document. A
bounded-knapsack search over the remaining documents per length comes as near to
the rest of the budget as any choice of them can. Which documents of a length are
taken is decided by seeded hashes of their ids.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmart.llm.common import column, materialise, unused
from ticketmart.operators.joins import join_on
from ticketmart.operators.numbering import number_in_order

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = 12
#: Longest documents' words that are left to the knapsack search.
SLACK = 8
#: Words that the knapsack search looks at; a larger rest is first filled by long documents.
SEARCHED = 1 << 22


def word_count(text: Column) -> Column:
    """Number of words between blanks of ASCII; null has none."""
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(words, F.lit(0)).cast("long")


def nearest_counts(
    lengths: Sequence[int], spare: Sequence[int], rest: int, seed: int = SEED
) -> dict[int, int]:
    """How many documents of each length come nearest to `rest` words together.

    Of two sums that are equally near the smaller one counts; lengths are tried in
    a seeded order until one sum is the rest itself. Sums up to twice the
    rest are searched, as taking none is nearer than any beyond. Where that is more
    than SEARCHED words, the longest documents that fit are taken first.
    """
    stock = {int(n): int(c) for n, c in zip(lengths, spare, strict=True) if n > 0 and c > 0}
    taken: dict[int, int] = {}
    for length in sorted(stock, reverse=True):
        if 2 * rest <= SEARCHED:
            break
        if count := min(stock[length], rest // length):
            taken[length] = count
            stock[length] -= count
            rest -= count * length
    if 2 * rest > SEARCHED:  # every document left is longer than the rest
        above = min((n for n, c in stock.items() if c), default=0)
        if rest < above < 2 * rest:
            taken[above] = taken.get(above, 0) + 1
        return taken
    span = 2 * rest
    reached = np.zeros(span + 1, bool)
    reached[0] = True
    last = np.full(span + 1, -1, np.int32)  # the chunk that first reached each sum
    chunks: list[tuple[int, int]] = []
    for length in np.random.default_rng(seed).permutation(sorted(stock)).tolist():
        left, size = min(stock[length], span // length), 1
        while left and not reached[rest]:
            size = min(size, left)
            weight = size * length
            fresh = np.flatnonzero(reached[: span + 1 - weight] & ~reached[weight:]) + weight
            last[fresh] = len(chunks)
            reached[fresh] = True
            chunks.append((length, size))
            left -= size
            size *= 2
        if reached[rest]:
            break
    sums = np.flatnonzero(reached)
    at = int(sums[np.abs(sums - rest).argmin()])
    while at:
        length, size = chunks[last[at]]
        taken[length] = taken.get(length, 0) + size
        at -= length * size
    return taken


def _decimal(name: str) -> Column:
    return F.col(name).cast("decimal(18,0)")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """(source, no, source_size, target, whole, budget) per source of rows (source, size).

    Sources are ordered by code point, null last, and take the weights in turn.
    `whole` is how often the target holds the source, `budget` the words beyond.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    keyed = totals.withColumn("no_name", F.col("source").isNull())
    numbered = number_in_order(keyed, ["no_name", "source"]).withColumnRenamed("start", "no")
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("no") % len(weights)).cast("int") + 1
    )
    sources = materialise(numbered.withColumn("weight", weight.cast("long")), "sources")
    whole, share = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    whole, share = whole or 0, share or 1
    at_most = F.col("source_size") * most

    def full(words: int, of: int) -> Column:
        """Whether the share would be above the most that the source may give."""
        return _decimal("weight") * F.lit(words).cast("decimal(18,0)") > _decimal(
            "source_size"
        ) * F.lit(most * of).cast("decimal(18,0)")

    words, of, stopped = whole, share, -1
    while whole:  # every round stops further sources, so this ends
        capped = full(words, of)
        n, used, gone = sources.where(capped).agg(
            F.count("*"), F.sum(at_most), F.sum("weight")
        ).first()
        if n == stopped:
            break
        stopped, words, of = n, whole - (used or 0), share - (gone or 0)
    capped = full(words, of)
    shared = _decimal("weight") * F.lit(words).cast("decimal(18,0)")
    exact = F.when(capped, _decimal("source_size") * (most * of)).otherwise(shared)
    parts = sources.select(
        "source",
        "no",
        "source_size",
        F.when(capped, at_most.cast("double"))
        .otherwise(F.col("weight").cast("double") * float(words) / float(of))
        .alias("target"),
        exact.alias("exact"),
        (_decimal("source_size") * F.lit(of).cast("decimal(18,0)")).alias("own"),
    )  # exact and own are `of` times as large as the target and the source
    times = F.expr("CASE WHEN source_size = 0 THEN 0 ELSE exact DIV own END").cast("int")
    beyond = (F.col("exact") - F.col("whole") * F.col("own")).cast("double") / float(of)
    budget = F.least(F.round(beyond).cast("long"), F.col("source_size"))
    return (
        parts.withColumn("whole", times).withColumn("budget", budget).drop("exact", "own")
    )


def _searched(groups: DataFrame, seed: int) -> DataFrame:
    """(no, size, more): documents that the knapsack search adds per source and length.

    A group is one source's different lengths, at most as many as the longest of its
    documents has words, whatever the number of documents.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        found = nearest_counts(group["size"], group["spare"], int(group["rest"].iloc[0]), seed)
        rows = {"no": group["no"].iloc[0], "size": list(found), "more": list(found.values())}
        return pd.DataFrame(rows, columns=["no", "size", "more"])

    return groups.groupBy("no").applyInPandas(run, "no long, size long, more long")


def repeats(
    rows: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: int = SEED
) -> DataFrame:
    """Rows (doc_id, source, size, node) with source_size, target and how often each is taken.

    `node` tells rows apart. Rows with null ids are ordered by their nodes alone.
    """
    targets = materialise(source_targets(rows, weights, most), "targets")
    placed = join_on(rows, targets.select("source", "no", "whole"), ["source"], "inner")
    order = ["no", "shorter", "hash", "node"]
    numbered = number_in_order(
        placed.withColumns(
            {
                "shorter": -F.col("size"),
                "hash": F.xxhash64(F.lit(seed), F.col("doc_id").cast("string")),
            }
        ),
        order,
    ).withColumnRenamed("start", "at")

    lengths = placed.groupBy("no", "size").agg(F.count("*").alias("n"))
    counted = materialise(
        number_in_order(lengths.withColumn("shorter", -F.col("size")), ["no", "shorter"], "n"),
        "lengths",
    )
    first = counted.groupBy("no").agg(
        F.min("start").alias("first"), (F.max("size") * SLACK).alias("slack")
    )
    budgets = targets.select("no", "source_size", "budget")
    shares = join_on(join_on(counted, first, ["no"], "inner"), budgets, ["no"], "inner")
    shares = shares.withColumn("before", F.col("start") - F.col("first")).withColumn(
        "shared", F.greatest(F.col("budget") - F.col("slack"), F.lit(0))
    )
    part = "CAST({0} AS DECIMAL(19,0)) * CAST(shared AS DECIMAL(18,0)) DIV CAST(source_size AS DECIMAL(19,0))"
    taken = F.when(
        F.col("source_size") > 0,
        F.expr(part.format("before + n")) - F.expr(part.format("before")),
    ).otherwise(0)
    shares = materialise(shares.withColumn("taken", taken.cast("long")), "shares")
    left = shares.groupBy("no").agg(
        (F.max("budget") - F.sum(F.col("taken") * F.col("size"))).alias("rest")
    )
    open_lengths = join_on(shares, left.where("rest > 0"), ["no"], "inner").where(
        (F.col("size") > 0) & (F.col("n") > F.col("taken")) & (F.col("size") <= 2 * F.col("rest"))
    )
    more = _searched(
        open_lengths.select("no", "size", (F.col("n") - F.col("taken")).alias("spare"), "rest"), seed
    )
    chosen = join_on(shares, more, ["no", "size"], "left").select(
        "no", "size", "start", (F.col("taken") + F.coalesce("more", F.lit(0))).alias("chosen")
    )
    known = targets.select("no", "source_size", "target")
    picked = join_on(numbered, chosen, ["no", "size"], "inner")
    return join_on(picked, known, ["no"], "inner").select(
        "doc_id",
        "source",
        "size",
        "node",
        "source_size",
        "target",
        (F.col("whole") + (F.col("at") - F.col("start") < F.col("chosen")).cast("int")).alias(
            "repeats"
        ),
    )


def _rows(docs: DataFrame, node: str) -> DataFrame:
    return docs.select(
        column("doc_id").alias("doc_id"),
        column("source").alias("source"),
        word_count(column("text")).alias("size"),
        column(node).alias("node"),
    )


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    node = unused(docs, "node")
    return docs.withColumn(node, F.monotonically_increasing_id()), node


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken.

    A null text has no words and a null source is a source of its own, the last
    one. Documents that repeat an id are documents of their own; those without an
    id are equal to the seed. An empty text is taken too, with no words. Extra
    columns are ignored and an empty table gives an empty result.
    """
    # written before use: the numbers have to stay the same
    rows = materialise(_rows(*_numbered(docs)), "sizes")
    return repeats(rows, weights, seed=seed).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("repeats") * F.col("size")).cast("long").alias("taken"),
    )


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """The mix itself: all columns of the documents, every one as often as it is taken."""
    numbered, node = _numbered(docs)
    held = materialise(numbered, "documents")
    rows = materialise(_rows(held, node), "sizes")
    often = repeats(rows, weights, seed=seed).where("repeats > 0")
    often = often.select(F.col("node").alias("_taken_node"), F.col("repeats").alias("_often"))
    met = held.join(often, held[f"`{node}`"] == often["_taken_node"])
    times = unused(held, "_copy")
    return met.withColumn(times, F.explode(F.sequence(F.lit(1), F.col("_often")))).select(
        *[column(name) for name in docs.columns]
    )
