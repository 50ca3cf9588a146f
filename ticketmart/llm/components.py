"""Connected components of a link table, by alternating large and small stars.

Every round joins links with the least neighbour of their ends and writes the
new links to the shared folder. No component is ever gathered in one task: the
least neighbour is an aggregate that is combined before the shuffle, and a node
with very many links is split by adaptive execution, because both sides of the
join come straight from a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmart.llm.common import discard, materialise
from ticketmart.operators.joins import join_on


def _state(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))
        ).first()
    )


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
        links.select(F.col("low").alias("node"), F.col("high").alias("other"))
    )
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    return (
        join_on(both.filter("other > node"), least, ["node"], "inner")
        .select(F.col("other").alias("high"), F.least("node", "least").alias("low"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("high").agg(F.min("low").alias("least"))
    moved = join_on(links, least, ["high"], "inner").filter("low > least")
    return (
        moved.select(F.col("low").alias("high"), F.col("least").alias("low"))
        .unionByName(least.select("high", F.col("least").alias("low")))
        .distinct()
    )


def components(links: DataFrame, one: str, other: str) -> DataFrame:
    """(node, component) for every node that has a link; the component is its least node.

    Null ends and links of a node with itself are ignored; links may repeat and
    may point either way. Without links the result is empty.
    """
    held = materialise(
        links.select(
            F.greatest(F.col(one), F.col(other)).alias("high"),
            F.least(F.col(one), F.col(other)).alias("low"),
        )
        .filter(F.col(one).isNotNull() & F.col(other).isNotNull() & (F.col("high") > F.col("low")))
        .distinct(),
        "links",
    )
    state = _state(held)
    while state[0]:
        following = materialise(_small_star(_large_star(held)), "links")
        discard(held)
        held, before = following, state
        state = _state(held)
        if state == before:
            break
    stars = held.select(F.col("high").alias("node"), F.col("low").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component")).distinct()
