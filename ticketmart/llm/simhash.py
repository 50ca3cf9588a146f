"""SimHash near-dedup with pivot distance tables.

A fingerprint has 64 bits. Two documents link if their fingerprints differ in at
most two bits, and components of links are groups of near copies.

The bits are cut into five blocks. For every fingerprint a table holds its
Hamming distances, block by block, to 16 reference fingerprints (the pivots).
Two differing bits touch at most two blocks, so a linked pair agrees in three
whole blocks at least, and there its distances to all pivots are equal. Each
choice of three blocks gives one key of pivot distances; fingerprints that share
a key are candidates. A candidate pair is discarded if the distance to any pivot
differs by more than two, which the triangle inequality rules out for a link,
and the survivors are verified bit by bit. No link is lost.

A key that very many fingerprints share is not expanded into pairs. There every
fingerprint is sent to the 65 values at distance zero or one of it: two
fingerprints link exactly if they meet at one of those, and whoever meets is
linked to the least one, which leaves the components the same.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmart.llm.common import column, map_text, materialise, unused
from ticketmart.llm.components import components
from ticketmart.operators.joins import join_on

SEED = 42
PIVOTS = 16
#: Starts of the blocks of bits, and the end.
EDGES = (0, 13, 26, 39, 52, 64)
#: A key shared by more fingerprints than this goes the way without pairs.
PAIRED = 32

#: Shingles of a text whose bits are held at once.
CHUNK = 1 << 14

_ALL = (1 << 64) - 1


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _pivots() -> list[int]:
    return [xxhash.xxh64_intdigest(f"pivot {i}".encode(), SEED) for i in range(PIVOTS)]


def fingerprint(text: str | None, width: int = 3) -> int:
    """Fingerprint of a text; zero for a text without words, null included."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    digest = xxhash.xxh64_intdigest
    sums, total, left = np.zeros(64, np.int64), 0, iter(shingles)
    while some := [digest(shingle, SEED) for shingle in islice(left, CHUNK)]:
        hashes = np.array(some, dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums += bits.sum(axis=0, dtype=np.int64)
        total += len(some)
    return int(np.packbits(sums * 2 > total, bitorder="little").view("<u8")[0])


def with_fingerprints(
    docs: DataFrame, name: str, text: str = "text", width: int = 3, keep: list[str] | None = None
) -> DataFrame:
    """Adds the fingerprint of a text column as a long, the bits as they are."""

    def work(texts: list[str | None]) -> list[pa.Array]:
        return [pa.array([_signed(fingerprint(value, width)) for value in texts], pa.int64())]

    return map_text(docs, text, f"`{name}` long", work, keep)


def _distances(first: int, last: int) -> Column:
    """Distances to the pivots over a block of bits, four bits each in one long."""
    mask = _signed((_ALL >> (64 - last + first)) << first)
    parts = [
        F.shiftleft(
            F.bit_count(
                F.col("print").bitwiseXOR(F.lit(_signed(pivot))).bitwiseAND(F.lit(mask))
            ).cast("long"),
            4 * i,
        )
        for i, pivot in enumerate(_pivots())
    ]
    return reduce(Column.bitwiseOR, parts)


def _farthest() -> Column:
    """Largest difference between two candidates' distances to a pivot."""
    return F.greatest(
        *[
            F.abs(
                F.bit_count(F.col("print").bitwiseXOR(F.lit(_signed(pivot))))
                - F.bit_count(F.col("other").bitwiseXOR(F.lit(_signed(pivot))))
            )
            for pivot in _pivots()
        ]
    )


def pivot_links(prints: DataFrame, distance: int = 2) -> DataFrame:
    """(print, other) links that connect all distinct fingerprints within the distance.

    The links keep every component together; in crowded keys a link goes to the
    least fingerprint of a meeting point, not to every other one.
    """
    if not 0 <= distance <= 2:
        raise ValueError("the blocks are cut for distances up to two bits")
    blocks = list(zip(EDGES, EDGES[1:], strict=False))
    tables = prints.select("print", *[_distances(*b).alias(f"b{i}") for i, b in enumerate(blocks)])
    choices = combinations(range(len(blocks)), len(blocks) - 2)
    keyed = tables.select(
        "print",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("choice"),
                        F.xxhash64(*[F.col(f"b{j}") for j in chosen]).alias("key"),
                    )
                    for i, chosen in enumerate(choices)
                ]
            )
        ).alias("at"),
    ).select("at.choice", "at.key", "print")
    crowded = (
        keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).filter(F.col("n") > PAIRED)
    ).select("choice", "key")

    sparse = join_on(keyed, crowded, ["choice", "key"], "left_anti")
    pairs = (
        sparse.join(sparse.withColumnRenamed("print", "other"), ["choice", "key"])
        .filter(F.col("print") < F.col("other"))
        .filter(_farthest() <= distance)
        .filter(F.bit_count(F.col("print").bitwiseXOR(F.col("other"))) <= distance)
        .select("print", "other")
    )
    dense = join_on(keyed, crowded, ["choice", "key"], "left_semi").select("print").distinct()
    return pairs.unionByName(_meetings(dense, distance)).distinct()


def _meetings(prints: DataFrame, distance: int) -> DataFrame:
    flips = [0, *[_signed(1 << i) for i in range(64)]] if distance else [0]
    near = prints.select(
        "print",
        F.explode(F.array(*[F.lit(flip) for flip in flips])).alias("flip"),
    ).select("print", F.col("print").bitwiseXOR(F.col("flip")).alias("point"))
    if distance == 1:  # both ends have to be one of the two
        near = near.join(prints.select(F.col("print").alias("point")), "point", "left_semi")
    least = near.groupBy("point").agg(F.min("print").alias("other"), F.max("print").alias("most"))
    return (
        join_on(near, least.filter("other < most"), ["point"], "inner")
        .filter(F.col("print") > F.col("other"))
        .select(F.col("other").alias("print"), F.col("print").alias("other"))
    )


def groups(rows: DataFrame, key: str, distance: int = 2) -> DataFrame:
    """(print, component, component_id) for each fingerprint.

    The component is its least fingerprint, component_id the least key its
    documents have. `rows` has the columns `print` and the key; it is read several times, so it
    should be a written table.
    """
    prints = materialise(
        rows.groupBy("print").agg(F.min(column(key)).alias("least")), "fingerprints"
    )
    joined = components(pivot_links(prints, distance), "print", "other")
    placed = prints.join(joined.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "least", F.coalesce("component", "print").alias("component")
    )
    ends = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    return join_on(placed, ends, ["component"], "inner").select(
        "print", "component", "component_id"
    )


def near_duplicates(docs: DataFrame, distance: int = 2, width: int = 3) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id.

    Null and empty texts have fingerprint zero and link like any other. A null
    doc_id never becomes a component_id unless its whole component has none.
    Repeated rows give repeated results, extra columns are ignored, and an empty
    table gives an empty result.
    """
    rows = materialise(
        with_fingerprints(
            docs.select(column("doc_id").alias("doc_id"), column("text").alias("text")),
            "print",
            width=width,
            keep=["doc_id"],
        ),
        "printed",
    )
    return join_on(rows, groups(rows, "doc_id", distance), ["print"], "inner").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def without_near_duplicates(docs: DataFrame, distance: int = 2, width: int = 3) -> DataFrame:
    """The documents with one of each group of near copies, the one with the least doc_id.

    Of rows that share that doc_id within a group, one stays.
    """
    name = unused(docs, "_print")
    held = materialise(with_fingerprints(docs, name, width=width), "printed")
    rows = held.select(column(name).alias("print"), column("doc_id").alias("doc_id"))
    found = groups(rows, "doc_id", distance)
    least = (
        join_on(rows, found, ["print"], "inner")
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("component", F.col("component_id").alias("doc_id"))
        .agg(F.min("print").alias(name))
    )
    return (
        join_on(held, least, ["doc_id", name], "left_semi")
        .dropDuplicates(["doc_id", name])
        .select(*[column(c) for c in docs.columns])
    )
