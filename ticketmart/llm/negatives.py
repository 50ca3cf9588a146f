"""Hard negatives by Strassen multiplication of tiles of whole numbers.

Every vector becomes a row of whole numbers, and a score is the inner product of
two such rows. Anchors and candidates are cut into stripes of a fixed size; every
two stripes meet in a cell of its own, where one tile of scores is multiplied by
Strassen's recursion: operands are padded with zeros to even sides, seven
products take the place of eight, and all sums are exact in 64 bits.

Positives come first, from cells of anchors and candidates of one label. A
second round lets the anchors, which now carry the scores of their positives,
meet all candidates and keeps for every positive the best rows of its window.
Both rounds keep heaps of a few rows per anchor, which merge over the cells of a
task and then by a window over all tasks; no scores are stored or shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketmart.llm.common import column, materialise, stretches
from ticketmart.operators.joins import join_on

#: Side of a tile from which on the recursion multiplies plainly.
LEAF = 16
#: Scores, in absolute value, are below this, so that four times a score fits 64 bits.
LARGEST = 2**60


@dataclass(frozen=True)
class Mining:
    """What to mine: numbers of positives and negatives, the window, and sizes of stripes.

    The window of a positive of score p holds scores from `low`/`high` of p up to p.
    """

    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100
    anchors: int = 512
    candidates: int = 4096


def _leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Plain product; in doubles where these hold every sum exactly."""
    if not a.size or not b.size:
        return a @ b
    largest = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if largest < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def _even(a: np.ndarray) -> np.ndarray:
    return np.pad(a, [(0, side % 2) for side in a.shape]) if any(s % 2 for s in a.shape) else a


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Product of two int64 matrices, exact wherever its entries fit 64 bits.

    Sums inside the recursion may wrap around, which cancels out as all steps are
    exact modulo 2**64.
    """
    rows, columns = a.shape[0], b.shape[1]
    if min(rows, a.shape[1], columns) <= leaf:
        return _leaf(a, b)
    a, b = _even(a), _even(b)
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out[:rows, :columns]


def _matrix(part: pa.RecordBatch, width: int) -> np.ndarray:
    """The vectors of a batch as rows, shorter ones padded with zeros."""
    lists = part.column("v")
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy()[offsets[0] : offsets[-1]]
    widths = np.diff(offsets)
    if (widths == width).all():
        return values.reshape(len(widths), width)
    out = np.zeros((len(widths), width), np.int64)
    out[np.arange(width)[None, :] < widths[:, None]] = values
    return out


def _scores(anchors: pa.RecordBatch, others: pa.RecordBatch) -> np.ndarray:
    width = max(int(np.diff(p.column("v").offsets.to_numpy()).max()) for p in (anchors, others))
    a, b = _matrix(anchors, width), _matrix(others, width)
    if width:
        sides = [max(1.0, float(np.abs(m.astype(np.float64)).max())) for m in (a, b)]
        if sides[0] * sides[1] * width >= LARGEST:
            raise OverflowError("scores of these vectors do not fit 64 bits; scale them down")
    return strassen(a, np.ascontiguousarray(b.T))


def best_of(keys: list[np.ndarray], score: np.ndarray, name: np.ndarray, count: int) -> np.ndarray:
    """Places of the first `count` entries of every key: higher scores first, then smaller names."""
    order = np.lexsort((name, -score, *reversed(keys)))
    if not len(order):
        return order
    sorted_keys = [key[order] for key in keys]
    fresh = np.ones(len(order), bool)
    fresh[1:] = np.any([key[1:] != key[:-1] for key in sorted_keys], axis=0)
    starts = np.flatnonzero(fresh)
    rank = np.arange(len(order)) - np.repeat(starts, np.diff([*starts, len(order)]))
    return order[rank < count]


Entries = tuple[np.ndarray, ...]
#: Entries (anchor, place, score, name) of one cell, from its tile of scores.
Pick = Callable[[pa.RecordBatch, pa.RecordBatch, np.ndarray], Entries]


def _heaps(met: DataFrame, run: list[str], pick: Pick, count: int) -> DataFrame:
    """(anchor, place, score, name): the best entries, merged over the cells of each task.

    Cells of one stripe of anchors follow each other, so at most one stripe's heaps are held.
    """
    schema = "anchor long, place int, score long, name long"

    def merged(held: list[Entries]) -> Entries:
        anchor, place, score, name = (np.concatenate(parts) for parts in zip(*held, strict=True))
        best = best_of([anchor, place], score, name, count)
        return anchor[best], place[best], score[best], name[best]

    def batch(entries: Entries) -> pa.RecordBatch:
        anchor, place, score, name = entries
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor), pa.array(place.astype(np.int32)), pa.array(score), pa.array(name)],
            names=["anchor", "place", "score", "name"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Entries | None = None
        stripe = None
        for part in stretches(batches, [*run, "block"]):
            here = tuple(part.column(k)[0].as_py() for k in run)
            if held is not None and here != stripe:
                yield batch(held)
                held = None
            stripe = here
            first = int(part.column("is_anchor").to_numpy(zero_copy_only=False).sum())
            anchors, others = part.slice(0, first), part.slice(first)
            if anchors.num_rows and others.num_rows:
                entries = pick(anchors, others, _scores(anchors, others))
                held = merged([entries] if held is None else [held, entries])
        if held is not None:
            yield batch(held)

    return met.mapInArrow(work, schema)


def _best_rows(heaps: DataFrame, count: int) -> DataFrame:
    """Heaps of all tasks merged; Spark keeps `count` rows per key before the shuffle too."""
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "name")
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def _stripe(count: Column, size: int) -> Column:
    """Stripe of a row among those of `count` rows."""
    return F.pmod(F.xxhash64("node"), F.ceil(count / size)).cast("int")


def _every(count: Column, size: int) -> Column:
    """All stripes of `count` rows; none if there are no rows."""
    last = F.ceil(count / size).cast("int") - 1
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _met(anchors: DataFrame, others: DataFrame, run: list[str], cells: int) -> DataFrame:
    """Rows of both kinds by cell, anchors of each cell first."""
    keys = [*run, "block"]
    return (
        anchors.unionByName(others, allowMissingColumns=True)
        .repartition(max(1, min(2 * cells, 10_000)), *[F.col(k) for k in keys])
        .sortWithinPartitions(*keys, F.desc("is_anchor"), "vec_id")
    )


def _pick_positives(count: int) -> Pick:
    def pick(anchors: pa.RecordBatch, others: pa.RecordBatch, scores: np.ndarray) -> Entries:
        own = anchors.column("vec_id").to_numpy()
        names = others.column("vec_id").to_numpy()
        other = names[None, :] != own[:, None]
        if len(names) > count + 1:  # only scores as high as the last that can be among the best
            at = scores.shape[1] - count
            least = np.where(other, scores, np.iinfo(np.int64).min)
            other &= scores >= np.partition(least, at, axis=1)[:, at][:, None]
        row, col = np.nonzero(other)
        score, name = scores[row, col], names[col]
        best = best_of([row], score, name, count)
        node = anchors.column("node").to_numpy()
        return node[row[best]], np.zeros(len(best), np.int64), score[best], name[best]

    return pick


def _pick_negatives(mining: Mining) -> Pick:
    def pick(anchors: pa.RecordBatch, others: pa.RecordBatch, scores: np.ndarray) -> Entries:
        lists = anchors.column("positive_scores")
        offsets = lists.offsets.to_numpy()
        counts = np.diff(offsets)
        top = np.full((len(counts), max(1, int(counts.max()))), -1, np.int64)
        inside = np.arange(top.shape[1])[None, :] < counts[:, None]
        top[inside] = lists.values.to_numpy()[offsets[0] : offsets[-1]]
        usable = inside & (top >= 0)  # no score lies in the window of a negative one
        low = np.array([-(-mining.low * p // mining.high) for p in top.ravel().tolist()], np.int64)
        low = low.reshape(top.shape)
        least = np.where(usable, low, np.iinfo(np.int64).max).min(axis=1)
        most = np.where(usable, top, -1).max(axis=1)
        labels = [p.column("label").to_numpy() for p in (anchors, others)]
        fits = (scores >= least[:, None]) & (scores <= most[:, None])
        row, col = np.nonzero(fits & (labels[0][:, None] != labels[1][None, :]))
        score, name = scores[row, col], others.column("vec_id").to_numpy()[col]
        node = anchors.column("node").to_numpy()
        found = []
        for place in range(top.shape[1]):
            good = np.flatnonzero(
                usable[row, place] & (score <= top[row, place]) & (score >= low[row, place])
            )
            best = good[best_of([row[good]], score[good], name[good], mining.negatives)]
            found.append((node[row[best]], np.full(len(best), place), score[best], name[best]))
        return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))

    return pick


def whole_rows(
    vectors: DataFrame, label: Column | None = None, is_anchor: Column | None = None, scale: int = 256
) -> DataFrame:
    """(vec_id, label, v, is_anchor): the rows that take part, each x as floor(scale * x).

    Rows without vec_id, label or vector, and those with a component that is null
    or not finite, take no part. `label` and `is_anchor` may be computed from
    `vec_id` and `label`.
    """
    rows = vectors.select(
        column("vec_id").cast("long").alias("vec_id"),
        column("embedding").cast("array<double>").alias("embedding"),
        column("label").cast("long").alias("label"),
    )
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = rows.where(
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & ~F.coalesce(bad, F.lit(False))
    )
    return good.select(
        "vec_id",
        (F.col("label") if label is None else label).cast("long").alias("label"),
        F.transform("embedding", lambda x: F.floor(x * scale).cast("long")).alias("v"),
        (F.lit(True) if is_anchor is None else is_anchor).alias("is_anchor"),
    )


def hard_negatives(rows: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """Per anchor, positive and rank: the ids and scores of the negatives in the window.

    `rows` are those of `whole_rows`. A row's score is its inner product with the
    anchor, shorter vectors being padded with zeros; higher scores come first, ties
    by smaller vec_id. Rows that repeat count as rows of their own, but rows of the
    anchor's vec_id are never its positives, and an anchor that repeats has its
    rows again. Positives of negative score have an empty window. Scores beyond 60
    bits fail the job. An empty table gives an empty result.
    """
    numbered = rows.withColumn("node", F.monotonically_increasing_id())
    held = materialise(numbered, "whole_rows")  # written before use, so the numbers stay the same
    others = held.select("node", "vec_id", "label", "v", F.lit(False).alias("is_anchor"))
    anchors = held.where("is_anchor")

    sizes = held.groupBy("label").agg(
        F.count("*").alias("n"), F.count_if("is_anchor").alias("n_anchors")
    )
    sizes = sizes.where("n_anchors > 0").select(
        "label", "n", "n_anchors", F.ceil(F.col("n") / mining.candidates).alias("blocks")
    )
    totals = sizes.agg(
        F.sum(F.col("blocks") * F.ceil(F.col("n_anchors") / mining.anchors)), F.sum("n_anchors")
    ).first()
    n, n_anchors = held.count(), totals[1] or 0

    def stripes(table: DataFrame, own: Column, all_of: Column, names: tuple[str, str]) -> DataFrame:
        return table.withColumn(names[0], own).withColumn(names[1], F.explode(all_of))

    by_label = join_on(anchors, sizes, ["label"], "inner")
    same = _met(
        stripes(
            by_label,
            _stripe(F.col("n_anchors"), mining.anchors),
            _every(F.col("n"), mining.candidates),
            ("stripe", "block"),
        ).drop("n", "n_anchors", "blocks"),
        stripes(
            join_on(others, sizes, ["label"], "inner"),
            _stripe(F.col("n"), mining.candidates),
            _every(F.col("n_anchors"), mining.anchors),
            ("block", "stripe"),
        ).drop("n", "n_anchors", "blocks"),
        ["label", "stripe"],
        int(totals[0] or 0),
    )
    pick = _pick_positives(mining.positives)
    best = _best_rows(_heaps(same, ["label", "stripe"], pick, mining.positives), mining.positives)
    positives = best.groupBy("anchor").agg(  # a few rows a key
        F.sort_array(F.collect_list(F.struct("rank", "name", "score"))).alias("found")
    )
    armed = materialise(
        anchors.join(positives, anchors["node"] == positives["anchor"]).select(
            "node", "vec_id", "label", "v", "is_anchor", "found"
        ),
        "armed",
    )

    all_n, all_anchors = F.lit(n), F.lit(n_anchors)
    met = _met(
        stripes(
            armed.withColumn("positive_scores", F.col("found.score")).drop("found"),
            _stripe(all_anchors, mining.anchors),
            _every(all_n, mining.candidates),
            ("stripe", "block"),
        ),
        stripes(
            others,
            _stripe(all_n, mining.candidates),
            _every(all_anchors, mining.anchors),
            ("block", "stripe"),
        ),
        ["stripe"],
        -(-n // mining.candidates) * -(-n_anchors // mining.anchors),
    )
    heaps = _heaps(met, ["stripe"], _pick_negatives(mining), mining.negatives)
    negatives = _best_rows(heaps, mining.negatives)
    positive = F.get("found", F.col("place"))
    return (
        negatives.join(armed.select("node", "vec_id", "found"), F.col("anchor") == F.col("node"))
        .select(
            F.col("vec_id").alias("anchor_id"),
            positive["name"].alias("positive_id"),
            "rank",
            F.col("name").alias("negative_id"),
            positive["score"].alias("positive_score"),
            F.col("score").alias("negative_score"),
        )
    )
