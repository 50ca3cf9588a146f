"""Embedding near-dedup by lattice hashing.

Every table rotates the vectors at random, takes a few blocks of eight
coordinates, and decodes each block to the nearest point of the E8 lattice; the
points together name a cell. A vector is placed in its own cell and in the
neighbouring cells that are nearest to it. Vectors that meet in a cell are
candidates, and a link is a pair whose cosine, in double precision, reaches the
threshold.

Equal vectors are one vector with a count. A cell with many vectors is cut into
blocks, and every two blocks of it meet in one small task; a task returns a
spanning forest of the links it finds, never all pairs. Links do not leave a
component, so once the components are known the links of each vector are counted
inside its component, again block by block, which also finds links that no cell
has shown.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmart.llm.common import column, materialise
from ticketmart.llm.components import components
from ticketmart.operators.joins import join_on

THRESHOLD = 0.95
#: Vectors of a block; two blocks meet in a task.
BLOCK = 256


@dataclass(frozen=True)
class Lattice:
    """Tables, blocks of eight coordinates in each, cells per vector and table, and scale.

    More blocks make cells smaller, which larger collections need; more tables
    and cells find more of the pairs near the threshold. The scale is the mean
    length of a unit vector within one block; the shortest lattice vector has the
    length 1.41.
    """

    tables: int = 6
    blocks: int = 2
    cells: int = 5
    scale: float = 1.8
    seed: int = 8

    def rotations(self, width: int) -> list[np.ndarray]:
        """One matrix per table with orthonormal columns, as far as the width allows."""
        random = np.random.default_rng(self.seed)
        found = []
        for _ in range(self.tables):
            square = random.standard_normal((max(width, 8 * self.blocks),) * 2)
            turned, _ = np.linalg.qr(square)
            found.append(turned[:width, : 8 * self.blocks] * self.scale * (width / 8) ** 0.5)
        return found


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    whole = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            row = [0.0] * 8
            row[i], row[j] = a, b
            whole.append(row)
    halves = [s for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(whole + [list(s) for s in halves])


SHORTEST = _shortest()


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    if len(odd):
        rest = x[odd] - near[odd]
        worst = np.abs(rest).argmax(axis=1)
        step = np.where(rest[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
        near[odd, worst] += step
    return near


def nearest_point(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: whole coordinates of even sum, or those moved by one half."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.where(closer[:, None], half, whole)


def _mixed(points: np.ndarray, start: int) -> np.ndarray:
    """One hash per row of doubled lattice coordinates."""
    value = np.full(len(points), np.uint64(start * 2 + 1) * np.uint64(0x9E3779B97F4A7C15))
    for part in np.rint(points * 2).astype(np.int64).astype(np.uint64).T:
        value = (value ^ part) * np.uint64(0xC2B2AE3D27D4EB4F)
        value ^= value >> np.uint64(29)
    return value.view(np.int64)


def cells(unit: np.ndarray, lattice: Lattice) -> np.ndarray:
    """(vectors, tables, cells): own cell first, then the nearest neighbouring ones."""
    out = []
    with np.errstate(over="ignore"):
        for number, rotation in enumerate(lattice.rotations(unit.shape[1])):
            turned = unit @ rotation
            choices, costs = [], []
            for b in range(lattice.blocks):
                x = turned[:, 8 * b : 8 * b + 8]
                point = nearest_point(x)
                rest = x - point
                extra = 2 - 2 * rest @ SHORTEST.T  # how much farther each neighbour is
                wanted = min(lattice.cells, len(SHORTEST))
                best = np.argpartition(extra, wanted - 1, axis=1)[:, :wanted]
                spare = np.take_along_axis(extra, best, axis=1)
                order = np.argsort(spare, axis=1)
                best = np.take_along_axis(best, order, axis=1)
                names = [_mixed(point, b)] + [
                    _mixed(point + SHORTEST[best[:, k]], b) for k in range(wanted)
                ]
                choices.append(np.stack(names, axis=1))
                costs.append(
                    np.concatenate(
                        [np.zeros((len(x), 1)), np.take_along_axis(spare, order, axis=1)], axis=1
                    )
                )
            total, name = costs[0], choices[0]
            for cost, choice in zip(costs[1:], choices[1:], strict=True):
                total = (total[:, :, None] + cost[:, None, :]).reshape(len(unit), -1)
                name = (
                    name[:, :, None] * np.int64(0x165667B19E3779F9) + choice[:, None, :]
                ).reshape(len(unit), -1)
                keep = np.argsort(total, axis=1, kind="stable")[:, : lattice.cells]
                total = np.take_along_axis(total, keep, axis=1)
                name = np.take_along_axis(name, keep, axis=1)
            out.append(name[:, : lattice.cells] * np.int64(31) + np.int64(number))
    return np.stack(out, axis=1)


def _unit(vector: np.ndarray | None) -> np.ndarray | None:
    """The vector scaled to length one; none if it can link with nothing."""
    if vector is None or not len(vector):
        return None
    found = np.array([np.nan if x is None else x for x in vector], dtype=np.float64)
    largest = np.abs(found).max()
    if not np.isfinite(largest) or largest == 0:
        return None
    found = found / largest  # so that squares neither overflow nor vanish
    return found / np.sqrt(found @ found)


def _units(batch: pa.RecordBatch) -> np.ndarray:
    """The unit vectors of a batch; their column holds eight bytes a coordinate."""
    raw = batch.column("unit").to_pylist()
    return np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)


def _normalised(rows: DataFrame) -> DataFrame:
    """(vec_id, unit, width) of the vectors that can link."""
    schema = "vec_id long, unit binary, width int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [_unit(v) for v in batch.column("embedding").to_pylist()]
            some = pa.array([u is not None for u in units], pa.bool_())
            held = [u for u in units if u is not None]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").filter(some),
                    pa.array([u.tobytes() for u in held], pa.binary()),
                    pa.array([len(u) for u in held], pa.int32()),
                ],
                names=["vec_id", "unit", "width"],
            )

    return rows.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(run, schema)


def _placed(distinct: DataFrame, lattice: Lattice) -> DataFrame:
    """(node, cell): every vector in its own and its neighbouring cells."""
    schema = "node long, cell long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = np.array(batch.column("width").to_pylist(), np.int64)
            for width in np.unique(widths):
                part = batch.filter(pa.array(widths == width))
                for at in range(0, part.num_rows, 4096):
                    yield _cells_of(part.slice(at, 4096), int(width), lattice)

    return distinct.select("node", "unit", "width").mapInArrow(run, schema)


def _cells_of(part: pa.RecordBatch, width: int, lattice: Lattice) -> pa.RecordBatch:
    found = cells(_units(part), lattice).reshape(part.num_rows, -1) ^ np.int64(width * 0x9E3779B1)
    at = pa.array(np.repeat(np.arange(part.num_rows), found.shape[1]))
    return pa.RecordBatch.from_arrays(
        [part.column("node").take(at), pa.array(found.reshape(-1))], names=["node", "cell"]
    )


def _meeting(rows: DataFrame, group: str, distinct: DataFrame) -> DataFrame:
    """Every two blocks of every group, sorted so that a task sees each meeting as one stretch.

    A group of at most BLOCK vectors is one block. Groups of one vector are left
    out before the vectors themselves are joined to what remains. `side` says to
    which of the two blocks a row belongs.
    """
    sizes = rows.groupBy(group).agg(F.count("*").alias("size")).filter("size > 1")
    cut = join_on(rows, sizes, [group], "inner").select(
        group, "node", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")
    )
    own = cut.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    keys = [group, "low", "high"]
    side = (F.col("own") > F.col("other")).cast("int").alias("side")
    return (
        met.select(group, low.alias("low"), high.alias("high"), side, "node")
        .join(distinct.select("node", "unit", "copies"), "node")
        .repartition(*[F.col(k) for k in keys])
        .sortWithinPartitions(*keys, "side", "node")
    )


def _stretches(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of equal keys together, from batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    name = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys])
        edges = np.flatnonzero((table[:, 1:] != table[:, :-1]).any(axis=0)) + 1
        for start, end in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            here = tuple(table[:, start])
            if held and here != name:
                yield pa.concat_batches(held) if len(held) > 1 else held[0]
                held = []
            name = here
            held.append(batch.slice(int(start), int(end - start)))
    if held:
        yield pa.concat_batches(held) if len(held) > 1 else held[0]


def _linked(part: pa.RecordBatch, threshold: float) -> np.ndarray:
    """Which vectors of the first block link with which of the second (or of the same)."""
    units = _units(part)
    side = part.column("side").to_numpy()
    if part.column("low")[0].as_py() == part.column("high")[0].as_py():
        links = units @ units.T >= threshold
        np.fill_diagonal(links, False)
        return links
    first = int((side == 0).sum())
    links = np.zeros((len(units),) * 2, bool)
    links[:first, first:] = units[:first] @ units[first:].T >= threshold
    links[first:, :first] = links[:first, first:].T
    return links


def _forest(links: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a link table, as pairs of places."""
    seen, found = np.zeros(len(links), bool), []
    for root in np.flatnonzero(links.any(axis=1)):
        if seen[root]:
            continue
        seen[root], todo = True, [root]
        while todo:
            at = todo.pop()
            fresh = np.flatnonzero(links[at] & ~seen)
            seen[fresh] = True
            found += [(int(at), int(f)) for f in fresh]
            todo += fresh.tolist()
    return found


def _forests(placed: DataFrame, distinct: DataFrame, threshold: float) -> DataFrame:
    """(one, other): spanning forests of the links that each meeting shows."""
    keys = ["cell", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _stretches(batches, keys):
            pairs = _forest(_linked(part, threshold))
            if pairs:
                nodes = part.column("node").to_numpy()
                ends = np.array(pairs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[ends[:, 0]]), pa.array(nodes[ends[:, 1]])],
                    names=["one", "other"],
                )

    return _meeting(placed, "cell", distinct).mapInArrow(run, "one long, other long")


def _counts(members: DataFrame, distinct: DataFrame, threshold: float) -> DataFrame:
    """(node, links): vectors of the same component that link with each, copies counted."""
    keys = ["component", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _stretches(batches, keys):
            copies = part.column("copies").to_numpy()
            sums = (_linked(part, threshold) * copies[None, :]).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), pa.array(sums.astype(np.int64))], names=["node", "links"]
            )

    met = _meeting(members.select("component", "node"), "component", distinct)
    found = met.mapInArrow(run, "node long, links long")
    return found.groupBy("node").agg(F.sum("links").alias("links"))


def linked_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, lattice: Lattice = Lattice()
) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero, or hold null or non-finite components link
    with nothing and are components of their own; vectors of different widths
    never link. n_links counts the other rows that link directly, equal vectors
    among them. Rows that repeat a vec_id count as rows of their own. Among rows
    without vec_id the links are counted too; component_id is null only where no
    member has one. Extra columns are ignored, an empty table gives an empty result.
    """
    rows = vectors.select(
        column("vec_id").cast("long").alias("vec_id"),
        column("embedding").cast("array<double>").alias("embedding"),
    )
    held = materialise(_normalised(rows), "units")
    distinct = materialise(  # written before it is used, so the numbers stay the same
        held.groupBy("unit", "width")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()),
        "distinct",
    )
    placed = materialise(_placed(distinct, lattice), "placed")
    forests = _forests(placed, distinct, threshold)
    found = materialise(components(forests, "one", "other"), "components")
    members = join_on(distinct, found, ["node"], "inner")
    ends = members.groupBy("component").agg(F.min("least").alias("component_id"))
    counted = _counts(members, distinct, threshold)
    known = (
        distinct.join(found, "node", "left")
        # a vector without links is alone in its component; a null would be one key for all of them
        .withColumn("component", F.coalesce("component", "node"))
        .join(ends, "component", "left")
        .join(counted, "node", "left")
        .select(
            F.col("unit"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "least").alias("component_id"),
        )
    )
    linked = join_on(held, known, ["unit"], "inner").select("vec_id", "n_links", "component_id")
    alone = _without_units(rows).select(
        "vec_id",
        F.lit(0).cast("long").alias("n_links"),
        F.col("vec_id").alias("component_id"),
    )
    return linked.unionByName(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )


def _without_units(rows: DataFrame) -> DataFrame:
    """The rows whose vectors can link with nothing."""
    vector = F.col("embedding")
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    ) | F.forall(vector, lambda x: x == 0)
    return rows.filter(vector.isNull() | F.coalesce(bad, F.lit(True))).select("vec_id")
