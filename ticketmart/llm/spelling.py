"""Groups of spelling variants, by a trie over letter frequencies.

A word is placed by its counts of successive letter groups. One inserted letter
is a surplus of one in one group, a deleted one a deficit of one, a replaced one
both or neither; so the near words of a word are among those whose counts differ
within a budget of one surplus and one deficit.

The upper levels of the trie divide the words into shards: as many levels as it
takes until no shard is large. A word is searched in its own shard and sent to
those that the budget reaches, with what is left of it. Inside a shard the two
tries are walked together, depth first: each step goes to children of equal
count, or spends a part of the budget on children one apart. Where few words are
left below two nodes, or the letter groups end, the words themselves are compared.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmart.llm.common import column, discard, materialise, stretches
from ticketmart.operators.joins import join_on

#: Letter groups in the order of the trie's levels; all other letters are a last group.
GROUPS = (
    "e", "a", "i", "t", "n", "o", "r", "s", "l", "u", "d", "c",
    "m", "h", "p", "g", "b", "f", "v", "k", "w", "zs", "y", "jqx",
)
#: Words of a shard, beyond which the trie divides one level further.
SHARD = 4096
#: Pairs of words below two nodes that are compared at once instead of walking on.
LEAF = 256
#: Letters of a word that arrays hold; longer words are compared one by one.
WIDE = 48
#: Pairs of one comparison.
BATCH = 1 << 15

RUN = r"[A-Za-zÀ-ÿ]+"


def word_counts(
    docs: DataFrame, letters: int = 6, occurrences: int = 5, divisor: int = 199
) -> DataFrame:
    """(word, n): words of all texts, each run's letter dropped where its hash says so."""
    lower = F.translate(
        column("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    name = F.coalesce(column("doc_id").cast("string"), F.lit(""))
    runs = docs.select(
        name.alias("name"), F.explode(F.regexp_extract_all(lower, F.lit(RUN), 0)).alias("run")
    ).where(F.length("run") >= letters)
    hashed = F.crc32(F.concat("name", F.lit(":"), "run").cast("binary"))
    place = (F.col("hash") % F.length("run")).cast("int")
    shorter = F.concat(
        F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run"))
    )
    words = runs.withColumn("hash", hashed).select(
        F.when(F.col("hash") % divisor == 0, shorter).otherwise(F.col("run")).alias("word")
    )
    counted = words.where(F.length("word") >= letters).groupBy("word")
    return counted.agg(F.count("*").alias("n")).where(F.col("n") >= occurrences)


def _counts(word: Column, groups: Sequence[str]) -> Column:
    """Counts of the given letter groups."""
    return F.array(
        *[F.length(word) - F.length(F.translate(word, group, "")) for group in groups]
    ).cast("array<int>")


def _key(counts: Column) -> Column:
    return F.concat_ws(",", counts.cast("array<string>"))


def _levels(words: DataFrame, groups: Sequence[str], shard: int) -> int:
    """Levels of the trie that divide the words into shards of at most `shard` words.

    Words that no level tells apart stay together, and meet in blocks.
    """
    for levels in range(len(groups)):
        key = _key(_counts(F.col("word"), groups[:levels]))
        largest = words.groupBy(key.alias("key")).count().agg(F.max("count")).first()[0]
        if (largest or 0) <= shard:
            return levels
    return len(groups)


def _steps(levels: int) -> list[tuple[list[int], int]]:
    """Steps to other shards whose first change is a surplus, each with the deficit left."""
    steps = []
    for place in range(levels):
        step = [0] * levels
        step[place] = 1
        steps.append((step, 1))
    for more, less in combinations(range(levels), 2):
        step = [0] * levels
        step[more], step[less] = 1, -1
        steps.append((step, 0))
    return steps


def _cells(words: DataFrame, groups: Sequence[str], levels: int, shard: int) -> DataFrame:
    """(cell, side, deficit, word, n): the words that meet in each cell.

    Side 0 and 1 are the two blocks of a shard, side 2 words from other shards.
    A shard of at most `shard` words is one block.
    """
    placed = words.withColumn("counts", _counts(F.col("word"), groups[:levels]))
    home = placed.withColumn("shard", _key(F.col("counts")))
    shards = home.groupBy("shard").agg(F.count("*").alias("homes"))
    steps = F.array(
        *[
            F.struct(F.array(*map(F.lit, step)).alias("step"), F.lit(deficit).alias("deficit"))
            for step, deficit in _steps(levels)
        ]
    )
    moved = (
        placed.withColumn("to", F.explode(steps))
        .withColumn("moved", F.zip_with("counts", "to.step", lambda a, b: a + b))
        .where(F.array_min("moved") >= 0)
        .select(_key(F.col("moved")).alias("shard"), "to.deficit", "word", "n")
        if levels
        else home.select("shard", F.lit(0).alias("deficit"), "word", "n").limit(0)
    )
    sized = materialise(join_on(moved, shards, ["shard"], "inner").drop("homes"), "guests")
    guests = sized.groupBy("shard").agg(F.count("*").alias("guests"))
    known = join_on(shards, guests, ["shard"], "left").select(
        "shard",
        F.ceil(F.col("homes") / shard).cast("int").alias("blocks"),
        F.ceil(F.coalesce("guests", F.lit(0)) / (8 * shard)).cast("int").alias("visits"),
    )
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    others = lambda count: F.when(
        F.col(count) > 0, F.sequence(F.lit(0), F.col(count) - 1)
    ).otherwise(F.array().cast("array<int>"))
    at_home = join_on(home.select("shard", "word", "n"), known, ["shard"], "inner")
    at_home = at_home.withColumn("own", own)
    met = at_home.withColumn("other", F.explode(others("blocks"))).select(
        "shard",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        F.lit(0).alias("deficit"),
        "word",
        "n",
    )
    hosts = at_home.withColumn("visit", F.explode(others("visits"))).select(
        "shard",
        F.col("own").alias("low"),
        (F.col("blocks") + F.col("visit")).alias("high"),
        F.lit(0).alias("side"),
        F.lit(0).alias("deficit"),
        "word",
        "n",
    )
    arrived = join_on(sized, known, ["shard"], "inner")
    visitors = arrived.withColumn("low", F.explode(others("blocks"))).select(
        "shard",
        "low",
        (F.col("blocks") + F.pmod(F.xxhash64("word"), F.col("visits")).cast("int")).alias("high"),
        F.lit(2).alias("side"),
        "deficit",
        "word",
        "n",
    )
    rows = met.unionByName(hosts).unionByName(visitors)
    return rows.select(
        F.xxhash64("shard", F.lit(1)).alias("shard"),
        F.xxhash64("shard", F.lit(2)).alias("shard_too"),
        "low",
        "high",
        "side",
        "deficit",
        "word",
        "n",
    )


@cache
def _kinds(groups: tuple[str, ...]) -> np.ndarray:
    """Letter group by code point."""
    kinds = np.full(0x10000, len(groups), np.int64)
    for place, group in enumerate(groups):
        kinds[[ord(letter) for letter in group]] = place
    return kinds


class _Words:
    """Words of a cell: their letters and their counts of letter groups."""

    def __init__(self, words: list[str], groups: Sequence[str]):
        self.words = words
        self.lengths = np.array([len(w) for w in words], np.int64)
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        row = np.repeat(np.arange(len(words)), self.lengths)
        width = len(groups) + 1
        kinds, limit = _kinds(tuple(groups)), 0xFFFF
        kind = kinds[np.minimum(letters, limit)]
        self.counts = np.bincount(row * width + kind, minlength=len(words) * width).reshape(
            len(words), width
        )
        start = np.cumsum(self.lengths) - self.lengths
        place = np.arange(len(letters)) - start[row]
        short = self.lengths[row] <= WIDE
        row, place, letters = row[short], place[short], letters[short]
        self.left = np.zeros((len(words), WIDE), np.uint32)
        self.left[row, place] = letters
        self.right = np.zeros((len(words), WIDE), np.uint32)
        self.right[row, self.lengths[row] - 1 - place] = letters

    def near(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Which pairs differ by exactly one inserted, deleted or replaced code point."""
        a, b = self.lengths[one], self.lengths[other]
        close = np.abs(a - b) <= 1
        wide = close & (np.maximum(a, b) > WIDE)
        found = np.zeros(len(one), bool)
        at = np.flatnonzero(close & ~wide)
        shared = np.zeros(len(at), np.int64)
        for letters in (self.left, self.right):
            differs = letters[one[at]] != letters[other[at]]
            same = np.where(differs.any(axis=1), differs.argmax(axis=1), WIDE)
            shared += np.minimum(same, np.minimum(a[at], b[at]))
        # words are distinct, so a shared start and end that leave one letter are enough
        found[at] = shared >= np.maximum(a[at], b[at]) - 1
        for i in np.flatnonzero(wide):
            found[i] = one_apart(self.words[one[i]], self.words[other[i]])
        return found


def one_apart(one: str, other: str) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    if len(one) > len(other):
        one, other = other, one
    if len(other) - len(one) > 1 or one == other:
        return False
    place = next((i for i, (a, b) in enumerate(zip(one, other)) if a != b), len(one))  # noqa: B905
    return one[place + (len(one) == len(other)) :] == other[place + 1 :]


class _Walk:
    """Pairs of near words below two tries, given as sorted rows of counts.

    Of two words with unequal counts, `other` is the one with the first surplus; with
    `both`, either may be.
    """

    def __init__(self, held: _Words, level: int, leaf: int, both: bool):
        self.held, self.level, self.leaf, self.both = held, level, leaf, both
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0
        self.found: list[tuple[np.ndarray, np.ndarray]] = []

    def sorted(self, places: np.ndarray) -> np.ndarray:
        return places[np.lexsort(self.held.counts[places, self.level :].T[::-1])]

    def compare(self, one: np.ndarray, other: np.ndarray, same: bool) -> None:
        if same:
            i, j = np.triu_indices(len(one), 1)
            one, other = one[i], one[j]
        else:
            one, other = np.repeat(one, len(other)), np.tile(other, len(one))
        for at in range(0, len(one), BATCH):
            self.pairs.append((one[at : at + BATCH], other[at : at + BATCH]))
            self.waiting += len(self.pairs[-1][0])
            if self.waiting >= BATCH:
                self.flush()

    def flush(self) -> None:
        if self.pairs:
            one, other = (np.concatenate(side) for side in zip(*self.pairs, strict=True))
            near = self.held.near(one, other)
            self.found.append((one[near], other[near]))
        self.pairs, self.waiting = [], 0

    def children(self, places: np.ndarray, level: int) -> list[tuple[int, np.ndarray]]:
        values = self.held.counts[places, level]
        edges = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1), len(values)]
        return [
            (int(values[a]), places[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)
        ]

    def down(
        self, one: np.ndarray, other: np.ndarray, level: int, surplus: int, deficit: int, same: bool
    ) -> None:
        """Depth-first search below two nodes. `same`: both are one node, nothing spent."""
        if not len(one) or not len(other):
            return
        if level == self.held.counts.shape[1] or len(one) * len(other) <= self.leaf:
            self.compare(one, other, same)
            return
        kept = self.children(one, level)
        reached = dict(kept if same else self.children(other, level))
        for count, below in kept:
            if count in reached:
                self.down(below, reached[count], level + 1, surplus, deficit, same)
            if surplus and count + 1 in reached:
                self.down(below, reached[count + 1], level + 1, surplus - 1, deficit, False)
            if deficit and count - 1 in reached and (self.both or not surplus):
                self.down(below, reached[count - 1], level + 1, surplus, deficit - 1, False)


def _pairs(
    cells: DataFrame, groups: Sequence[str], levels: int, leaf: int, tasks: int
) -> DataFrame:
    """(word, near, near_n): near words in both directions."""
    keys = ["shard", "shard_too", "low", "high"]

    def of(part: pa.RecordBatch) -> pa.RecordBatch:
        side = part.column("side").to_numpy()
        deficit = part.column("deficit").to_numpy()
        held = _Words(part.column("word").to_pylist(), groups)
        walk = _Walk(held, levels, leaf, both=bool((side == 1).any()))
        first = walk.sorted(np.flatnonzero(side == 0))
        second = walk.sorted(np.flatnonzero(side == 1))
        if len(second):  # two blocks of a shard
            walk.down(first, second, levels, 1, 1, False)
        elif (side == 2).any():
            for left in (0, 1):
                guests = walk.sorted(np.flatnonzero((side == 2) & (deficit == left)))
                walk.down(guests, first, levels, 0, left, False)
        elif part.column("low")[0].as_py() == part.column("high")[0].as_py():
            walk.down(first, first, levels, 1, 1, True)
        walk.flush()
        one = np.concatenate([p[0] for p in walk.found] or [np.zeros(0, np.int64)])
        other = np.concatenate([p[1] for p in walk.found] or [np.zeros(0, np.int64)])
        names, n = part.column("word"), part.column("n")
        to = pa.array(np.concatenate([other, one]))
        return pa.RecordBatch.from_arrays(
            [names.take(pa.array(np.concatenate([one, other]))), names.take(to), n.take(to)],
            names=["word", "near", "near_n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in stretches(batches, keys):
            yield of(part)

    dealt = cells.repartition(tasks, *[F.col(k) for k in keys]).sortWithinPartitions(*keys, "side")
    return dealt.mapInArrow(run, "word string, near string, near_n long")


def near_words(
    words: DataFrame, groups: Sequence[str] = GROUPS, shard: int = SHARD, leaf: int = LEAF
) -> DataFrame:
    """(word, near, near_n) of distinct words (word, n): every near word of every word, once."""
    levels = _levels(words, groups, shard)
    tasks = min(-(-words.count() // shard) * 4 + 1, 10_000)
    return _pairs(_cells(words, groups, levels, shard), groups, levels, leaf, tasks)


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of every chain of forms, which grow along it, by doubling steps."""
    held = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    moving = held.count()
    while moving:
        further = held.select(F.col("word").alias("at"), F.col("root").alias("further"))
        joined = join_on(held.withColumnRenamed("root", "at"), further, ["at"], "left")
        following = materialise(
            joined.select(
                "word",
                F.coalesce("further", "at").alias("root"),
                F.col("further").isNotNull().alias("moved"),
            ),
            "roots",
        )
        discard(held)
        moving = following.where("moved").limit(1).count()
        held = following.drop("moved")
    return held


def variants(docs: DataFrame, larger: int = 5, groups: Sequence[str] = GROUPS) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.

    The form is the near word of largest n, of equal ones the first in code-point
    order, if it is at least `larger` times as frequent. Null texts have no words,
    a null doc_id is hashed as an empty one, documents that repeat count each time,
    extra columns are ignored, and an empty table gives an empty result.
    """
    words = materialise(word_counts(docs), "words")
    near = near_words(words, groups)
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"),
    )
    joined = join_on(words, best, ["word"], "left")
    form_n = -F.col("best.less")
    good = form_n >= larger * F.col("n")
    formed = materialise(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(good, F.col("best.near")).alias("form"),
            F.when(good, form_n).alias("form_n"),
        ),
        "formed",
    )
    roots = _roots(formed.where("form IS NOT NULL"))
    return join_on(formed, roots, ["word"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
