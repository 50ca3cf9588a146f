"""Benchmark decontamination by winnowing.

Words are hashed, and every five neighbouring words give a fingerprint. Of each
six neighbouring fingerprints the least one is kept, on both sides alike. Ten
shared words hold six shared fingerprints, so the kept one is shared too: every
span of ten words or more that a document shares with an item leaves a common
fingerprint. Documents and items are joined on fingerprints, and each hit is
extended to the windows of ten words around it, which are then compared whole.
Items of fewer than ten words are one window; there every run of as many words
is a fingerprint.

Nothing but the few words around a kept fingerprint travels with it. Whether the
fingerprints of the benchmark are sent to every task is left to Spark's size
check.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmart.llm.common import column, materialise, unused

#: Words of a window, of a fingerprint, and fingerprints of which one is kept.
WINDOW = 10
GRAM = 5
KEPT_OF = WINDOW - GRAM + 1
#: Low bits of a kept fingerprint that hold its place in the text.
_PLACE = 28
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text: runs of digits, of a to z in either case, and of all beyond ASCII."""
    plain = F.octet_length(text) == F.length(text)
    folded = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.coalesce(F.array_remove(F.split(folded, _BETWEEN), ""), F.array().cast("array<string>"))


def _hashes(text: Column) -> Column:
    return F.transform(words(text), lambda word: F.xxhash64(word))


def _upto(last: Column) -> Column:
    """0, 1, ... last; nothing if last is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _grams(hashes: Column) -> Column:
    """Fingerprints of all runs of words, each with its place in the low bits.

    A text of more words than these bits can tell apart fails the job.
    """
    fits = F.size(hashes) <= 1 << _PLACE
    last = F.when(fits, F.size(hashes) - GRAM).otherwise(
        F.raise_error(F.lit(f"a text has more than {1 << _PLACE} words")).cast("int")
    )
    return F.transform(
        _upto(last),
        lambda i: F.shiftleft(F.xxhash64(*[hashes[i + j] for j in range(GRAM)]), _PLACE).bitwiseOR(
            i.cast("long")
        ),
    )


def _least(grams: Column) -> Column:
    """The least of every few neighbouring fingerprints."""
    return F.transform(
        _upto(F.size(grams) - KEPT_OF),
        lambda i: F.least(*[grams[i + j] for j in range(KEPT_OF)]),
    )


def _fingerprints(rows: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., print, near, first): kept fingerprints and the word hashes around each."""
    grams = rows.select(*keep, "_hashes", _grams(F.col("_hashes")).alias("_grams"))
    least = grams.select(*keep, "_hashes", _least(F.col("_grams")).alias("_least"))
    new = F.filter("_least", lambda x, i: (i == 0) | (x != F.get(F.col("_least"), i - 1)))
    chosen = least.select(*keep, "_hashes", new.alias("_chosen"))
    place = lambda x: x.bitwiseAND(F.lit((1 << _PLACE) - 1)).cast("int")
    first = lambda x: F.greatest(place(x) - (KEPT_OF - 1), F.lit(0))
    return chosen.select(
        *keep,
        F.inline(
            F.transform(
                "_chosen",
                lambda x: F.struct(
                    F.shiftright(x, _PLACE).alias("print"),
                    first(x).alias("first"),
                    F.slice(
                        F.col("_hashes"), first(x) + 1, place(x) + WINDOW - first(x)
                    ).alias("near"),
                ),
            )
        ),
    )


def _window(hashes: Column, start: Column, length: int) -> Column:
    """Two independent hashes of a run of words, as the identity of a window."""
    run = [hashes[start + i] for i in range(length)]
    return F.struct(
        F.xxhash64(*run).alias("one"), F.xxhash64(F.lit(length), *reversed(run)).alias("two")
    )


def _windows(rows: DataFrame, length: int, keep: list[str], hashes: str) -> DataFrame:
    """(keep..., start, one, two) of every run of that many words."""
    return rows.select(
        *keep,
        F.inline(
            F.transform(
                _upto(F.size(hashes) - length),
                lambda i: F.struct(i.alias("start"), _window(F.col(hashes), i, length).alias("w")),
            )
        ),
    ).select(*keep, "start", "w.one", "w.two")


def item_windows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items with their word hashes, (length, one, two, item_id) of their windows), each once.

    Texts without words have none. An item of fewer than ten words is one window.
    """
    items = materialise(
        benchmark.select(
            column("item_id").alias("item_id"), _hashes(column("text")).alias("_hashes")
        ).filter(F.size("_hashes") > 0),
        "items",
    )
    parts = []
    for length in _lengths(items):
        long = F.size("_hashes") >= WINDOW if length == WINDOW else F.size("_hashes") == length
        found = _windows(items.filter(long), length, ["item_id"], "_hashes")
        parts.append(found.select(F.lit(length).alias("length"), "one", "two", "item_id"))
    return items, materialise(reduce(DataFrame.unionByName, parts).distinct(), "windows")


def _lengths(items: DataFrame) -> list[int]:
    """Numbers of words of the windows: ten, and those of shorter items."""
    sized = F.least(F.size("_hashes"), F.lit(WINDOW))
    return sorted({WINDOW, *[n for (n,) in items.select(sized).distinct().collect()]})  # ten at most


def hits(
    docs: DataFrame, key: list[str], text: str, items: DataFrame, windows: DataFrame
) -> DataFrame:
    """(key..., start, length, one, two): every occurrence of a window of an item.

    How many items hold a window makes no difference here. An occurrence that two
    fingerprints show is there twice.
    """
    hashed = _hashes(column(text)).alias("_hashes")
    rows = docs.select(*key, hashed)
    wanted = windows.select("length", "one", "two").distinct()
    prints = _fingerprints(items.filter(F.size("_hashes") >= WINDOW), ["item_id"])
    near = _fingerprints(rows, key).join(prints.select("print").distinct(), "print")
    around = near.select(
        *key,
        F.inline(
            F.transform(
                _upto(F.size("near") - WINDOW),
                lambda i: F.struct(
                    (i + F.col("first")).alias("start"),
                    _window(F.col("near"), i, WINDOW).alias("w"),
                ),
            )
        ),
    ).select(*key, "start", F.lit(WINDOW).alias("length"), "w.one", "w.two")
    found = [around]
    for length in _lengths(items):
        if length < WINDOW:
            short = _windows(rows, length, key, "_hashes")
            found.append(short.select(*key, "start", F.lit(length).alias("length"), "one", "two"))
    return reduce(
        DataFrame.unionByName, [part.join(wanted, ["length", "one", "two"]) for part in found]
    ).select(*key, "start", "length", "one", "two")


def _items_by_class(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(length, one, two, class) of windows, and (class, item_id): windows of equal items are a class.

    A phrase that many items share has many windows with the same items; its
    documents are joined with these items once.
    """
    window = ["length", "one", "two"]
    digest = lambda seed: F.sum(F.xxhash64(F.lit(seed), "item_id").cast("decimal(38,0)"))
    sets = windows.groupBy(*window).agg(F.count("*").alias("n"), digest(1).alias("a"), digest(2).alias("b"))
    classed = sets.select(*window, F.xxhash64("n", "a", "b").alias("class"))
    first = classed.groupBy("class").agg(F.min(F.struct(*window)).alias("w")).select("class", "w.*")
    named = windows.filter("item_id IS NOT NULL").join(first, window).select("class", "item_id")
    return classed, named


def _covered(spans: Column) -> Column:
    """Number of words in the union of spans."""
    zero = F.struct(F.lit(0).alias("words"), F.lit(0).alias("end"))
    return F.aggregate(
        F.array_sort(spans),
        zero,
        lambda state, span: F.struct(
            (
                state["words"]
                + F.greatest(
                    span["start"] + span["length"] - F.greatest(span["start"], state["end"]),
                    F.lit(0),
                )
            ).alias("words"),
            F.greatest(state["end"], span["start"] + span["length"]).alias("end"),
        ),
        lambda state: state["words"],
    )


def _identity(docs: DataFrame) -> list[Column]:
    """Two hashes of doc_id and text: rows equal in both are one document."""
    pair = (column("doc_id"), F.coalesce(column("text"), F.lit("")))
    return [F.xxhash64(*pair).alias("_one"), F.xxhash64(F.lit(1), *pair).alias("_two")]


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A null or empty text has no words and no hit. Repeated rows give repeated
    results. A hit of an item without item_id counts as a hit, not as an item.
    Extra columns are ignored; with an empty benchmark nothing is contaminated.
    """
    rows = docs.select(
        column("doc_id").alias("doc_id"), column("text").alias("_text"), *_identity(docs)
    )
    key = ["_one", "_two"]
    items, windows = item_windows(benchmark)
    found = materialise(hits(rows, key, "_text", items, windows), "hits")
    spans = (
        found.groupBy(*key)
        .agg(F.collect_set(F.struct("start", "length")).alias("spans"))
        .select(*key, _covered(F.col("spans")).cast("long").alias("n_hit"))
    )
    classed, named = _items_by_class(windows)
    window = ["length", "one", "two"]
    held = found.select(*key, *window).distinct().join(classed, window).select(*key, "class").distinct()
    listed = (
        held.join(named, "class")
        .groupBy(*key)
        .agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
        .select(
            *key,
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        )
    )
    spans = spans.join(listed, key, "left")
    counted = rows.select("doc_id", *key, F.size(words(F.col("_text"))).cast("long").alias("n_words"))
    return counted.join(spans, key, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no window of any item, with their own columns."""
    one, two = unused(docs, "_one"), unused(docs, "_two")
    marked = docs.withColumns(dict(zip((one, two), _identity(docs), strict=True)))
    rows = marked.select(column(one).alias("_one"), column(two).alias("_two"), column("text").alias("_text"))
    items, windows = item_windows(benchmark)
    found = hits(rows, ["_one", "_two"], "_text", items, windows).select(
        F.col("_one").alias(one), F.col("_two").alias(two)
    ).distinct()
    return marked.join(found, [one, two], "left_anti").select(*[column(c) for c in docs.columns])
