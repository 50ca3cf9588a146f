"""Line dedup by suffix ranks over the sequences of line ids.

Every document is a sequence of its non-blank lines. Prefix doubling ranks the
suffixes of all sequences: the rank of a run of one line is the place of the line
among all repeated lines, and the rank of a run of twice as many lines is the
place of its pair of halves among all repeated pairs, both in sorted order. The
positions that share a rank are an interval of the suffix array whose longest
common prefix is at least that long; runs that occur once drop out at each step.

A run of any length between two doublings is named by the ranks of the two
doubled runs that cover it from both ends, so positions with equal names are the
interval with at least that common prefix. Runs are looked up at the shortest
lengths that make a passage of `min_words` words, forwards from every line and
backwards from every line; together these cover every maximal repeated run with
that many words. Of the copies of a passage the first one stays (by doc_id, then
place) and the lines of all later ones go. As a passage needs at most `min_words`
lines, the number of doublings does not grow with the data.

No interval is gathered anywhere: its size and its first position are aggregates
that are combined before the shuffle, and later copies are told from the first
one by an anti join on positions, which are unique. A line that very many
documents share is split by adaptive execution where ranks are joined back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketmart.llm.common import column, discard, materialise, unused
from ticketmart.operators.joins import join_on

#: Words that a repeated passage has at least.
MIN_WORDS = 50
_BLANKS = " \t\r\x0b\x0c"
_KEY = ["doc", "text_hash"]


def _lines(text: Column) -> Column:
    """The non-blank lines of a text, with the blanks at their ends cut off."""
    cut = F.transform(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(_BLANKS)))
    return F.filter(cut, lambda line: line != "")


def _positions(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc, text_hash, place, one, two, words): every non-blank line, hashed, once.

    Rows with equal doc_id and text are the same document.
    """
    rows = docs.select(
        column("doc_id").alias("doc"),
        F.xxhash64(F.coalesce(column("text"), F.lit(""))).alias("text_hash"),
        F.posexplode(_lines(column("text"))).alias("place", "line"),
    )
    words = F.regexp_count("line", F.lit(f"[^{_BLANKS}]+"))
    hashed = rows.select(
        *_KEY,
        "place",
        F.xxhash64("line").alias("one"),
        F.xxhash64(F.lit(1), "line").alias("two"),
        F.least(words, F.lit(min_words)).alias("words"),
    )
    held = materialise(hashed, "lines")
    twice = held.filter("place = 0").groupBy(*_KEY).agg(F.count("*").alias("n")).filter("n > 1")
    return materialise(held.distinct(), "lines") if twice.limit(1).count() else held


def _ranked(rows: DataFrame, keys: list[str], rank: str) -> DataFrame:
    """Rows whose keys occur more than once, with the place of the keys in sorted order.

    The ids are written before they are used, so they stay the same if a task
    has to be run again.
    """
    repeated = rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").select(*keys)
    order = materialise(
        repeated.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(rank, F.monotonically_increasing_id()),
        "ranks",
    )
    return join_on(rows, order, keys, "inner").drop(*keys)


def _segments(rows: DataFrame, min_words: int) -> DataFrame:
    """Adds the passages that begin and end at each line: (until) and (since), else null.

    Only unbroken stretches of repeated lines can hold a repeated passage.
    `words` counts no line higher than `min_words`, so the line that completes a
    passage is always found within twice that many words.
    """
    by_doc = Window.partitionBy(*_KEY).orderBy("place")
    rows = rows.withColumn("stretch", F.col("place") - F.row_number().over(by_doc))
    stretch = Window.partitionBy(*_KEY, "stretch")
    so_far = stretch.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns(
        {
            "after": F.sum("words").over(so_far),
            "total": F.sum("words").over(stretch),
            "first": F.min("place").over(stretch),
            "final": F.max("place").over(stretch),
        }
    ).withColumn("before", F.col("after") - F.col("words"))
    ahead = stretch.orderBy("before").rangeBetween(min_words, 2 * min_words)
    behind = stretch.orderBy("after").rangeBetween(-2 * min_words, -min_words)
    enough_ahead = F.col("total") - F.col("before") >= min_words
    enough_behind = F.col("after") >= min_words
    return rows.filter(F.col("total") >= min_words).select(
        *_KEY,
        "place",
        "stretch",
        "rank0",
        F.when(enough_ahead, F.coalesce(F.min("place").over(ahead), F.col("final") + 1)).alias("until"),
        F.when(enough_behind, F.coalesce(F.max("place").over(behind) + 1, F.col("first"))).alias("since"),
    )


def _passages(rows: DataFrame) -> DataFrame:
    """(doc, text_hash, rank0, place, length) of the shortest passages.

    rank0 is the rank of the first line where the passage has one line only.
    """
    return rows.select(
        *_KEY,
        "rank0",
        F.inline(
            F.array_distinct(
                F.filter(
                    F.array(
                        F.struct(F.col("place"), (F.col("until") - F.col("place")).alias("length")),
                        F.struct(
                            F.col("since").alias("place"),
                            (F.col("place") + 1 - F.col("since")).alias("length"),
                        ),
                    ),
                    lambda passage: passage["length"].isNotNull(),
                )
            )
        ),
    )


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, text_hash, places): the lines that are later copies, per document that has some.

    Places count non-blank lines from 0.
    """
    if min_words < 1:
        raise ValueError("a passage has at least one word")
    positions = _positions(docs, min_words)
    rows = materialise(
        _segments(_ranked(positions, ["one", "two"], "rank0"), min_words), "stretches"
    )
    discard(positions)
    passages = materialise(_passages(rows), "passages")
    longest = passages.agg(F.max("length")).first()[0] or 0

    levels, size = [rows.select(*_KEY, "place", "stretch", F.col("rank0").alias("rank"))], 1
    while 2 * size <= longest:
        beyond = Window.partitionBy(*_KEY, "stretch").orderBy("place").rangeBetween(size, size)
        pairs = (
            levels[-1]
            .withColumn("next", F.first("rank").over(beyond))
            .filter(F.col("next").isNotNull())
        )
        doubled = _ranked(pairs, ["rank", "next"], "doubled")
        levels.append(materialise(doubled.withColumnRenamed("doubled", "rank"), "doubled"))
        size *= 2
    return _later_copies(passages, levels)


def _later_copies(passages: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Lines of the passages that also occur earlier, gathered per document."""
    doubled = [
        ranks.select(*_KEY, "place", F.lit(level).alias("level"), "rank")
        for level, ranks in enumerate(levels)
        if level
    ]
    single = passages.filter("length = 1").select(
        *_KEY, "place", "length", F.col("rank0").alias("head"), F.col("rank0").alias("tail")
    )
    names = single
    if doubled:
        ranks = reduce(DataFrame.unionByName, doubled)
        level = F.length(F.bin("length")) - 1
        covered = passages.filter("length > 1").withColumn("level", level)
        covered = covered.withColumn("tail_at", F.expr("place + length - shiftleft(1, level)"))
        tails = ranks.withColumnsRenamed({"rank": "tail", "place": "tail_at"})
        heads = ranks.withColumnRenamed("rank", "head")
        covered = join_on(covered, heads, [*_KEY, "place", "level"], "inner")
        covered = join_on(covered, tails, [*_KEY, "tail_at", "level"], "inner")
        names = single.unionByName(covered.select(*_KEY, "place", "length", "head", "tail"))
    first = (
        names.groupBy("length", "head", "tail")
        .agg(F.min(F.struct(*_KEY, "place")).alias("at"))
        .select("at.*", "length")
    )
    later = join_on(names, first, [*_KEY, "place", "length"], "left_anti")
    return (
        later.select(
            *_KEY,
            F.explode(F.sequence("place", F.col("place") + F.col("length") - 1)).alias("place"),
        )
        .groupBy(*_KEY)
        .agg(F.collect_set("place").alias("places"))
    )


def with_deduped_text(
    docs: DataFrame, min_words: int = MIN_WORDS, names: tuple[str, str] = ("n_lines", "n_removed")
) -> DataFrame:
    """Removes from `text` the lines of later copies; adds the counts of lines and removals.

    Columns that already have the names of the counts are replaced.

    A document that loses nothing keeps its text as it is, null included; null
    counts as no lines. One that loses lines keeps its other non-blank lines, cut
    of blanks at their ends, joined by line ends; it may become empty. Rows with
    equal doc_id and text are one document and stay alike, documents without
    doc_id come before all others. Extra columns stay.
    """
    doc, mark = unused(docs, "_doc"), unused(docs, "_hash")
    lines, gone = unused(docs, "_lines"), unused(docs, "_gone")
    marked = docs.withColumns(
        {
            doc: column("doc_id"),
            mark: F.xxhash64(F.coalesce(column("text"), F.lit(""))),
        }
    )
    found = repeated_lines(docs, min_words).withColumnsRenamed(
        {"doc": doc, "text_hash": mark, "places": gone}
    )
    joined = join_on(marked, found, [doc, mark], "left").withColumn(lines, _lines(column("text")))
    total = F.coalesce(F.size(column(lines)), F.lit(0))
    total = F.greatest(total, F.lit(0))
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), total - 1), column(gone)),
        lambda place: F.get(column(lines), place),
    )
    text = F.when(column(gone).isNull(), column("text")).otherwise(F.concat_ws("\n", kept))
    return joined.select(
        *[
            (text if c == "text" else column(c)).alias(c)
            for c in docs.columns
            if c.lower() not in [name.lower() for name in names]
        ],
        total.cast("long").alias(names[0]),
        F.coalesce(F.size(column(gone)), F.lit(0)).cast("long").alias(names[1]),
    )


def without_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without lines of later copies; those that lose every line go.

    The columns stay, and `n_chars`, if there is one, counts the new text.
    """
    names = (unused(docs, "_lines"), unused(docs, "_removed"))
    cleaned = with_deduped_text(docs, min_words, names)
    lines, removed = column(names[0]), column(names[1])
    kept = cleaned.filter((removed == 0) | (removed < lines))
    length = F.when(removed > 0, F.length("text").cast("long"))
    return kept.select(
        *[
            F.coalesce(length, column(c)).alias(c) if c == "n_chars" else column(c)
            for c in docs.columns
        ]
    )
