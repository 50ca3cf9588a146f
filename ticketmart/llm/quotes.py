"""Chat formatting by quotation linking.

Messages quote what they answer, line by line behind `>` marks, and quotes may
hold quotes. Every run of non-blank lines of one quote level is a passage; its
text is normalised (blanks folded, lower case), so that a passage that was wrapped
anew still equals its original, and hashed. Quoted passages are joined to the
messages that hold them as their own text. A message answers the owner of its
least deep quotes, and the conversation is the tree of answers; own text is left,
without quotes and without the lines that introduce them.

A quote has one owner: of the messages before it that hold the passage, the last
in the same scope, else the earliest of all. Owners and quotes are put in one order
that is cut into ranges, and every quote takes the last owner before it; so each
quote gives one row, and a passage that very many messages hold is spread over
ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketmart.llm.common import column, discard, materialise
from ticketmart.operators.joins import join_on

# nothing in it is given back, so that a line of very many marks needs no stack
_MARKS = r"^[ \t]*+(?:>[ \t]?+)++"
#: A line that introduces a quote, in the languages of the corpus.
INTRODUCTION = r"(?i)^(?:on|am|le|el)\b.*\b(?:wrote|schrieb|écrit|escribió)\b.*:$"


def _split(messages: DataFrame) -> DataFrame:
    """(id, at, level, content): every line, its quote level, and what follows the marks.

    Null texts have no lines.
    """
    rows = messages.select(
        "id", F.posexplode(F.split("text", r"\r?\n")).alias("at", "line")
    )
    marks = F.regexp_extract("line", _MARKS, 0)
    level = F.length(F.regexp_replace(marks, "[^>]", ""))
    return rows.select(
        "id",
        "at",
        level.alias("level"),
        F.btrim(F.substring("line", F.length(marks) + 1, F.length("line")), F.lit(" \t")).alias(
            "content"
        ),
    )


def passages(messages: DataFrame) -> DataFrame:
    """(id, run, level, text): runs of non-blank lines of one level, in order.

    A line that introduces a quote right below it belongs to no passage.
    """
    by_message = Window.partitionBy("id").orderBy("at")
    below = F.lead("level").over(by_message)
    introduces = (F.col("level") == 0) & (below > 0) & F.col("content").rlike(INTRODUCTION)
    new = (
        (F.col("content") == "")
        | (F.lag("content").over(by_message) == "")
        | (F.lag("level").over(by_message) != F.col("level"))
    )
    runs = (
        _split(messages)
        .withColumns({"introduces": introduces, "new": F.coalesce(new, F.lit(True)).cast("int")})
        .withColumn("run", F.sum("new").over(by_message))
        .filter((F.col("content") != "") & ~F.coalesce(F.col("introduces"), F.lit(False)))
    )
    return (
        runs.groupBy("id", "run", "level")
        .agg(F.array_sort(F.collect_list(F.struct("at", "content"))).alias("lines"))
        .select("id", "run", "level", F.concat_ws("\n", "lines.content").alias("text"))
    )


def _normalised(text: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(text, r"\s+", " "), F.lit(" ")))


def _hashed(found: DataFrame) -> DataFrame:
    plain = found.withColumn("plain", _normalised(F.col("text")))
    return plain.withColumns(
        {
            "one": F.xxhash64("plain"),
            "two": F.xxhash64(F.lit(1), "plain"),
            "words": F.size(F.split("plain", " ")),
        }
    ).drop("plain")


#: Owners and quotes in order; an owner comes after the quotes of its place, which it cannot answer.
_ORDER = ["scope", "one", "two", "place", "owns", "id", "run"]


def _with_last_owner(quotes: DataFrame, own: DataFrame) -> DataFrame:
    """Adds to quotes `near`: the last message of the scope before them that holds the passage.

    Of messages at one place it is that of the least id. Inside a range a window
    finds it; the first passage of a range may have its owner in an earlier one,
    whose last owner is then that of this passage. The last owners are one row
    per range, no more than there are shuffle partitions.
    """
    passage = ["scope", "one", "two"]
    owners = own.groupBy(*passage, "place").agg(F.min("id").alias("id"))
    rows = quotes.withColumn("owns", F.lit(False)).unionByName(
        owners.withColumn("owns", F.lit(True)), allowMissingColumns=True
    )
    ranged = rows.repartitionByRange(*_ORDER).withColumn("_range", F.spark_partition_id())
    held = materialise(ranged, "owners")
    owner = F.when(F.col("owns"), F.struct("place", "scope", "id"))
    so_far = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ends = held.groupBy("_range").agg(
        F.max(F.when(F.col("owns"), F.struct(*passage, "place", "id"))).alias("end")
    )
    earlier = ends.select("_range", F.last("end", ignorenulls=True).over(so_far).alias("end"))
    inside = (
        Window.partitionBy("_range", *passage)
        .orderBy("place", "owns", "id", "run")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = held.withColumn("near", F.last(owner, ignorenulls=True).over(inside)).filter("NOT owns")
    same = F.col("end").isNotNull()
    for name in passage:
        same &= F.col(f"end.{name}").eqNullSafe(F.col(name))
    carried = F.when(same, F.struct("end.place", "end.scope", "end.id"))
    return placed.join(F.broadcast(earlier), "_range").withColumn("near", F.coalesce("near", carried))


def _links(messages: DataFrame, hashed: DataFrame) -> DataFrame:
    """(id, parent): the earlier message that each message answers, if it quotes one."""
    who = messages.select("id", "scope", "place")
    located = hashed.join(who, "id").filter("place IS NOT NULL")
    own = located.filter("level = 0")
    earliest = F.min(F.struct("place", "scope", "id"))
    anywhere = own.groupBy("one", "two").agg(earliest.alias("far"))
    quotes = located.filter("level > 0").select(*_ORDER[:4], "id", "run", "level", "words")
    found = join_on(_with_last_owner(quotes, own), anywhere, ["one", "two"], "left")
    earlier = F.when(F.col("far.place") < F.col("place"), F.col("far"))
    owner = F.coalesce("near", earlier)
    weighed = (
        found.select("id", "level", "words", owner.alias("owner"))
        .filter(F.col("owner").isNotNull())
        .groupBy("id", "level", "owner")
        .agg(F.sum("words").alias("words"))
    )
    best = weighed.groupBy("id").agg(
        F.min(F.struct("level", -F.col("words"), "owner")).alias("best")
    )
    return best.select("id", F.col("best.owner.id").alias("parent"))


def _ancestry(links: DataFrame) -> DataFrame:
    """(id, root, depth) of all messages with a parent, by doubling the steps to the root."""
    held = materialise(
        links.select("id", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")),
        "ancestry",
    )
    while True:
        above = held.select(F.col("id").alias("root"), F.col("root").alias("top"), F.col("depth").alias("more"))
        joined = join_on(held, above, ["root"], "left")
        following = materialise(
            joined.select(
                "id",
                F.coalesce("top", "root").alias("root"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("more").isNotNull().alias("moved"),
            ),
            "ancestry",
        )
        discard(held)
        held = following.drop("moved")
        if not following.filter("moved").limit(1).count():
            return held


def conversations(
    messages: DataFrame, scope: str, place: str, text: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Messages as turns: their own text, whom they answer, and their place in the conversation.

    Returns scope, place, the kept columns, `parent_scope` and `parent_place`
    (null where nothing is answered), `root_scope` and `root_place` (the first
    message of the conversation, itself where nothing is answered), `depth`
    (answers up to the root), `n_quotes` (quoted passages) and the own text, its
    passages parted by blank lines. A parent always has a smaller depth, so
    sorting a conversation by depth and place gives the order of replies.

    A message answers only what has a smaller place, of repeated messages of its
    scope the last before it; ties of owners go to the least place, then scope. Rows without a place answer nothing and are not
    answered. A null or blank text has no passages and an empty text. Repeated
    rows are messages of their own with the same result. Extra columns are
    ignored unless kept.
    """
    rows = messages.select(
        column(scope).alias("scope"),
        column(place).alias("place"),
        column(text).alias("text"),
        F.struct(F.lit(0).alias("_"), *[column(name).alias(name) for name in keep]).alias("kept"),
    )
    held = materialise(rows.withColumn("id", F.monotonically_increasing_id()), "messages")
    found = materialise(_hashed(passages(held)), "passages")
    links = materialise(_links(held, found), "replies")
    roots = _ancestry(links)
    own = found.groupBy("id").agg(
        F.count_if(F.col("level") > 0).alias("n_quotes"),
        F.array_sort(
            F.collect_list(F.when(F.col("level") == 0, F.struct("run", "text")))
        ).alias("own"),
    )
    where = held.select("id", "scope", "place")
    parents = where.select(
        F.col("id").alias("parent"),
        F.col("scope").alias("parent_scope"),
        F.col("place").alias("parent_place"),
    )
    tops = where.select(
        F.col("id").alias("root"), F.col("scope").alias("top_scope"), F.col("place").alias("top_place")
    )
    joined = join_on(held.drop("text"), own, ["id"], "left")
    joined = join_on(join_on(joined, links, ["id"], "left"), roots, ["id"], "left")
    joined = join_on(join_on(joined, parents, ["parent"], "left"), tops, ["root"], "left")
    top = F.col("root").isNotNull()
    return joined.select(
        F.col("scope").alias(scope),
        F.col("place").alias(place),
        *[F.col("kept").getField(name).alias(name) for name in keep],
        "parent_scope",
        "parent_place",
        F.when(top, F.col("top_scope")).otherwise(F.col("scope")).alias("root_scope"),
        F.when(top, F.col("top_place")).otherwise(F.col("place")).alias("root_place"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"),
        F.coalesce(F.concat_ws("\n\n", "own.text"), F.lit("")).alias(text),
    )


def as_mail(
    turns: DataFrame, scope: str = "conv_id", place: str = "turn", text: str = "text"
) -> DataFrame:
    """Turns written as mail: each quotes the turn before it, and what that one quoted.

    The other columns stay. Turns are looked up by number, so a conversation of
    any length is spread over all tasks.
    """
    def before(steps: int) -> DataFrame:
        return turns.filter(column(place).isNotNull()).groupBy(
            column(scope).alias("_scope"), (column(place) + steps).alias("_place")
        ).agg(F.min(column(text)).alias(f"_back{steps}"))

    def quoted(name: str, marks: str) -> Column:
        return F.concat(F.lit(marks), F.regexp_replace(F.col(name), r"\r?\n", f"\n{marks}"))

    rows = turns.withColumns({"_scope": column(scope), "_place": column(place)})
    for steps in (1, 2):
        rows = join_on(rows, before(steps), ["_scope", "_place"], "left")
    mail = F.concat_ws(
        "\n",
        F.when(F.col("_back1").isNotNull(), F.lit("On some day they wrote:")),
        F.when(F.col("_back1").isNotNull(), quoted("_back2", "> > ")),
        quoted("_back1", "> "),
        F.when(F.col("_back1").isNotNull(), F.lit("")),
        column(text),
    )
    return rows.select(
        *[(F.when(column(text).isNotNull(), mail) if c == text else column(c)).alias(c) for c in turns.columns]
    )
