"""Personal data by weak supervision.

Patterns propose spans. Labelers look at each one and vote for, against, or not at
all: the strict form of its kind, lists of words and codes, the characters beside
it, the words before it, and its shape. Expectation-maximisation over the counts
of vote patterns estimates how reliable each labeler is and how likely each
pattern stands for personal data; a logistic span classifier is trained on these
soft labels and compiled into a column expression.

Spans that meet the strict form of the four base kinds always stay; the classifier
decides on all others. Vote patterns are few whatever the data (three votes, five
labelers, nine kinds), so only their counts reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmart.llm.common import column, materialise

#: The base kinds in the order in which spans are listed.
BASE = ("email", "ip", "card", "phone")
_EDGE = "(?:(?<![{0}])|\\G)"
#: Patterns by kind. Where the base patterns start within a run of their own
#: characters they match nothing that starting with the run does not, so starting
#: there is left out; and what cannot give back characters does not try to.
PATTERNS = {
    "email": _EDGE.format("A-Za-z0-9._%+-")
    + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _EDGE.format("0-9") + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "masked_email": r"[A-Za-z0-9._%+-]{1,64} ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{1,63}"
    r"(?: ?(?:\.|[\[(](?:dot|DOT)[\])]) ?[A-Za-z0-9-]{1,63})+",
    "local_phone": r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "person_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])",
    "secret": r"(?i:password|passwd|token|secret|api[_-]?key) ?[=:] ?\x22?[A-Za-z0-9_-]{8,}",
}
KINDS = tuple(PATTERNS)
#: Words that tell of personal data right before it, and domain ends in use.
_TELLING = (
    r"(?i)\b(?:mail|e-mail|email|contact|phone|tel|telephone|mobile|cell|call|fax|whatsapp|card|visa"
    r"|mastercard|credit|account|iban|ssn|social|password|login|user|ip|host|address|kontakt"
    r"|telefon|karte|konto|correo|tarjeta|teléfono|carte|compte|courriel)\b[^\n]{0,20}$"
)
_DOMAINS = r"(?i)\.(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu|it|nl|ch|at|co)$"
#: Characters of the pieces in which a text is looked up.
PIECE = 1024
#: Matches of a text whose places are summed one by one.
BLOCK = 32
LABELERS = ("strict", "listed", "beside", "before", "shape")
#: How much each labeler is trusted before any data is seen, as a share of all spans.
TRUST = {"strict": 10.0, "listed": 0.2, "beside": 0.2, "before": 0.2, "shape": 0.2}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""
    n = F.length(digits)

    def step(total: Column, i: Column) -> Column:
        digit = F.ascii(F.substring(digits, i, F.lit(1))) - 48
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when((n - i) % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) % 10 == 0


def _small_parts(value: Column) -> Column:
    """Whether all parts of dotted numbers are 255 at most."""
    return value.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}$")


#: Whether a match is worth a vote at all, whether it meets the strict form, and
#: which character a text must hold for the pattern to be tried.
_RULES: dict[str, tuple[Callable, Callable, str]] = {
    "email": (lambda v: F.lit(True), lambda v: F.lit(True), "@"),
    "ip": (lambda v: F.lit(True), _small_parts, "."),
    "card": (
        lambda v: F.length(_digits(v)).between(13, 19),
        lambda v: luhn(_digits(v)),
        "",
    ),
    "phone": (
        lambda v: F.length(_digits(v)).between(7, 17),
        lambda v: F.length(_digits(v)).between(9, 15),
        "+",
    ),
}


def _once(value: Column, work: Callable[[Column], Column]) -> Column:
    """What `work` makes of a value that is computed once, however often it is used there."""
    return F.get(F.transform(F.array(value), work), F.lit(0))


def _matches(text: Column, kind: str) -> Column:
    """(kind, start, end, value, strict) of the matches of a kind, in order.

    Starts and ends count code points. `strict` is null for kinds without a base
    form.
    """
    pattern = PATTERNS[kind]
    worth, strict, sign = _RULES.get(kind, (lambda v: F.lit(True), lambda v: F.lit(None), ""))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(values))
    pairs = F.zip_with(gaps, values, lambda g, v: F.struct(F.length(g).alias("gap"), v.alias("value")))
    none = F.array().cast("array<struct<kind:string,start:int,end:int,value:string,strict:boolean>>")

    def length(of: Column) -> Column:
        return F.aggregate(of, F.lit(0), lambda sum_, p: sum_ + p["gap"] + F.length(p["value"]))

    def spans(block: Column, begin: Column) -> Column:
        def ended(pair: Column, i: Column) -> Column:
            end = begin + length(F.slice(block, F.lit(1), i + 1))
            return F.struct(end.alias("end"), pair["value"].alias("value"))

        def span(match: Column) -> Column:
            return F.struct(
                F.lit(kind).alias("kind"),
                (match["end"] - F.length(match["value"])).alias("start"),
                match["end"].alias("end"),
                match["value"].alias("value"),
                strict(match["value"]).cast("boolean").alias("strict"),
            )

        good = F.filter(F.transform(block, ended), lambda match: worth(match["value"]))
        return F.transform(good, span)

    # a sum up to each match would grow with their square: sums inside blocks, and over blocks
    def in_blocks(pairs: Column) -> Column:
        last = F.floor((F.size(pairs) - 1) / BLOCK).cast("int")
        cut = F.transform(
            F.sequence(F.lit(0), last), lambda i: F.slice(pairs, i * BLOCK + 1, F.lit(BLOCK))
        )
        return F.when(F.size(pairs) > 0, _once(cut, placed)).otherwise(none)

    def placed(blocks: Column) -> Column:
        begins = F.aggregate(
            blocks,
            F.array(F.lit(0)),
            lambda sums, block: F.array_append(sums, F.element_at(sums, -1) + length(block)),
        )
        return F.flatten(F.zip_with(blocks, F.slice(begins, F.lit(1), F.size(blocks)), spans))

    found = _once(pairs, in_blocks)
    tried = text.rlike("[0-9]") if sign == "" else text.contains(sign)
    if kind == "masked_email":
        tried = text.rlike(r"(?i)[\[(]at[\])]")
    if kind == "secret":
        tried = text.rlike("(?i)password|passwd|token|secret|api[_-]?key")
    return F.when(tried, found).otherwise(none)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _cut(pieces: Column, at: Column, length: Column) -> Column:
    """Characters from a place on, counted from 1, of a text in pieces.

    Only the piece of the place and the next one are looked at, as a place in a
    whole text is found by counting all characters before it.
    """
    piece = F.floor((at - 1) / PIECE).cast("int")
    near = F.concat(F.get(pieces, piece), F.coalesce(F.get(pieces, piece + 1), F.lit("")))
    return F.coalesce(F.substring(near, at - piece * PIECE, length), F.lit(""))


def _votes(span: Column, pieces: Column) -> list[Column]:
    """The labelers' votes on a span: 1, -1, or 0 for none."""
    kind, value = span["kind"], span["value"]
    digits = _digits(value)
    left = _cut(pieces, F.greatest(span["start"] - 39, F.lit(1)), F.least(span["start"], F.lit(40)))
    left = F.when(kind == "secret", F.concat(left, F.lit(" password "))).otherwise(left)
    last = F.when(span["start"] > 0, _cut(pieces, span["start"], F.lit(1))).otherwise(" ")
    following = _cut(pieces, span["end"] + 1, F.lit(1))
    mixed = value.rlike(r"[=:] ?\x22?(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])[A-Za-z0-9_-]{12,}$")
    listed = (
        F.when(kind.isin("email", "masked_email"), _vote(value.rlike(_DOMAINS), F.lit(False)))
        .when(kind == "ip", _vote(F.lit(False), value.rlike(r"^(?:0|127|255)\.|\.255$")))
        .when(kind == "card", _vote(digits.rlike("^(?:3[47]|4|5[1-5]|6(?:011|5))"), digits.rlike("^[01]")))
        .when(kind == "phone", _vote(digits.rlike("^(?:1|33|34|39|41|43|44|49)"), digits.rlike("^0")))
        .when(kind == "secret", _vote(mixed, ~mixed))
        .otherwise(0)
    )
    apart = last.rlike(r"[\s(\[:;,\x22'<=]") & ((following == "") | following.rlike(r"[\s)\],.;:\x22'>!?]"))
    joined = last.rlike("[A-Za-z0-9_./-]") | following.rlike("[A-Za-z0-9_/]")
    same = digits.rlike(r"^([0-9])\1{6,}$") | F.lit("0123456789012345678").contains(digits)
    varied = F.size(F.array_distinct(F.split(digits, ""))) >= 5
    shape = _vote((F.length(digits) >= 7) & varied & ~same, (F.length(digits) >= 7) & same)
    return [
        _vote(span["strict"], ~span["strict"]),
        listed,
        _vote(apart, joined),
        _vote(left.rlike(_TELLING), F.lit(False)),
        shape,
    ]


def proposals(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds `spans`: every proposed span with its votes, base kinds first.

    Spans of other kinds that overlap a strict base span are left out.
    """
    plain = F.coalesce(column(text), F.lit(""))
    found = F.concat(*[_matches(plain, kind) for kind in KINDS])
    rows = docs.withColumn("_found", found)
    strict = F.filter("_found", lambda s: F.coalesce(s["strict"], F.lit(False)))
    pieces = F.when(
        F.size("_found") > 0, F.regexp_extract_all(plain, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    )
    rows = rows.withColumns({"_strict": strict, "_pieces": pieces})
    apart = F.filter(
        "_found",
        lambda s: F.coalesce(s["strict"], F.lit(False))
        | ~F.exists("_strict", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    voted = F.transform(
        apart,
        lambda s: F.struct(
            s["kind"].alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.coalesce(s["strict"], F.lit(False)).alias("base"),
            *[v.alias(name) for name, v in zip(LABELERS, _votes(s, F.col("_pieces")), strict=True)],
        ),
    )
    return rows.withColumn("spans", voted).drop("_found", "_strict", "_pieces")


@dataclass(frozen=True)
class SpanModel:
    """Weights of kinds and votes, and the labelers' estimated reliabilities."""

    bias: float
    weights: dict[tuple[str, object], float]
    reliability: dict[str, float]

    def score(self, span: Column) -> Column:
        """Log-odds that a span is personal data."""
        parts = [F.lit(self.bias)]
        for (name, value), weight in sorted(self.weights.items(), key=str):
            parts.append(F.when(span[name] == value, weight).otherwise(0.0))
        return reduce(Column.__add__, parts)


def estimate(
    counts: list[tuple[str, tuple[int, ...], int]], rounds: int = 50
) -> tuple[list[float], dict[str, float]]:
    """Probability that each (kind, votes) stands for personal data, and reliabilities.

    Expectation-maximisation with one prior per kind and, per labeler, the chance
    of each vote on personal data and on other text. It begins with the majority
    of the votes, the strict form counting twice. Every labeler begins with some
    spans judged rightly (TRUST), so that the two sides keep their meaning.
    """
    spans = sum(n for _, _, n in counts)
    sides = [1 / (1 + math.exp(-sum(votes) - votes[0])) for _, votes, _ in counts]
    chance: list[dict[tuple[int, int], float]] = []
    for _ in range(rounds):
        prior = {}
        for kind in {kind for kind, _, _ in counts}:
            own = [(p, n) for p, (k, _, n) in zip(sides, counts, strict=True) if k == kind]
            prior[kind] = (sum(p * n for p, n in own) + 1) / (sum(n for _, n in own) + 2)
        chance = []
        for j in range(len(LABELERS)):
            table = {}
            for side in (0, 1):
                sums = {-1: 1.0, 0: 1.0, 1: 1.0}
                sums[1 if side else -1] += TRUST[LABELERS[j]] * spans
                for p, (_, votes, n) in zip(sides, counts, strict=True):
                    sums[votes[j]] += n * (p if side else 1 - p)
                total = sum(sums.values())
                table |= {(side, vote): amount / total for vote, amount in sums.items()}
            chance.append(table)
        sides = []
        for kind, votes, _ in counts:
            odds = math.log(prior[kind] / (1 - prior[kind]))
            odds += sum(math.log(t[1, v] / t[0, v]) for t, v in zip(chance, votes, strict=True))
            sides.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
    reliability = {
        name: (t[1, 1] + t[0, -1]) / (t[1, 1] + t[1, -1] + t[0, 1] + t[0, -1])
        for name, t in zip(LABELERS, chance, strict=True)
    }
    return sides, reliability


def train(counts: list[tuple[str, tuple[int, ...], int]], steps: int = 500) -> SpanModel:
    """The span classifier for counted vote patterns; without any it refuses every span."""
    if not counts:
        return SpanModel(-1.0, {}, {})
    sides, reliability = estimate(counts)
    marks = [
        [("kind", kind), *[(name, v) for name, v in zip(LABELERS, votes, strict=True) if v]]
        for kind, votes, _ in counts
    ]
    weights = {mark: 0.0 for row in marks for mark in row}
    total, bias = float(sum(n for _, _, n in counts)), 0.0
    for _ in range(steps):
        slopes, slope = {mark: 0.001 * w for mark, w in weights.items()}, 0.0
        for row, side, (_, _, n) in zip(marks, sides, counts, strict=True):
            odds = bias + sum(weights[mark] for mark in row)
            error = n / total * (1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))) - side)
            slope += error
            for mark in row:
                slopes[mark] += error
        bias -= 4 * slope
        for mark, value in slopes.items():
            weights[mark] -= 4 * value
    return SpanModel(bias, weights, reliability)


def fit(proposed: DataFrame) -> SpanModel:
    """Span classifier from the vote patterns of all proposed spans."""
    spans = proposed.select(F.inline("spans"))
    rows = spans.groupBy("kind", *LABELERS).agg(F.count("*").alias("n")).collect()
    return train(sorted((row[0], tuple(row[1:-1]), row[-1]) for row in rows))


def _listed(spans: Column) -> Column:
    """kind:start:end of spans, by kind as listed, then start."""
    kinds = F.array(*[F.lit(kind) for kind in KINDS])
    placed = F.transform(
        spans,
        lambda s: F.struct(
            F.array_position(kinds, s["kind"]).alias("rank"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["kind"].alias("kind"),
        ),
    )
    return F.concat_ws(
        ",",
        F.transform(
            F.array_sort(placed),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
    )


def find(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    The counts and the digest cover the base spans, `spans` also those that the
    classifier adds. A null or empty text has none. Repeated rows give repeated
    results, extra columns are ignored, and an empty table gives an empty result.
    """
    rows = docs.select(column("doc_id").alias("doc_id"), column("text").alias("text"))
    proposed = materialise(proposals(rows).drop("text"), "spans")
    model = fit(proposed)
    base = F.filter("spans", lambda s: s["base"])
    chosen = F.filter("spans", lambda s: s["base"] | (model.score(s) > 0))

    def count(kind: str) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long")

    return (
        proposed.withColumns({"_base": base, "_all": chosen})
        .select(
            "doc_id",
            *[count(kind).alias(f"n_{kind}") for kind in BASE],
            F.sha2(_listed(F.col("_base")), 256).alias("base_sha256"),
            _listed(F.col("_all")).alias("spans"),
            (F.size("_all") - F.size("_base")).cast("long").alias("n_added"),
        )
    )
