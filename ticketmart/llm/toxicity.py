"""Toxicity by FTRL-proximal logistic regression over hashed words.

Features of a text are its words and their first letters, its pairs of
neighbouring words and its pairs with one word between (skip-grams), hashed into
2**20 places; a feature counts once however often it occurs. Every place has a
learning rate of its own, and the L1 term keeps most weights at zero, so the
model that tasks receive is a short list of places and weights. Two halves of the
sample judge each other to choose the L1 term, and the score from which on a text
is marked; the model is then learnt from all of it.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketmart.llm.common import column, labelled_sample, map_text, unused

BITS = 20
#: Largest number of labelled rows that a model is fitted on.
SAMPLE_ROWS = 6_000
#: Largest number of bytes of their texts together; rows beyond are left out whole.
SAMPLE_BYTES = 48_000_000
#: A text with this score or more is marked.
THRESHOLD = 0.7

_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 32
    for c in range(256)
)
#: Odd multipliers that mix the hashes of two words.
_MIX = {
    "pair": (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)),
    "skip": (np.uint64(0x165667B19E3779F9), np.uint64(0x27D4EB2F165667C5)),
}


#: Numbers of first letters that are features.
BEGINNINGS = (4, 5, 6)


class _Hashes(dict):
    """Hashes of words already seen and of their beginnings; begun anew when it has grown large."""

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= 100_000:
            self.clear()
        letters = word.decode("utf-8", "replace")
        begun = [f"^{letters[:n]}" for n in BEGINNINGS if len(letters) > n]
        value = self[word] = tuple(map(xxhash.xxh64_intdigest, [word, *begun]))
        return value


_HASHES = _Hashes()


def features(text: str | None) -> np.ndarray:
    """Distinct places of a text's features, in order; none for a text without words."""
    return np.unique(_places(text))


def _places(text: str | None) -> np.ndarray:
    words = (text or "").encode("utf-8", "replace").translate(_FOLD).split()
    if not words:
        return np.empty(0, np.int64)
    one = np.fromiter((_HASHES[word][0] for word in words), np.uint64, len(words))
    begun = [value for word in set(words) for value in _HASHES[word][1:]]
    parts = [one, np.array(begun, np.uint64)]
    for gap, name in ((1, "pair"), (2, "skip")):
        a, b = _MIX[name]
        parts.append(one[:-gap] * a + one[gap:] * b)
    places = np.concatenate(parts) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)
    return places.astype(np.int64)


@dataclass(frozen=True)
class Rates:
    """Settings of the learner: rate, its smoothing, and the two penalties."""

    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.1
    rounds: int = 3


class Learner:
    """Per-coordinate FTRL-proximal state over all places and the constant term."""

    def __init__(self, rates: Rates = Rates()) -> None:
        self.rates = rates
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, places: np.ndarray) -> np.ndarray:
        rates, z = self.rates, self.z[places]
        l1 = np.where(places == 1 << BITS, 0.0, rates.l1)
        steps = (rates.beta + np.sqrt(self.n[places])) / rates.alpha + rates.l2
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / steps)

    def learn(self, places: np.ndarray, label: int) -> None:
        at = np.append(places, 1 << BITS)
        weights = self.weights(at)
        gradient = _logistic(weights.sum()) - label
        grown = np.sqrt(self.n[at] + gradient**2) - np.sqrt(self.n[at])
        self.z[at] += gradient - grown / self.rates.alpha * weights
        self.n[at] += gradient**2

    def model(self) -> Model:
        used = np.flatnonzero(np.abs(self.z[:-1]) > self.rates.l1)
        bias = float(self.weights(np.array([1 << BITS]))[0])
        return Model(used, self.weights(used), bias)


@dataclass(frozen=True)
class Model:
    """Places with a weight, in order, their weights, and the constant term."""

    places: np.ndarray
    weights: np.ndarray
    bias: float

    def logit(self, found: np.ndarray) -> float:
        if not len(self.places) or not len(found):
            return self.bias
        at = np.minimum(np.searchsorted(self.places, found), len(self.places) - 1)
        return float(self.bias + self.weights[at][self.places[at] == found].sum())

    @cached_property
    def _dense(self) -> np.ndarray:
        dense = np.zeros(1 << BITS)
        dense[self.places] = self.weights
        return dense

    def score(self, text: str | None) -> float:
        """As the logit of its features says, of which only those with a weight are sorted."""
        found = _places(text)
        return _logistic(self.logit(np.unique(found[self._dense[found] != 0])))

    def __getstate__(self) -> dict:
        """What tasks receive: places and weights."""
        return {"places": self.places, "weights": self.weights, "bias": self.bias}


def _logistic(value: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(value, -35.0, 35.0))))


#: L1 terms among which the halves of the sample choose.
L1_TERMS = (2.0, 4.0, 8.0)
#: (places, label) of each row.
Rows = list[tuple[np.ndarray, int]]


def _learnt(rows: Rows, rates: Rates) -> Model:
    learner = Learner(rates)
    for _ in range(rates.rounds):
        for places, label in rows:
            learner.learn(places.astype(np.int64), label)
    return learner.model()


def best_cut(logits: np.ndarray, labels: np.ndarray) -> float | None:
    """Middle of the widest gap between logits that parts the labels with the best F1."""
    order = np.argsort(-logits, kind="stable")
    logits, labels = logits[order], labels[order]
    found = np.cumsum(labels)
    f1 = 2 * found / (np.arange(1, len(labels) + 1) + max(1, labels.sum()))
    gap = np.append(logits[:-1] - logits[1:], 0.0)
    usable = np.flatnonzero((gap > 0) & (f1 > 0))
    if not len(usable):
        return None
    at = max(usable, key=lambda i: (f1[i], gap[i]))
    return float(logits[at] + logits[at + 1]) / 2


def learn(rows: Rows, rates: Rates = Rates(), threshold: float = THRESHOLD) -> Model:
    """Model of all rows; its L1 term and its marking score come from halves that judge each other."""
    halves = rows[::2], rows[1::2]
    labels = np.array([label for half in halves for _, label in half])
    if len(rows) < 4 or not 0 < labels.sum() < len(labels):
        return _learnt(rows, rates)
    best = None
    for l1 in L1_TERMS:
        tried = replace(rates, l1=l1)
        logits = np.concatenate(
            [
                [model.logit(places) for places, _ in half]
                for half, model in zip(halves, (_learnt(half, tried) for half in halves[::-1]), strict=True)
            ]
        )
        loss = float(np.logaddexp(0, np.where(labels == 1, -logits, logits)).sum())
        if best is None or loss < best[0]:
            best = loss, tried, logits
    model = _learnt(rows, best[1])
    cut = best_cut(best[2], labels)
    if cut is None:
        return model
    return replace(model, bias=model.bias + np.log(threshold / (1 - threshold)) - cut)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    allowed: Column | None = None,
    sample_rows: int = SAMPLE_ROWS,
    rates: Rates = Rates(),
    sample_bytes: int = SAMPLE_BYTES,
) -> Model:
    """Model of a bounded sample of labelled documents.

    `allowed` says which rows of `labels` may be learnt from. Only the places of
    the sample's features reach the driver: at most as many bytes as a few times
    `sample_bytes`, as rows beyond it, in the order of their hashes, are left out.
    Without any labelled row every score is one half.
    """
    allowed = F.lit(True) if allowed is None else allowed
    sample = labelled_sample(docs, labels, label, allowed, sample_rows)
    # a window over at most `sample_rows` rows, without their texts
    sizes = sample.select("doc_id", F.octet_length("_text").alias("bytes"))
    so_far = Window.orderBy(F.xxhash64("doc_id"), "doc_id")
    within = sizes.withColumn("sum", F.sum("bytes").over(so_far)).where(F.col("sum") <= sample_bytes)
    sample = sample.join(within.select("doc_id"), "doc_id", "left_semi")

    def places(texts: list[str | None]) -> list[pa.Array]:
        return [pa.array([features(t).astype("<i4").tobytes() for t in texts], pa.binary())]

    hashed = map_text(sample, "_text", "places binary", places, keep=["doc_id", "_label"])
    rows = sorted(
        (xxhash.xxh64_intdigest(str(doc_id)), bytes(found), marked)
        for doc_id, marked, found in hashed.collect()
    )
    return learn([(np.frombuffer(found, "<i4"), marked) for _, found, marked in rows], rates)


def with_scores(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Adds the probability that a text is toxic; null and empty texts get the constant term's."""

    def work(texts: list[str | None]) -> list[pa.Array]:
        return [pa.array([model.score(text) for text in texts], pa.float64())]

    return map_text(docs, "text", f"`{name}` double", work)


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is below the threshold, with their own columns."""
    name = unused(docs, "_score")
    scored = with_scores(docs, model, name)
    return scored.filter(column(name) < threshold).select(*[column(c) for c in docs.columns])
