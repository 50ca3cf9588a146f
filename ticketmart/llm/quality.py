"""Quality by a sparse ensemble of rules.

Small trees are grown on statistics of labelled texts; every path from a root is
a rule, a conjunction of conditions on statistics. A logistic model with an L1
penalty gives the rules weights, most of them zero. What remains is compiled into
one Spark column expression.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmart.llm.common import column, labelled_sample, map_text

#: Largest number of labelled rows that a model is fitted on.
SAMPLE_ROWS = 8_000
#: A text with this score or more counts as good.
THRESHOLD = 0.7

STATISTICS = (
    "log_chars",
    "log_words",
    "bytes_per_word",
    "upper_share",
    "digit_share",
    "symbol_share",
    "bar_share",
    "exclaim_per_word",
    "stop_per_word",
    "comma_per_word",
    "beyond_ascii_share",
    "space_share",
    "distinct_share",
    "top_word_share",
    "same_as_before_share",
    "longest_word",
    "symbol_end_share",
    "log_lines",
    "words_per_line",
    "repeated_line_share",
)

_UPPER = bytes(range(0x41, 0x5B))
_DIGIT = bytes(range(0x30, 0x3A))
_SPACE = b" \t\n\r\x0b\x0c"
_SYMBOL = b"#$%&*+/<=>@[\\]^_`{|}~"
_BEYOND = bytes(range(0x80, 0x100))
_SYMBOL_END = re.compile(rb"[#$%&*+/<=>@^_`{|}~!]+(?=\s|\Z)")


def statistics(text: str | None) -> tuple[float, ...]:
    """Statistics of a whole text; all zero for a null or empty one."""
    raw = (text or "").encode("utf-8", "replace")
    size = len(raw)
    if not size:
        return (0.0,) * len(STATISTICS)

    def share(kinds: bytes) -> float:
        return (size - len(raw.translate(None, kinds))) / size

    words = raw.split()
    n = max(len(words), 1)
    folded = [word.lower() for word in words]
    counts = Counter(folded)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    again = sum(map(bytes.__eq__, folded, folded[1:]))
    return (
        float(np.log1p(len(text))),
        float(np.log1p(len(words))),
        sum(map(len, words)) / n,
        share(_UPPER),
        share(_DIGIT),
        share(_SYMBOL),
        raw.count(b"|") / size,
        raw.count(b"!") / n,
        raw.count(b".") / n,
        raw.count(b",") / n,
        share(_BEYOND),
        share(_SPACE),
        len(counts) / n,
        max(counts.values(), default=0) / n,
        again / n,
        float(max(map(len, words), default=0)),
        len(_SYMBOL_END.findall(raw)) / n,
        float(np.log1p(len(lines))),
        len(words) / max(len(lines), 1),
        1 - len(set(lines)) / max(len(lines), 1),
    )


def with_statistics(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The kept columns and one column `s0`, `s1`, ... per statistic."""

    def work(texts: list[str | None]) -> list[pa.Array]:
        found = np.array([statistics(t) for t in texts]).reshape(-1, len(STATISTICS))
        return [pa.array(values) for values in found.T]

    schema = ", ".join(f"s{i} double" for i in range(len(STATISTICS)))
    return map_text(docs, text, schema, work, keep)


#: A condition: (statistic, bound, whether values above the bound meet it).
Condition = tuple[int, float, bool]


@dataclass(frozen=True)
class Rules:
    """Weighted conjunctions of conditions, and the constant term."""

    rules: tuple[tuple[tuple[Condition, ...], float], ...]
    bias: float

    def score(self) -> Column:
        """The model as an expression over the statistics' columns."""
        parts = [F.lit(self.bias)]
        for conditions, weight in self.rules:
            met = [
                F.col(f"s{i}") > bound if above else F.col(f"s{i}") <= bound
                for i, bound, above in conditions
            ]
            parts.append(F.when(reduce(Column.__and__, met), weight).otherwise(0.0))
        total = reduce(Column.__add__, parts)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


@dataclass(frozen=True)
class Growth:
    """Settings: trees, their depth, rows and statistics tried per tree, penalty, steps."""

    trees: int = 60
    depth: int = 3
    rows: int = 2_000
    tried: int = 8
    bins: int = 24
    penalty: float = 0.002
    steps: int = 400
    seed: int = 7


def _grow(
    binned: np.ndarray, y: np.ndarray, edges: list[np.ndarray], growth: Growth
) -> set[tuple[Condition, ...]]:
    """Paths of trees on random parts of the rows and statistics."""
    random = np.random.default_rng(growth.seed)
    found: set[tuple[Condition, ...]] = set()

    def split(rows: np.ndarray, path: tuple[Condition, ...]) -> None:
        if path:
            found.add(path)
        good = y[rows].sum()
        if len(path) == growth.depth or len(rows) < 20 or good in (0, len(rows)):
            return
        best = (1e-9, None, None)
        parent = good * (len(rows) - good) / len(rows)
        for i in random.choice(binned.shape[1], growth.tried, replace=False):
            if not len(edges[i]):
                continue
            size = np.bincount(binned[rows, i], minlength=len(edges[i]) + 1)
            ones = np.bincount(binned[rows, i], weights=y[rows], minlength=len(edges[i]) + 1)
            n, k = np.cumsum(size)[:-1], np.cumsum(ones)[:-1]
            m, j = len(rows) - n, good - k
            with np.errstate(divide="ignore", invalid="ignore"):
                rest = np.nan_to_num(k * (n - k) / n) + np.nan_to_num(j * (m - j) / m)
            gain = np.where((n >= 5) & (m >= 5), parent - rest, 0.0)
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (gain[at], int(i), at)
        _, i, at = best
        if i is None:
            return
        low = binned[rows, i] <= at
        bound = float(edges[i][at])
        split(rows[low], (*path, (i, bound, False)))
        split(rows[~low], (*path, (i, bound, True)))

    for _ in range(growth.trees):
        split(random.integers(0, len(y), min(growth.rows, len(y))), ())
    return found


def _lasso(x: np.ndarray, y: np.ndarray, penalty: float, steps: int) -> tuple[np.ndarray, float]:
    """Logistic weights under an L1 penalty, by accelerated proximal gradient steps."""
    mean = x.mean(axis=0)
    scale = np.sqrt(np.maximum(mean * (1 - mean), 1e-6))
    x = (x - mean) / scale
    rate = 4 * len(y) / max(np.linalg.norm(x, 2) ** 2, 1e-9)
    rate = min(rate, 4.0)
    w, b = np.zeros(x.shape[1]), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    ahead, ahead_b, t = w, b, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead + ahead_b, -35, 35)))
        step = ahead - rate * (x.T @ (p - y)) / len(y)
        new = np.sign(step) * np.maximum(np.abs(step) - rate * penalty, 0.0)
        new_b = ahead_b - rate * (p - y).mean()
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead = new + (before - 1) / t * (new - w)
        ahead_b = new_b + (before - 1) / t * (new_b - b)
        w, b = new, new_b
    return w / scale, float(b - (w / scale) @ mean)


def fit_rules(x: np.ndarray, y: np.ndarray, growth: Growth = Growth()) -> Rules:
    """Rules for a table of statistics with labels 0 and 1; one half without any row."""
    if not len(y):
        return Rules((), 0.0)
    levels = np.linspace(0, 1, growth.bins + 1)[1:-1]
    edges = [np.unique(np.quantile(column, levels)) for column in x.T]
    edges = [e[e < column.max()] for e, column in zip(edges, x.T, strict=True)]
    binned = np.stack(
        [np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T, strict=True)], 1
    )
    paths = sorted(_grow(binned, y, edges, growth))
    columns, kept, seen = [], [], set()
    for path in paths:
        met = np.ones(len(y), bool)
        for i, bound, above in path:
            met &= (x[:, i] > bound) == above
        key = np.packbits(met if met[0] else ~met).tobytes()
        if 0.002 < met.mean() < 0.998 and key not in seen:
            seen.add(key)
            columns.append(met)
            kept.append(path)
    if not kept:
        share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        return Rules((), float(np.log(share / (1 - share))))
    weights, bias = _lasso(
        np.stack(columns, 1).astype(np.float64), y.astype(np.float64), growth.penalty, growth.steps
    )
    rules = [(path, float(w)) for path, w in zip(kept, weights, strict=True) if abs(w) > 1e-6]
    return Rules(tuple(rules), bias)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    allowed: Column | None = None,
    sample_rows: int = SAMPLE_ROWS,
    growth: Growth = Growth(),
) -> Rules:
    """Rules from a bounded sample of labelled documents; its statistics reach the driver.

    `allowed` says which rows of `labels` may be learnt from.
    """
    allowed = F.lit(True) if allowed is None else allowed
    sample = labelled_sample(docs, labels, label, allowed, sample_rows)
    rows = sorted(map(tuple, with_statistics(sample, "_text", ["doc_id", "_label"]).collect()))
    x = np.array([row[2:] for row in rows]).reshape(-1, len(STATISTICS))
    return fit_rules(x, np.array([row[1] for row in rows], np.int64), growth)


def with_scores(docs: DataFrame, rules: Rules, name: str = "score") -> DataFrame:
    """doc_id and the probability that the text is good; null scores like an empty text."""
    rows = with_statistics(
        docs.select(column("doc_id").alias("doc_id"), column("text").alias("text")),
        "text",
        ["doc_id"],
    )
    return rows.select("doc_id", rules.score().alias(name))
