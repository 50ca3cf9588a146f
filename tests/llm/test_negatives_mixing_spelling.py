"""Hard negatives, mixing and spelling variants against plain versions."""

import math
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ticketmart.llm import mixing, negatives, spelling


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 40), st.integers(0, 40), st.integers(0, 40), st.integers(0, 9), st.booleans())
def test_strassen_is_exact(m, k, n, seed, large):
    random = np.random.default_rng(seed)
    most = 2**28 if large else 300
    a, b = random.integers(-most, most, (m, k)), random.integers(-most, most, (k, n))
    assert (negatives.strassen(a, b, leaf=3) == a @ b).all()


def plain_negatives(rows, mining):
    """Negatives by sorting all rows for every anchor."""
    good = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, label, v in rows
        if i is not None and label is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for anchor, label, v in good:
        if anchor % 10:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in good)  # noqa: B905
        same = [(i, -s) for s, i, other in scored if other == label and i != anchor]
        for positive, score in same[: mining.positives]:
            inside = [
                (i, -s) for s, i, other in scored
                if other != label and mining.low * score <= -100 * s <= 100 * score
            ]
            for rank, (i, s) in enumerate(inside[: mining.negatives], 1):
                out.append((anchor, positive, rank, i, score, s))
    return sorted(out)


SMALL_CELLS = {"anchors": 4, "candidates": 16}


def embeddings(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    return frame.withColumn("node", F.lit("x")).withColumn("v", F.lit(1)).withColumn("rank", F.lit(2))


@pytest.mark.parametrize("sizes", [SMALL_CELLS, {}])
def test_negatives_equal_those_of_all_rows(spark, sizes):
    random = np.random.default_rng(5)
    rows = []
    for i in range(260):
        label = int(random.choice([1, 1, 1, 2, 3]))  # a label with most of the rows
        rows.append((i, label, (random.integers(-3, 9, 5) / 16).tolist()))  # many ties
    rows += [(1000 + i, 2, rows[0][2]) for i in range(40)]  # copies under other labels
    rows += [(2000, None, [0.5] * 5), (2001, 1, None), (2002, 1, [0.5, None]), (None, 1, [0.5] * 5)]
    rows += [(2010, 1, [float("nan")] * 5), (2020, 2, [float("inf")] * 5), (2030, 1, [])]
    rows += [(2040, 3, [0.5] * 9), (2050, 3, [0.25]), rows[3], rows[3], rows[10]]
    rows += [(2060, 7, [0.5] * 5), (2070, 2, [-0.5] * 5)]
    mining = negatives.Mining(**sizes)
    frame = embeddings(spark, rows)
    whole = negatives.whole_rows(frame, is_anchor=F.col("vec_id") % 10 == 0)
    found = negatives.hard_negatives(whole, mining).collect()
    assert sorted(map(tuple, found)) == plain_negatives(rows, mining)
    none = negatives.whole_rows(frame.limit(0), is_anchor=F.lit(True))
    assert negatives.hard_negatives(none, mining).collect() == []
    unasked = negatives.whole_rows(frame, is_anchor=F.lit(False))
    assert negatives.hard_negatives(unasked, mining).collect() == []


def test_scores_beyond_64_bits_fail(spark):
    rows = [(i, 1, [1e17] * 4) for i in range(3)]
    whole = negatives.whole_rows(embeddings(spark, rows))
    with pytest.raises(Exception, match="do not fit 64 bits"):
        negatives.hard_negatives(whole).collect()


@settings(max_examples=150, deadline=None)
@given(
    st.dictionaries(st.integers(1, 12), st.integers(0, 3), max_size=5),
    st.integers(0, 60),
    st.sampled_from([1 << 22, 20]),
)
def test_counts_are_the_nearest(stock, rest, searched):
    before, mixing.SEARCHED = mixing.SEARCHED, searched
    try:
        taken = mixing.nearest_counts(list(stock), list(stock.values()), rest)
    finally:
        mixing.SEARCHED = before
    assert all(0 < n <= stock[length] for length, n in taken.items())
    sums = {
        sum(n * length for n, length in zip(counts, stock, strict=True))
        for counts in product(*[range(n + 1) for n in stock.values()])
    }
    found = sum(n * length for length, n in taken.items())
    if searched > 20:
        assert (abs(found - rest), found) == min((abs(s - rest), s) for s in sums)
    else:  # long documents first: near, if not always the nearest
        assert found == sum(sums and {max(sums)}) or abs(found - rest) <= max([*stock, rest])


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {name: 1 + i % 3 for i, name in enumerate(names)}
    full, whole = set(), sum(sizes.values())
    while True:
        words = whole - sum(3 * sizes[s] for s in full)
        share = sum(weight[s] for s in names if s not in full) or 1
        more = {s for s in names if s not in full and weight[s] * words > 3 * sizes[s] * share}
        if not more or not whole:
            return {s: 3 * sizes[s] if s in full else weight[s] * words / share for s in names}
        full |= more


def re_split(text):
    return re.split("[\x20\x09-\x0d]+", text)


def documents(spark):
    random = np.random.default_rng(3)
    rows = []
    for i in range(400):
        source = "big" if i % 3 == 0 else f"s{i % 7}"
        rows.append((i, " é\t ".join(["w"] * int(random.integers(0, 40))), source))
    rows += [(500 + i, "copy of a text", "copies") for i in range(120)]
    rows += [(700, "a b c", None), (701, None, None), (702, "", "empty"), (703, None, "nothing")]
    rows += [(704, "w " * 5000, "one long"), (705, "tiny", "ünï"), (None, "a b", "big"), (0, "a b", "big")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mix_comes_near_its_targets(spark):
    rows, frame = documents(spark)
    clash = frame.withColumns({name: F.lit("x") for name in ("size", "node", "no", "target", "at")})
    found = mixing.mix(clash).collect()
    again = mixing.mix(clash.repartition(5)).collect()
    key = lambda row: tuple(str(x) for x in row)
    assert sorted(found, key=key) == sorted(again, key=key)
    size = lambda text: len([w for w in re_split(text or "") if w])
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += size(text)
    expected = plain_targets(sizes)
    by_size = Counter((i, size(text), sizes[source], expected[source]) for i, text, source in rows)
    assert Counter((r.doc_id, r.size, r.source_size, r.target) for r in found) == by_size
    assert all(r.taken % max(1, r.size) == 0 and r.taken <= 3 * r.size for r in found)
    source_of = {i: source for i, _, source in rows if i is not None}
    taken = Counter()
    for r in found:
        taken[source_of.get(r.doc_id, "big")] += r.taken
    for source, target in expected.items():
        # one document of 5,000 words is farther from its target than none
        off = {"one long": target, "copies": 2}.get(source, 1)
        assert abs(taken[source] - target) <= off, source
    assert mixing.mix(frame.limit(0)).collect() == []


def test_mixed_rows_are_whole_documents(spark):
    rows, frame = documents(spark)
    frame = frame.withColumn("node", F.lit(1))
    found = Counter((r.doc_id, r.text, r.source) for r in mixing.mixed(frame).collect())
    taken = Counter()
    for r in mixing.mix(frame).collect():
        taken[r.doc_id] += r.taken
    words = Counter()
    for (doc_id, text, _), n in found.items():
        words[doc_id] += n * len([w for w in re_split(text or "") if w])
    assert +words == +taken
    assert set(found) <= set(rows)


def plain_variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        run = ""
        for letter in (text or "") + " ":
            if "A" <= letter <= "Z" or "a" <= letter <= "z" or "À" <= letter <= "ÿ":
                run += letter.lower() if letter < "a" else letter
                continue
            if run:
                name = "" if doc_id is None else str(doc_id)
                h = zlib.crc32(f"{name}:{run}".encode())
                if h % 199 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                counts[run] += 1
            run = ""
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in words if spelling.one_apart(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v.encode()), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def edits(one, other):
    """Edit distance by the whole table."""
    row = list(range(len(other) + 1))
    for i, a in enumerate(one, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(other, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abé", max_size=6), st.text("abé", max_size=6))
def test_one_apart(one, other):
    assert spelling.one_apart(one, other) == (edits(one, other) == 1)


def texts():
    random = np.random.default_rng(9)
    rows, letters = [], list("abcdeéÿ×z")
    base = ["".join(random.choice(letters, int(random.integers(6, 9)))) for _ in range(60)]
    base += ["abcabc", "abcabd", "abcbad", "cbacba", "x" * 60, "x" * 61, "x" * 59 + "y", "ab" * 400]
    for i, word in enumerate(base):
        other = base[i][:-1] + "z" if i % 2 else base[i] + "a"
        middle = base[i][:2] + base[i][3:] if i % 3 else "é" + base[i]
        for n, form in ((150, word), (25, other), (5, middle), (4, word + "zz")):
            rows += [(1000 * i + j, f"{form.upper() if j % 2 else form}, {form}!1 short") for j in range(n)]
    rows += [(None, "nameless words " * 7), (None, None), (5, ""), (5, None), (7, "ß" * 9 + " ")] * 3
    return rows


@pytest.mark.parametrize(
    ("groups", "shard", "leaf"), [(spelling.GROUPS, 25, 4), ((), 30, 8), (spelling.GROUPS, 4096, 256)]
)
def test_variants_equal_those_of_all_pairs(spark, groups, shard, leaf):
    rows = texts()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    expected = plain_variants(rows)
    words = spark.createDataFrame([(w, n) for w, *_, n, _, _ in expected], "word string, n long")
    near = spelling.near_words(words, groups, shard, leaf).collect()
    pairs = [(a, b) for a, *_ in expected for b, *_ in expected if spelling.one_apart(a, b)]
    assert sorted((r.word, r.near) for r in near) == sorted(pairs)
    if shard == spelling.SHARD:
        frame = frame.withColumns({name: F.lit(1) for name in ("word", "n", "run", "near", "name")})
        found = spelling.variants(frame)
        assert sorted(map(tuple, found.collect()), key=lambda r: r[0]) == expected
        assert any(row[2] not in (row[0], row[1]) for row in expected)  # a chain of two forms
        assert spelling.variants(frame.limit(0)).collect() == []
