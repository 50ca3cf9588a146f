"""Operators on documents against plain versions, and their defined edge cases."""

import hashlib
import random
import re
import time
import tracemalloc

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketmart.llm import (
    checks,
    decontamination,
    lines,
    personal_data,
    quality,
    quotes,
    sentencepiece,
    simhash,
    toxicity,
)

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EMPTY_CASES = [(None, None), (1, None), (2, ""), (3, " \n\t "), (3, " \n\t "), (4, "x " * 40_000)]


def documents(spark, rows, clash=()):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for name in clash:
        frame = frame.withColumn(name, F.lit("kept"))
    return frame


# -- SentencePiece


def pieces(kind="bpe"):
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(sentencepiece.read_model(MODEL))
    if kind == "unigram":
        proto.trainer_spec.model_type = 1
        chance = random.Random(5)
        for piece in proto.pieces:
            if piece.type == 1:
                piece.score = -chance.uniform(4, 16)
    raw = proto.SerializeToString()
    return sentencepiece.Pieces(raw), SentencePieceProcessor(model_proto=raw)


def test_ids_are_those_of_merging():
    ours, library = pieces()
    chance = random.Random(1)
    signs = list("abcdeghinorst   \n\t.,!?éñ中文🙂▁ABC0123''  ")
    texts = ["".join(chance.choices(signs, k=chance.randint(0, 60))) for _ in range(800)]
    texts += ["  the  of", " " * 70, "a" * 300, "\n\n", "don't stop; it's fine.", "x " * 30_000]
    found = [ids.tolist() for ids in ours.encode(texts)]
    assert found == [library.encode(text) for text in texts]
    assert [ours.decode(ids) for ids in found] == [library.decode(ids) for ids in found]


def test_unigram_pieces_have_the_best_score():
    ours, library = pieces("unigram")
    texts = ["the reading of thoughts", "unbelievable stories about nothing", "日本 text", "a  b"]
    for text, ids in zip(texts, ours.encode(texts), strict=True):
        best = library.encode(text)
        score = lambda found: sum(ours.scores[i] for i in found)
        assert ours.decode(ids.tolist()) == text
        assert score(ids.tolist()) == pytest.approx(score(best), abs=1e-3)


def test_prefix_states_do_not_change_the_result():
    ours, _ = pieces()
    words = sorted({"▁the", "▁then", "▁there", "▁theorem", "▁th", "▁a", "▁abc", "thing", "things"})
    assert dict(ours.walk(words)) == {w: next(iter(ours.walk([w])))[1] for w in words}


def test_encoding_of_odd_rows(spark):
    rows = [*EMPTY_CASES, (5, "has ▁ mark"), (6, "🙂 zwölf\x00")]
    docs = documents(spark, rows, clash=("ids", "n_ids"))
    model = sentencepiece.read_model(MODEL)
    coded = sentencepiece.with_ids(docs, model)
    assert coded.columns == ["doc_id", "text", "n_ids", "ids", "round_trip"]
    found = [(r.doc_id, r.ids, r.round_trip) for r in coded.orderBy("doc_id").collect()]
    assert found[0] == (None, None, None)
    assert found[1] == (1, None, None)
    assert found[2] == (2, [], True)
    assert [row[2] for row in found[3:]] == [True, True, True, False, True]
    again = sentencepiece.with_text(coded, model).orderBy("doc_id").collect()
    assert [r.decoded for r in again if r.doc_id == 6] == ["🙂 zwölf\x00"]
    assert sentencepiece.encoded(docs.limit(0), model).collect() == []


# -- personal data


def plain_spans(text):
    def luhn(digits):
        total = 0
        for i, c in enumerate(reversed(digits)):
            v = int(c) * (1 + i % 2)
            total += v - 9 if v > 9 else v
        return total % 10 == 0

    bare = lambda m: re.sub(r"\D", "", m)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            lambda m: all(int(x) <= 255 for x in m.split(".")),
        ),
        "card": (
            r"[0-9]([\x20-]?[0-9])+",
            lambda m: 13 <= len(bare(m)) <= 19 and luhn(bare(m)),
        ),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(bare(m)) <= 15),
    }
    return [
        (kind, m.start(), m.end())
        for kind, (pattern, valid) in kinds.items()
        for m in re.finditer(pattern, text or "")
        if valid(m.group())
    ]


def test_base_spans_equal_the_plain_patterns(spark):
    chance = random.Random(3)
    texts = ["".join(chance.choices("a1.@+- 2345()é🙂9_\n", k=90)) for _ in range(400)]
    texts += ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8 300.1.1.1 001.02.3.4", "4111 1111 1111 1111."]
    texts += ["1." * 3000, "1 2 3 4 " * 900, "a" * 4000 + "@b.c", "é +1 (988) 555-2485. +12"]
    rows = [*EMPTY_CASES, *enumerate(texts, start=10)]
    found = personal_data.find(documents(spark, rows, clash=("spans", "_found")))
    by_id = {r.doc_id: r for r in found.collect()}
    assert found.count() == len(rows)
    for doc_id, text in rows:
        spans, row = plain_spans(text), by_id[doc_id]
        listed = [f"{k}:{a}:{b}" for k, a, b in spans]
        assert row.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        counts = [sum(s[0] == kind for s in spans) for kind in personal_data.BASE]
        assert counts == [row.n_email, row.n_ip, row.n_card, row.n_phone]
        assert set(listed) <= set(row.spans.split(",")) | {""}
    assert personal_data.find(documents(spark, rows).limit(0)).collect() == []


def test_texts_of_very_many_spans(spark):
    """Places of 20,000 matches, at ends of blocks and within, in a text of one kind and of two."""
    emails = " ".join(f"a{i}@x.org" for i in range(20_000))
    both = " ".join(f"b{i}@y.org 10.0.{i % 300}.{i % 256}" for i in range(65))
    rows = [(1, emails), (2, both), (3, "c@d.org " * 32), (4, "c@d.org " * 33)]
    started = time.perf_counter()
    found = {r.doc_id: r for r in personal_data.find(documents(spark, rows)).collect()}
    assert time.perf_counter() - started < 60
    for doc_id, text in rows:
        spans = plain_spans(text)
        assert found[doc_id].n_email == sum(kind == "email" for kind, _, _ in spans)
        listed = ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)
        assert found[doc_id].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()


def test_the_classifier_adds_spans_and_refuses_others(spark):
    rows = [(i, f"write to a{i}@site.com or call +1 (212) 555-{1000 + i}") for i in range(40)]
    rows += [(100 + i, f"password=b7db7aa4a5fcc7{i:04d} and 411111111111111{i % 10}") for i in range(20)]
    found = {r.doc_id: r for r in personal_data.find(documents(spark, rows)).collect()}
    assert all("secret:0:" in found[100 + i].spans for i in range(20))
    bad = [i for i in range(10) if i != 1]  # only one last digit passes the check
    assert all("card" not in found[100 + i].spans for i in bad)
    assert "card" in found[101].spans


def test_reliabilities_come_from_agreement():
    counts = [("card", (1, 1, 1, 0, 1), 90), ("card", (-1, -1, 1, 0, 1), 30)]
    sides, reliability = personal_data.estimate(counts)
    assert sides[0] > 0.9 > 0.1 > sides[1]
    assert reliability["strict"] > 0.9
    assert personal_data.train([]).weights == {}


# -- line dedup


def plain_line_dedup(rows, least):
    """Deletes every line of a run of `least` words that begins earlier, by comparing runs."""
    docs = {}
    for doc_id, text in dict.fromkeys(rows):
        cut = [line.strip(" \t\r\x0b\x0c") for line in (text or "").split("\n")]
        docs[doc_id, text] = [line for line in cut if line]
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    seen, gone = {}, set()
    for doc in order:
        found = docs[doc]
        for i in range(len(found)):
            for j in range(i + 1, len(found) + 1):
                run = tuple(found[i:j])
                if sum(len(line.split()) for line in run) < least:
                    continue
                if seen.setdefault(run, (doc, i)) != (doc, i):
                    gone |= {(doc, k) for k in range(i, j)}
    out = []
    for doc in rows:
        kept = [line for k, line in enumerate(docs[doc]) if (doc, k) not in gone]
        lost = len(docs[doc]) - len(kept)
        out.append((doc[0], doc[1] if not lost else "\n".join(kept), len(docs[doc]), lost))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_deleted_lines_equal_those_of_all_runs(spark, seed):
    chance = random.Random(seed)
    pool = [" ".join(chance.choices("abcdef", k=chance.randint(1, 6))) for _ in range(12)]
    rows = [
        (i, "\n".join(chance.choice([*pool, " ", f"own {i} {k}"]) for k in range(chance.randint(0, 14))))
        for i in range(40)
    ]
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, "\n".join(pool * 3)), (103, "\n".join(pool))]
    found = lines.with_deduped_text(documents(spark, rows), min_words=9).collect()
    assert sorted(map(tuple, found)) == sorted(plain_line_dedup(rows, 9))


def test_line_dedup_of_odd_rows(spark):
    long = "\n".join(f"line {i} of a very long text" for i in range(3000))
    rows = [*EMPTY_CASES, (7, long), (8, long), (8, long), (None, "z " * 60), (9, " z" * 60)]
    docs = documents(spark, rows, clash=("doc", "place", "n_lines", "_hash"))
    cleaned = lines.with_deduped_text(docs)
    assert cleaned.count() == len(rows)
    found = {(r.doc_id, (r.text or "")[:3]): (r.n_lines, r.n_removed) for r in cleaned.collect()}
    assert found[7, "lin"] == (3000, 0)
    assert found[8, ""] == (3000, 3000)
    assert found[None, "z z"] == (1, 0)
    assert found[9, ""] == (1, 1)
    kept = lines.without_repeated_lines(docs.withColumn("n_chars", F.length("text").cast("long")))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 3, 4, 7]
    assert lines.with_deduped_text(docs.limit(0)).collect() == []


# -- benchmark decontamination


def plain_contamination(docs, items):
    cut = lambda t: re.findall(
        r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
        "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""),
    )
    windows = {}
    for item, text in items:
        w = cut(text)
        for i in range(max(len(w) - 9, 1 if w else 0)):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = cut(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                owners = windows.get(tuple(w[i : i + size]))
                if owners:
                    hit |= set(range(i, i + size))
                    found |= owners
        names = ",".join(sorted(str(x) for x in found))
        digest = hashlib.sha256(names.encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_contamination_equals_a_plain_search(spark, seed):
    chance = random.Random(seed)
    vocabulary = ["ab", "Cd", "é", "É", "f7", "the"]
    items = [(i, " ".join(chance.choices(vocabulary, k=chance.randint(0, 25)))) for i in range(12)]
    items += [(50, None), (51, "..."), (7, "the same id twice " * 4), (52, "only four words here")]
    docs = [(i, ", ".join(chance.choices(vocabulary, k=chance.randint(0, 90)))) for i in range(60)]
    for i in range(60, 90):
        words = chance.choice(items)[1] or ""
        docs.append((i, f"own {words.upper()} own {words[3:60]}; only FOUR words-here"))
    docs += EMPTY_CASES
    frame = documents(spark, docs, clash=("_one", "start", "print", "item_id"))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("one", F.lit(1))
    found = decontamination.contamination(frame, bench).collect()
    key = lambda row: tuple(str(x) for x in row)
    assert sorted(map(tuple, found), key=key) == sorted(plain_contamination(docs, items), key=key)
    kept = decontamination.without_contaminated(frame, bench)
    assert kept.columns == frame.columns
    assert kept.count() == sum(not row[-1] for row in plain_contamination(docs, items))
    assert not any(r.contaminated for r in decontamination.contamination(frame, bench.limit(0)).collect())


def test_items_that_share_a_phrase_are_met_once(spark):
    phrase = " ".join(f"w{i}" for i in range(13))  # four windows
    items = [(i, f"{phrase} own{i} a b") for i in range(300)] + [(None, f"{phrase} x")]
    docs = [(i, f"{i} {phrase} {i}") for i in range(50)] + [(99, "own7 a b")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.contamination(documents(spark, docs), bench).collect()
    named = ",".join(sorted(str(i) for i in range(300)))
    digest = hashlib.sha256(named.encode()).hexdigest()
    for r in found:
        expected = (13, 300, digest) if r.doc_id < 99 else (0, 0, hashlib.sha256(b"").hexdigest())
        assert (r.n_hit, r.n_items, r.items_sha256) == expected
    kept, windows = decontamination.item_windows(bench)
    hits = decontamination.hits(documents(spark, docs), ["doc_id"], "text", kept, windows)
    assert hits.distinct().count() == 50 * 4 and hits.count() < 50 * 4 * 3
    _, named = decontamination._items_by_class(windows)
    assert named.count() == 300 + 300  # the phrase's class, and one of each item's own windows


# -- quality and toxicity


def labelled(spark, n=700):
    chance = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(chance.choices("abcdefgh", k=4)) for _ in range(chance.randint(20, 60))]
        kind = i % 7
        if kind == 0:
            words.insert(chance.randrange(len(words)), "vile" if i % 2 else "nasty")
        text = " ".join(f"{w}###" if kind == 1 else w for w in words) + "."
        rows.append((i, text))
        labels.append((i, int(kind != 1), int(kind == 0)))
    return documents(spark, rows), spark.createDataFrame(
        [*labels, (None, 1, 1), (10_000, 0, None), (0, 1, 1)],
        "doc_id long, quality int, toxic int",
    )


def test_quality_rules_hold_on_unseen_rows(spark):
    docs, labels = labelled(spark)
    rules = quality.fit(docs, labels, allowed=F.col("doc_id") < 400)
    scores = {r.doc_id: r.score for r in quality.with_scores(docs, rules).collect()}
    right = [(scores[i] >= quality.THRESHOLD) == (i % 7 != 1) for i in range(400, 700)]
    assert sum(right) / len(right) > 0.97
    assert 0 < len(rules.rules) < 60
    odd = quality.with_scores(documents(spark, EMPTY_CASES, clash=("s0", "score")), rules).collect()
    assert len(odd) == len(EMPTY_CASES) and all(0 <= r.score <= 1 for r in odd)
    assert quality.fit(docs, labels.limit(0)).rules == ()
    assert quality.with_scores(docs.limit(0), rules).collect() == []


def test_rules_score_as_they_read(spark):
    """The compiled expression against a walk over the conditions, on whole texts."""
    docs, labels = labelled(spark, 300)
    rules = quality.fit(docs, labels)
    assert any(len(conditions) > 1 for conditions, _ in rules.rules)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in quality.with_scores(docs, rules).collect():
        found = quality.statistics(texts[r.doc_id])
        total = rules.bias + sum(
            weight
            for conditions, weight in rules.rules
            if all((found[i] > bound) == above for i, bound, above in conditions)
        )
        assert r.score == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-12)


def test_lasso_weights_meet_the_conditions_of_an_optimum():
    chance = np.random.default_rng(2)
    x = (chance.random((400, 12)) < 0.4).astype(float)
    y = (chance.random(400) < 1 / (1 + np.exp(1 - 3 * x[:, 0] + 2 * x[:, 1]))).astype(float)
    penalty = 0.02
    weights, bias = quality._lasso(x, y, penalty, 3000)
    scale = np.sqrt(x.mean(axis=0) * (1 - x.mean(axis=0)))
    error = 1 / (1 + np.exp(-(x @ weights + bias))) - y
    slope = ((x - x.mean(axis=0)) / scale).T @ error / len(y)
    used = np.abs(weights) > 1e-9
    assert 0 < used.sum() < 12 and abs(error.mean()) < 1e-4
    assert np.allclose(slope[used], -penalty * np.sign(weights[used]), atol=1e-3)
    assert (np.abs(slope[~used]) <= penalty + 1e-3).all()


def test_learner_takes_the_steps_of_ftrl_proximal():
    """The vectors of the learner against the formulas, place by place."""
    chance = random.Random(6)
    rates = toxicity.Rates(alpha=0.7, beta=0.5, l1=0.3, l2=0.2)
    learner, z, n, bias = toxicity.Learner(rates), {}, {}, 1 << toxicity.BITS

    def weight(i):
        l1 = 0.0 if i == bias else rates.l1
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        pull = l1 if z[i] > 0 else -l1
        return (pull - z[i]) / ((rates.beta + n.get(i, 0.0) ** 0.5) / rates.alpha + rates.l2)

    for _ in range(300):
        places = sorted(chance.sample(range(40), chance.randint(0, 9)))
        label = int(bool(set(places) & {3, 5}))
        learner.learn(np.array(places, np.int64), label)
        every = [*places, bias]
        weights = {i: weight(i) for i in every}
        gradient = 1 / (1 + np.exp(-sum(weights.values()))) - label
        for i in every:
            before = n.get(i, 0.0)
            n[i] = before + gradient**2
            z[i] = z.get(i, 0.0) + gradient - (n[i] ** 0.5 - before**0.5) / rates.alpha * weights[i]
    model = learner.model()
    expected = {i: weight(i) for i in range(40) if weight(i)}
    assert dict(zip(model.places.tolist(), model.weights.tolist(), strict=True)) == pytest.approx(expected)
    assert model.bias == pytest.approx(weight(bias)) and {3, 5} <= set(expected)


def test_toxicity_weights_are_few_and_hold_on_unseen_rows(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels, allowed=F.col("doc_id") < 400)
    assert 0 < len(model.places) < 500
    scores = {r.doc_id: r.score for r in toxicity.with_scores(docs, model).collect()}
    order = sorted(range(400, 700), key=scores.get, reverse=True)
    worst = order[: sum(i % 7 == 0 for i in order)]
    assert sum(i % 7 == 0 for i in worst) / len(worst) > 0.95
    marked = [scores[i] >= toxicity.THRESHOLD for i in range(400, 700)]
    toxic = [i % 7 == 0 for i in range(400, 700)]
    right = sum(a and b for a, b in zip(marked, toxic, strict=True))
    assert right / sum(toxic) > 0.95 and right / sum(marked) > 0.95
    few = toxicity.fit(docs, labels, sample_bytes=2_000)
    assert len(few.places) < len(toxicity.fit(docs, labels).places)
    odd = documents(spark, EMPTY_CASES, clash=("score", "_score"))
    assert toxicity.without_toxic(odd, model).columns == odd.columns
    assert toxicity.without_toxic(odd, model).count() == len(EMPTY_CASES)
    empty = toxicity.fit(docs, labels.limit(0))
    assert empty.score("anything") == 0.5
    assert toxicity.with_scores(docs.limit(0), model).collect() == []


def test_toxic_words_are_known_by_their_beginnings(spark):
    """Every toxic word of the unseen rows is new, but begins as others do."""
    chance = random.Random(3)
    rows = []
    for i in range(600):
        words = ["".join(chance.choices("abcdefgh", k=7)) for _ in range(20)]
        ending = "".join(chance.choices("abcdefgh", k=5))
        rows.append((i, " ".join([*words, f"viles{ending}" if i % 4 == 0 else "calm"])))
    frame = documents(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(frame, labels, allowed=F.col("doc_id") < 400)
    scores = {r.doc_id: r.score for r in toxicity.with_scores(frame, model).collect()}
    assert all((scores[i] >= toxicity.THRESHOLD) == (i % 4 == 0) for i in range(400, 600))


def test_cut_parts_labels_best():
    cut = toxicity.best_cut(np.array([3.0, -2.0, 1.0, -4.0]), np.array([1, 0, 1, 0]))
    assert cut == -0.5
    assert toxicity.best_cut(np.zeros(4), np.array([1, 0, 1, 0])) is None


def test_features_fold_case_and_ends():
    assert (toxicity.features("Vile, words") == toxicity.features("vile words.")).all()
    assert len(toxicity.features("a b c")) == 6  # three words, two pairs, one skip
    assert len(toxicity.features(None)) == 0


# -- chat formatting


def test_conversations_come_back_from_mail(spark):
    turns = [
        ("a", 0, "user", "How do I start?"),
        ("a", 1, "assistant", "Open the door.\nThen walk."),
        ("a", 2, "user", "Which door?"),
        ("b", 0, "user", "How do I start?"),
        ("b", 1, "assistant", "You wait."),
        ("c", 0, "user", None),
        ("c", 1, "assistant", ""),
        (None, 0, "user", "No name"),
        ("d", None, "user", "No place"),
    ]
    frame = spark.createDataFrame(turns, "conv_id string, turn long, role string, text string")
    mail = quotes.as_mail(frame)
    assert "> > How do I start?" in [r.text for r in mail.collect() if r.turn == 2][0]
    out = quotes.conversations(mail, "conv_id", "turn", keep=("role",))
    found = {(r.conv_id, r.turn): r for r in out.collect()}
    assert len(found) == len(turns)
    assert [found["a", i].text for i in range(3)] == [t[3] for t in turns[:3]]
    assert [(found["a", i].parent_place, found["a", i].depth) for i in range(3)] == [
        (None, 0),
        (0, 1),
        (1, 2),
    ]
    assert (found["b", 1].root_scope, found["b", 1].root_place) == ("b", 0)
    assert found["c", 1].text == "" and found["c", 1].parent_place is None
    assert quotes.conversations(mail.limit(0), "conv_id", "turn").collect() == []


def test_quotes_wrapped_anew_and_of_other_scopes_are_linked(spark):
    rows = [
        (1, 0, "First thought here.\n\nSecond thought, which is longer."),
        (2, 1, "On Monday Ann wrote:\n> Second   thought,\n> which is longer.\n>\n> unknown\nYes."),
        (2, 2, "> > second thought, which is longer.\n> Yes.\nNo."),
        (2, 3, "> > First thought here.\n> something lost\nAnswer."),
        (2, 4, "> Nobody said this.\nAlone."),
    ]
    rows += [(9, 9, rows[0][2])] * 2
    frame = spark.createDataFrame(rows, "list long, at long, body string")
    out = quotes.conversations(frame, "list", "at", "body")
    found = {(r["list"], r["at"]): r for r in out.collect()}
    assert out.count() == len(rows)
    assert (found[2, 1].parent_scope, found[2, 1].parent_place, found[2, 1].body) == (1, 0, "Yes.")
    assert (found[2, 2].parent_place, found[2, 2].depth) == (1, 2)
    assert (found[2, 3].parent_scope, found[2, 3].n_quotes) == (1, 2)
    assert found[2, 4].parent_place is None and found[2, 4].root_place == 4
    assert found[2, 2].root_scope == 1 and found[9, 9].depth == 0


def test_quotes_of_repeated_messages_link_to_the_last_before(spark):
    said = ["Hello", "Hi.", "Go on", "yes", "And then?", "yes", "Thank you", "Go on", "yes", "Stop"]
    turns = [(scope, i, text) for scope in ("a", "b", None) for i, text in enumerate(said)]
    turns += [("many", i, ["yes", "no", "continue"][i % 3]) for i in range(400)]
    turns += [("same", i, "yes") for i in range(300)]
    frame = spark.createDataFrame(turns, "conv_id string, turn long, text string")
    out = quotes.conversations(quotes.as_mail(frame), "conv_id", "turn")
    for r in out.collect():
        assert r.depth == r.turn and r.root_place == 0, r
        assert r.parent_place == (r.turn - 1 if r.turn else None)
        assert r.parent_scope == (r.conv_id if r.turn else None)
    rows = [("x", 1, "yes"), ("x", 1, "> yes\nno"), ("y", 3, "> yes\nno"), ("x", 9, "> yes\nwell")]
    rows += [("x", 5, "yes"), ("x", 9, "yes"), ("x", None, "> yes\nlost")]
    frame = spark.createDataFrame(rows, "conv_id string, turn long, text string")
    out = quotes.conversations(frame, "conv_id", "turn").collect()
    found = {(r.conv_id, r.turn, r.text): (r.parent_scope, r.parent_place) for r in out}
    assert found["x", 1, "no"] == found["x", None, "lost"] == (None, None)
    assert (found["y", 3, "no"], found["x", 9, "well"]) == (("x", 1), ("x", 5))


def test_repeated_turns_give_what_the_sql_gives(spark, tmp_path):
    chance = random.Random(4)
    said = ["hello", "yes", "what?", "then", "ok", "yes\nno"]
    turns = [("fixed", i, text) for i, text in enumerate(["hello", "yes", "what?", "yes", "then", "ok"])]
    turns += [(f"c{c}", i, f"{c % 5} " * (c % 3) + chance.choice(said)) for c in range(40) for i in range(9)]
    frame = spark.createDataFrame(turns, "conv_id string, turn long, text string")
    frame.withColumn("role", F.lit("user")).write.parquet(f"{tmp_path}/conversations.parquet")
    found = checks.op8_chat_formatting(spark, str(tmp_path))
    database = duckdb.connect()
    database.execute(
        f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'"
    )
    names = ", ".join(found.columns)
    expected = database.execute(f"SELECT {names} FROM ({checks.SQL['op8_chat_formatting']})").fetchall()
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))
    parents = {(r.conv_id, r.turn): (r.parent_place, r.depth) for r in found.collect()}
    assert parents["fixed", 4] == (3, 4)


def test_lines_of_very_many_marks(spark):
    rows = [("a", 0, "deep"), ("a", 1, ">" * 100_000 + " deep\nown"), ("a", 2, "> " * 50_000 + "own\nlast")]
    rows += [("a", 3, " \t" * 50_000 + ">last\nend"), ("a", 4, ">  > end\nx")]
    frame = spark.createDataFrame(rows, "conv_id string, turn long, text string")
    found = {r.turn: r for r in quotes.conversations(frame, "conv_id", "turn").collect()}
    assert [found[i].parent_place for i in range(5)] == [None, 0, 1, 2, None]
    assert [found[i].text for i in range(5)] == ["deep", "own", "last", "end", "x"]


# -- SimHash


def plain_groups(prints):
    """Least key per row, from all pairs of fingerprints."""
    groups = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 2 and groups[i] != groups[j]:
                old, new = groups[i], groups[j]
                groups = [new if g == old else g for g in groups]
    least = {}
    for g, (key, _) in zip(groups, prints, strict=True):
        if key is not None:
            least[g] = min(key, least.get(g, key))
    return [least.get(g) for g in groups]


@pytest.mark.parametrize("crowd", [5, 300])
def test_components_equal_those_of_all_pairs(spark, crowd):
    chance = random.Random(crowd)
    values = [chance.getrandbits(64) for _ in range(40)]
    for _ in range(crowd):
        value = values[0]
        for _ in range(chance.randint(0, 4)):
            value ^= 1 << chance.randrange(14)
        values.append(value)
    prints = [(i if i % 9 else None, v) for i, v in enumerate(values)]
    rows = spark.createDataFrame(
        [(k, v - (1 << 64) if v >> 63 else v) for k, v in prints], "doc_id long, print long"
    )
    found = simhash.groups(rows, "doc_id").collect()
    by_print = {r["print"] & ((1 << 64) - 1): r.component_id for r in found}
    assert [by_print[v] for _, v in prints] == plain_groups(prints)


def test_fingerprints_count_repeated_shingles():
    import xxhash

    def slow(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        parts = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        bits = [sum(h >> b & 1 for h in hashes) * 2 > len(hashes) for b in range(64)]
        return sum(1 << b for b, on in enumerate(bits) if on)

    for text in ("", "one", "Two Words", "a b c a b c a b c d É", "x y z\x85w  v", "q " * 500):
        assert simhash.fingerprint(text) == slow(text)
    assert simhash.fingerprint(None) == 0


def test_fingerprints_of_long_texts_take_bounded_memory():
    chance = random.Random(1)
    words = [f"w{chance.randrange(5000)}" for _ in range(3 * simhash.CHUNK + 7)]
    text = " ".join(words)
    sums = [0] * 64
    for i in range(len(words) - 2):
        value = simhash.xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), simhash.SEED)
        for bit in range(64):
            sums[bit] += 2 * (value >> bit & 1) - 1
    assert simhash.fingerprint(text) == sum(1 << bit for bit in range(64) if sums[bit] > 0)
    tracemalloc.start()
    simhash.fingerprint("some words " * 1_000_000)
    assert tracemalloc.get_traced_memory()[1] < 400_000_000
    tracemalloc.stop()


def test_near_copies_of_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [*EMPTY_CASES, (10, text), (11, text), (11, text), (None, text), (12, text.upper())]
    docs = documents(spark, rows, clash=("print", "component", "_print"))
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    assert {r.component_id for r in found if r.doc_id and r.doc_id >= 10} == {10}
    assert {r.component_id for r in found if r.fingerprint == "0" * 16} == {1}
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 10]
    assert simhash.near_duplicates(docs.limit(0)).collect() == []
