"""Embeddings against all pairs, pages against their known texts, and the pipeline."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketmart.llm import pages, vectors


def plain_links(rows, threshold=0.95):
    units = {}
    for i, (_, v) in enumerate(rows):
        if v and None not in v and np.isfinite(v).all() and any(v):
            units[i] = np.array(v) / np.linalg.norm(v)
    links = {
        i: [
            j
            for j in units
            if j != i and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold
        ]
        for i in units
    }
    out = []
    for i, (vec_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((vec_id, len(links.get(i, [])), min(ids, default=None)))
    return out


def test_links_equal_those_of_all_pairs(spark):
    random = np.random.default_rng(2)
    base = random.standard_normal((60, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    for i in range(700):  # a crowd that needs several blocks, and looser groups
        centre = base[0] if i < 600 else base[i % 60]
        rows.append((100 + i, (centre + random.standard_normal(32) * 0.12).tolist()))
    rows += [(2000 + i, base[1].tolist()) for i in range(50)]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 32), (3003, [1.0, None]), (None, base[2].tolist())]
    rows += [(3004, [float("nan")] * 32), (3005, [float("inf")] * 32), (3006, base[2].tolist())]
    rows += [(3007, base[5][:8].tolist()), (3008, (base[5][:8] * 7).tolist()), (3008, [1e308] * 32)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    frame = frame.withColumn("unit", F.lit("x")).withColumn("node", F.lit(1))
    found = vectors.linked_vectors(frame).collect()
    key = lambda row: tuple(str(x) for x in row)
    assert sorted((tuple(r)[:3] for r in found), key=key) == sorted(plain_links(rows), key=key)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found if r.vec_id is not None)
    assert vectors.linked_vectors(frame.limit(0)).collect() == []


def test_cells_find_pairs_at_the_threshold():
    random = np.random.default_rng(4)
    a = random.standard_normal((3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    z = random.standard_normal(a.shape)
    z -= (z * a).sum(axis=1, keepdims=True) * a
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * z
    one, other = vectors.cells(a, vectors.Lattice()), vectors.cells(b, vectors.Lattice())
    met = (one[:, :, :, None] == other[:, :, None, :]).any(axis=(1, 2, 3))
    assert met.mean() >= 0.95


def test_lattice_points_are_the_nearest():
    x = np.random.default_rng(0).standard_normal((500, 8)) * 2
    point = vectors.nearest_point(x)
    own = ((x - point) ** 2).sum(axis=1)
    near = ((x[:, None] - point[:, None] - vectors.SHORTEST[None]) ** 2).sum(axis=2).min(axis=1)
    assert (own <= near + 1e-9).all() and (own <= 1 + 1e-9).all()


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body>
<nav><ul><li><a href="/x">Menu</a></li></ul></nav><div class="ad">Buy</div>
<article><h1>Head &amp; line</h1><p><b>Bold<br><p>One &lt;two&gt;
 three&nbsp;four.</p><div class="comments"><p>Reader says</p></div><form>Name</form>
<ul><li>first<li>second</ul></article><aside>Side</aside><footer>&copy; site</footer>"""
OPEN = "<div>Top of the site</div><p>Story {0} begins.</p><p>And ends {0}.</p><div>Bottom</div>"


def test_article_without_its_frame(spark):
    rows = [(1, "http://a.com/x", PAGE), (2, None, None), (3, "http://[bad", ""), (3, "http://[bad", "")]
    rows += [(4, "http://a.com/x", PAGE), (5, "http://b.com/", "plain text"), (None, "x", "<p>a<p>b")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    frame = frame.withColumn("lines", F.lit("clash")).withColumn("row", F.lit(0))
    found = pages.main_texts(frame).collect()
    assert len(found) == len(rows)
    text = "Head & line\nBold\nOne <two> three four.\nfirst\nsecond"
    expected = {1: text, 2: "", 3: "", 4: text, 5: "plain text", None: "a\nb"}
    assert all(r.text == expected[r.page_id] and r.n_chars == len(r.text) for r in found)
    assert pages.main_texts(frame.limit(0)).collect() == []


FRAMED = [
    ('<form id="f"><nav>m</nav><article><p>T</p></article></form>', "T"),
    ('<div class="page-with-sidebar"><main class="no-sidebar"><p>T</p></main></div>', "T"),
    ('<article class="post comment-open"><p>T</p></article>', "T"),
    ('<article class="notice"><p>T</p></article><div>site</div>', "T"),
    ('<nav><a>m</a><article><p>T</p></article>', "T"),
    ('<div><div class="ad">Buy<article>T</article></div><article>U</article>', "T\nU"),
    ('<article><h2 id="related-work">T</h2><h2 id="search">U</h2></article>', "T\nU"),
    ('<article><section id="search-results">T</section><p id="notice-period">U</p></article>', "T\nU"),
    ("<article><p>T <math><mi>x</mi></math></p></article>", "T x"),
    ("<article><form><p>T</p></form></article><div>site</div>", "T"),
    ("<form><p>T</p></form>", "T"),
    ('<article><ul><li class="ad">a<li>T</ul></article>', "T"),
    ('<article>T<div class="comments"><article>c</article></div></article><aside>a</aside>', "T"),
    ("<nav>m</nav><article>T</article><aside><article>teaser</article></aside>", "T"),
    ("<nav>m</nav><footer>f</footer>", ""),
    ('<div class="site-header">s</div><div class="main-nav">m</div><p>T</p><div class="site-footer">f</div>', "T"),
    ('<div class="cookie-banner">c</div><p>T</p><ul class="comment-list"><li>c</ul>', "T"),
    ('<p>T</p><div class="related-posts">r</div><div id="comments-section">c</div>', "T"),
    ('<article>T<div class="share-buttons">s</div><div class="ad-slot">a</div><p>U</article>', "T\nU"),
    ('<article>T<div class="ad_unit">a</div><section id="comments-section">U</section></article>', "T\nU"),
    ('<div class="article-header"><p>T</p></div><div class="no-sidebar">U</div>', "T\nU"),
    ('<div class="page-with-sidebar"><p>T</p></div><div class="search-results">U</div>', "T\nU"),
    ('<article class="sidebar-right">T</article><aside><article>teaser</article></aside>', "T"),
    ('<div class="sidebar-left"><article>T</article></div>', "T"),
    ('<div class="sidebar-left"><p>T</p></div>', "T"),
]


def test_parsing_takes_time_in_proportion():
    """Elements that stay open, or never were, do not make every further one slower."""
    for html in ("<b><div>", "<article>a", "<i></b><p>", "<div class=ad><article>a"):
        times = []
        for n in (2_000, 16_000):
            start = time.perf_counter()
            pages.blocks(html * n)
            times.append(time.perf_counter() - start)
        assert times[1] < 24 * times[0] + 0.5, html


def test_articles_inside_frames_are_whole(spark):
    rows = [(i, f"http://h{i}.org/", html) for i, (html, _) in enumerate(FRAMED)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in pages.main_texts(frame).collect()}
    assert found == {i: text for i, (_, text) in enumerate(FRAMED)}


def test_shared_lines_of_pages_without_an_article_go(spark):
    rows = [(i, f"https://site.org/story/{i}?x=1", OPEN.format(i)) for i in range(12)]
    rows += [(50, "https://lone.org/1", OPEN.format(50))]
    rows += [(60 + i, "https://copy.org/1", OPEN.format(60)) for i in range(2)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r for r in pages.main_texts(frame).collect()}
    assert all(found[i].text == f"Story {i} begins.\nAnd ends {i}." for i in range(12))
    assert all(found[i].n_shared == 2 for i in range(12))
    assert found[50].text.startswith("Top of the site") and found[50].n_shared == 0
    assert all(found[i].text.count("\n") == 3 for i in (60, 61))  # a copy keeps its lines


def test_shared_lines_beside_the_article_of_a_main_element_go(spark):
    main = "<main><p>Site line</p><h1>Head {0}</h1><article><p>Quoted</p><p>Own {0}</p></article><p>End</p></main>"
    rows = [(i, f"https://site.org/{i}", main.format(i)) for i in range(4)]
    rows += [(9, "https://lone.org/", main.format(9)), (8, "https://alone.org/8", "<main>Quoted</main>")]
    rows += [(7, "https://plain.org/", "<main>Story</main><article>Other</article>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in pages.main_texts(frame).collect()}
    assert all(found[i] == f"Head {i}\nQuoted\nOwn {i}" for i in range(4))
    assert found[9] == "Site line\nHead 9\nQuoted\nOwn 9\nEnd"
    assert (found[8], found[7]) == ("Quoted", "Story\nOther")


def test_pages_of_one_path_are_no_evidence_of_site_lines(spark):
    rows = [(i, f"https://site.org/story/{i // 3}?page={i % 3}", OPEN.format(i // 3)) for i in range(12)]
    changed = OPEN.format(0).replace("And", "Or")
    rows += [(20, "https://site.org/story/0/#again", changed), (21, "https://site.org/story/0", None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r for r in pages.main_texts(frame).collect()}
    text = "Story {0} begins.\nAnd ends {0}."
    assert all(found[i].text == text.format(i // 3) for i in range(12))
    assert found[20].text == text.format(0).replace("And", "Or")
    assert all(found[i].n_shared == 2 for i in (*range(12), 20)) and found[21].text == ""


@pytest.mark.parametrize("seed", range(20))
def test_shared_lines_are_a_longest_common_subsequence(seed):
    random = np.random.default_rng(seed)
    a, b = (random.integers(0, 5, random.integers(0, 25)) for _ in range(2))
    best = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a)):
        for j in range(len(b)):
            best[i + 1, j + 1] = (
                best[i, j] + 1 if a[i] == b[j] else max(best[i, j + 1], best[i + 1, j])
            )
    mask = pages.shared_lines(a, b)
    assert mask.sum() == best[-1, -1]
    rest = iter(b.tolist())
    assert all(value in rest for value in a[mask].tolist())  # in order


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity",
        "line_dedup",
        "simhash_near_dedup",
        "benchmark_decontamination",
        "sentencepiece",
    ]
    words = lambda tag, n: " ".join(f"{tag}{i}" for i in range(n))
    passage, item = words("p", 60), words("b", 15)
    texts = {
        0: words("clean", 30),
        1: f"{words('one', 20)}\n{passage}",
        2: f"{words('two', 20)}\n{passage}",
        3: f"{words('three', 20)} {item}",
        4: words("clean", 30),
        5: None,
        6: f"{words('bad', 10)} vile {words('end', 10)}",
    }
    labels = []
    for i in range(100, 500):
        sick = i % 4 == 0
        texts[i] = f"{words(f'k{i}x', 12)} {'vile' if sick else 'kind'} {words(f'm{i}x', 12)}"
        labels.append((i, 1, int(sick)))
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in texts.items()]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {i for i in found if i < 100} == {0, 1, 2, 5}
    assert found[2].text == words("two", 20) and found[2].n_chars == len(found[2].text)
    assert passage in found[1].text and found[0].round_trip
    assert {i for i in found if i >= 100} == {i for i in range(100, 500) if i % 4}
