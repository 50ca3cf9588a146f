"""Main text of web pages, with help of the page whose URL is nearest.

A page is cut into blocks. The markup says of most blocks where they belong: to
the article, to the frame around it (menus, footers, adverts, forms, comments), or
to neither. Pages are then compared with the page of the same host whose path is
nearest, but another one, as pages of the same path are versions of one page: lines
outside the article that both share, by a longest common subsequence, belong to the
site and not to the page, and are deleted. The text is the article, with what is left
of a main element that holds it, or, on a page that marks none, what is left outside
the frame.

Lines of an article are never deleted for being shared, because neighbouring
pages may quote or copy each other.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmart.llm.common import column, map_text, materialise
from ticketmart.operators.joins import join_on
from ticketmart.operators.numbering import number_in_order

#: Elements whose text is no text of the page at all.
_SILENT = frozenset("script style noscript template svg iframe object annotation annotation-xml".split())
#: Elements that frame a page.
_FRAME = frozenset("head title nav footer aside form button select textarea menu dialog".split())
#: Whole words of a class, an id or a role that say the same of any element.
_FRAME_WORDS = frozenset(
    """ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment
    comments complementary consent contentinfo cookie cookies dialog disqus footer menu modal nav
    navbar navigation newsletter notice notices popup promo recommended related search share
    sharing sidebar social sponsor sponsored subscribe toolbar widget""".split()
)
#: Words that go with those in a compound name, as in main-nav or comment-list. Any other word
#: may turn the meaning (page-with-sidebar, no-sidebar, search-results).
_BESIDE = frozenset(
    """area bar block bottom box button buttons container global left link links list main page post
    posts primary right secondary section site slot top unit wrapper""".split()
)
#: Words that with `header` name the top of a site; an article has a header too.
_SITE = frozenset(("global", "site", "top"))
_ARTICLE = frozenset(("article", "main"))
#: Elements whose id may come from their text and says nothing of their place: the first
#: anywhere, the others inside an article.
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_ANCHORS = frozenset("section a span p dt dd li".split())
_BLOCKS = frozenset(
    """address article aside blockquote body center dd details dialog div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre
    section summary table tbody td tfoot th thead title tr ul""".split()
)
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements that the next of their kind closes, if no element of the second kind is between.
_SIBLINGS = {
    "li": (("li",), frozenset(("ul", "ol", "menu"))),
    **dict.fromkeys(("dt", "dd"), (("dt", "dd"), frozenset(("dl",)))),
    **dict.fromkeys(("td", "th"), (("td", "th"), frozenset(("tr", "table")))),
    "tr": (("tr",), frozenset(("table",))),
}
_MAY_STAY_OPEN = frozenset("html body head p li dt dd td th tr tbody thead tfoot option".split())
#: What a block was found in; REST is a main element, beside the article it holds.
BODY, OPEN, FRAME, REST = 0, 1, 2, 3
#: Which element of an article a block is in, with the number of the main element around.
_NONE, _IN_MAIN, _IN_ARTICLE = 0, 1, 2
_Place = tuple[int, int]


@lru_cache(65536)
def _names_frame(mark: str) -> bool:
    """Whether a word of a class, an id or a role names a part of the frame, alone or compound."""
    if mark in _FRAME_WORDS:
        return True
    parts = frozenset(re.split("[-_]+", mark)) - {""}
    if "header" in parts:
        return len(parts) > 1 and parts <= _SITE | {"header"}
    return not parts.isdisjoint(_FRAME_WORDS) and parts <= _FRAME_WORDS | _BESIDE


class _Frame:
    """Why the text of an element belongs to no article.

    A frame is weak if only a class or a form says so. `article` marks an article
    element inside the frame `around`, or one that names itself a frame.
    """

    def __init__(self, tag: str, weak: bool, around: _Frame | None = None) -> None:
        self.tag, self.weak, self.around = tag, weak, around
        self.article = tag == "article"
        self.holds_article = self.closed = False

    def strength(self) -> int:
        return 0 if self.tag == "form" else 1 if self.weak else 2


class _Blocks(HTMLParser):
    """Collects the blocks of a page in order: the frame and article they are in, and the text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[_Frame | None, _Place, str]] = []
        self.left_open: set[str] = set()  # tags that lack an end tag
        # tag, frame, article, silent, the frame that the element itself opens
        self._open: list[tuple[str, _Frame | None, _Place, bool, _Frame | None]] = []
        self._parts: dict[tuple[_Frame | None, _Place], list[str]] = {}
        self._mains = 0
        self._count: Counter[str] = Counter()  # open elements of each tag
        self._frames: list[_Frame] = []  # frames that open elements have opened

    def _flush(self) -> None:
        for (frame, article), parts in self._parts.items():
            text = " ".join("".join(parts).split())
            if text:
                self.found.append((frame, article, text))
        self._parts.clear()

    def _inner(self) -> tuple[str, _Frame | None, _Place, bool, _Frame | None]:
        return self._open[-1] if self._open else ("", None, (_NONE, 0), False, None)

    def _add(self, text: str) -> None:
        _, frame, article, _, _ = self._inner()
        self._parts.setdefault((frame, article), []).append(text)

    def _framed_by(self, tag: str, attrs: list[tuple[str, str | None]], article: int) -> _Frame | None:
        """The frame that an element opens by its tag or its marks."""
        if tag in _FRAME or (tag == "header" and not article):
            return _Frame(tag, tag == "form")
        if tag in ("html", "body", "main"):
            return None
        named = tag in _HEADINGS or (article and tag in _ANCHORS)
        kinds = ("class", "role") if named else ("class", "id", "role")
        marks = " ".join(v or "" for k, v in attrs if k in kinds).lower().split()
        # an article may name the layout around it, so there only a whole word counts
        named = _FRAME_WORDS.__contains__ if tag == "article" else _names_frame
        return _Frame(tag, True) if any(map(named, marks)) else None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self._add(" ")
        if tag in _BLOCKS:
            self._flush()
            self._close("p", _ARTICLE | {"div", "section", "td", "th", "li", "body"})
            if tag not in ("head", "title"):
                self._close("head", frozenset(("body",)))
        for sibling in _SIBLINGS.get(tag, ((),))[0]:
            self._close(sibling, _SIBLINGS[tag][1])
        if tag in _VOID:
            return
        _, frame, article, silent, _ = self._inner()
        own = self._framed_by(tag, attrs, article[0])
        if tag in _ARTICLE:
            for opened in reversed(self._frames):
                if opened.holds_article:
                    break  # and so do those around it
                opened.holds_article = True
            if tag == "article" and frame and frame.strength():
                own = _Frame(tag, True, None if own else frame)
            frame = own
            if tag == "article":
                article = (_IN_ARTICLE, article[1])
            elif not article[0]:
                self._mains += 1
                article = (_IN_MAIN, self._mains)
        elif own and not (frame and frame.strength() > own.strength()):
            frame = own
        self._open.append((tag, frame, article, silent or tag in _SILENT, own))
        self._count[tag] += 1
        if own:
            self._frames.append(own)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br" or tag in _BLOCKS:
            self.handle_starttag(tag, attrs)
            if tag not in _VOID:
                self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCKS:
            self._flush()
        self._close(tag, frozenset())

    def _close(self, tag: str, walls: frozenset[str]) -> None:
        """Closes the last open element of that name, and all within, up to a wall."""
        if not self._count[tag]:
            return
        for at in range(len(self._open) - 1, -1, -1):
            name = self._open[at][0]
            if name == tag:
                if self._open[at][4]:
                    self._open[at][4].closed = True
                self.left_open.update(element[0] for element in self._open[at + 1 :])
                for element in self._open[at:]:
                    self._count[element[0]] -= 1
                    if element[4]:
                        self._frames.pop()
                del self._open[at:]
                return
            if name in walls:
                return

    def handle_data(self, data: str) -> None:
        if not (self._open and self._open[-1][3]):
            self._add(data)

    def close(self) -> None:
        super().close()
        self._flush()
        self.left_open.update(element[0] for element in self._open)
        self.left_open -= _MAY_STAY_OPEN


def blocks(html: str | None) -> list[tuple[int, str]]:
    """(kind, text) of the blocks of a page; none for a null or empty page.

    A frame ends where an article begins inside of it, if the frame is a form or
    lacks its end tag. An article in any other frame (a teaser, a comment) counts
    as one if there is no article outside. Where nothing would be left, blocks
    count that only a class, a form or a missing end tag puts into a frame.
    """
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()

    def sure(frame: _Frame) -> bool:
        return frame.closed and frame.tag not in parser.left_open

    found, claimed, loose = [], [], []
    for frame, article, text in parser.found:
        if frame and frame.article and frame.around and not sure(frame.around):
            frame = None
        if frame and frame.tag == "form" and frame.holds_article:
            frame = None
        if frame and frame.article:
            claimed.append(len(found))
        elif frame and frame.tag not in ("head", "title") and (frame.weak or not sure(frame)):
            loose.append((len(found), article))
        found.append((FRAME if frame else BODY if article[0] else OPEN, article, text))

    def admit(places: list[int], kind: int) -> None:
        for i in places:
            found[i] = (kind, *found[i][1:])

    if not any(kind == BODY and article[0] == _IN_ARTICLE for kind, article, _ in found):
        admit(claimed, BODY)
    if not any(kind == BODY for kind, _, _ in found):
        admit([i for i, article in loose if article[0]], BODY)
    if not any(kind != FRAME for kind, _, _ in found):
        admit([i for i, _ in loose], OPEN)
    held = {main for kind, (element, main), _ in found if kind == BODY and element == _IN_ARTICLE}
    for i, (kind, (element, main), _) in enumerate(found):
        if kind == BODY and element == _IN_MAIN and main in held:
            admit([i], REST)
    return [(kind, text) for kind, _, text in found]


def place_of(url: str | None) -> tuple[str | None, str]:
    """Host and path of a URL, without a slash at its end; no host if there is none."""
    try:
        parts = urlsplit((url or "").strip())
        return (parts.hostname or None), parts.path.rstrip("/")
    except ValueError:
        return None, ""


def _row(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequence of `a` and every beginning of `b`."""
    row = np.zeros(len(b) + 1, np.int64)
    for value in a:
        row[1:] = np.maximum(row[1:], np.where(b == value, row[:-1] + 1, 0))
        np.maximum.accumulate(row, out=row)
    return row


def shared_lines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which lines of `a` are in a longest common subsequence with `b`, in linear space."""
    shared = np.zeros(len(a), bool)
    at = np.flatnonzero(np.isin(a, b))
    b = b[np.isin(b, a)]
    todo = [(at, b)]
    while todo:
        at, b = todo.pop()
        n = min(len(at), len(b))
        differ = np.flatnonzero(a[at[:n]] != b[:n])
        head = int(differ[0]) if len(differ) else n
        shared[at[:head]] = True
        at, b = at[head:], b[head:]
        if not len(at) or not len(b):
            continue
        if len(at) == 1:
            shared[at] = bool((b == a[at[0]]).any())
            continue
        middle = len(at) // 2
        before = _row(a[at[:middle]], b)
        after = _row(a[at[middle:]][::-1], b[::-1])[::-1]
        cut = int((before + after).argmax())
        todo += [(at[:middle], b[:cut]), (at[middle:], b[cut:])]
    return shared


_KEY = ["one", "two"]


def _keyed(pages: DataFrame) -> DataFrame:
    """page_id, url, html and two hashes of all three: rows equal in them are one page."""
    chosen = pages.select(*[column(name).alias(name) for name in ("page_id", "url", "html")])
    return chosen.withColumns(
        {
            "one": F.xxhash64("page_id", "url", "html"),
            "two": F.xxhash64(F.lit(1), "page_id", "url", "html"),
        }
    )


def _outside(pages: DataFrame) -> DataFrame:
    """(one, two, host, path, marks): hashes of the blocks outside the article, in order."""

    def work(texts: list[str | None]) -> list[pa.Array]:
        hashes = [
            [xxhash.xxh3_64_intdigest(t.encode("utf-8", "replace")) >> 1 for k, t in blocks(html) if k]
            for html in texts
        ]
        return [pa.array(hashes, pa.list_(pa.int64()))]

    def places(urls: list[str | None]) -> list[pa.Array]:
        found = [place_of(url) for url in urls]
        return [
            pa.array([host for host, _ in found], pa.string()),
            pa.array([path for _, path in found], pa.string()),
        ]

    rows = map_text(pages, "html", "marks array<bigint>", work, keep=[*_KEY, "url"])
    rows = map_text(rows, "url", "host string, path string", places, keep=[*_KEY, "marks"])
    return rows.dropDuplicates(_KEY)


def _inside(pages: DataFrame) -> DataFrame:
    """Adds what may be the text: article blocks, or blocks the markup says nothing of.

    With the former come other blocks of a main element that holds the article.
    `places` gives the place of every line among all blocks outside the article;
    it is null for lines of the article.
    """

    def work(texts: list[str | None]) -> list[pa.Array]:
        lines, places = [], []
        for html in texts:
            found = blocks(html)
            wanted = (BODY, REST) if any(kind == BODY for kind, _ in found) else (OPEN,)
            chosen, outside = [], 0
            for kind, text in found:
                if kind in wanted:
                    chosen.append((text, None if kind == BODY else outside))
                outside += kind != BODY
            lines.append([text for text, _ in chosen])
            places.append([place for _, place in chosen])
        return [pa.array(lines, pa.list_(pa.string())), pa.array(places, pa.list_(pa.int32()))]

    return map_text(
        pages, "html", "lines array<string>, places array<int>", work, ["page_id", "url", *_KEY]
    )


def _common(a: str | None, b: str | None) -> int:
    if a is None or b is None:
        return -1
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def _nearest(rows: DataFrame) -> DataFrame:
    """(host, path, marks): those of the page whose path is nearest, per path that is not alone.

    A path stands in the order once, however many pages it has, by the page with
    the most marks. So its neighbours always have other paths.
    """
    paths = (
        rows.filter("host IS NOT NULL")
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.size("marks").alias("n"), *_KEY)).alias("best"))
        .select("host", "path", *[F.col(f"best.{key}").alias(f"best_{key}") for key in _KEY])
    )
    ordered = materialise(number_in_order(paths, ["host", "path"]), "ordered")

    def beside(step: int, side: str) -> DataFrame:
        return ordered.select(
            (F.col("start") + step).alias("start"),
            F.col("host").alias(f"{side}_host"),
            F.struct("path", *[F.col(f"best_{key}").alias(key) for key in _KEY]).alias(side),
        )

    joined = ordered
    for step, side in ((1, "left"), (-1, "right")):
        joined = joined.join(beside(step, side), "start", "left")
    sides = [
        F.when(F.col(f"{side}_host") == F.col("host"), F.col(side)).alias(side)
        for side in ("left", "right")
    ]
    chosen = joined.select("host", "path", *sides)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                left, right = (
                    _common(row["path"], row[side] and row[side]["path"]) for side in ("left", "right")
                )
                found.append(row["left" if left >= right else "right"] or {})
            keys = [pa.array([other.get(key) for other in found], pa.int64()) for key in _KEY]
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), batch.column("path"), *keys], names=["host", "path", *_KEY]
            )

    nearest = chosen.mapInArrow(run, "host string, path string, one long, two long")
    marks = rows.select(*_KEY, F.col("marks").alias("other"))
    return join_on(nearest.filter("one IS NOT NULL"), marks, _KEY, "inner").drop(*_KEY)


def _compared(rows: DataFrame) -> DataFrame:
    """(one, two, shared): places among the marks that the nearest page of another path shares."""
    held = materialise(rows, "marks")
    chosen = join_on(held, _nearest(held), ["host", "path"], "left").select(*_KEY, "marks", "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for page in batch.to_pylist():
                mask = shared_lines(
                    np.array(page["marks"] or [], np.int64), np.array(page["other"] or [], np.int64)
                )
                found.append(np.flatnonzero(mask).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("one"), batch.column("two"), pa.array(found, pa.list_(pa.int32()))],
                names=[*_KEY, "shared"],
            )

    return chosen.mapInArrow(run, "one long, two long, shared array<int>")


def main_texts(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars, n_shared.

    n_shared counts the lines outside the article that the nearest page of another
    path of the host has too. A page without an article all of whose lines are
    shared is a copy of that page and keeps them. A null or empty page has an empty
    text; a page without a host, or whose path is the only one of its host, is
    compared with nothing. Rows that
    are equal in page_id, url and html are one page and give equal results. Extra
    columns are ignored, an empty table gives an empty result.

    Pages are parsed twice, for their marks and for their texts, so that whole
    texts are shuffled once and never held on disk besides.
    """
    keyed = _keyed(pages)
    compared = _compared(_outside(keyed))
    joined = join_on(_inside(keyed), compared, _KEY, "left")
    own = lambda place: place.isNull() | ~F.array_contains("shared", place)
    kept = F.filter("lines", lambda _, i: own(F.get(F.col("places"), i)))
    lines = F.when(F.exists("places", own), kept).otherwise(F.col("lines"))
    return (
        joined.withColumn("shared", F.coalesce("shared", F.array().cast("array<int>")))
        .select("page_id", "url", F.concat_ws("\n", lines).alias("text"), F.size("shared").alias("n_shared"))
        .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_shared")
    )
