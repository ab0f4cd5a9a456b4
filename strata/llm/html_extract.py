"""Main text of web pages from parser events and text-to-tag ratios.

A page is fed in pieces to the standard library's HTML parser. Its events cut
the page into lines, one per block element, and count each line's characters
and tags. The ratio of the two is high in running text and low in lists of
links. Ratios are smoothed with a Gaussian, so that a short line amid long
ones stays with them, and lines above a threshold form clusters: they mark
the regions that hold content. A region is then taken whole, from its first
block to its last, but for what its own markup says is no content.

The step is narrow: no shuffle, one page in memory at a time.

Defined results: a null or empty page, and one without any text of its own,
has the empty text. Pages are judged one by one, so repeated rows give equal
rows and ties do not arise. Very long pages are parsed whole; memory is the
page, its text and a few numbers per line. Markup that is never closed ends with
the page: an open comment or tag hides what follows it, as in browsers.
Columns named in ``carry`` are passed on; others are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches

# Fixed values of HTML: elements that begin and end a line of their own.
BLOCKS = frozenset((
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head",
    "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section",
    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
# Blocks that close by themselves when another of the kinds named begins.
CLOSED_BY = {"p": BLOCKS, "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")),
             "tr": frozenset(("tr",)), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")),
             "option": frozenset(("option",))}
# Elements that say by themselves that they hold no content; a header does so outside an article.
NO_CONTENT = frozenset((
    "aside", "audio", "button", "canvas", "datalist", "dialog", "footer", "form", "head", "iframe", "input", "menu",
    "nav", "noscript", "object", "script", "search", "select", "style", "svg", "template", "textarea", "title", "video",
))
NO_CONTENT_ROLES = frozenset((
    "alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation",
    "search", "toolbar",
))
# Words of class names and ids that say so.
NO_CONTENT_WORDS = frozenset((
    "ad", "ads", "adsbygoogle", "adslot", "adsense", "advert", "adverts", "advertisement", "advertising", "alert",
    "aside", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "copyright",
    "disclaimer", "disqus", "feedback", "foot", "footer", "gdpr", "header", "login", "masthead", "menu", "modal", "nav",
    "navbar", "navigation", "newsletter", "notice", "notices", "notification", "overlay", "pager", "pagination",
    "paywall", "popular", "popup", "promo", "promoted", "promotion", "recommendations", "recommended", "related",
    "replies", "reply", "respond", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored",
    "subscribe", "subscription", "toolbar", "topbar", "trending", "widget", "widgets",
))
# Beside one of these, such a word speaks of the layout, as in "with-sidebar".
LAYOUT_WORDS = frozenset(("with", "has", "no", "without", "article", "body", "container", "content", "layout", "main", "page", "wrapper"))
READERS_WORDS = frozenset(("comment", "comments", "disqus", "replies", "reply", "respond"))
ARTICLE, MAIN = 1, 2
# How an element stands to content: PLAIN says nothing, HIDDEN is never content, ASIDE neither, unless an
# article begins within it (a page's whole body may sit in an element called "with-menu").
PLAIN, ASIDE, HIDDEN = 0, 1, 2

_NAME_WORDS = re.compile(r"[a-z0-9]+")
PIECE = 1 << 20


@dataclass(frozen=True)
class ExtractParams:
    """``deviations``: the threshold in standard deviations of the smoothed ratios; ``width``: the Gaussian's, in lines."""

    deviations: float = 1.0
    width: float = 1.0
    # An element holds the page's text if its share of the clusters' characters is at least this.
    region_share: float = 0.8
    max_link_share: float = 0.5


@dataclass
class Line:
    """A block's text and its tags; ``element`` is the number of the block in page order, 0 the page itself."""

    text: str
    tags: int
    link_chars: int
    hidden: bool
    scope: int          # ARTICLE, MAIN or 0: the kind of element that marks it as content
    element: int


@dataclass
class _Open:
    tag: str
    number: int
    state: int
    readers: bool
    scope: int


def _no_content(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> tuple[int, bool]:
    """What an element says of its content, and whether it holds its readers' words."""
    if tag in NO_CONTENT or tag == "header" and not in_article:
        return (ASIDE if tag in ("form", "header", "nav") else HIDDEN), False
    state, readers = PLAIN, False
    for name, value in attrs:
        if name == "hidden":
            return HIDDEN, False
        if not value:
            continue
        if name == "role" and value.lower() in NO_CONTENT_ROLES:
            return HIDDEN, False
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return HIDDEN, False
        if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            for single in value.lower().split():
                words = _NAME_WORDS.findall(single)
                if words and (words[0] in NO_CONTENT_WORDS or words[-1] in NO_CONTENT_WORDS) and not LAYOUT_WORDS.intersection(words):
                    state = ASIDE
                    readers = readers or bool(READERS_WORDS.intersection(words))
        elif name in ("class", "id") and tag == "article":
            # A comment may be an article of its own.
            if READERS_WORDS.intersection(_NAME_WORDS.findall(value.lower())):
                return HIDDEN, True
    return state, readers


class LineParser(HTMLParser):
    """Turns parser events into lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        # The element that holds each; elements are numbered as they begin, so those inside one follow it.
        self.holders = [0]
        self._stack: list[_Open] = []
        self._open_tags: dict[str, int] = {}
        self._pieces: list[str] = []
        self._tags = 0
        self._links = 0
        self._link_chars = 0
        self._ending = False

    def read(self, page: str) -> list[Line]:
        for at in range(0, len(page), PIECE):
            self.feed(page[at:at + PIECE])
        self._ending = True
        self.close()
        self._end_line()
        return self.lines

    # Markup that is not closed before the page ends hides the rest; the library would pass it on as text.
    def parse_comment(self, i, report=1):
        return self._closed(super().parse_comment(i, report))

    def parse_starttag(self, i):
        return self._closed(super().parse_starttag(i))

    def parse_endtag(self, i):
        return self._closed(super().parse_endtag(i))

    def parse_marked_section(self, i, report=1):
        return self._closed(self.parse_bogus_comment(i, report))

    def parse_pi(self, i):
        return self._closed(super().parse_pi(i))

    def _closed(self, end: int) -> int:
        return len(self.rawdata) if end < 0 and self._ending else end

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._end_line()
            top = self._stack[-1].tag if self._stack else ""
            if tag in CLOSED_BY.get(top, ()):
                self._leave(len(self._stack) - 1)
        self._tags += 1
        if tag == "br":
            self._pieces.append(" ")
        if tag == "a":
            self._links += 1
        if tag in VOID or tag not in BLOCKS and tag not in NO_CONTENT and not attrs:
            return
        above = self._stack[-1] if self._stack else None
        scope = above.scope if above else 0
        state, readers = _no_content(tag, attrs, scope == ARTICLE)
        if tag not in BLOCKS and state == PLAIN:
            return
        begins = ARTICLE if tag == "article" else MAIN if tag == "main" or ("role", "main") in attrs else 0
        if ("itemprop", "articleBody") in attrs:
            begins = ARTICLE
        inherited = above.state if above else PLAIN
        if begins == ARTICLE and scope != ARTICLE and inherited == ASIDE and not above.readers:
            inherited = PLAIN
        if state != PLAIN and begins and tag not in ("article", "main"):
            state = PLAIN
        self.holders.append(above.number if above else 0)
        self._open_tags[tag] = self._open_tags.get(tag, 0) + 1
        self._stack.append(_Open(tag, len(self.holders) - 1, max(state, inherited), readers or bool(above and above.readers),
                                 ARTICLE if ARTICLE in (begins, scope) else begins or scope))

    def handle_startendtag(self, tag, attrs):
        # Browsers ignore the slash of "<div/>".
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "canvas", "object", "iframe"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self._end_line()
        self._tags += 1
        if tag == "a":
            self._links = max(0, self._links - 1)
        if not self._open_tags.get(tag):
            return
        for at in range(len(self._stack) - 1, -1, -1):
            if self._stack[at].tag == tag:
                # What was left open inside ends with it.
                self._leave(at)
                return
            if tag not in BLOCKS and self._stack[at].tag in BLOCKS:
                return

    def _leave(self, at: int) -> None:
        for left in self._stack[at:]:
            self._open_tags[left.tag] -= 1
        del self._stack[at:]

    def handle_data(self, data):
        if self.cdata_elem or not data:
            return
        if self._stack and self._stack[-1].state != PLAIN and self._stack[-1].tag not in BLOCKS:
            return
        self._pieces.append(data)
        if self._links:
            self._link_chars += len(data)

    def _end_line(self) -> None:
        text = " ".join("".join(self._pieces).split()) if self._pieces else ""
        if text:
            # Elements within a line, such as a button, say nothing of the line.
            block = next((e for e in reversed(self._stack) if e.tag in BLOCKS), None)
            self.lines.append(Line(text, max(1, self._tags), self._link_chars, bool(block and block.state != PLAIN),
                                   block.scope if block else 0, block.number if block else 0))
        self._pieces, self._tags, self._link_chars = [], 0, 0


def smoothed(ratios: np.ndarray, width: float) -> np.ndarray:
    """The ratios under a Gaussian, renormalised at the edges."""
    radius = max(1, int(np.ceil(2 * width)))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / width) ** 2)
    whole = np.convolve(ratios, kernel)[radius:radius + len(ratios)]
    return whole / np.convolve(np.ones(len(ratios)), kernel)[radius:radius + len(ratios)]


def clusters(lines: list[Line], counts: np.ndarray, params: ExtractParams) -> np.ndarray:
    """Which lines stand above the threshold; those that do not count, or that markup rules out, count as empty."""
    counts = counts & np.array([not line.hidden for line in lines])
    ratios = np.array([len(line.text) / line.tags for line in lines]) * counts
    smooth = smoothed(ratios, params.width)
    return counts & (smooth >= params.deviations * smooth.std())


def _region(lines: list[Line], holders: list[int], marked: list[int], params: ExtractParams) -> int:
    """The innermost element that holds the greater part of the marked lines' characters."""
    chars, count = [0] * len(holders), [0] * len(holders)
    for i in marked:
        chars[lines[i].element] += len(lines[i].text)
        count[lines[i].element] += 1
    best: dict[int, int] = {}
    for number in range(len(holders) - 1, 0, -1):
        holder = holders[number]
        chars[holder] += chars[number]
        count[holder] += count[number]
        if chars[number] > chars[best.get(holder, number)] or holder not in best:
            best[holder] = number
    region = 0
    while region in best:
        inner = best[region]
        if chars[inner] < params.region_share * chars[0] or count[inner] == 1 < count[0]:
            break
        region = inner
    return region


def _branches(holders: list[int], region: int) -> dict[int, int]:
    """For the elements of a region, the part of it right below the region that holds each."""
    branch = {region: region}
    for number in range(region + 1, len(holders)):
        if holders[number] not in branch:
            break
        branch[number] = number if holders[number] == region else branch[holders[number]]
    return branch


def select_lines(lines: list[Line], holders: list[int], params: ExtractParams) -> list[int]:
    """The lines of the page's content regions, in page order."""
    open_lines = [i for i, line in enumerate(lines) if not line.hidden]
    if not open_lines:
        return []
    for scopes in ((ARTICLE,), (ARTICLE, MAIN)):
        inside = np.array([line.scope in scopes for line in lines])
        if inside[open_lines].any():
            # The page says where its text is: only those lines count, and the clusters choose among such elements.
            runs = np.cumsum(np.diff(inside.astype(np.int8), prepend=0) == 1)
            regions = set(runs[clusters(lines, inside, params)].tolist())
            return [i for i in open_lines if inside[i] and int(runs[i]) in regions]
    links = np.array([line.link_chars > params.max_link_share * len(line.text) for line in lines])
    marked = np.flatnonzero(clusters(lines, ~links, params)).tolist()
    if not marked:
        return []
    branch = _branches(holders, region := _region(lines, holders, marked, params))
    kept = [i for i in marked if lines[i].element in branch]
    with_text = {branch[lines[i].element] for i in kept}

    def belongs(i: int) -> bool:
        # Between the clusters, a block of the region's own, or beside a cluster in the same part of it.
        element = lines[i].element
        return kept[0] <= i <= kept[-1] or branch[element] in (element, region) or branch[element] in with_text

    return [i for i in open_lines if lines[i].element in branch and not links[i] and belongs(i)]


def main_text(page: str | None, params: ExtractParams = ExtractParams()) -> str:
    """The blocks of a page's main text, one per line."""
    if not page:
        return ""
    parser = LineParser()
    lines = parser.read(page)
    return "\n".join(lines[i].text for i in select_lines(lines, parser.holders, params))


def extract_text(pages: DataFrame, params: ExtractParams = ExtractParams(), carry: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``carry``, ``text`` and ``n_chars`` for every page; the page itself is the column ``html``."""
    types = dict(pages.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in carry), "text string", "n_chars bigint"])

    def judge(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = [main_text(value.as_py(), params) for value in batch.column("html")]
        yield {**{c: batch.column(c) for c in carry}, "text": pa.array(texts, pa.string()),
               "n_chars": pa.array([len(t) for t in texts], pa.int64())}

    return map_batches(pages.select(*(F.col(f"`{c}`") for c in carry), "html"), judge, schema)
