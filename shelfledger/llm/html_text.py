"""Main text of web pages by scoring the element tree.

Every block of text passes points for its length and commas to its ancestors, the further the less; a candidate's
points are discounted by the share of its text that stands in links. An article or main element gets the points of all its
text undiminished, so it wins over its own parts, but not over another article with more to say. The best container is kept
with those siblings, on every level above it, that score well too or are of its kind. Menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments are left out by element name, by ``role``, and by whole names in
``class`` and ``id``.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

TAG = re.compile(
    r"""<(?:(?P<comment>!--)|(?P<other>[!?])|(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)"""
    r"""(?P<rest>(?:[^>"']++|"[^"]*"|'[^']*')*+>|[^>]*>?))"""
)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")
TELLING = re.compile("class|id|role|hidden|style", re.I)
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = RAW | frozenset("head nav header footer aside form menu svg math canvas button select dialog object audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+|[^\x00-\x7f]+")
#: A name is unwanted if it is one of the first words, alone or with others of the three kinds only: ``site-header`` and
#: ``cookie-notice`` are, ``notice-period`` and ``social-history`` are not.
UNWANTED = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense banner banners breadcrumb breadcrumbs byline comment "
    "comments commentlist consent cookie cookies disqus footer foot gdpr header masthead menu modal nav navbar navigation "
    "newsletter notice notices notification alert overlay pager pagination popup promo promotion recommended related reply "
    "replies respond rss search share sharing sidebar skyscraper social sponsor sponsored subscribe subscription toolbar "
    "widget widgets".split()
)
SURROUNDING = frozenset(
    "site page main top bottom left right global primary secondary list box block wrapper wrap container inner outer section "
    "area bar side link links item items button buttons btn panel col column row group holder region zone unit slot js mobile "
    "desktop sticky fixed large small sm md lg xl form thread body icons icon media signup count the id class wp g".split()
)
CONTENT_WORDS = frozenset("post posts entry article articles content story stories user reader".split())
#: Words that name a part of the article itself when they stand with one of those before.
OF_CONTENT = frozenset("header masthead byline".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search menu menubar form alert alertdialog dialog toolbar".split()
)
KEPT, SOFT, HARD = 0, 1, 2
NEVER_DROPPED = frozenset(("html", "body", "article", "main"))
START = {"article": 25.0, "main": 10.0, "section": 5.0, "div": 5.0, "ul": -3.0, "ol": -3.0, "table": -3.0, "th": -5.0}
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
PARAGRAPHS = frozenset(("p", "blockquote", "pre"))
#: An open element that a new one of the same kind closes, and where the search for it ends.
CLOSED_BY = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr",)), frozenset(("table",))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
}
ANCESTORS = 4
SIBLING_SHARE, LINK_SHARE = 0.2, 0.3
MENU_LINKS = 3
MENU_SHARE = 0.8


@lru_cache(1 << 14)
def unwanted_name(name: str) -> bool:
    """Whether a class or an id names something beside the article."""
    parts = {part.lower() for part in PARTS.findall(name)}
    found = parts & UNWANTED
    if not found or any(not (p in UNWANTED or p in SURROUNDING or p in CONTENT_WORDS or p.isdigit()) for p in parts):
        return False
    return parts.isdisjoint(CONTENT_WORDS) or not found <= OF_CONTENT


def _unwanted(name: str, rest: str) -> int:
    """HARD for what is never shown or never text of an article; SOFT for what its class or id calls unwanted."""
    if name in DROPPED:
        return HARD
    if name in NEVER_DROPPED or not TELLING.search(rest):
        return KEPT
    state = KEPT
    for m in ATTRIBUTE.finditer(rest):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "role" and value.lower() in ROLES:
            return HARD
        if key == "style" and "display:none" in value.lower().replace(" ", ""):
            return HARD
        if key in ("class", "id") and any(map(unwanted_name, value.split())):
            state = SOFT
    return state


class Page:
    """Elements and text blocks of one page; elements are numbered in page order, so parents come before children."""

    def __init__(self, html: str):
        self.names, self.parents, self.hidden, self.holders = ["#root"], [-1], [KEPT], [0]
        self.stack, self.depths = [0], defaultdict(list)
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        self.soft_blocks: list[tuple[int, str, int]] = []
        self.links: list[int] = []  # elements that hold a link
        self.pieces: list[str] = []
        self.linked = 0
        self._read(html)
        self._flush()
        if not self.blocks:  # a page whose names call all of it unwanted
            self.blocks = self.soft_blocks

    def _flush(self) -> None:
        text = " ".join("".join(self.pieces).split())
        at = self.stack[-1]
        if text and self.hidden[at] != HARD:
            found = self.blocks if self.hidden[at] == KEPT else self.soft_blocks
            found.append((self.holders[at], text, min(self.linked, len(text))))
        self.pieces, self.linked = [], 0

    def _text(self, raw: str) -> None:
        if self.hidden[self.stack[-1]] != HARD:
            text = unescape(raw) if "&" in raw else raw
            self.pieces.append(text)
            if self.depths["a"]:
                self.linked += len(text)

    def _pop(self, kinds: frozenset[str] | set[str]) -> None:
        """Close elements up to the nearest one of these kinds."""
        while len(self.stack) > 1:
            name = self.names[self.stack.pop()]
            self.depths[name].pop()
            if name in kinds:
                return

    def _deepest(self, kinds: frozenset[str]) -> int:
        """How deep the nearest open element of these kinds lies."""
        return max((self.depths[name][-1] for name in kinds if self.depths[name]), default=-1)

    def _start(self, name: str, rest: str) -> None:
        if name not in INLINE:
            self._flush()
            if self.depths["p"]:
                self._pop({"p"})
            if name in CLOSED_BY:
                kinds, ends = CLOSED_BY[name]
                if self._deepest(kinds) > self._deepest(ends):
                    self._pop(kinds)
        elif name == "a" and self.depths["a"]:
            self._pop({"a"})
        if name == "br":
            self.pieces.append(" ")
        if name in VOID or rest.endswith("/>") and name in ("svg", "path"):
            return
        parent = self.stack[-1]
        self.names.append(name)
        self.parents.append(parent)
        self.hidden.append(max(self.hidden[parent], _unwanted(name, rest)) if self.hidden[parent] != HARD else HARD)
        self.holders.append(self.holders[parent] if name in INLINE else len(self.names) - 1)
        self.depths[name].append(len(self.stack))
        self.stack.append(len(self.names) - 1)
        if name == "a":
            self.links.append(len(self.names) - 1)

    def _read(self, html: str) -> None:
        at = 0
        for_raw: dict[str, re.Pattern] = {}
        while (m := TAG.search(html, at)) is not None:
            if m.start() > at:
                self._text(html[at : m.start()])
            at = m.end()
            if m["comment"]:
                end = html.find("-->", m.start() + 2)
                at = end + 3 if end >= 0 else len(html)
            elif m["other"]:
                end = html.find(">", at)
                at = end + 1 if end >= 0 else len(html)
            elif m["end"]:
                name = m["name"].lower()
                if name not in INLINE:
                    self._flush()
                if self.depths[name]:
                    self._pop({name})
            else:
                name = m["name"].lower()
                self._start(name, m["rest"])
                if name in RAW:
                    close = for_raw.setdefault(name, re.compile(f"</{name}[^>]*>?", re.I)).search(html, at)
                    at = close.end() if close else len(html)
                    self._pop({name})
        self._text(html[at:])

    def _up(self, at: int, levels: int) -> Iterator[int]:
        while at > 0 and levels:
            yield at
            at, levels = self.parents[at], levels - 1

    def main_text(self) -> str:
        if not self.blocks:
            return ""
        size = len(self.names)
        points, whole, chars, linked, n_links = [0.0] * size, [0.0] * size, [0] * size, [0] * size, [0] * size
        told = [False] * size  # holds a heading or a paragraph with text
        for at, text, in_links in self.blocks:
            chars[at] += len(text)
            linked[at] += in_links
            told[at] = self.names[at] in HEADINGS or self.names[at] in PARAGRAPHS
            if self.names[at] not in HEADINGS:
                given = (1.0 + text.count(",") + min(len(text) / 100, 3.0)) * (1 - in_links / len(text))
                whole[at] += given
                holder = at if self.names[at] in START or self.names[at] == "body" else self.parents[at]
                for level, up in enumerate(self._up(holder, ANCESTORS)):
                    points[up] += given / (1, 2, 6, 9)[level]
        for at in self.links:
            n_links[self.parents[at]] += 1
        for at in range(size - 1, 0, -1):
            up = self.parents[at]
            chars[up] += chars[at]
            linked[up] += linked[at]
            n_links[up] += n_links[at]
            whole[up] += whole[at]
            told[up] = told[up] or told[at]
        for at in range(size):
            if self.names[at] in ("article", "main"):
                points[at] = whole[at]
        total = [
            (START.get(self.names[at], 0.0) + points[at]) * (1 - linked[at] / chars[at]) if points[at] > 0 else 0.0
            for at in range(size)
        ]
        best = max(range(size), key=lambda at: (total[at], -at))
        if total[best] <= 0:  # headings or links only
            best = max(range(size), key=lambda at: (self.names[at] in ("article", "main") and chars[at] > 0, -at))
        kept = self._container(best, total, chars, linked, told)
        menus = {
            at
            for at in range(1, size)
            if self.names[at] in ("ul", "ol") and n_links[at] >= MENU_LINKS and linked[at] >= MENU_SHARE * max(1, chars[at])
        }
        state = [False] * size
        for at in range(size):  # parents first
            state[at] = (at in kept or (at > 0 and state[self.parents[at]])) and at not in menus
        return "\n".join(text for at, text, _ in self.blocks if state[at])

    def _container(self, best: int, total: list[float], chars: list[int], linked: list[int], told: list[bool]) -> set[int]:
        """The best container, and beside it and its ancestors what scores well, headings, paragraphs and more of its kind."""
        kept, path, least = {best}, [best], max(10.0, SIBLING_SHARE * total[best])
        while path[-1] > 0 and self.names[path[-1]] not in ("body", "html"):
            path.append(self.parents[path[-1]])
        above, on_path = set(path[1:]), set(path)
        for at in range(1, len(self.names)):
            if self.parents[at] in above and at not in on_path and chars[at] and linked[at] <= LINK_SHARE * chars[at]:
                alike = self.parents[at] == self.parents[best] and self.names[at] == self.names[best] and told[at]
                if total[at] >= least or alike or self.names[at] in HEADINGS or self.names[at] in PARAGRAPHS:
                    kept.add(at)
        return kept


def main_text(html: str | None) -> str:
    return Page(html or "").main_text()


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``text`` (empty if none), ``n_chars`` in code points.

    A null or empty page and one without text give an empty text; null ids and addresses are carried; repeated rows each
    give a row; unclosed, stray and badly nested tags are read as browsers would; other columns are ignored. One pass
    without a shuffle; reading is linear in the length of a page.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py()) for html in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    page_id = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(read, f"page_id {page_id}, url string, text string, n_chars bigint")
