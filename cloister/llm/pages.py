"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams a page's events. Text between block elements makes a line, with as many tags as
came with it; the ratios of text to tags, smoothed with a Gaussian, are clustered by a threshold, their standard
deviation. Lines over it that are
no links for the most part are content and choose the regions: structure only says where a region ends. Regions are article
and main elements, of which those with a content line are taken whole, or, where none has any, the smallest division that
holds most of the content, without its parts that are links for the most part.

Parts that are never content, whatever their ratio, count as lines without text: menus, headers and footers of the page,
sidebars, notices, adverts, forms, scripts, styles and reader comments, told by element or role, or by a class or id that
says nothing else. Inside an article, paragraphs, headings and inline elements are text whatever they are called, adverts apart.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var td th br img wbr".split())
_NEVER = frozenset("head script style noscript template nav footer aside form button select textarea option input iframe svg math canvas object audio video dialog menu".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert alerts"
    " sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments disqus respond replies share sharing social related"
    " recommended subscribe subscription newsletter signup popup modal overlay toolbar pagination pager widget widgets form search login skip".split()
)
#: Words that say nothing of what a part is, beside one of the names.
_NEUTRAL = frozenset("area bar block body bottom box container content group inner item items left link links list main outer page post posts article articles region right section site slot text title top unit wrap wrapper".split())
_ADVERTS = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo".split())
_KEEP = frozenset("html body main article".split())
_SECTIONS = frozenset("div section td body html table center".split())
#: Elements that hold text of their own, not parts of a page.
_TEXT = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre figcaption caption summary address tr td th".split())
_CLOSED_BY = {"p": _INLINE, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]), "tr": frozenset(["tr"])}
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_SPACE = re.compile(r"\s+")
SIGMA = 1.0
_REACH = 3
_KERNEL = [math.exp(-(d * d) / (2 * SIGMA * SIGMA)) for d in range(-_REACH, _REACH + 1)]


def _named_away(tag: str, attrs: list[tuple[str, str | None]], inside: bool = False) -> bool:
    """Whether an element's attributes say that it is no part of the article: by all words of a class or id together."""
    for name, value in attrs:
        if name == "hidden":
            return True
        if not value:
            continue
        if name == "role" and value.lower() in _ROLES:
            return tag not in _KEEP
        if name in ("class", "id"):
            names = _ADVERTS if inside and (tag in _TEXT or tag in _INLINE) else _NAMES
            for token in value.split():
                words = {w.lower() for w in _WORDS.findall(token) if not w.isdigit()}
                if tag in _KEEP:
                    if tag == "article" and words & {"comment", "comments"}:
                        return True
                elif words & names and words <= names | _NEUTRAL:
                    return True
    return False


class Lines(HTMLParser):
    """The lines of a page: (text, tags, container, characters of links). A container is above 0 for an article or main
    element, else below 0 for a division, or 0; ``within`` has the division
    around each division, ``whole`` those that are the page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int]] = []
        self.within: dict[int, int] = {}
        self.whole = {0}
        self.open: list[tuple[str, bool, int, bool]] = [("", False, 0, False)]  # tag, excluded, container, in an article
        self.text: list[str] = []
        self.tags = 0
        self.containers = 0
        self.linked = 0

    def _flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        _, excluded, container, _ = self.open[-1]
        if text or self.tags:
            self.lines.append(("" if excluded else text, self.tags, container, min(self.linked, len(text))))
        self.text, self.tags, self.linked = [], 0, 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _INLINE and tag not in ("td", "th"):
            self.tags += 1
            if tag == "br":
                self.text.append(" ")
            elif tag not in _VOID and attrs and _named_away(tag, attrs, self.open[-1][3]):
                self._push(tag, True)
            elif tag not in _VOID:
                top = self.open[-1]
                self.open.append((tag, top[1], top[2], top[3]))
            return
        if tag in ("td", "th"):
            self.tags += 1
            self.text.append(" ")
            top = self.open[-1]
            self.open.append((tag, top[1], top[2], top[3]))
            return
        self._flush()
        self.tags = 1
        if tag == "main":  # what is still open around it was left unclosed
            while self.open[-1][1]:
                self.open.pop()
        top = self.open[-1][0]
        if tag in _CLOSED_BY.get(top, ()) or top == "p":
            self.open.pop()
        elif tag in ("li", "tr", "dt", "dd"):
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k][0] in _CLOSED_BY[tag] or self.open[k][0] == tag:
                    del self.open[k:]
                    break
                if self.open[k][0] in ("ul", "ol", "dl", "table", "tbody", "thead", "div", "article", "section"):
                    break
        if tag in _VOID:
            return
        inside = self.open[-1][3]
        away = tag in _NEVER or (tag == "header" and not inside) or bool(attrs and _named_away(tag, attrs, inside))
        self._push(tag, away)

    def _push(self, tag: str, away: bool) -> None:
        _, excluded, container, inside = self.open[-1]
        if away and not excluded and self.text:
            self._flush()
        if not inside and not excluded and not away:
            if tag in ("article", "main"):
                self.containers += 1
                container, inside = self.containers, True
            elif tag in _SECTIONS:
                self.containers += 1
                self.within[-self.containers] = container
                container = -self.containers
                if tag in ("html", "body"):
                    self.whole.add(container)
        self.open.append((tag, excluded or away, container, inside))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _VOID:
            self.handle_starttag(tag, attrs)
        else:
            self.tags += 1

    def handle_endtag(self, tag: str) -> None:
        if tag in _VOID:
            return
        self.tags += 1
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] == tag:
                inline = tag in _INLINE
                if not inline or self.open[k][1] != self.open[k - 1][1]:
                    self._flush()
                del self.open[k:]
                return
            if tag in _INLINE and self.open[k][0] not in _INLINE:
                return

    def handle_data(self, data: str) -> None:
        if not self.open[-1][1]:
            self.text.append(data)
            if any(x[0] == "a" for x in self.open[-3:]):
                self.linked += len(data)

    def finished(self) -> list[tuple[str, int, int, int]]:
        self.close()
        self._flush()
        return self.lines


def smoothed(values: list[float]) -> list[float]:
    """Each value with its neighbours, by a Gaussian; weights are made to sum to 1 at the ends too."""
    n, out = len(values), []
    for i in range(n):
        low, high = max(0, i - _REACH), min(n, i + _REACH + 1)
        weights = _KERNEL[low - i + _REACH : high - i + _REACH]
        out.append(sum(w * v for w, v in zip(weights, values[low:high])) / sum(weights))
    return out


def main_text(html: str | None) -> str:
    """The content blocks of a page in page order, joined by two line feeds; empty for no page."""
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    lines = parser.finished()
    if not any(text for text, *_ in lines):
        return ""
    ratios = smoothed([len(text) / max(1, tags) for text, tags, *_ in lines])
    mean = sum(ratios) / len(ratios)
    threshold = math.sqrt(sum((r - mean) ** 2 for r in ratios) / len(ratios))
    content = [2 * line[3] < len(line[0]) and r >= threshold for line, r in zip(lines, ratios)]
    if not any(content):  # whatever has most text
        most = max(len(line[0]) for line in lines)
        content = [len(line[0]) == most for line in lines]
    articles = {line[2] for line, c in zip(lines, content) if c and line[2] > 0}
    if articles:
        return "\n\n".join(line[0] for line in lines if line[0] and line[2] in articles)
    return "\n\n".join(_of_divisions([line if line[2] <= 0 else ("", *line[1:]) for line in lines], content, parser.within, parser.whole))


def _of_divisions(lines: list[tuple[str, int, int, int]], content: list[bool], within: dict[int, int], pages: set[int]) -> list[str]:
    """The texts of the smallest division that holds three quarters of the content (or, as long as those around it have lines
    of their own, as headings are, the outermost of these, but never the page for a division of it), without its divisions that have no
    content line and are links for the most part. Of the page as a whole, divisions without a content line go, too."""
    held: dict[int, int] = {}
    text: dict[int, int] = {}
    links: dict[int, int] = {}
    for (x, _, at, linked), c in zip(lines, content):
        while True:
            held[at] = held.get(at, 0) + (len(x) if c else 0)
            text[at] = text.get(at, 0) + len(x)
            links[at] = links.get(at, 0) + linked
            if at not in within:
                break
            at = within[at]
    whole = max(held.values())
    # Numbers of divisions fall from the outer to the inner.
    main = min(at for at, n in held.items() if 4 * n >= 3 * whole)
    own = {line[2] for line in lines if line[0]}
    while main not in pages and within[main] not in pages and within[main] in own:
        main = within[main]
    out = []
    for x, _, at, _ in lines:
        steps = [at]
        while steps[-1] != main and steps[-1] in within:
            steps.append(within[steps[-1]])
        if not x or steps[-1] != main:
            continue
        if all(held[s] or (main not in pages and 2 * links[s] < text[s]) for s in steps[:-1]):
            out.append(x)
    return out


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 200):
            some = batch.slice(i, 200)
            texts = [main_text(h) for h in some.column("html").to_pylist()]
            columns = [some.column("page_id"), some.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of each page: page_id, url, text, n_chars (code points).

    A null or empty page, or one without content, gives the empty text. Rows with equal ids are pages of their own. An
    empty table gives no rows. Other columns are ignored. Pages are independent: there is no shuffle.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
