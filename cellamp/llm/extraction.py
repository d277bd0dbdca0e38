"""Main text of web pages from parser events and text-to-tag ratios.

A page is read once, event by event, with the standard library's parser. Elements that end a line of text (paragraphs, headings, list
items, cells, and so on) cut it into lines. A line's ratio is its number of characters outside links by its number of tags. Ratios are smoothed
with a Gaussian; lines above one standard deviation of the smoothed ratios are content, and runs of them are the content regions.

Regions stand for the element that holds them: all lines of a ``main`` or ``article`` with content are kept, short ones too. Pages without such an
element keep the lines of the block elements that hold content, from the first to the last content line where that is the body itself.

Lines inside menus, page headers and footers, sidebars, forms, scripts, styles, hidden elements, and elements whose class, id or role says
notice, advert, sharing, related links or reader comments have ratio 0 and are never kept. Of the header of an article only its headings are.

Character references are decoded, white space (as Unicode has it) inside a line becomes one space, lines are joined by one space. A null or
empty page, or one without text, has an empty text. Pages of any length are read whole; markup that is never closed ends where HTML ends it.
Repeated rows each get a row, missing ids and urls stay missing, extra columns stay as they are unless they are called ``text`` or ``n_chars``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements of HTML by how they are laid out.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th "
    "thead tr ul".split()
) - {"br"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
# An element that starts ends an open one of the same kind, up to the element that holds them.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "option": ({"option"}, {"select"}),
}
# Elements without article text.
ASIDE = frozenset(
    "aside audio button canvas datalist dialog embed footer form head iframe input map menu nav noembed noframes noscript object script "
    "search select style svg template textarea title video".split()
)
# Words in a class, id or role that mark an element without article text.
MARKS = frozenset(
    "ad ads adbox adslot adunit adv advert adverts advertisement advertisements advertising adsbygoogle alert alertdialog banner "
    "breadcrumb breadcrumbs comment commentlist comments complementary consent contentinfo cookie cookies copyright dialog discussion "
    "disqus footer gdpr login masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager pagination "
    "popup privacy promo promotion promotions recommendations recommended related reply replies respond search share sharing sidebar sidebars signup "
    "social sponsor sponsored subscribe subscription toolbar tracking widget widgets".split()
)
# Words that turn such a mark round (no-sidebar, has-comments).
TURNS = frozenset("no has with without".split())
# Words that say a header belongs to an article.
OWN_HEADER = frozenset("article content entry main post story".split())
# Elements whose class speaks of the page, not of the element.
WHOLE = frozenset("html body main".split())
SCOPES = frozenset("main article".split())

RADIUS = 2
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")

# What holds for the text inside an element.
KEPT, DROPPED, HEADINGS_ONLY = range(3)


def state_of(tag: str, attrs: list[tuple[str, str | None]], in_scope: bool) -> int:
    """Whether an element by itself may hold article text."""
    if tag in ASIDE:
        return DROPPED
    if not attrs and tag != "header":
        return KEPT
    named = {k: v or "" for k, v in attrs}
    if "hidden" in named or named.get("aria-hidden") == "true" or _HIDDEN.search(named.get("style", "").lower()):
        return DROPPED
    header = tag == "header"
    if tag not in WHOLE:
        for name in ("class", "id", "role"):
            for part in named.get(name, "").split():
                words = {w.lower() for w in _WORDS.findall(part)}
                if words & TURNS:
                    continue
                if words & MARKS:
                    return DROPPED
                if "header" in words:
                    header, in_scope = True, in_scope or bool(words & OWN_HEADER)
    return (HEADINGS_ONLY if in_scope else DROPPED) if header else KEPT


class Page(HTMLParser):
    """Lines of a page: their text, ratio, whether they may be kept, and the elements that hold them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        # Open elements: (tag, state, number of the holding element, number of the holding main or article)
        self.open: list[tuple[str, int, int, int]] = [("", KEPT, 0, 0)]
        self.names: Counter = Counter()
        self.count = 0
        self.words: list[str] = []
        self.dropped = False
        self.tags = self.link_chars = 0
        self.texts: list[str] = []
        self.ratios: list[float] = []
        self.kept: list[bool] = []
        self.holders: list[tuple[int, int]] = []
        self.bodies = {0}

    def end_line(self) -> None:
        text = " ".join("".join(self.words).split())
        if text or self.dropped:
            self.texts.append(text)
            self.kept.append(text != "")
            self.ratios.append(max(0, len(text) - self.link_chars) / max(1, self.tags))
            self.holders.append(self.open[-1][2:])
            self.tags = self.link_chars = 0
        self.words, self.dropped = [], False

    def shut(self, keep: int) -> None:
        """End the open elements from the given place on."""
        for tag, *_ in self.open[keep:]:
            self.names[tag] -= 1
        del self.open[keep:]

    def end_before(self, tag: str) -> None:
        """End elements that cannot hold the one that starts."""
        if self.names["head"] and tag not in IN_HEAD:
            self.shut(next(k for k, e in enumerate(self.open) if e[0] == "head"))
        if tag in BLOCK and self.names["p"]:
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k][0] == "p":
                    self.shut(k)
                    break
                if self.open[k][0] in BLOCK:
                    break
        same, holders = SIBLINGS.get(tag, ((), ()))
        if any(self.names[s] for s in same):
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k][0] in same:
                    self.shut(k)
                    break
                if self.open[k][0] in holders:
                    break

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self.end_line()
        self.tags += 1
        if tag == "br":
            self.words.append(" ")
        self.end_before(tag)
        if tag in VOID or (tag in ("html", "body") and self.names[tag]):
            return
        _, outer, holder, scope = self.open[-1]
        state = state_of(tag, attrs, scope > 0)
        if outer == HEADINGS_ONLY and state == KEPT:
            state = KEPT if tag in HEADINGS else HEADINGS_ONLY
        elif outer == DROPPED:
            state = DROPPED
        self.count += 1
        if tag in SCOPES and not scope and state == KEPT:
            scope = self.count
        # A paragraph, heading or cell is a line of the element around it.
        if tag in BLOCK and tag not in HEADINGS and tag not in ("p", "li", "tr", "td", "th", "dt", "dd", "tbody", "thead", "pre"):
            holder = self.count
            if tag in ("html", "body"):
                self.bodies.add(holder)
        self.open.append((tag, state, holder, scope))
        self.names[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if not self.names[tag]:
            return
        if tag in BLOCK:
            self.end_line()
        k = len(self.open) - 1
        while self.open[k][0] != tag:
            k -= 1
        if tag in BLOCK or not any(e[0] in BLOCK for e in self.open[k + 1 :]):
            self.shut(k)
        else:
            # An inline element that ends inside a block that it does not hold: only the element itself ends.
            self.names[tag] -= 1
            self.open[k] = ("", *self.open[k][1:])

    def handle_data(self, data: str) -> None:
        if self.open[-1][0] == "head" and not data.isspace():
            self.shut(len(self.open) - 1)
        if self.open[-1][1] != KEPT:
            # Text that is left out is a line without a ratio, unless it stands within one that is kept.
            self.dropped = self.dropped or not data.isspace()
            return
        self.words.append(data)
        if self.names["a"]:
            self.link_chars += len(data)

    def read(self, html: str) -> Page:
        self.feed(html)
        self.close()
        self.end_line()
        return self


def smoothed(ratios: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Gaussian mean over the neighbouring lines; beyond the ends lines have ratio 0."""
    kernel = np.exp(-np.arange(-radius, radius + 1) ** 2 / (2.0 * (radius / 2) ** 2))
    return np.convolve(np.pad(ratios, radius), kernel / kernel.sum(), "valid")


def content_lines(ratios: np.ndarray) -> np.ndarray:
    """Which lines are content by their smoothed ratio: above the standard deviation, or else the highest."""
    smooth = smoothed(ratios)
    above = (smooth > smooth.std()) & (ratios > 0)
    return above if above.any() else (ratios > 0) & (smooth == smooth[ratios > 0].max(initial=0))


def main_text(html: str | None) -> str:
    """The main text of a page."""
    page = Page().read(html or "")
    if not any(page.kept):
        return ""
    kept, ratios = np.array(page.kept), np.array(page.ratios)
    holder, scope = np.array(page.holders).T
    content = content_lines(ratios) & kept
    if (scope[content] > 0).any():
        chosen = kept & np.isin(scope, scope[content & (scope > 0)])
    else:
        chosen = np.zeros(len(kept), bool)
        for number in set(holder[content].tolist()):
            own = holder == number
            if number in page.bodies:
                at = np.flatnonzero(own & content)
                own &= (np.arange(len(own)) >= at[0]) & (np.arange(len(own)) <= at[-1])
            # Without an article element, lines that are links throughout are taken for menus.
            chosen |= own & kept & (ratios > 0)
    return " ".join(t for t, c in zip(page.texts, chosen.tolist(), strict=True) if c)


def main_text_of(html: Column) -> Column:
    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page) for page in batch], dtype=object)

    return texts(html)


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with the main text (``text``) and its code points (``n_chars``); a map over the rows without a shuffle."""
    found = pages.withColumn("text", main_text_of(F.col(html)))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))
