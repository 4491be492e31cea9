"""Main text of web pages by line-block distribution.

Markup is stripped into lines: one per block element, inline elements and line breaks
being white space inside it.  A line's weight is its text without link text; lines of
parts that are not the article (by element, role, class or id) weigh nothing.  Weights are
summed over windows of ``WINDOW`` lines.  The text surges where a window's sum first rises
above the threshold and dives where it falls to nothing; the lines between both points are
kept, short ones included.

The text surges at the first window over ``THRESHOLD`` characters, on any page.  It dives at the
first window without weight after the last such window.  Everything between is kept, lines of
links too, except the parts beside the article.  A page without such a window has its points at its
first and last line with weight.  A declared article (``article``, ``main`` or that role) only
changes weights: where it holds over half of the page's, its lines weigh ``DECLARED_WEIGHT`` times and the
others nothing, so that its short lines surge and a line beside it does not.  Otherwise
(teasers beside an undeclared body) the tags count for nothing.  The points come from the windows on every page.

Defined cases: null and empty pages have empty text; pages without markup are one
block; unclosed elements end with their parent, and if an unclosed part beside the article
swallows all of it, names no longer mark parts; character references are decoded
once; nothing is capped; repeated rows give repeated results; an empty table gives no
rows; extra columns are not carried.  A page takes time in proportion to its length, however deep
or broken its elements.  Row by row, no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table

#: Lines of a window, characters without links that make one surge, the share of a page's weight that a
#: declared article must exceed, and how much more its lines then weigh.
WINDOW = 3
THRESHOLD = 86
DECLARED_SHARE, DECLARED_WEIGHT = 0.5, 8

# Elements by role in a page, and names that mark parts beside the article.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset("script style noscript template title svg math iframe object canvas audio video select button "
                    "textarea option datalist form nav footer aside menu dialog".split())
_BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure "
                    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section "
                    "summary table tbody td tfoot th thead title tr ul".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_SILENT_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu "
                          "menubar toolbar".split())
_SILENT_NAMES = frozenset("ad ads adv advert adverts advertisement advertising adsbygoogle banner breadcrumb breadcrumbs comment "
                          "comments commentlist consent cookie cookies disqus disclaimer footer gdpr header masthead menu modal "
                          "nav navbar navigation newsletter notice notification overlay pager pagination popup promo "
                          "promotion recommended related replies reply share sharing sidebar signup social sponsor "
                          "sponsored subscribe subscription toolbar widget copyright login search alert discussion responses "
                          "topbar subnav paywall".split())
_ARTICLE_NAMES = frozenset("ad ads advert advertisement comment comments promo related replies reply sponsored teaser".split())
#: What an element closes when it opens (implied end tags).
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
           "option": {"option"}, "body": {"head"}}


def _names(attrs: dict[str, str | None]) -> set[str]:
    found: set[str] = set()
    for key in ("class", "id"):
        words = re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", attrs.get(key) or "").lower())
        # "has-sidebar" speaks of a page that has one
        found |= {w for before, w in pairwise(["", *words]) if before not in ("has", "no", "with", "without", "non")}
    return found


class _Lines(HTMLParser):
    """Lines of a page: (text, weight, in a declared article)."""

    def __init__(self, use_names: bool = True) -> None:
        super().__init__(convert_charrefs=True)
        self.use_names = use_names
        self.lines: list[tuple[str, int, bool]] = []
        self.parts: list[str] = []
        self.linked = 0
        self.open: list[tuple[str, bool, bool, bool]] = []  # tag, silent, declared article, link
        # where each tag and the blocks lie in the stack, so that no tag searches it
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.silent = self.main = self.links = self.headers = self.headings = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, max(0, len(text) - self.linked), self.main > 0))
        self.parts, self.linked = [], 0

    def _silences(self, tag: str, attrs: dict[str, str | None]) -> bool:
        if tag in ("html", "body", "main"):
            return False
        if tag in _SILENT or "hidden" in attrs or attrs.get("aria-hidden") == "true" or \
                "display:none" in (attrs.get("style") or "").replace(" ", "").lower():
            return True
        if (attrs.get("role") or "").lower() in _SILENT_ROLES:
            return True
        if tag == "header":
            return not self.main
        if not self.use_names:
            return False
        if tag in _HEADINGS or tag == "p":
            return bool(_names(attrs) & _ARTICLE_NAMES)
        return bool(_names(attrs) & (_ARTICLE_NAMES if tag == "article" else _SILENT_NAMES))

    def handle_starttag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.parts.append("\n")
            return
        if tag in _BLOCKS:
            self.flush()
        if tag in _VOID:
            return
        closes = _CLOSES.get(tag)
        if closes:
            while self.open and self.open[-1][0] in closes:
                self._close()
        elif tag in _BLOCKS and self.open and self.open[-1][0] == "p":
            self._close()
        attrs = dict(attributes)
        silent = self._silences(tag, attrs)
        main = not silent and not self.silent and (tag in ("article", "main") or (attrs.get("role") or "").lower() in ("main", "article"))
        link = tag == "a"
        self.silent, self.main, self.links = self.silent + silent, self.main + main, self.links + link
        self.headers += tag == "header"
        self.headings += tag in _HEADINGS
        if silent:
            self.lines.append(("", 0, self.main > 0))  # a weightless line where the part stood
        self.places.setdefault(tag, []).append(len(self.open))
        if tag in _BLOCKS:
            self.blocks.append(len(self.open))
        self.open.append((tag, silent, main, link))

    handle_startendtag = handle_starttag

    def _close(self) -> None:
        tag, silent, main, link = self.open.pop()
        self.places[tag].pop()
        if tag in _BLOCKS:
            self.blocks.pop()
        self.silent, self.main, self.links = self.silent - silent, self.main - main, self.links - link
        self.headers -= tag == "header"
        self.headings -= tag in _HEADINGS

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCKS or tag in _SILENT:
            self.flush()
        places = self.places.get(tag)
        # a stray end tag closes nothing, and one of an inline element closes no block
        if places and (tag in _BLOCKS or not self.blocks or places[-1] > self.blocks[-1]):
            for _ in range(len(self.open) - places[-1]):
                self._close()

    def handle_data(self, data: str) -> None:
        if self.silent or (self.headers and not self.headings):
            return
        self.parts.append(data)
        if self.links:
            self.linked += len(" ".join(data.split()))

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i, report)


def points(weights: np.ndarray, window: int, threshold: float) -> tuple[int, int]:
    """The line range from the first window above the threshold to where, after the last one, a window weighs nothing."""
    sums = np.convolve(weights, np.ones(window), "full")  # sums[i]: the window that ends at line i
    high = np.flatnonzero(sums > threshold)
    if not len(high):
        high = np.flatnonzero(sums)
    none = np.flatnonzero(sums[high[-1]:] == 0)
    surge, dive = max(0, high[0] - window + 1), high[-1] + none[0] if len(none) else len(weights)
    inside = np.flatnonzero(weights[surge:dive]) + surge
    return int(inside[0]), int(inside[-1]) + 1


def main_text(html: str | None) -> str:
    """The main text; a page that class and id names leave without any is read again without them."""
    return (_text(html, True) or _text(html, False)) if html else ""


def line_weights(lines: list[tuple[str, int, bool]]) -> np.ndarray:
    """Characters without links per line.  Where a declared article holds over half of them, its lines weigh
    ``DECLARED_WEIGHT`` times and the others nothing."""
    weights = np.array([w for _, w, _ in lines], float)
    declared = np.array([main and text != "" for text, _, main in lines], bool)
    if weights[declared].sum() > DECLARED_SHARE * weights.sum():
        weights = np.where(declared, weights * DECLARED_WEIGHT, 0.0)
    return weights


def lines_of(html: str, use_names: bool = True) -> list[tuple[str, int, bool]]:
    """(text, characters without links, in a declared article) of every line of a page."""
    parser = _Lines(use_names)
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.lines


def _text(html: str, use_names: bool) -> str:
    lines = lines_of(html, use_names)
    weights = line_weights(lines)
    if not weights.any():
        return ""
    first, end = points(weights, WINDOW, THRESHOLD)
    return "\n\n".join(text for text, _, _ in lines[first:end] if text)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(h) for h in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    rows = pages.select("page_id", "url", "html")
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars long")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
