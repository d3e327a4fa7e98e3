"""Main text of web pages by line-block distribution.

Markup is stripped to one line per block of the page. Menus, adverts and the like leave empty
lines in their place. The lengths of the lines are summed over a sliding window: where the sum
surges from nothing a segment begins, where it dives to nothing the segment ends. Lines that are
links for the most part have no length, in an article element only where ``WINDOW`` or more follow each other.

A segment is text if its peak comes near the median line of the page or the highest peak,
whichever is less. An article element is evidence: where its highest window is no small share of
the page's, its segments need no height and others do not count. A teaser with the text beside it
is outweighed, and all segments of the page are compared.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

WINDOW = 3
PEAK_SHARE = 0.25  # of the highest window
MEDIAN_SHARE = 0.5  # of the median line

# Elements of HTML by their role.
RAW_TEXT = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
SKIPPED = frozenset(
    "head nav footer aside form button select noscript template svg canvas audio video object "
    "dialog menu".split()
)
SKIPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar "
    "toolbar".split()
)
# Elements within a line; their class names say nothing about the block.
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i img kbd mark q s samp small span strong sub "
    "sup time tt u var wbr".split()
)
# Words in class or id names that mark what is no part of an article.
SKIPPED_NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion "
    "banner nav navbar navigation navi menu topnav sidenav sidebar aside footer cookie cookies "
    "consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup share "
    "sharing social related recommended recommendations comment comments feedback disqus respond reply "
    "replies breadcrumb breadcrumbs pagination pager widget toolbar masthead".split()
)
# Words that add nothing to such a word in a class or id name.
COMPANIONS = frozenset(
    "a area bar block body bottom box button buttons center col column container content form group "
    "inner item items js left link links list main outer page post posts primary reader readers right row section "
    "secondary site slot story the top unit user users wrap wrapper".split()
)
PAGE_HEADERS = frozenset("header masthead banner".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?:(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|(?P<odd>[^>]*+)(?:>|\Z))",
    re.DOTALL,
)
_ATTR = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PARTS = re.compile(r"[a-z]+")
_HIDDEN_STYLE = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)")


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTR.finditer(text)}


def _is_boilerplate(name: str, attrs: str, in_article: bool) -> bool:
    """Whether an element is no part of an article. A header inside the article is part of it."""
    if name in SKIPPED or (name == "header" and not in_article):
        return True
    if not attrs.strip(" /\n\t"):
        return False
    given = _attributes(attrs)
    if given.get("role") in SKIPPED_ROLES or "hidden" in given or given.get("aria-hidden") == "true":
        return True
    if _HIDDEN_STYLE.search(given.get("style", "")):
        return True
    if name in ("html", "body", "main", "article"):
        return name == "article" and bool({"comment", "comments", "ad", "promo"} & set(_NAME_PARTS.findall(given.get("class", ""))))
    if name in INLINE:
        return False
    return any(_names_boilerplate(word, in_article) for word in f"{given.get('class', '')} {given.get('id', '')}".split())


def _names_boilerplate(word: str, in_article: bool) -> bool:
    """Whether a class or id name marks boilerplate: all its parts do so, or add nothing to one that
    does ("ad-slot", not "notice-period"). Outside articles the last part is enough ("acme-footer")."""
    parts = _NAME_PARTS.findall(word)
    listed = SKIPPED_NAMES if in_article else SKIPPED_NAMES | PAGE_HEADERS
    marks = [part in listed for part in parts]
    if not any(marks):
        return False
    return all(mark or part in COMPANIONS for mark, part in zip(marks, parts)) or (not in_article and marks[-1])


class _Lines:
    """The blocks of a page: text, weight (characters outside links) and whether in an article."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, int, bool]] = []
        self.parts: list[str] = []
        self.linked = 0

    def text(self, raw: str, in_link: bool) -> None:
        value = html.unescape(raw)
        self.parts.append(value)
        if in_link:
            self.linked += len(value)

    def end_block(self, in_article: bool) -> None:
        if self.parts:
            line = " ".join("".join(self.parts).split())
            if line:
                self.rows.append((line, len(line) if 2 * self.linked <= len(line) else 0, in_article))
        self.parts, self.linked = [], 0

    def gap(self) -> None:
        self.rows.extend([("", 0, False)] * WINDOW)


def page_lines(page: str) -> list[tuple[str, int, bool]]:
    """One pass over the markup. An element that is left out ends with its end tag, or where an
    article begins if it wraps that article; a paragraph also where the next block begins."""
    lines, at, articles, links, seen_article = _Lines(), 0, 0, 0, False
    skip, depth = "", 0
    while True:
        m = _TOKEN.search(page, at)
        if not skip:
            lines.text(page[at : m.start() if m else len(page)], links > 0)
        if m is None:
            break
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        closing, attrs = bool(m["close"]), m["attrs"] or m["odd"] or ""
        if name in RAW_TEXT and not closing:
            end = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.IGNORECASE).search(page, at)
            at = end.start() if end else len(page)
            continue
        container = name in ("article", "main")
        if skip:
            wraps = container and not closing and not seen_article and skip in ("form", "nav", "header", "head", "div")
            if skip == "head" and name == "body":
                depth = 0
            elif wraps and not _is_boilerplate(name, attrs, False):
                depth = 0
            elif skip == "p" and (name in BLOCKS):
                depth = 0
            elif name == skip:
                depth += -1 if closing else 1
            if depth > 0:
                continue
            closed_it, skip = closing and name == skip, ""
            lines.gap()
            if closed_it:
                continue
        if not closing and name not in VOID and _is_boilerplate(name, attrs, articles > 0):
            lines.end_block(articles > 0)
            lines.gap()
            skip, depth, links = name, 1, 0
            continue
        if name in BLOCKS:
            lines.end_block(articles > 0)
            links = 0
            if container:
                lines.gap()
                seen_article |= not closing
                articles = max(0, articles - 1) if closing else articles + 1
        elif name == "br":
            lines.text(" ", False)
        elif name == "a":
            links = 0 if closing else 1
    lines.end_block(articles > 0)
    return lines.rows


def segments(weights: list[int], window: int = WINDOW) -> Iterator[tuple[int, int, int]]:
    """(first line, line after the last, peak) between each surge and dive of the window sums."""
    n, begin, total, peak, last = len(weights), None, 0, 0, 0
    for i in range(n + window):
        total += weights[i] if i < n else 0
        total -= weights[i - window] if i >= window else 0
        if i < n and weights[i]:
            last = i
            begin = i if begin is None else begin
        peak = max(peak, total)
        if total == 0 and begin is not None:
            yield begin, last + 1, peak
            begin, peak = None, 0


def _article_lengths(rows: list[tuple[str, int, bool]]) -> list[int]:
    """Lengths of the lines in articles; ``WINDOW`` or more lines of links on end count nothing."""
    lengths, run = [], 0
    for line, weight, article in rows:
        run = run + 1 if article and line and not weight else 0
        lengths.append(len(line) if article else 0)
        if run == WINDOW:
            lengths[-WINDOW:] = [0] * WINDOW
        elif run > WINDOW:
            lengths[-1] = 0
    return lengths


def main_text(page: str | None) -> str:
    """The article of a page: its blocks joined by an empty line, '' if there is none."""
    rows = page_lines(page or "")
    weights = [weight for _, weight, _ in rows]
    found = list(segments(weights))
    highest = max((peak for _, _, peak in found), default=0)
    declared = list(segments(_article_lengths(rows)))
    trusted = bool(declared) and max(peak for _, _, peak in declared) >= PEAK_SHARE * highest
    if trusted:
        found, least = declared, 0
    else:
        lengths = sorted(filter(None, weights))
        median = lengths[len(lengths) // 2] if lengths else 0
        least = min(PEAK_SHARE * highest, MEDIAN_SHARE * median)
    kept = [
        line
        for begin, end, peak in found
        if peak >= least
        for line, _, article in rows[begin:end]
        if line and (article or not trusted)
    ]
    return "\n\n".join(kept)


@F.pandas_udf(StringType())
def _main_text(pages: pd.Series) -> pd.Series:
    return pages.map(main_text, na_action=None).astype(object)


def extract(pages: DataFrame, column: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """Every row of ``pages`` with the page's main text and its length in code points.

    The columns ``text`` and ``n_chars`` replace any of these names; all others stay. White space
    within a block becomes one space; character references are decoded. A null or empty page, and
    one without text, gives an empty text and 0. Equal pages give equal texts; pages count whole,
    whatever their length.
    """
    out = pages.withColumn(text, _main_text(F.col(column)))
    return out.withColumn(n_chars, F.length(text).cast("long"))
