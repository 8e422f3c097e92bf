"""Main text of web pages by line-block distribution (operator 2).

Markup is stripped into lines, one for each block of the page; menus, forms, notices, adverts and the like
are no part of the sequence.  A line weighs as much as its text outside links.  Where the page declares its
article, and the article holds most of the page's text outside links, lines inside weigh one threshold more
and lines outside weigh eight thresholds less.  The weights are summed over sliding windows of
lines on every page.  Text begins at a surge, where a window passes the threshold, ends at the following dive, where
a whole window weighs nothing, and the lines between that don't weigh less than nothing are kept, whatever
their share of links.  Pages with little text have a lower threshold.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MARKUP = re.compile(r"""<(?:!--(?:.*?-->|.*\Z)|([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>?|/([a-zA-Z][^\s/>]*)[^>]*>?|[!?/][^>]*>?)""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_PARTS = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")

RAW = frozenset("script style title textarea noscript template iframe svg math object audio video canvas head".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
#: Elements and roles that hold no article text.
ASIDE_TAGS = frozenset("nav header footer aside form button select dialog menu fieldset".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar note".split())
#: Words of class and id attributes that tell the same.
ASIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adsbygoogle banner sponsor sponsored promo promotion sidebar side rail "
    "comment comments commentlist disqus respond replies reply cookie cookies consent gdpr notice notices notification alert popup overlay modal "
    "newsletter subscribe subscription signup login register menu nav navbar navigation breadcrumb breadcrumbs topbar masthead header footer foot "
    "copyright share sharing social related recommended recommendations widget widgets pagination pager toolbar skip search form tags".split()
)
ARTICLE_NAMES = frozenset({"articlebody", "article-body", "article-content", "post-content", "post-body", "entry-content", "story-body", "main-content"})
#: An article's own title may stand in its header.
KEPT_IN_ARTICLE = frozenset({"header", "banner", "masthead"})


def _attributes(source: str) -> dict[str, str]:
    return {k.lower(): html.unescape(v.strip("\"'")) for k, v in _ATTRIBUTE.findall(source)}


def _kind(tag: str, source: str, inside: bool) -> tuple[bool, bool]:
    """Whether an element is aside from the text, and whether it declares the article."""
    if not source.strip():
        return tag in ASIDE_TAGS and not (inside and tag in KEPT_IN_ARTICLE), tag == "article"
    a = _attributes(source)
    names = f"{a.get('class', '')} {a.get('id', '')}".split()
    article = tag == "article" or a.get("itemprop", "").lower() == "articlebody" or bool(ARTICLE_NAMES.intersection(n.lower() for n in names))
    parts = [[w.lower() for w in _PARTS.split(n) if w] for n in names]
    words = {w for x in parts for w in (*x[:1], *x[-1:])}  # what a name begins or ends with
    aside = (ASIDE_TAGS & {tag}) | (ASIDE_ROLES & {a.get("role", "").lower()})
    if tag not in ("html", "body", "main") and not (article and tag != "article"):
        aside |= ASIDE_NAMES & words
    if inside:
        aside = {x for x in aside if x not in KEPT_IN_ARTICLE}
    gone = "hidden" in a or a.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", a.get("style", "").lower())
    return bool(aside or gone), article


def page_lines(source: str) -> list[tuple[str, int, bool, bool]]:
    """The page's non-empty blocks: text, characters in links, aside, in a declared article."""
    lines: list[tuple[str, int, bool, bool]] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # tag, aside, article, link: each also true below it
    text: list[str] = []
    linked = at = 0

    def end_line() -> None:
        nonlocal linked
        joined = " ".join("".join(text).split())
        if joined:
            top = stack[-1] if stack else ("", False, False, False)
            lines.append((joined, linked, top[1], top[2]))
        text.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        if piece:
            piece = html.unescape(piece) if "&" in piece else piece
            text.append(piece)
            if stack and stack[-1][3]:
                linked += len(piece.strip())

    while True:
        m = _MARKUP.search(source, at)
        if m is None:
            add(source[at:])
            break
        add(source[at : m.start()])
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            if tag in RAW:
                close = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(source, at)
                if tag == "head" and close is None:
                    continue
                at = close.end() if close else len(source)
                continue
            if tag in BLOCKS:
                end_line() if tag != "br" else text.append("\n")
            if tag in VOID or m[2].endswith("/") and tag not in BLOCKS:
                continue
            if tag in BLOCKS and stack and stack[-1][0] == "p":
                stack.pop()
            _, aside, article, link = stack[-1] if stack else ("", False, False, False)
            own_aside, own_article = _kind(tag, m[2], article)
            if own_aside and not aside or own_aside != aside and tag not in BLOCKS:
                end_line()
            stack.append((tag, aside or own_aside, article or own_article, link or tag == "a"))
        elif m[3]:
            tag = m[3].lower()
            where = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if tag in BLOCKS and tag != "br":
                end_line()
            if where is not None:
                before = stack[where - 1][1:3] if where else (False, False)
                if stack[-1][1:3] != before:
                    end_line()
                del stack[where:]
    end_line()
    return lines


def line_weights(lines: list[tuple[str, int, bool, bool]], threshold: int) -> list[int]:
    """What each line of :func:`page_lines` weighs; see the module text."""
    weights = [max(0, len(text) - 2 * linked) for text, linked, _, _ in lines]
    plain = [max(0, len(text) - linked) for text, linked, _, _ in lines]
    own = sum(n for n, (*_, article) in zip(plain, lines) if article)
    if not any(article for *_, article in lines) or 2 * own < sum(plain):
        return weights
    return [w + threshold if article else max(w - 8 * threshold, -1) for w, (*_, article) in zip(weights, lines)]


def main_text(source: str | None, window: int = 3, threshold: int = 80) -> str:
    """The text between the surges and dives of one page; null, empty and textless pages give an empty string.

    The threshold is at most half of what the page's lines weigh, so a page of one short paragraph, however short, keeps it.
    """
    lines = [x for x in page_lines(source or "") if not x[2]]
    weights = line_weights(lines, threshold)
    need = min(threshold, max(1, sum(max(w, 0) for w in weights) // 2))
    kept, inside = [], False
    for i, (line, weight) in enumerate(zip(lines, weights)):
        block = sum(weights[i : i + window])
        inside = block > 0 and (inside or (weight > 0 and block >= need))
        if inside and weight >= 0:
            kept.append(line[0])
    return " ".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages(page_id, url, html)``.

    White space inside a block becomes one space and blocks are joined by one.  Rows with a null
    html have an empty text; null ids and repeated rows stay; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = pa.array([main_text(x.as_py()) for x in part.column(2)], pa.string())
                yield pa.record_batch([part.column(0), part.column(1), found], names=["page_id", "url", "text"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string").withColumn("n_chars", F.char_length("text").cast("long"))
