"""Main text of HTML pages by line-block distribution.

Markup is stripped into lines, one per block element. Lines of menus, headers,
footers, sidebars, notices, adverts, forms, comments, scripts and the like are
stripped with the markup: they stay as lines of length zero. Text lengths are
summed over a sliding window of WINDOW lines; the text surges where a window
rises over SURGE characters and its first line has text, and dives where a
window falls to zero. Everything between a surge and its dive is kept, short
lines included, and so are the short lines before the surge that no WINDOW - 1
lines of length zero part from it. Lines that are mostly link text have length
zero.

That holds for every page. A marked article (article, main, role=main,
articleBody) only widens the result: its lines are kept with those that the
windows choose, links included. A page without either keeps all its lines that
are not stripped, links only if there is nothing else.

Character references are decoded, white space inside a block becomes one
space. A null or empty page gives an empty text. Repeated rows give repeated
rows, an empty table an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm.common import table

WINDOW = 3
SURGE = 80
LINKS = 0.6

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|iframe|svg|textarea|select|object|math)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden|itemprop)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small strike "
                   "strong sub sup time tt u var".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav "
                  "ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
BOILER = frozenset("nav header footer aside form button dialog menu head fieldset".split())
ARTICLE = frozenset("article main".split())
#: Words of class, id and role that mark what is not the article.
NAMES = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar "
                  "navigation menu breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr notice "
                  "notices alert popup modal overlay newsletter subscribe signup login share sharing social related "
                  "recommended pagination toolbar widget contentinfo complementary search".split())
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies".split())


def kind_of(tag: str, attributes: str) -> str:
    """'comments', 'boiler', 'article' or ''."""
    words, article, hidden = set(), tag in ARTICLE, False
    if attributes:
        for name, *value in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(value)
            if name in ("class", "id", "role"):
                words.update(w.lower() for w in PARTS.findall(value))
                article |= name == "role" and value.strip().lower() == "main"
            elif name == "style":
                hidden |= "display:none" in value.replace(" ", "").lower()
            elif name == "itemprop":
                article |= "articleBody" in value
            else:
                hidden |= value.lower() != "false"
    if tag in ("html", "body"):
        return ""
    if words & COMMENTS:
        return "comments"
    if hidden or tag in BOILER or not article and words & NAMES:
        return "boiler"
    return "article" if article else ""


def lines_of(page: str) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Lines of a page: text, whether stripped, whether in an article, characters of links."""
    texts, stripped, inside, linked = [], [], [], []
    line: list[str] = []
    links, anchors = 0, 0
    stack: list[tuple[str, str]] = []
    depth = {"comments": 0, "boiler": 0, "article": 0, "": 0}
    opened: dict[str, int] = {}

    def flush():
        nonlocal links
        text = " ".join(html.unescape("".join(line)).split())
        line.clear()
        if text:
            texts.append(text)
            stripped.append(bool(depth["comments"] or depth["boiler"]))
            inside.append(bool(depth["article"]))
            linked.append(links)
        links = 0

    def pop():
        tag, kind = stack.pop()
        opened[tag] -= 1
        depth[kind] -= 1

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            part = page[at:m.start()]
            line.append(part)
            if anchors:
                links += len(part)
        at = m.end()
        tag = m[3]
        if not tag:
            line.append(" " if m[1] else "")
            continue
        tag = tag.lower()
        if tag == "a":
            anchors = 0 if m[2] else 1
        if tag == "br":
            line.append(" ")
        if tag in INLINE or tag in VOID and tag != "hr":
            continue
        if tag in BLOCK:
            flush()
        if tag == "hr":
            continue
        if m[2]:
            if opened.get(tag):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if tag in BLOCK and stack and stack[-1][0] == "p":
            pop()                                   # an open paragraph ends at a block
        kind = kind_of(tag, m[4])
        if kind == "article" and depth["boiler"] and not depth["comments"] and not depth["article"]:
            while depth["boiler"]:                  # left open before the article
                pop()
        stack.append((tag, kind))
        opened[tag] = opened.get(tag, 0) + 1
        depth[kind] += 1
    line.append(page[at:])
    flush()
    return texts, np.array(stripped, bool), np.array(inside, bool), np.array(linked, np.int64)


def between(length: np.ndarray, window: int, threshold: int) -> np.ndarray:
    """Which lines lie between a surge and its dive of the windows' sums."""
    n = len(length)
    run = np.concatenate([[0], np.cumsum(np.concatenate([length, np.zeros(window, np.int64)]))])
    block = run[window:window + n] - run[:n]        # block[i]: characters of lines i to i + window - 1
    surge = (length > 0) & (block > threshold)
    keep, i = np.zeros(n, bool), 0
    while i < n:
        if not surge[i]:
            i += 1
            continue
        dive = i
        while dive < n and block[dive] > 0:
            dive += 1
        start = i                                   # short lines that join the span
        while start and run[start] > run[max(0, start - window + 1)]:
            start -= 1
        keep[start:dive] = True
        i = dive
    return keep & (length > 0)


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    texts, stripped, inside, linked = lines_of(page or "")
    if not texts:
        return ""
    whole = np.array([len(t) for t in texts])
    whole[stripped] = 0
    length = np.where(linked > LINKS * whole, 0, whole)
    marked = inside & (whole > 0)
    length[marked] = whole[marked]
    keep = between(length, window, surge) | marked
    if not keep.any():
        keep = length > 0 if length.any() else whole > 0
    return "\n".join(t for t, k in zip(texts, keep, strict=True) if k)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): one row per page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")) \
        .mapInArrow(run, "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
