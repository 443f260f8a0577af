"""Main text of HTML pages from flat text blocks.

A page is read into blocks: the text between block-level tags, with its word count, link
density and the kind of region it stands in.  Each block is classified from its own
features and those of its neighbours by a decision tree, which is trained at first use on the
small labelled table below.  Blocks classified as text are joined in page order.

Character references are decoded, white space inside a block becomes one space.  A null or
empty page has an empty text.  Scripts, styles, comments, forms and other markup that holds no
text for readers give no block.
"""

from __future__ import annotations

import functools
import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

#: Elements whose content is never text of the page.
_SKIPPED = frozenset("script style noscript template svg math canvas iframe object select textarea option head title form button audio video map dialog".split())
#: Elements whose content is raw up to the end tag.
_RAW = frozenset("script style textarea title iframe noscript template".split())
#: Elements that stay within a line of text.
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter output progress q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr br input picture source track".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a following element of the set closes when their end tag is left out.
_CLOSES_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: Regions of a page, by element.
_SIDE = frozenset("nav footer aside menu".split())
_MAIN = frozenset("article main".split())
#: Words in class, id or role that mark a region as not part of the article.
_HINT = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|promo\w*|sponsor\w*|comments?|commentlist|respond|replies|disqus|sidebar|side|widget\w*|nav\w*|menu\w*|breadcrumbs?|footer|foot|header|masthead|topbar|toolbar|"
    r"cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|related|recommend\w*|teaser\w*|pagination|pager|tags?|copyright|legal|disclaimer|search|skip|"
    r"complementary|navigation|contentinfo|dialog|hidden|paywall|outbrain|taboola)(?:$|[\s_-])",
    re.I,
)
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|[^<]+|<", re.S)
_ATTR = re.compile(r"([a-zA-Z_:][\w:.-]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_SPACE = re.compile(r"\s+")

OUT, PLAIN, IN = 0, 1, 2


class Block(NamedTuple):
    text: str
    words: int
    link_words: int
    region: int
    heading: int


def _attrs(raw: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or "").strip("\"'") for m in _ATTR.finditer(raw)}


def _region(tag: str, raw: str, above: int, in_main: bool) -> tuple[int, bool]:
    """The region that an element opens, and whether it stands in the article."""
    if tag in _SIDE or (tag == "header" and not in_main):
        return OUT, in_main
    found = _attrs(raw) if raw.strip() else {}
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower():
        return OUT, in_main
    if tag not in ("body", "html") and _HINT.search(" ".join(found.get(k, "") for k in ("class", "id", "role"))) and tag not in _MAIN:
        return OUT, in_main
    if tag in _MAIN or found.get("role") == "main" or found.get("itemprop") == "articleBody":
        return (OUT if above == OUT else IN), True
    return above, in_main


def blocks(page: str | None) -> list[Block]:
    """The flat text blocks of a page, in page order."""
    page = page or ""
    out: list[Block] = []
    text: list[tuple[str, bool]] = []
    # Open elements: tag, region, in the article, skipped.
    stack: list[tuple[str, int, bool, bool]] = [("", PLAIN, False, False)]
    links, raw_until = 0, ""

    def flush(tag: str = "") -> None:
        if text:
            whole = _SPACE.sub(" ", html.unescape("".join(t for t, _ in text))).strip()
            if whole:
                linked = len(html.unescape("".join(t for t, a in text if a)).split())
                heading = int(any(re.fullmatch("h[1-6]", x[0]) for x in stack))
                out.append(Block(whole, len(whole.split()), linked, stack[-1][1], heading))
            text.clear()

    for m in _TOKEN.finditer(page):
        tag = m[2]
        if raw_until:
            if not (tag and m[1] and tag.lower() == raw_until):
                continue
            raw_until = ""
        if tag is None:
            piece = m[0]
            if piece.startswith("<!") or piece.startswith("<?"):
                continue
            if not stack[-1][3]:
                text.append((piece, links > 0))
            continue
        tag = tag.lower()
        closing = m[1] == "/"
        if tag == "a":
            if closing:
                links = max(0, links - 1)
            elif "href" in m[3].lower():
                links = 1
        if tag == "br" and not closing:
            text.append((" ", False))
        inline = tag in _INLINE
        if not inline:
            flush()
            links = 0
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
                if inline and stack[i][0] not in _INLINE:
                    break
            continue
        if tag in _CLOSES_P or tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            shut = ("p",) if tag in _CLOSES_P else (tag,)
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in shut:
                    del stack[i:]
                    break
                if stack[i][0] not in _INLINE:
                    break
        if tag in _VOID or m[3].rstrip().endswith("/") and tag not in _MAIN and tag not in ("p", "div", "a"):
            continue
        _, region, in_main, skipped = stack[-1]
        if tag in _RAW:
            raw_until = tag
        region, in_main = (region, in_main) if inline and not m[3].strip() else _region(tag, m[3], region, in_main)
        stack.append((tag, region, in_main, skipped or tag in _SKIPPED))
    flush()
    return out


#: The labelled table.  One row per example block: region (0 outside, 1 plain, 2 in the
#: article), heading, the page has an article region, then word count and link density (%) of
#: the previous, the own and the next block, and the label.
LABELLED = [
    (2, 1, 1, 0, 0, 8, 0, 40, 0, 1), (2, 0, 1, 8, 0, 40, 0, 60, 0, 1), (2, 0, 1, 40, 0, 2, 0, 35, 0, 1), (2, 0, 1, 3, 0, 1, 0, 2, 0, 1),
    (2, 0, 1, 60, 0, 90, 5, 12, 0, 1), (2, 0, 1, 20, 0, 12, 30, 50, 0, 1), (2, 0, 1, 1, 0, 1, 0, 0, 0, 1), (2, 0, 1, 0, 0, 300, 0, 0, 0, 1),
    (2, 0, 1, 80, 0, 15, 60, 80, 0, 1), (2, 0, 1, 1, 100, 5, 0, 20, 0, 1), (2, 0, 1, 50, 0, 1, 100, 1, 100, 0), (2, 0, 1, 1, 100, 2, 100, 1, 100, 0),
    (2, 0, 1, 2, 100, 3, 100, 40, 0, 0), (2, 0, 1, 30, 0, 6, 100, 8, 100, 0), (2, 0, 1, 9, 90, 8, 95, 9, 90, 0), (2, 1, 1, 100, 0, 4, 0, 70, 0, 1),
    (2, 1, 1, 3, 100, 5, 0, 3, 100, 1), (2, 0, 1, 4, 0, 9, 0, 3, 100, 1),
    (0, 0, 1, 1, 100, 1, 100, 1, 100, 0), (0, 0, 1, 1, 100, 10, 0, 8, 0, 0), (0, 0, 1, 0, 0, 12, 0, 60, 0, 0), (0, 0, 1, 80, 0, 14, 0, 0, 0, 0),
    (0, 0, 1, 50, 0, 200, 0, 3, 0, 0), (0, 1, 1, 50, 0, 2, 0, 40, 0, 0), (0, 0, 1, 40, 0, 60, 10, 30, 0, 0), (0, 0, 1, 300, 0, 45, 0, 45, 0, 0),
    (0, 0, 0, 1, 100, 1, 100, 1, 100, 0), (0, 0, 0, 10, 0, 120, 0, 80, 0, 0), (0, 1, 0, 0, 0, 5, 0, 50, 0, 0), (0, 0, 0, 40, 0, 12, 0, 0, 0, 0),
    (1, 0, 1, 50, 0, 10, 0, 60, 0, 0), (1, 0, 1, 60, 0, 120, 0, 4, 0, 0), (1, 0, 1, 1, 100, 1, 100, 1, 100, 0), (1, 1, 1, 2, 0, 6, 0, 40, 0, 0),
    (1, 0, 1, 0, 0, 3, 0, 4, 0, 0), (1, 0, 1, 20, 0, 30, 0, 200, 0, 0), (1, 0, 1, 20, 0, 7, 80, 5, 0, 0),
    (1, 0, 0, 40, 0, 60, 0, 80, 0, 1), (1, 0, 0, 80, 0, 25, 0, 40, 0, 1), (1, 0, 0, 60, 0, 4, 0, 70, 0, 1), (1, 1, 0, 5, 0, 6, 0, 60, 0, 1),
    (1, 0, 0, 6, 0, 45, 10, 30, 0, 1), (1, 0, 0, 0, 0, 150, 0, 0, 0, 1), (1, 0, 0, 30, 0, 18, 0, 3, 0, 1), (1, 0, 0, 12, 0, 22, 15, 30, 0, 1),
    (1, 1, 0, 0, 0, 7, 0, 90, 0, 1), (1, 0, 0, 25, 0, 3, 0, 30, 0, 1), (1, 0, 0, 5, 0, 14, 0, 25, 0, 1), (1, 0, 0, 30, 0, 11, 0, 20, 0, 1),
    (1, 0, 0, 1, 100, 1, 100, 1, 100, 0), (1, 0, 0, 3, 100, 4, 100, 2, 100, 0), (1, 0, 0, 2, 0, 3, 0, 2, 100, 0), (1, 0, 0, 1, 100, 5, 0, 1, 100, 0),
    (1, 0, 0, 50, 0, 6, 90, 7, 100, 0), (1, 0, 0, 6, 70, 9, 60, 5, 80, 0), (1, 0, 0, 2, 100, 4, 0, 3, 50, 0), (1, 0, 0, 0, 0, 2, 0, 1, 100, 0),
    (1, 0, 0, 1, 100, 3, 0, 0, 0, 0), (1, 0, 0, 4, 80, 30, 85, 4, 90, 0), (1, 0, 0, 20, 0, 25, 70, 10, 60, 0), (1, 1, 0, 2, 100, 3, 0, 4, 100, 0),
    (1, 0, 0, 1, 100, 60, 0, 50, 0, 1), (1, 0, 0, 60, 0, 50, 0, 1, 100, 1), (1, 0, 0, 2, 100, 35, 0, 3, 100, 1), (1, 0, 0, 1, 100, 90, 5, 1, 100, 1),
]

Node = tuple  # (feature, threshold, left, right) or (label,)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8) -> Node:
    """A decision tree by Gini impurity; ties go to the earlier feature and lower threshold."""
    if depth == 0 or len(set(y.tolist())) == 1:
        return (int(2 * y.sum() >= len(y)),)
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for t in (values[1:] + values[:-1]) / 2:
            left = x[:, f] <= t
            cost = sum(s.sum() * p * (1 - p) for s, p in ((left, y[left].mean()), (~left, y[~left].mean())))
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, float(t))
    if best is None:
        return (int(2 * y.sum() >= len(y)),)
    left = x[:, best[1]] <= best[2]
    return (best[1], best[2], grow(x[left], y[left], depth - 1), grow(x[~left], y[~left], depth - 1))


@functools.cache
def tree() -> Node:
    rows = np.array(LABELLED, float)
    return grow(rows[:, :-1], rows[:, -1])


def classify(x: np.ndarray, node: Node | None = None) -> np.ndarray:
    """Labels of the rows of ``x``."""
    node = tree() if node is None else node
    if len(node) == 1:
        return np.full(len(x), node[0])
    left = x[:, node[0]] <= node[1]
    out = np.zeros(len(x), int)
    out[left] = classify(x[left], node[2])
    out[~left] = classify(x[~left], node[3])
    return out


def features(found: list[Block]) -> np.ndarray:
    n = len(found)
    own = np.array([(b.region, b.heading, b.words, 100 * b.link_words / b.words) for b in found], float).reshape(n, 4)
    padded = np.vstack([np.zeros((1, 2)), own[:, 2:], np.zeros((1, 2))])
    article = np.full((n, 1), float(bool((own[:, 0] == IN).any())))
    return np.hstack([own[:, :2], article, padded[:-2], padded[1:-1], padded[2:]])


def main_text(page: str | None) -> str:
    found = blocks(page)
    if not found:
        return ""
    return "\n".join(b.text for b, keep in zip(found, classify(features(found)), strict=True) if keep)


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 256):
        text = [main_text(p) for p in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(list(map(len, text)), pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row of ``pages`` (page_id, url, html)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_run, "page_id long, url string, text string, n_chars long")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
