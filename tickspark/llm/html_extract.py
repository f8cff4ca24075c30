"""Operator 3: main text of HTML pages by classified flat text blocks.

A page is cut at block-level tags into flat text blocks. Each block has its word
count and link density, those of its two neighbours, and whether it stands in an
element that the markup itself calls content or page furniture. A decision tree,
fitted by Spark ML on the small labelled table below, keeps or drops each block.

Defined cases: null or empty html gives an empty text; unclosed, unmatched and cut
off tags are read as far as they go; character references are decoded once; pages
that occur twice give two rows; other columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

#: HTML elements that start a new block.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section "
    "summary table tbody td tfoot th thead tr ul".split())
#: Elements whose content is never text of the page.
SILENT_TAGS = frozenset("script style noscript template iframe object svg math head title select option textarea "
                        "button canvas audio video map datalist".split())
RAW_TAGS = frozenset(["script", "style", "textarea", "title", "noscript", "iframe", "template"])
#: Elements of page furniture, and of content.
FURNITURE_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
CONTENT_TAGS = frozenset(["article", "main"])
#: Words in class, id or role that name furniture.
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments complementary "
    "consent contentinfo cookie cookies copyright discussion disqus feedback footer form gdpr login masthead menu "
    "modal nav navbar navigation navigationbar newsletter notice notification overlay pager pagination paywall popup "
    "promo promotion recommended related replies reply respond search share sharing sidebar sidenav signup social "
    "sponsor sponsored subscribe subscription tagcloud toc toolbar topbar tracking widget widgets alert".split())
CONTENT_WORDS = frozenset("article content entry main post story maincontent articlebody postbody".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                    r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_NAMING = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "furniture", "content", "heading")
#: The labelled table: features in the order above, then 1 to keep and 0 to drop.
#: Fixed values, written by hand from typical pages.
LABELLED = [
    (60, 0.0, 45, 0.0, 80, 0.0, 0, 1, 0, 1), (25, 0.1, 60, 0.0, 60, 0.0, 0, 1, 0, 1), (3, 0.0, 0, 0.0, 60, 0.0, 0, 1, 0, 1),
    (1, 0.0, 30, 0.0, 40, 0.0, 0, 1, 0, 1), (2, 0.0, 2, 1.0, 1, 0.0, 0, 1, 0, 1), (9, 0.0, 9, 0.0, 9, 0.0, 0, 1, 1, 1),
    (7, 0.0, 1, 1.0, 40, 0.0, 0, 1, 1, 1), (200, 0.0, 10, 0.0, 12, 0.1, 0, 1, 0, 1), (4, 0.25, 50, 0.0, 50, 0.0, 0, 1, 0, 1),
    (12, 0.3, 12, 0.3, 12, 0.3, 0, 1, 0, 1), (30, 0.0, 8, 0.0, 0, 0.0, 0, 1, 0, 1), (5, 0.0, 100, 0.0, 6, 0.1, 0, 1, 0, 1),
    (3, 1.0, 3, 1.0, 3, 1.0, 0, 1, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0, 0), (6, 1.0, 40, 0.0, 6, 1.0, 0, 1, 0, 0),
    (8, 0.9, 3, 1.0, 3, 1.0, 0, 1, 0, 0), (2, 1.0, 60, 0.0, 60, 0.0, 0, 1, 0, 0), (12, 0.8, 0, 0.0, 30, 0.0, 0, 1, 0, 0),
    (1, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0, 0), (2, 1.0, 2, 1.0, 2, 1.0, 1, 0, 0, 0), (9, 0.0, 2, 1.0, 10, 0.0, 1, 0, 0, 0),
    (12, 0.0, 40, 0.0, 0, 0.0, 1, 0, 0, 0), (40, 0.0, 30, 0.0, 30, 0.0, 1, 0, 0, 0), (80, 0.0, 80, 0.0, 20, 0.0, 1, 0, 0, 0),
    (25, 0.1, 4, 1.0, 60, 0.0, 1, 1, 0, 0), (60, 0.0, 60, 0.0, 8, 0.0, 1, 1, 0, 0), (5, 0.0, 50, 0.0, 30, 0.0, 1, 1, 1, 0),
    (3, 0.5, 100, 0.0, 0, 0.0, 1, 0, 0, 0), (30, 0.0, 3, 0.0, 3, 0.0, 1, 1, 0, 0), (150, 0.05, 2, 1.0, 2, 1.0, 1, 0, 0, 0),
    (1, 0.0, 1, 0.0, 1, 0.0, 1, 1, 0, 0), (4, 0.0, 0, 0.0, 70, 0.0, 1, 0, 1, 0), (2, 0.0, 200, 0.0, 2, 0.0, 1, 0, 0, 0),
    (60, 0.0, 45, 0.0, 80, 0.0, 0, 0, 0, 1), (35, 0.05, 20, 0.0, 50, 0.0, 0, 0, 0, 1), (18, 0.1, 40, 0.0, 60, 0.1, 0, 0, 0, 1),
    (22, 0.0, 6, 0.0, 30, 0.0, 0, 0, 0, 1), (14, 0.0, 50, 0.0, 14, 0.0, 0, 0, 0, 1), (120, 0.1, 1, 1.0, 2, 1.0, 0, 0, 0, 1),
    (6, 0.0, 60, 0.0, 60, 0.0, 0, 0, 0, 1), (8, 0.0, 45, 0.0, 25, 0.0, 0, 0, 0, 1), (5, 0.0, 70, 0.0, 40, 0.0, 0, 0, 0, 1),
    (7, 0.0, 2, 1.0, 45, 0.0, 0, 0, 1, 1), (9, 0.0, 3, 1.0, 60, 0.0, 0, 0, 1, 1), (4, 0.0, 40, 0.0, 50, 0.0, 0, 0, 1, 1),
    (45, 0.0, 45, 0.0, 2, 1.0, 0, 0, 0, 1), (60, 0.0, 50, 0.0, 0, 0.0, 0, 0, 0, 1), (80, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1),
    (40, 0.0, 2, 1.0, 40, 0.0, 0, 0, 0, 1), (25, 0.0, 30, 0.0, 1, 1.0, 0, 0, 0, 1), (50, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0, 1),
    (5, 0.0, 4, 1.0, 3, 1.0, 0, 0, 1, 0), (3, 0.0, 3, 1.0, 3, 1.0, 0, 0, 0, 0), (2, 0.0, 1, 1.0, 5, 0.0, 0, 0, 0, 0),
    (2, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0), (1, 1.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0), (10, 0.9, 3, 1.0, 3, 1.0, 0, 0, 0, 0),
    (4, 0.0, 0, 0.0, 3, 1.0, 0, 0, 0, 0), (3, 0.0, 40, 0.0, 0, 0.0, 0, 0, 0, 0), (6, 0.5, 50, 0.0, 2, 1.0, 0, 0, 0, 0),
    (5, 0.0, 4, 0.0, 4, 0.0, 0, 0, 0, 0), (15, 0.7, 4, 1.0, 6, 0.8, 0, 0, 0, 0), (30, 0.8, 20, 0.8, 20, 0.8, 0, 0, 0, 0),
]


def _named(attrs: str) -> set[str]:
    out: set[str] = set()
    for values in _NAMING.findall(attrs):
        for value in "".join(values).split():
            parts = [p.lower() for p in _PARTS.findall(value)]
            out.update(parts)
            out.add("".join(parts))
    return out


def blocks(page: str | None) -> list[tuple[str, int, int, bool, bool, bool]]:
    """(text, words, words in links, in furniture, in content, heading) in page order."""
    page = page or ""
    out: list[tuple[str, int, int, bool, bool, bool]] = []
    pieces: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # (tag, furniture, content) of open containers
    at, links, silent = 0, 0, []
    heading = False

    def close_block():
        nonlocal heading
        if pieces:
            text = " ".join(html_lib.unescape("".join(pieces)).split())
            if text:
                in_links = len(html_lib.unescape(" ".join(linked)).split()) if linked else 0
                words = len(text.split(" "))
                furniture = any(f for _, f, _ in stack)
                out.append((text, words, min(in_links, words), furniture, any(c for _, _, c in stack), heading))
            pieces.clear()
            linked.clear()

    def take(text: str):
        if text and not silent:
            pieces.append(text)
            if links:
                linked.append(text)

    while at < len(page):
        m = _TOKEN.search(page, at)
        if m is None:
            rest = page[at:]
            cut = re.search(r"<[/a-zA-Z][^>]*\Z", rest)  # a tag that the page's end cuts off
            take(rest[:cut.start()] if cut else rest)
            break
        take(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        closing, attrs = bool(m[1]), m[3] or ""
        if tag in SILENT_TAGS:
            if closing:
                if tag in silent:
                    while silent.pop() != tag:
                        pass
            elif not attrs.endswith("/"):
                if tag in RAW_TAGS:
                    end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                    at = end.end() if end else len(page)
                else:
                    silent.append(tag)
            if tag in ("head", "body"):
                close_block()
            continue
        if tag == "body":
            silent.clear()
        if tag == "a":
            links = max(0, links - 1) if closing else 1
            continue
        if tag == "br":
            take(" ")
            continue
        if tag not in BLOCK_TAGS:
            continue
        close_block()
        links = 0
        heading = not closing and len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
        if tag in VOID_TAGS or tag in ("p", "html", "body") or (len(tag) == 2 and tag[0] == "h"):
            if tag != "p" or not attrs:
                continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        else:
            names = _named(attrs) if attrs else set()
            content = tag in CONTENT_TAGS or bool(names & CONTENT_WORDS)
            furniture = (tag in FURNITURE_TAGS or (bool(names & FURNITURE_WORDS) and tag not in CONTENT_TAGS and not names & {"article", "articlebody"})
                         or (tag == "header" and not any(c for _, _, c in stack)))
            if tag == "p" and not furniture:
                continue
            stack.append((tag, furniture, content))
    close_block()
    return out


def rows_of(found: list[tuple[str, int, int, bool, bool, bool]]) -> list[tuple[float, ...]]:
    """The feature row of each block of a page."""
    size = [(float(b[1]), b[2] / b[1]) for b in found]
    size = [(0.0, 0.0), *size, (0.0, 0.0)]
    return [(*size[k + 1], *size[k], *size[k + 2], float(b[3]), float(b[4]), float(b[5])) for k, b in enumerate(found)]


def fit_tree(spark: SparkSession, labelled=None, depth: int = 6):
    """Nested (feature, threshold, left, right) or leaf float of a fitted Spark ML tree."""
    rows = [(Vectors.dense(r[:-1]), float(r[-1])) for r in (LABELLED if labelled is None else labelled)]
    model = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=1, seed=5, maxBins=64).fit(
        spark.createDataFrame(rows, ["features", "label"]).coalesce(1))

    def walk(node):
        if node.numDescendants() == 0:
            return float(node.prediction())
        split = node.split()
        return int(split.featureIndex()), float(split.threshold()), walk(node.leftChild()), walk(node.rightChild())

    return walk(model._java_obj.rootNode())


def _keeps(tree, row) -> bool:
    while not isinstance(tree, float):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree > 0.5


def main_text(tree, page: str | None) -> str:
    found = blocks(page)
    return "\n".join(b[0] for b, row in zip(found, rows_of(found)) if _keeps(tree, row))


def extract_text(spark: SparkSession, html_col: Column, labelled=None) -> Column:
    """Column of main texts of an html column."""
    tree = fit_tree(spark, labelled)

    @pandas_udf("string")
    def texts(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in pages:
            yield pd.Series([main_text(tree, p) for p in batch], dtype=object)

    return texts(html_col.cast("string"))


def extract_pages(pages: DataFrame, labelled=None, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages``."""
    text = extract_text(pages.sparkSession, F.col(html_col), labelled)
    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text.alias("text")).withColumn(
        "n_chars", F.length("text").cast("long"))
