"""Main text of web pages from flat text blocks.

A page is cut at block-level tags into blocks of text. A block is described by its
words and link density, those of its neighbours, and the elements around it; a
decision tree, fitted on a small labelled table of blocks, tells text from the rest.
"""

import re
from collections import Counter
from dataclasses import dataclass
from functools import cache
from html import unescape
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUOTED = r"""[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*"""
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)({QUOTED}|[^>]*)(?:>|\Z)", re.S
)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
PART = re.compile(r"[a-z]+")
#: Elements whose text is no text of the page.
DROPPED = frozenset(
    "script style noscript template svg math iframe object head title select button textarea canvas audio video".split()
)
#: Elements that begin and end a block.
BLOCKS = frozenset(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are remembered while they are open, and those of them that hold no article text.
KEPT_OPEN = BLOCKS - HEADINGS - {"p", "hr", "body", "html", "li", "dd", "dt", "td", "th", "tr"} | {"span"}
OUTSIDE = frozenset("nav header footer aside form dialog".split())
ARTICLE = frozenset("article main".split())
#: Parts of class, id and role names of what is not the article.
AROUND = frozenset(
    "ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments complementary"
    " consent contentinfo cookie cookies copyright disclaimer disqus footer gdpr header login masthead menu modal nav navbar"
    " navigation newsletter notice notification overlay pagination popup promo promoted promotion related respond search share"
    " sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar widget".split()
)
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "outside", "article", "page_has_article", "heading")
DEPTH = 6


class OpenTags:
    """Tags that are open, innermost last, each with how many up to it are outside or of the article.

    What a page costs grows with its tags, also where they are never closed.
    """

    def __init__(self) -> None:
        self.tags: list[tuple[str, int, int]] = []
        self.times: Counter[str] = Counter()

    def open(self, tag: str, outside: bool) -> None:
        _, outsides, articles = self.tags[-1] if self.tags else ("", 0, 0)
        self.tags.append((tag, outsides + outside, articles + (tag in ARTICLE)))
        self.times[tag] += 1

    def close(self, tag: str) -> None:
        """Close the innermost such tag and all within it, if one is open."""
        while self.times[tag]:
            last = self.tags.pop()[0]
            self.times[last] -= 1
            if last == tag:
                break

    def outside(self) -> bool:
        return bool(self.tags) and self.tags[-1][1] > 0

    def article(self) -> bool:
        return bool(self.tags) and self.tags[-1][2] > 0

    def outside_span(self) -> bool:
        """True if the innermost open span is outside by itself."""
        if not self.times["span"]:
            return False
        place = next(i for i in range(len(self.tags) - 1, -1, -1) if self.tags[i][0] == "span")
        return self.tags[place][1] > (self.tags[place - 1][1] if place else 0)


@dataclass
class Block:
    text: str
    words: int
    links: float
    outside: bool
    article: bool
    heading: bool


def blocks_of(html: str | None) -> list[Block]:
    """Blocks with text, in page order. Tags that are never closed end with the page."""
    html = html or ""
    found: list[Block] = []
    open_tags = OpenTags()
    pieces: list[str] = []
    linked: list[str] = []
    in_link = in_heading = False
    place = 0

    def close_block() -> None:
        text = " ".join(unescape("".join(pieces)).split())
        if text:
            words = text.count(" ") + 1
            anchors = len(unescape(" ".join(linked)).split())
            found.append(
                Block(
                    text,
                    words,
                    min(1.0, anchors / words),
                    open_tags.outside(),
                    open_tags.article(),
                    in_heading,
                )
            )
        pieces.clear()
        linked.clear()

    def add(text: str) -> None:
        pieces.append(text)
        if in_link:
            linked.append(text)

    while token := TOKEN.search(html, place):
        add(html[place : token.start()])
        place = token.end()
        closing, tag = token[1], (token[2] or "").lower()
        if not tag:
            continue
        if tag in DROPPED and not closing:
            if not token[0].endswith("/>"):
                end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(html, place)
                place = end.end() if end else len(html)
            continue
        if tag == "br":
            add(" ")
        elif tag == "a":
            in_link = not closing
        if tag in BLOCKS:
            close_block()
            in_link = False
        elif tag == "span" and (open_tags.outside_span() if closing else around(token[3])):
            close_block()
        if tag in HEADINGS:
            in_heading = not closing
        if tag in KEPT_OPEN and closing:
            open_tags.close(tag)
        elif tag in KEPT_OPEN and not token[0].endswith("/>"):
            open_tags.open(tag, tag in OUTSIDE or around(token[3]))
    add(html[place:])
    close_block()
    return found


def around(attributes: str) -> bool:
    """True if a class, id or role says that the element isn't part of the article."""
    return any(
        part in AROUND for name in NAMED.findall(attributes or "") for part in PART.findall(name.lower())
    )


def features_of(blocks: list[Block]) -> np.ndarray:
    """One row of ``FEATURES`` per block; beyond the page's ends there are no words."""
    has_article = any(block.article for block in blocks)
    sizes = np.array([0, *(block.words for block in blocks), 0], dtype=float)
    links = np.array([0, *(block.links for block in blocks), 0], dtype=float)
    flags = np.array([(b.outside, b.article, has_article, b.heading) for b in blocks], dtype=float).reshape(-1, 4)
    return np.column_stack([sizes[1:-1], links[1:-1], sizes[:-2], links[:-2], sizes[2:], links[2:], flags])


@dataclass(frozen=True)
class Tree:
    """A decision tree in arrays; a leaf has feature -1."""

    feature: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    is_text: list[bool]

    def decide(self, features: np.ndarray) -> np.ndarray:
        result = np.zeros(len(features), dtype=bool)
        parts = [(0, np.arange(len(features)))]
        while parts:
            node, rows = parts.pop()
            if self.feature[node] < 0:
                result[rows] = self.is_text[node]
                continue
            below = features[rows, self.feature[node]] <= self.threshold[node]
            parts += [(self.left[node], rows[below]), (self.right[node], rows[~below])]
        return result


def fit_tree(features: np.ndarray, labels: np.ndarray, depth: int = DEPTH) -> Tree:
    """Splits that lower the Gini impurity most, down to ``depth`` or pure leaves."""
    tree = Tree([], [], [], [], [])

    def grow(rows: np.ndarray, left: int) -> int:
        node = len(tree.feature)
        share = labels[rows].mean()
        for column, value in zip(
            (tree.feature, tree.threshold, tree.left, tree.right, tree.is_text),
            (-1, 0.0, node, node, bool(share >= 0.5)),
            strict=True,
        ):
            column.append(value)
        best = None
        if left and 0 < share < 1:
            for feature in range(features.shape[1]):
                values = features[rows, feature]
                for cut in np.unique(values)[:-1]:
                    below = values <= cut
                    impurity = sum(len(p) * p.mean() * (1 - p.mean()) for p in (labels[rows][below], labels[rows][~below]))
                    if best is None or impurity < best[0] - 1e-9:
                        best = impurity, feature, cut, below
        if best and best[0] < len(rows) * share * (1 - share) - 1e-9:
            _, feature, cut, below = best
            tree.feature[node], tree.threshold[node] = feature, float(cut)
            tree.left[node], tree.right[node] = grow(rows[below], left - 1), grow(rows[~below], left - 1)
        return node

    grow(np.arange(len(labels)), depth)
    return tree


def labelled_pages(count: int = 60, seed: int = 11) -> list[str]:
    """Small pages of many layouts; words of the article begin with ``t``, all others with ``x``."""
    rnd = Random(seed)

    def words(mark: str, least: int, most: int) -> str:
        return " ".join(mark + str(rnd.randrange(999)) for _ in range(rnd.randint(least, most)))

    def links(n: int) -> str:
        return "".join(f"<li><a href='/'>{words('x', 1, 3)}</a></li>" for _ in range(n))

    pages = []
    for i in range(count):
        plain = i % 3 == 0  # no element tells the article from the rest
        body = "".join(f"<p>{words('t', 20, 90) if plain else words('t', 1, 90)}</p>" for _ in range(rnd.randint(1, 7)))
        if not plain and rnd.random() < 0.4:
            body += f"<h2>{words('t', 1, 4)}</h2><ul><li>{words('t', 1, 9)}</li></ul><p><a href='/'>{words('t', 1, 4)}</a></p>"
        if not plain and rnd.random() < 0.4:
            body += f"<div class='ad'>{words('x', 3, 40)}</div>"
        title = f"<h1>{words('t', 5, 12)}</h1>"
        middle = {0: f"<div>{title}{body}</div>", 1: f"<article>{title}{body}</article>", 2: f"<main>{title}{body}</main>"}[i % 3]
        before = [f"<nav><ul>{links(rnd.randint(2, 8))}</ul></nav>", f"<header><p>{words('x', 1, 30)}</p></header>", f"<div class='cookie-notice'>{words('x', 4, 40)}</div>", f"<ul>{links(5)}</ul>"]
        after = [f"<footer>{words('x', 2, 30)}</footer>", f"<aside><p>{words('x', 2, 50)}</p></aside>", f"<section id='comments'><p>{words('x', 1, 60)}</p></section>", f"<form><p>{words('x', 1, 25)}</p></form>", f"<div><a href='/'>{words('x', 2, 6)}</a> {words('x', 1, 2)}</div>"]
        if not plain:
            before.append(f"<div>{words('x', 1, 40)}</div>")
            after.append(f"<p>{words('x', 1, 40)}</p>")
        pages.append("".join(rnd.sample(before, 2)) + middle + "".join(rnd.sample(after, 3)))
    return pages


@cache
def default_tree() -> Tree:
    """The tree of the labelled table."""
    pages = [blocks_of(page) for page in labelled_pages()]
    labels = np.array([block.text.startswith("t") for page in pages for block in page], dtype=float)
    return fit_tree(np.concatenate([features_of(page) for page in pages]), labels)


def main_text(html: str | None, tree: Tree) -> str:
    """Blocks that the tree takes for text, a line each."""
    blocks = blocks_of(html)
    chosen = tree.decide(features_of(blocks))
    return "\n".join(block.text for block, is_text in zip(blocks, chosen, strict=True) if is_text)


def main_text_of(html: Column, tree: Tree) -> Column:
    @F.arrow_udf("string")
    def extracted(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(page, tree) for page in pages.to_pylist()], pa.string())

    return extracted(html)


def extract(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """``page_id``, ``url``, main ``text`` and its ``n_chars`` of every page.

    One row for each row of ``pages``, repeated rows included. Null and empty pages,
    and pages without article text, give an empty text; an empty table gives no rows.
    Pages of any length are read whole, in time that grows with their length.
    """
    text = main_text_of(F.col("html").cast("string"), tree or default_tree())
    return pages.select("page_id", "url", text.alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
