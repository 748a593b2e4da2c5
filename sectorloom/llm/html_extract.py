"""Main text of web pages: flat text blocks classified by a decision tree.

A page is read once into a flat list of text blocks, cut at block-level tags. A block knows its number of words,
the share of them inside links, both for the block before and after it, whether it stands in a part of the page
that is named as furniture (navigation, header, footer, sidebar, advert, form, comments), whether it stands in
the article element, where furniture starts afresh unless the article is itself in a nav, aside or footer element, and whether the page has one. A decision tree, grown from a small labelled table of blocks,
decides which are main text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_slices, texts_of

# HTML's inline elements, elements without text for readers, and furniture by element and by name.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr img".split()
)
# Unread elements: those of raw text last to the end of the page if they are not closed, of others only the tag is left out.
RAW = "script|style|textarea|title"
UNREAD = "noscript|template|svg|math|iframe|object|canvas|select"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose end tag may be left out, with the kind of each and what else one of them ends.
ITEMS = {"p": "p", "li": "li", "dt": "dd", "dd": "dd", "tr": "tr", "td": "td", "th": "td"}
ENDS = {"p": {"p"}, "li": {"p", "li"}, "dd": {"p", "dd"}, "td": {"p", "td"}, "tr": {"p", "td", "tr"}}
FURNITURE = frozenset("nav header footer aside form menu button dialog fieldset".split())
NAMED = re.compile(
    r"(?i)(?:ad|ads|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|notices?|alert|"
    r"side-?bar|widget|menu|nav|navbar|navigation|breadcrumbs?|footer|header|masthead|comments?|disqus|repl(?:y|ies)|"
    r"respond|share|sharing|social|related|recommended|newsletter|subscribe|signup|login|popup|modal|pagination|"
    r"copyright|legal|disclaimer|tags?|byline|toolbar)\Z"
)
# Last parts of a class, id or role that only say where or in what it is: the part before them is its name.
PLACE = re.compile(
    r"(?i)(?:left|right|top|bottom|first|last|primary|secondary|main|site|page|wrap|wrapper|container|inner|outer|box|"
    r"area|section|block|region|column|col|row|bar|list|items?|links?|buttons?|icons?|posts?|articles?|stories|text|"
    r"title|content|body|form|slot|unit|\d+)\Z"
)
# Unless the first part says that it describes the layout.
MODIFIER = re.compile(r"(?i)(?:with|without|has|have|no|not|is|hide|show|supports)\Z")
MAIN = frozenset(["article", "main"])
# Elements whose articles are furniture too.
APART = frozenset(["nav", "aside", "footer"])

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])(?:[^>]*/>|[^>]*>.*?(?:</(?P=raw)\s*>|\Z))|<(?P<unread>{UNREAD})(?=[\s/>])[^>]*>|"
    r"<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)"
    # Attributes: a quote opens a quoted value only right after the equals sign, else it is a character like others.
    r"(?P<rest>(?:[\s/]++|[^\s/>=<]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+|=)*+)>|<[!?][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_NAMES = re.compile(r"""(?is)\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""")

FEATURES = "furniture inside words density before_words before_density after_words after_density".split()

# The labelled table: the features above, in their order, and whether the block is main text. inside is 1 in the
# article element, -1 outside the one that the page has, and 0 on a page without.
LABELLED = (
    # Pages with an article element: text in it, of any length, between any neighbours.
    (0, 1, 220, 0.00, 12, 0.00, 180, 0.00, 1),
    (0, 1, 2, 0.00, 90, 0.00, 40, 0.00, 1),
    (0, 1, 9, 0.00, 6, 1.00, 220, 0.00, 1),
    (0, 1, 40, 0.10, 30, 0.05, 0, 0.00, 1),
    (0, 1, 3, 1.00, 60, 0.00, 50, 0.00, 1),
    (0, 1, 1, 0.00, 0, 0.00, 0, 0.00, 1),
    (0, 1, 30, 0.00, 50, 0.00, 2, 1.00, 1),
    (0, 1, 5, 0.00, 3, 1.00, 4, 1.00, 1),
    (0, 1, 25, 0.90, 12, 0.80, 2, 1.00, 1),
    # Furniture inside or outside the article.
    (1, -1, 1, 1.00, 1, 1.00, 1, 1.00, 0),
    (1, -1, 12, 0.00, 1, 1.00, 10, 0.00, 0),
    (1, -1, 60, 0.00, 80, 0.00, 0, 0.00, 0),
    (1, 1, 35, 0.00, 90, 0.00, 20, 0.00, 0),
    (1, 1, 4, 0.50, 120, 0.00, 30, 0.00, 0),
    (1, 1, 200, 0.02, 100, 0.00, 100, 0.00, 0),
    (1, 0, 25, 0.00, 15, 0.00, 0, 0.00, 0),
    (1, 0, 150, 0.00, 120, 0.00, 90, 0.00, 0),
    # Other text of a page that has an article.
    (0, -1, 14, 0.00, 1, 1.00, 9, 0.00, 0),
    (0, -1, 70, 0.05, 100, 0.00, 4, 0.50, 0),
    (0, -1, 2, 1.00, 3, 1.00, 2, 1.00, 0),
    (0, -1, 110, 0.00, 120, 0.00, 80, 0.00, 0),
    (0, -1, 8, 0.00, 0, 0.00, 150, 0.00, 0),
    # Pages without an article element: long text and the short text next to it, not lists of links.
    (0, 0, 120, 0.02, 10, 0.00, 95, 0.03, 1),
    (0, 0, 80, 0.00, 0, 0.00, 0, 0.00, 1),
    (0, 0, 45, 0.10, 60, 0.00, 30, 0.00, 1),
    (0, 0, 18, 0.00, 40, 0.00, 55, 0.02, 1),
    (0, 0, 12, 0.00, 70, 0.05, 3, 1.00, 1),
    (0, 0, 6, 0.00, 2, 1.00, 110, 0.00, 1),
    (0, 0, 4, 0.00, 85, 0.00, 60, 0.00, 1),
    (0, 0, 3, 1.00, 3, 1.00, 2, 1.00, 0),
    (0, 0, 2, 0.50, 4, 1.00, 5, 0.80, 0),
    (0, 0, 30, 0.80, 12, 0.90, 10, 0.70, 0),
    (0, 0, 5, 0.00, 3, 1.00, 2, 1.00, 0),
    (0, 0, 50, 0.60, 90, 0.00, 70, 0.00, 0),
    (0, 0, 4, 1.00, 80, 0.00, 3, 1.00, 0),
    (0, 0, 3, 0.00, 2, 0.50, 0, 0.00, 0),
)


@dataclass
class Node:
    """A split (feature below the value goes left), or a leaf with its answer."""

    answer: bool
    feature: int = -1
    value: float = 0.0
    left: Node | None = None
    right: Node | None = None


def grow(rows: np.ndarray, least: int = 1) -> Node:
    """A binary tree of smallest Gini impurity; the last column of ``rows`` is the label.

    Equal splits: the earlier feature, then the smaller value. A leaf answers yes on a tie.
    """
    x, y = rows[:, :-1], rows[:, -1]
    node = Node(bool(y.mean() >= 0.5))
    best = len(y) * _gini(y)
    for feature in range(x.shape[1]):
        values = np.unique(x[:, feature])
        for value in (values[1:] + values[:-1]) / 2:
            left = x[:, feature] < value
            if min(left.sum(), (~left).sum()) < least:
                continue
            cost = left.sum() * _gini(y[left]) + (~left).sum() * _gini(y[~left])
            if cost < best - 1e-12:
                best, node.feature, node.value = cost, feature, value
    if node.feature >= 0:
        left = x[:, node.feature] < node.value
        node.left, node.right = grow(rows[left], least), grow(rows[~left], least)
    return node


def _gini(y: np.ndarray) -> float:
    return 2 * y.mean() * (1 - y.mean())


@cache
def tree(table: tuple = LABELLED) -> Node:
    return grow(np.array(table, float))


def answer(node: Node, x: Sequence[float]) -> bool:
    while node.feature >= 0:
        node = node.left if x[node.feature] < node.value else node.right
    return node.answer


@dataclass
class Block:
    """Text with one space between words, its words and those in links, and where it stands."""

    text: str
    words: int
    linked: int
    furniture: bool
    in_main: bool

    @property
    def density(self) -> float:
        return self.linked / self.words


def _named(attributes: str) -> bool:
    """Whether a class, id or role is that of furniture: by its last part that is more than a place."""
    for value in _NAMES.findall(attributes):
        for name in value.strip("\"'").split():
            parts = [part for part in re.split(r"[_-]+", name) if part]
            if not parts or len(parts) > 1 and MODIFIER.match(parts[0]):
                continue
            if NAMED.match(name):
                return True
            while len(parts) > 1 and PLACE.match(parts[-1]):
                parts.pop()
            if NAMED.match(parts[-1]):
                return True
    return False


def _closed(page: str, name: str) -> dict[int, int]:
    """Where each closed element of this name ends, by where it begins; elements may be nested."""
    found, begun = {}, []
    for tag in re.finditer(rf"(?i)<!--(?s:.*?)(?:-->|\Z)|<(?P<close>/?){name}(?=[\s/>])[^>]*>", page):
        if tag["close"] is None or tag[0].endswith("/>"):
            continue
        if not tag["close"]:
            begun.append(tag.start())
        elif begun:
            found[begun.pop()] = tag.end()
    return found


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page in order."""
    found: list[Block] = []
    pieces: list[tuple[str, bool]] = []
    stack: list[tuple[str, bool, bool, bool]] = []
    # Open paragraphs, list items and cells: kind, depth of the stack, and whether they are named as furniture.
    items: list[tuple[str, int, bool]] = []
    furniture = in_main = apart = False
    links = at = 0
    closed: dict[str, dict[int, int]] = {}

    def close() -> None:
        text = html.unescape("".join(piece for piece, _ in pieces)).split()
        if text:
            linked = sum(len(html.unescape(piece).split()) for piece, link in pieces if link)
            named = furniture or any(x[2] for x in items)
            found.append(Block(" ".join(text), len(text), min(linked, len(text)), named, in_main))
        pieces.clear()

    while token := _TOKEN.search(page, at):
        if token.start() > at:
            pieces.append((page[at : token.start()], links > 0))
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            if token["unread"]:
                unread = token["unread"].lower()
                if unread not in closed:
                    closed[unread] = _closed(page, unread)
                at = closed[unread].get(token.start(), at)
            if token["unread"] or token["raw"]:
                pieces.append((" ", False))
            continue
        if name == "a":
            links = 0 if token["close"] else 1
        if name in INLINE:
            continue
        close()
        links = 0
        if name in VOID:
            continue
        if name in ITEMS:
            kind, depth = ITEMS[name], len(stack)
            ended = {kind} if token["close"] else ENDS[kind]
            items = [x for x in items if x[1] < depth or x[0] not in ended]
            if not token["close"]:
                items.append((kind, depth, _named(token["rest"])))
            continue
        items = [x for x in items if x[0] != "p" or x[1] < len(stack)]
        if token["close"]:
            if any(entry[0] == name for entry in stack):
                while stack and stack.pop()[0] != name:
                    pass
                furniture, in_main, apart = stack[-1][1:] if stack else (False, False, False)
                items = [x for x in items if x[1] <= len(stack)]
        elif not token["rest"].endswith("/"):
            if name in MAIN:
                # Furniture starts afresh: what is around the outermost one is the layout of the page.
                if not in_main and not apart:
                    furniture, items = False, []
            elif name not in ("html", "body"):
                furniture = furniture or name in FURNITURE or _named(token["rest"])
            in_main = in_main or name in MAIN
            apart = apart or name in APART
            stack.append((name, furniture, in_main, apart))
    if at < len(page):
        pieces.append((page[at:], links > 0))
    close()
    return found


def main_text(page: str) -> str:
    found = blocks(page)
    root, has_main = tree(), any(block.in_main for block in found)
    kept = []
    for i, block in enumerate(found):
        before = found[i - 1] if i else None
        after = found[i + 1] if i + 1 < len(found) else None
        inside = 1 if block.in_main else -int(has_main)
        x = [block.furniture, inside, block.words, block.density]
        for other in (before, after):
            x += [other.words, other.density] if other else [0, 0.0]
        if answer(root, x):
            kept.append(block.text)
    return " ".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    A null or empty html, or one without main text, gives an empty text. White space inside a block is one space,
    and blocks are joined by one. Repeated rows keep one result each; no rows give none; other columns are ignored.
    Unclosed elements last to the end of the one around them, those of raw text and comments to the end of the page.
    A tag that ends in ``/>`` is an empty element.
    """
    texts = F.arrow_udf(
        lambda column: by_slices(
            lambda part: pa.array(
                [main_text(page) for page in texts_of(pa.RecordBatch.from_arrays([part], ["text"]))], pa.string()
            ),
            column,
        ),
        "string",
    )
    text = pages.select("page_id", "url", texts("html").alias("text"))
    return text.withColumn("n_chars", F.char_length("text").cast("long"))
