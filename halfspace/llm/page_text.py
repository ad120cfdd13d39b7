"""Main text of web pages by classifying flat text blocks.

A page is cut into text blocks at its block-level tags. A block is described by its word
count and link density, those of the blocks before and after it, and where it lies: in
main content, in boilerplate (menus, sidebars, comments ...), or in neither. A decision
tree tells content from the rest. It is trained in numpy on the labelled table below.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halfspace.llm.common import slices

# Where a block lies.
NEUTRAL, MAIN, BOILERPLATE, OUTSIDE_MAIN = range(4)

FEATURES = (
    "words", "density", "words_before", "density_before", "words_after", "density_after", "place",
)

# The labelled table: features in the order above, and 1 for content.
TABLE = [
    # In main content: paragraphs of any length, headings, lists, quotations.
    (9, 0.0, 0, 0.0, 120, 0.0, MAIN, 1),
    (120, 0.0, 9, 0.0, 85, 0.02, MAIN, 1),
    (2, 0.0, 120, 0.0, 64, 0.0, MAIN, 1),
    (1, 0.0, 30, 0.0, 0, 0.0, MAIN, 1),
    (1, 0.0, 0, 0.0, 0, 0.0, MAIN, 1),
    (35, 0.2, 60, 0.0, 12, 0.0, MAIN, 1),
    (18, 0.4, 60, 0.0, 70, 0.1, MAIN, 1),
    (6, 0.0, 7, 0.0, 5, 0.0, MAIN, 1),
    (250, 0.05, 6, 1.0, 4, 1.0, MAIN, 1),
    (12, 0.0, 3, 1.0, 8, 1.0, MAIN, 1),
    (44, 0.3, 0, 0.0, 0, 0.0, MAIN, 1),
    (900, 0.01, 14, 0.0, 20, 0.0, MAIN, 1),
    (3, 0.0, 4, 1.0, 90, 0.0, MAIN, 1),
    (2, 0.0, 1, 0.0, 1, 0.0, MAIN, 1),
    (3, 0.0, 2, 0.0, 4, 0.0, MAIN, 1),
    (5, 0.0, 3, 0.0, 2, 1.0, MAIN, 1),
    (8, 0.0, 0, 0.0, 6, 0.0, MAIN, 1),
    (4, 0.0, 6, 1.0, 3, 0.0, MAIN, 1),
    (7, 0.0, 5, 0.0, 20, 0.0, MAIN, 1),
    (2, 0.0, 4, 0.0, 0, 0.0, MAIN, 1),
    (1, 0.0, 1, 1.0, 2, 0.0, MAIN, 1),
    (3, 0.0, 2, 1.0, 4, 0.0, MAIN, 1),
    (6, 0.0, 2, 1.0, 5, 1.0, MAIN, 1),
    (20, 0.1, 4, 1.0, 3, 1.0, MAIN, 1),
    (5, 0.8, 40, 0.0, 30, 0.0, MAIN, 1),
    (12, 0.6, 9, 0.0, 8, 0.2, MAIN, 1),
    (10, 0.7, 3, 1.0, 4, 1.0, MAIN, 1),
    # A paragraph of the text that is a link stands between others that are not.
    (8, 1.0, 60, 0.0, 70, 0.0, MAIN, 1),
    (3, 1.0, 15, 0.1, 9, 0.0, MAIN, 1),
    (14, 0.95, 6, 0.3, 40, 0.5, MAIN, 1),
    (20, 1.0, 80, 0.0, 0, 0.0, MAIN, 1),
    # In main content, but one link after another: further articles, tags, share buttons.
    (8, 1.0, 60, 0.0, 7, 1.0, MAIN, 0),
    (9, 1.0, 7, 1.0, 80, 0.0, MAIN, 0),
    (3, 1.0, 8, 1.0, 9, 1.0, MAIN, 0),
    (5, 1.0, 3, 1.0, 0, 0.0, MAIN, 0),
    (1, 1.0, 90, 0.0, 2, 1.0, MAIN, 0),
    (14, 0.95, 11, 0.95, 12, 0.95, MAIN, 0),
    (2, 1.0, 0, 0.0, 1, 1.0, MAIN, 0),
    (25, 1.0, 40, 0.0, 30, 1.0, MAIN, 0),
    # In boilerplate nothing is content, however long.
    (1, 1.0, 0, 0.0, 1, 1.0, BOILERPLATE, 0),
    (1, 1.0, 1, 1.0, 9, 0.0, BOILERPLATE, 0),
    (9, 0.0, 1, 1.0, 12, 0.0, BOILERPLATE, 0),
    (15, 0.1, 120, 0.0, 0, 0.0, BOILERPLATE, 0),
    (60, 0.0, 5, 1.0, 45, 0.0, BOILERPLATE, 0),
    (140, 0.0, 70, 0.0, 80, 0.0, BOILERPLATE, 0),
    (4, 0.0, 4, 0.0, 4, 0.0, BOILERPLATE, 0),
    (30, 0.5, 100, 0.0, 3, 1.0, BOILERPLATE, 0),
    (22, 0.0, 200, 0.0, 0, 0.0, BOILERPLATE, 0),
    (400, 0.02, 10, 0.0, 9, 0.0, BOILERPLATE, 0),
    # Neutral blocks of a page that has main content elsewhere.
    (3, 0.0, 1, 1.0, 9, 0.0, OUTSIDE_MAIN, 0),
    (9, 0.0, 5, 1.0, 40, 0.0, OUTSIDE_MAIN, 0),
    (26, 0.1, 100, 0.0, 0, 0.0, OUTSIDE_MAIN, 0),
    (80, 0.0, 3, 1.0, 10, 0.0, OUTSIDE_MAIN, 0),
    (200, 0.0, 60, 0.0, 2, 1.0, OUTSIDE_MAIN, 0),
    (5, 1.0, 5, 1.0, 5, 1.0, OUTSIDE_MAIN, 0),
    # Neutral blocks of a page without marked content: long ones, and short ones beside them.
    (70, 0.0, 8, 0.0, 65, 0.0, NEUTRAL, 1),
    (45, 0.1, 60, 0.0, 30, 0.0, NEUTRAL, 1),
    (25, 0.0, 90, 0.0, 40, 0.05, NEUTRAL, 1),
    (150, 0.02, 0, 0.0, 0, 0.0, NEUTRAL, 1),
    (16, 0.0, 2, 1.0, 80, 0.0, NEUTRAL, 1),
    (30, 0.25, 3, 1.0, 5, 1.0, NEUTRAL, 1),
    (19, 0.0, 0, 0.0, 0, 0.0, NEUTRAL, 1),
    (8, 0.0, 1, 1.0, 75, 0.0, NEUTRAL, 1),
    (4, 0.0, 80, 0.0, 60, 0.0, NEUTRAL, 1),
    (3, 0.0, 55, 0.1, 0, 0.0, NEUTRAL, 1),
    (9, 0.0, 0, 0.0, 45, 0.0, NEUTRAL, 1),
    (2, 0.0, 40, 0.0, 110, 0.0, NEUTRAL, 1),
    (6, 0.0, 35, 0.0, 3, 0.0, NEUTRAL, 1),
    # The same, not content: links, and short blocks among short ones or links.
    (1, 1.0, 0, 0.0, 1, 1.0, NEUTRAL, 0),
    (2, 1.0, 1, 1.0, 2, 1.0, NEUTRAL, 0),
    (12, 0.9, 15, 0.8, 10, 1.0, NEUTRAL, 0),
    (40, 0.8, 5, 1.0, 6, 1.0, NEUTRAL, 0),
    (20, 0.6, 3, 1.0, 2, 1.0, NEUTRAL, 0),
    (3, 0.0, 2, 1.0, 4, 1.0, NEUTRAL, 0),
    (5, 0.0, 3, 0.0, 2, 1.0, NEUTRAL, 0),
    (4, 0.0, 1, 1.0, 3, 0.0, NEUTRAL, 0),
    (8, 0.0, 4, 0.0, 0, 0.0, NEUTRAL, 0),
    (2, 0.0, 0, 0.0, 1, 1.0, NEUTRAL, 0),
    (6, 0.5, 90, 0.0, 4, 1.0, NEUTRAL, 0),
    (4, 1.0, 80, 0.0, 70, 0.0, NEUTRAL, 0),
    (7, 0.0, 5, 1.0, 6, 0.0, NEUTRAL, 0),
]

# Elements without readable content (of the first, what follows is no markup
# until they are closed), elements that end a text block, and names that sites use for parts
# of a page.
RAW = "script style textarea"
DROPPED = "noscript template title svg math iframe object canvas audio video select button"
BLOCKS = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend "
    "li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul"
    .split()
)
CONTAINERS = BLOCKS - set("br hr p h1 h2 h3 h4 h5 h6 li dt dd td th tr caption option".split())
CONTENT_TAGS = {"article", "main"}
BOILERPLATE_TAGS = {"nav", "aside", "footer", "dialog", "menu"}
WEAK_TAGS = {"form", "header", "fieldset", "search"}
CONTENT_NAMES = set("article articlebody content entry main maincontent post story".split())
BOILERPLATE_NAMES = set(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline "
    "comment comments commentlist cookie cookies consent copyright disclaimer disqus footer footnav "
    "gdpr legal login menu menubar metadata modal nav navbar navigation newsletter notice notices "
    "notification pager pagination paywall popup popular promo promoted promotion recommendations "
    "recommended related replies reply respond share sharing sidebar signin signup skip social "
    "sponsor sponsored subscribe subscription tags teaser toolbar topbar trending widget widgets"
    .split()
)
# What a part of a name that follows one of these says is not what the element is.
QUALIFIERS = set("with without has have no not hide show".split())
# A compound that begins with one of these is one of many beside the text, as comment-body.
ITEM_NAMES = set(
    "ad ads advert comment comments promo promoted recommended related replies reply respond "
    "sponsored teaser".split()
)
WEAK_NAMES = set("header masthead form search alert message topnav".split())
ROLES = {
    "main": MAIN, "article": MAIN, "navigation": BOILERPLATE, "banner": BOILERPLATE,
    "complementary": BOILERPLATE, "contentinfo": BOILERPLATE, "search": BOILERPLATE,
    "dialog": BOILERPLATE, "alert": BOILERPLATE, "menu": BOILERPLATE,
}
# Words from which an unmarked block may be prose, and how many times the words of marked
# content such prose has where that is a teaser.
PROSE_WORDS = 20
TEASER = 3
VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "area", "base", "col", "embed", "source"}

# A "<" without its own ">" is text, unless it has quoted attributes. No tag is looked for
# beyond the next "<", so that many of them take no longer than as much text.
ATTRIBUTES = r"(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+"
COMMENT = r"<!--(?:-?>|.*?(?:--!?>|\Z))"
RAW_ELEMENT = r"<(" + "|".join(RAW.split()) + r")(?=[\s/>])" + ATTRIBUTES + r">.*?(?:</\1\s*+>|\Z)"
TOKEN = re.compile(
    f"{COMMENT}|{RAW_ELEMENT}"
    r"|<(/?)([a-z][a-z0-9:-]*+)(" + ATTRIBUTES + r")(?:>|(?:(?<=[\"'])|(?<=[\"']\s))(?=<))"
    r"|<(/?)([a-z][a-z0-9:-]*+)([^<>]*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
DROPPED_TAGS = set(DROPPED.split())
DROPPED_TAG = re.compile(
    f"{COMMENT}|{RAW_ELEMENT}"
    r"|<(/?)(" + "|".join(DROPPED.split()) + r")(?=[\s/>])" + ATTRIBUTES + ">",
    re.IGNORECASE | re.DOTALL,
)
BOUNDARY = re.compile(
    f"{COMMENT}|{RAW_ELEMENT}|(</?(?:" + "|".join(sorted(BLOCKS - {"option"})) + r")(?=[\s/>]))",
    re.IGNORECASE | re.DOTALL,
)
ATTRIBUTE = re.compile(
    r"([a-z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE
)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


# How an element's place gives way to elements inside it: to any that has a place, to
# content tags only, or to none.
OPEN, TAGS_ONLY, SETTLED = range(3)


def _place(tag: str, attributes: str) -> tuple[int, bool, int]:
    """Where an element puts its blocks (NEUTRAL: no change), whether that is weak, and to
    what it gives way.

    What is weak, such as a form around a whole page, gives way to content inside it. A
    word for boilerplate that is but part of a compound name gives way to content tags,
    and says nothing about an element that is content by its tag or by a whole name.
    """
    place, weak = NEUTRAL, False
    if tag in CONTENT_TAGS:
        place = MAIN
    elif tag in BOILERPLATE_TAGS:
        place = BOILERPLATE
    elif tag in WEAK_TAGS:
        place, weak = BOILERPLATE, True
    level = SETTLED if place == BOILERPLATE and not weak else OPEN
    if not attributes.strip() or tag in ("html", "body"):
        return place, weak, level
    given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    if "hidden" in given or HIDDEN.search(given.get("style", "")):
        return BOILERPLATE, False, SETTLED
    role = given.get("role", "").lower()
    if role in ROLES:
        place = ROLES[role]
        level = SETTLED if place == BOILERPLATE and not weak else OPEN
    whole = f"{given.get('class', '')} {given.get('id', '')}".split()
    compounds = [[part.lower() for part in NAME.findall(name)] for name in whole]
    whole = {name.lower() for name in whole} | {c[0] for c in compounds if len(c) == 1}
    if whole & BOILERPLATE_NAMES:
        # A page's own content element may be named after its kind, such as post-with-sidebar.
        return (place, False, level) if tag == "main" else (BOILERPLATE, False, SETTLED)
    names = whole.union(*compounds)
    said = {
        part
        for c in compounds
        for before, part in zip(["", *c], c, strict=False)
        if part in BOILERPLATE_NAMES and before not in QUALIFIERS
    }
    item = any(c and c[0] in ITEM_NAMES for c in compounds)
    named = bool(whole & CONTENT_NAMES)
    for_content = named + (place == MAIN)
    if said and tag != "main" and for_content < 1 + item:
        alone = place == BOILERPLATE and not weak or item and not for_content
        return BOILERPLATE, False, SETTLED if alone else TAGS_ONLY
    if place == NEUTRAL and (names if not named else whole) & WEAK_NAMES:
        return BOILERPLATE, True, OPEN
    if given.get("itemprop", "").lower() == "articlebody" or (
        place == NEUTRAL and names & CONTENT_NAMES
    ):
        return MAIN, False, OPEN
    return place, weak, level


def _is_content(tag: str, attributes: str) -> bool:
    """Whether an element is content by its tag or role, whatever its names say."""
    if tag in CONTENT_TAGS:
        return True
    if "role" not in attributes.lower():
        return False
    roles = [m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes) if m[1].lower() == "role"]
    return any(ROLES.get(role.lower()) == MAIN for role in roles)


def dropped_ends(page: str) -> dict[int, int]:
    """Where each dropped element ends that is open, by the end of its opening tag.

    An element ends at its own closing tag. One without ends at the next tag that ends a
    text block, and one that is closed in its opening tag (svg, math) at once; so does
    any other that is written so and has no closing tag.
    """
    ends: dict[int, int] = {}
    unclosed: dict[str, list[tuple[int, bool]]] = {}
    for token in DROPPED_TAG.finditer(page):
        if not token[3]:
            continue
        tag, at = token[3].lower(), token.end()
        empty = page[at - 2] == "/"
        if token[2]:
            if unclosed.get(tag):
                ends[unclosed[tag].pop()[0]] = at
        elif empty and tag in ("svg", "math"):
            ends[at] = at
        else:
            unclosed.setdefault(tag, []).append((at, empty))
    left = sorted(found for several in unclosed.values() for found in several)
    boundary = -1
    for at, empty in left:
        if not empty and boundary < at:
            found = (m.start() for m in BOUNDARY.finditer(page, at) if m[2])
            boundary = next(found, len(page))
        ends[at] = at if empty else boundary
    return ends


@dataclass
class Block:
    text: str
    words: int
    linked: int
    place: int


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order, those without words left out."""
    found: list[Block] = []
    # Open containers: tag, place of their blocks, to what that gives way.
    stack: list[tuple[str, int, int]] = []
    opened: Counter[str] = Counter()
    text: list[str] = []
    linked: list[str] = []
    in_link = False

    def place() -> int:
        return stack[-1][1] if stack else NEUTRAL

    def end_block() -> None:
        if text:
            words = "".join(text).split()
            if words:
                in_links = len(" ".join(linked).split()) if linked else 0
                found.append(Block(" ".join(words), len(words), in_links, place()))
            text.clear()
            linked.clear()

    def add(piece: str) -> None:
        if piece:
            # A reference ends where the text does, before the next tag.
            if "&" in piece:
                piece = html.unescape(piece)
            text.append(piece)
            if in_link:
                linked.append(piece)

    at = 0
    ends: dict[int, int] | None = None
    while token := TOKEN.search(page, at):
        add(page[at : token.start()])
        at = token.end()
        name = token[3] or token[6]
        if not name:
            if token[1]:
                add(" ")
            continue
        tag, closing = name.lower(), bool(token[2] or token[5])
        if tag in DROPPED_TAGS:
            if not closing:
                add(" ")
                if ends is None:
                    ends = dropped_ends(page)
                at = ends.get(at, at)
            continue
        if tag == "a":
            in_link = not closing
            continue
        if tag not in BLOCKS:
            continue
        if tag == "br":
            add(" ")
            continue
        end_block()
        in_link = False
        if tag not in CONTAINERS:
            continue
        if closing:
            inner = ""
            while opened[tag] and inner != tag:
                inner = stack.pop()[0]
                opened[inner] -= 1
            continue
        opened[tag] += 1
        before, settled = (stack[-1][1], stack[-1][2]) if stack else (NEUTRAL, OPEN)
        attributes = token[4] or token[7] or ""
        if settled == SETTLED or (settled == TAGS_ONLY and not _is_content(tag, attributes)):
            stack.append((tag, before, settled))
            continue
        own, weak, settled = _place(tag, attributes)
        if own == NEUTRAL or (own == BOILERPLATE and weak and before == MAIN and tag == "header"):
            own, settled = before, OPEN
        stack.append((tag, own, settled))
    add(page[at:])
    end_block()
    settle_main(found)
    return found


def settle_main(found: list[Block]) -> None:
    """Decide whether marked content is all there is, by the words in it and beside it.

    Beside an article, unmarked blocks lie outside of it. But an article with far fewer
    words than the prose beside it is a teaser: then it is what lies outside, and unmarked
    blocks are judged by their words and links.
    """
    inside = sum(b.words for b in found if b.place == MAIN)
    if not inside:
        return
    beside = sum(b.words for b in found if b.place == NEUTRAL and b.words >= PROSE_WORDS and 3 * b.linked <= b.words)
    for block in found:
        if beside > TEASER * inside:
            block.place = OUTSIDE_MAIN if block.place == MAIN else block.place
        elif block.place == NEUTRAL:
            block.place = OUTSIDE_MAIN


def features(found: list[Block]) -> np.ndarray:
    """One row for each block, in the order of ``FEATURES``; no neighbour counts as empty."""
    words = np.array([0, *(b.words for b in found), 0], float)
    linked = np.array([0, *(min(b.linked, b.words) for b in found), 0], float)
    density = linked / np.maximum(words, 1)
    place = np.array([b.place for b in found], float)
    return np.column_stack(
        [words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:], place]
    )


@dataclass
class Tree:
    """A node of a decision tree; a leaf has no feature."""

    content: bool
    feature: int = -1
    cut: float = 0.0
    below: Tree | None = None
    above: Tree | None = None

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(rows), self.content)
        low = rows[:, self.feature] <= self.cut
        out = np.empty(len(rows), bool)
        out[low] = self.below(rows[low])
        out[~low] = self.above(rows[~low])
        return out


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 8) -> Tree:
    """A tree by the best Gini split at each node; of equal splits, the first."""
    share = labels.mean()
    leaf = Tree(bool(share >= 0.5))
    if depth == 0 or share in (0.0, 1.0):
        return leaf
    best = (np.inf, -1, 0.0)
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for cut in (values[1:] + values[:-1]) / 2:
            low = rows[:, feature] <= cut
            impurity = 0.0
            for side in (labels[low], labels[~low]):
                p = side.mean()
                impurity += len(side) * p * (1 - p)
            if impurity < best[0] - 1e-12:
                best = (impurity, feature, float(cut))
    if best[1] < 0:
        return leaf
    low = rows[:, best[1]] <= best[2]
    return Tree(
        leaf.content,
        best[1],
        best[2],
        grow(rows[low], labels[low], depth - 1),
        grow(rows[~low], labels[~low], depth - 1),
    )


def train(table: list[tuple] = TABLE) -> Tree:
    rows = np.array(table, float)
    return grow(rows[:, :-1], rows[:, -1])


def main_text(page: str | None, tree: Tree) -> str:
    """The content blocks of a page in order, joined by one space."""
    found = blocks(page or "")
    if not found:
        return ""
    content = tree(features(found))
    return " ".join(b.text for b, yes in zip(found, content, strict=True) if yes)


def extract(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """page_id, url and text of each page.

    NULL, empty and blank pages, and pages without content, have an empty text. Broken
    or cut-off markup is read as far as it goes. Equal pages give equal texts, and rows
    that repeat an id are read each. Other columns are ignored; an empty table gives an
    empty result.
    """
    tree = tree or train()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = [main_text(page, tree) for page in part.column("html").to_pylist()]
            columns = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())]
            yield pa.record_batch(columns, names=["page_id", "url", "text"])

    kind = dict(pages.dtypes)["page_id"]
    raw = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string"))
    return raw.mapInArrow(rows, f"page_id {kind}, url string, text string")


def op8_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages).withColumn("n_chars", F.length("text").cast("bigint"))
