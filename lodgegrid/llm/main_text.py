"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut at its block-level tags into flat blocks of text. A block has its number of words, its link
density (the share of its words inside links), both of the block before and after it, the region it stands
in, and whether the page marks an article at all. The region comes from the elements around the block: 1
inside an article or main element or one named so, -1 inside an element for menus, headers, footers, sidebars, notices,
adverts, forms or comments (by its name, or by a word of its class, id or role), 0 where neither says
anything. A decision tree (CART: Gini impurity, whole splits) is grown from ``LABELLED``, a table of about
100 hand-labelled blocks, and keeps or drops each block. Pages that mark their article are decided by the
region; for the others the words and links of a block and of its neighbours decide.

Cases
-----
* NULL and empty pages, and pages without text, have the empty text and no blocks.
* Scripts, styles, templates, comments and the head are no text; unclosed ones reach to the page's end, as
  they do in a browser. A tag cut off at the end is dropped. Unclosed elements end with their parents, end
  tags without a start are ignored.
* White space is what Unicode says it is, no-break spaces included.
* A page is one row's work and nothing is shuffled; repeated rows are repeated in the result, and ``page_id``
  and ``url`` pass unread. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

# Element names and the words that page authors use in class, id and role.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark nobr "
    "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp".split())
HIDDEN = frozenset("select datalist object audio video canvas svg math button".split())
ARTICLE = frozenset("article main".split())
AROUND = frozenset("nav aside footer header form menu dialog".split())
SURELY_AROUND = frozenset(
    "ad ads adv advert adverts advertisement adsense banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus gdpr login menu modal nav navbar navigation newsletter notice pager pagination popup "
    "promo promotion related recommended replies respond share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription toolbar widget complementary contentinfo search".split())
PERHAPS_AROUND = frozenset("header footer masthead".split())
CONTENT = frozenset("article content entry post story main body text maintext".split())
CONTENT_ALONE = frozenset("article story main maintext".split())
BARE = frozenset("has with no without is".split())

_TAG = re.compile(
    r"""<!--(?:-?>|(?:(?!--!?>).)*+(?:--!?>|\Z))"""
    r"""|<[!?][^>]*+>?|</(?![a-zA-Z])[^>]*+>?"""
    r"""|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:=\s*+(?:"[^"]*+"|'[^']*+')?|[^>=]++)*+)>?""",
    re.DOTALL)
_HINT = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[\d]+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}

UNSEEN = -2


@dataclass
class Block:
    text: str
    words: int
    linked: int
    region: int


def hinted(rest: str) -> int:
    """-1 if an element's class, id or role names furniture, -2 if only perhaps, 1 for content, else 0."""
    found = 0
    for values in _HINT.findall(rest):
        for name in "".join(values).split():
            parts = [p.lower() for p in _PART.findall(name)]
            if not parts or parts[0] in BARE:
                continue
            if not SURELY_AROUND.isdisjoint(parts):
                return -1
            if CONTENT.isdisjoint(parts):
                if not PERHAPS_AROUND.isdisjoint(parts):
                    found = -2
            elif not found and CONTENT.issuperset(parts) and (len(parts) > 1 or parts[0] in CONTENT_ALONE):
                found = 1
    return found


def _region(name: str, rest: str, outer: int) -> int:
    """The region inside an element that stands in region ``outer``."""
    hint = hinted(rest) if rest and name not in ("html", "body") else 0
    if hint == -1:
        return -1
    if name in ARTICLE:
        return 1
    if name in AROUND:
        # the header of an article holds its headline
        return outer if name == "header" and outer == 1 else -1
    if hint == -2:
        return outer if outer == 1 else -1
    return 1 if hint == 1 and outer == 0 else outer


def blocks_of(page: str | None) -> list[Block]:
    """The text blocks of a page in page order."""
    page = page or ""
    blocks: list[Block] = []
    pieces: list[str] = []
    linked = 0
    open_links = 0
    # name and the region inside: 0 outside everything, UNSEEN where no text is
    stack: list[tuple[str, int]] = []
    opened: Counter[str] = Counter()
    region = 0

    def text(raw: str) -> None:
        nonlocal linked
        if region == UNSEEN or not raw:
            return
        own = references.unescape(raw) if "&" in raw else raw
        pieces.append(own)
        if open_links:
            linked += len(own.split())

    def close_from(i: int) -> None:
        nonlocal region, open_links
        opened.subtract(name for name, _ in stack[i:])
        del stack[i:]
        region = stack[-1][1] if stack else 0
        open_links = 0

    def end() -> None:
        nonlocal linked
        if pieces:
            own = "".join(pieces).split()
            if own:
                blocks.append(Block(" ".join(own), len(own), min(linked, len(own)), region))
            pieces.clear()
        linked = 0

    at = 0
    while True:
        start = page.find("<", at)
        if start < 0:
            text(page[at:])
            break
        tag = _TAG.match(page, start)
        if not tag:
            # a sign that opens no tag is text
            text(page[at : start + 1])
            at = start + 1
            continue
        text(page[at:start])
        at = tag.end()
        name = tag["name"]
        if name is None:
            continue
        name = name.lower()
        if tag["close"]:
            if name == "a":
                open_links = 0
            elif name == "br":
                pieces.append(" ")
            if name not in INLINE:
                end()
                if opened[name] > 0:
                    i = len(stack) - 1
                    while stack[i][0] != name:
                        i -= 1
                    close_from(i)
            continue
        if name in RAW:
            over = _RAW_END[name].search(page, at)
            at = over.start() if over else len(page)
            continue
        if name in INLINE:
            if name == "a":
                open_links = 1
            elif name == "br":
                pieces.append(" ")
            continue
        end()
        if name in VOID:
            continue
        if name in ARTICLE and region == -1 and stack:
            # an article does not stand in a menu or header: these were not closed
            if opened["nav"] > 0 or opened["header"] > 0 or opened["menu"] > 0:
                close_from(next(i for i, (own, _) in enumerate(stack) if own in ("nav", "header", "menu")))
        region = UNSEEN if name in HIDDEN or region == UNSEEN else _region(name, tag["rest"], region)
        stack.append((name, region))
        opened[name] += 1
    end()
    return blocks


#: A block's features, in the order of ``features``.
FEATURES = ("words", "link_density", "words_before", "links_before", "words_after", "links_after", "region", "marked")


def features(blocks: list[Block]) -> np.ndarray:
    """A row per block; what is beyond the first and last block has no words and no links."""
    words = np.array([0, *(b.words for b in blocks), 0], dtype=float)
    links = np.array([0, *(b.linked for b in blocks), 0], dtype=float) / np.maximum(words, 1)
    region = np.array([b.region for b in blocks], dtype=float)
    marked = np.full(len(blocks), float((region == 1).any()))
    return np.column_stack([words[1:-1], links[1:-1], words[:-2], links[:-2], words[2:], links[2:], region, marked])


# Blocks labelled by hand, in the order of FEATURES, then 1 for main text.
# Pages that mark their article: inside it short, linked and long blocks are text, outside nothing is.
LABELLED = (
    (60, 0.0, 8, 0.0, 75, 0.0, 1, 1, 1), (8, 0.0, 1, 1.0, 60, 0.0, 1, 1, 1), (1, 0.0, 40, 0.0, 1, 0.0, 1, 1, 1),
    (1, 0.0, 1, 0.0, 90, 0.0, 1, 1, 1), (2, 1.0, 35, 0.0, 50, 0.0, 1, 1, 1), (7, 1.0, 30, 0.0, 6, 1.0, 1, 1, 1),
    (12, 0.3, 70, 0.1, 3, 1.0, 1, 1, 1), (240, 0.0, 5, 0.0, 9, 0.4, 1, 1, 1), (3, 0.0, 2, 1.0, 0, 0.0, 1, 1, 1),
    (25, 0.9, 3, 1.0, 4, 1.0, 1, 1, 1), (18, 0.0, 0, 0.0, 0, 0.0, 1, 1, 1), (5, 0.0, 12, 0.0, 4, 0.0, 1, 1, 1),
    (1, 1.0, 1, 1.0, 1, 1.0, -1, 1, 0), (2, 1.0, 0, 0.0, 1, 1.0, -1, 1, 0), (9, 0.0, 1, 1.0, 8, 0.0, -1, 1, 0),
    (40, 0.0, 2, 1.0, 12, 0.0, -1, 1, 0), (95, 0.0, 30, 0.0, 6, 0.0, -1, 1, 0), (7, 0.2, 80, 0.0, 0, 0.0, -1, 1, 0),
    (14, 0.1, 22, 0.0, 31, 0.0, -1, 1, 0), (55, 0.0, 60, 0.0, 70, 0.0, -1, 1, 0), (3, 0.0, 45, 0.0, 2, 1.0, -1, 1, 0),
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0), (6, 0.0, 1, 1.0, 9, 0.0, 0, 1, 0), (28, 0.0, 3, 1.0, 10, 0.0, 0, 1, 0),
    (35, 0.1, 60, 0.0, 4, 1.0, 0, 1, 0), (11, 0.0, 90, 0.0, 0, 0.0, 0, 1, 0), (2, 0.0, 0, 0.0, 1, 1.0, 0, 1, 0),
    (48, 0.0, 50, 0.0, 44, 0.0, 0, 1, 0), (120, 0.0, 2, 1.0, 3, 0.0, 0, 1, 0), (5, 1.0, 40, 0.0, 30, 0.0, 0, 1, 0),
    # Pages that mark no article: furniture is named, or short, or linked; text is long, or beside long text.
    (2, 1.0, 1, 1.0, 2, 1.0, -1, 0, 0), (45, 0.0, 30, 0.0, 50, 0.0, -1, 0, 0), (8, 0.0, 60, 0.0, 0, 0.0, -1, 0, 0),
    (70, 0.0, 80, 0.0, 20, 0.0, -1, 0, 0), (16, 0.5, 3, 1.0, 40, 0.0, -1, 0, 0), (33, 0.0, 2, 1.0, 90, 0.0, -1, 0, 0),
    (80, 0.0, 7, 0.0, 65, 0.0, 0, 0, 1), (65, 0.02, 80, 0.0, 30, 0.0, 0, 0, 1), (30, 0.0, 65, 0.0, 110, 0.1, 0, 0, 1),
    (110, 0.1, 30, 0.0, 45, 0.0, 0, 0, 1), (45, 0.0, 110, 0.1, 3, 1.0, 0, 0, 1), (50, 0.2, 2, 1.0, 40, 0.0, 0, 0, 1),
    (22, 0.0, 40, 0.0, 38, 0.0, 0, 0, 1), (200, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1), (38, 0.0, 1, 1.0, 4, 1.0, 0, 0, 1),
    (26, 0.0, 5, 0.0, 3, 0.5, 0, 0, 1), (19, 0.1, 50, 0.0, 60, 0.0, 0, 0, 1), (24, 0.3, 33, 0.0, 21, 0.0, 0, 0, 1),
    (9, 0.0, 55, 0.0, 62, 0.0, 0, 0, 1), (4, 0.0, 48, 0.0, 70, 0.0, 0, 0, 1), (7, 0.0, 3, 1.0, 85, 0.0, 0, 0, 1),
    (1, 0.0, 35, 0.0, 40, 0.0, 0, 0, 1), (12, 0.0, 28, 0.0, 31, 0.0, 0, 0, 1), (6, 0.0, 1, 1.0, 42, 0.0, 0, 0, 1),
    (10, 0.0, 2, 1.0, 27, 0.0, 0, 0, 1), (3, 0.0, 66, 0.0, 29, 0.0, 0, 0, 1), (14, 0.0, 90, 0.0, 16, 0.0, 0, 0, 1),
    (16, 0.0, 14, 0.0, 55, 0.0, 0, 0, 1), (17, 0.0, 3, 1.0, 6, 1.0, 0, 0, 1), (8, 0.25, 72, 0.0, 33, 0.0, 0, 0, 1),
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0), (2, 1.0, 2, 1.0, 3, 1.0, 0, 0, 0), (3, 1.0, 0, 0.0, 2, 1.0, 0, 0, 0),
    (4, 1.0, 60, 0.0, 5, 1.0, 0, 0, 0), (5, 0.8, 2, 1.0, 70, 0.0, 0, 0, 0), (18, 0.9, 4, 1.0, 6, 1.0, 0, 0, 0),
    (30, 0.7, 5, 1.0, 8, 0.6, 0, 0, 0), (25, 1.0, 25, 1.0, 24, 1.0, 0, 0, 0), (12, 0.5, 10, 0.6, 9, 0.5, 0, 0, 0),
    (40, 0.9, 3, 1.0, 50, 0.0, 0, 0, 0), (6, 1.0, 80, 0.0, 75, 0.0, 0, 0, 0), (8, 0.6, 30, 0.0, 0, 0.0, 0, 0, 0),
    (3, 0.0, 2, 1.0, 1, 1.0, 0, 0, 0), (5, 0.0, 1, 1.0, 4, 1.0, 0, 0, 0), (2, 0.0, 1, 1.0, 2, 0.0, 0, 0, 0),
    (1, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0), (9, 0.0, 3, 1.0, 2, 1.0, 0, 0, 0), (7, 0.0, 6, 0.0, 5, 0.0, 0, 0, 0),
    (4, 0.0, 9, 0.0, 0, 0.0, 0, 0, 0), (11, 0.0, 4, 1.0, 3, 0.0, 0, 0, 0), (6, 0.0, 5, 1.0, 8, 0.4, 0, 0, 0),
    (13, 0.0, 3, 1.0, 2, 1.0, 0, 0, 0), (20, 0.05, 2, 0.0, 1, 1.0, 0, 0, 1), (14, 0.0, 6, 0.0, 4, 0.0, 0, 0, 0),
    (8, 0.0, 7, 0.0, 0, 0.0, 0, 0, 0), (3, 0.0, 4, 0.0, 6, 1.0, 0, 0, 0), (10, 0.1, 5, 0.0, 6, 0.0, 0, 0, 0),
)


@dataclass
class Node:
    """A leaf with ``keep``, or a question: is the feature at most ``limit``?"""

    keep: bool
    feature: int = -1
    limit: float = 0.0
    low: Node | None = None
    high: Node | None = None


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8) -> Node:
    """A tree of the splits with the least Gini impurity; ties go to the first feature and limit."""
    keep = bool(y.mean() >= 0.5)
    if depth == 0 or y.min() == y.max():
        return Node(keep)
    best: tuple[float, int, float] | None = None
    for feature in range(x.shape[1]):
        values = np.unique(x[:, feature])
        for limit in (values[:-1] + values[1:]) / 2:
            low = x[:, feature] <= limit
            impurity = sum(part.sum() * 2 * y[part].mean() * (1 - y[part].mean()) for part in (low, ~low))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, feature, float(limit))
    if best is None:
        return Node(keep)
    low = x[:, best[1]] <= best[2]
    return Node(keep, best[1], best[2], grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1))


def trained(table: tuple = LABELLED) -> Node:
    rows = np.array(table, dtype=float)
    return grow(rows[:, :-1], rows[:, -1])


def kept(tree: Node, rows: np.ndarray) -> np.ndarray:
    """What the tree says of each row."""
    if tree.feature < 0 or tree.low is None or tree.high is None:
        return np.full(len(rows), tree.keep)
    low = rows[:, tree.feature] <= tree.limit
    out = np.empty(len(rows), dtype=bool)
    out[low], out[~low] = kept(tree.low, rows[low]), kept(tree.high, rows[~low])
    return out


def main_blocks(page: str | None, tree: Node) -> list[str]:
    """The texts of the page's main blocks in page order."""
    blocks = blocks_of(page)
    if not blocks:
        return []
    return [b.text for b, keep in zip(blocks, kept(tree, features(blocks))) if keep]


SLICE_ROWS = 500


def main_texts(pages: DataFrame, tree: Node | None = None) -> DataFrame:
    """``page_id, url, blocks, n_blocks`` of every page: its main blocks, and how many it has in all."""
    tree = tree or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                texts, counts = [], []
                for page in part["html"].to_pylist():
                    blocks = blocks_of(page)
                    keep = kept(tree, features(blocks)) if blocks else []
                    texts.append([b.text for b, k in zip(blocks, keep) if k])
                    counts.append(len(blocks))
                yield pa.RecordBatch.from_arrays(
                    [part["page_id"], part["url"], pa.array(texts, pa.list_(pa.string())), pa.array(counts, pa.int64())],
                    ["page_id", "url", "blocks", "n_blocks"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, blocks array<string>, n_blocks long")


def op13_main_text(spark: SparkSession, folder: str) -> DataFrame:
    found = main_texts(spark.read.parquet(f"{folder}/pages.parquet"))
    return found.withColumn("text", F.array_join("blocks", " ")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
