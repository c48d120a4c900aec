"""Main text of web pages from flat text blocks.

A page is cut into blocks of text between block-level tags. A decision tree, trained on a
small table of labelled pages, tells main text by the word count and link density of a
block and its neighbours and by what encloses it.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.llm.rows import per_batch

# Elements whose tags end a block of text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
# Elements whose content is never text of the page. Those of the first kind run to the end if they are not closed, as in
# browsers; those of the second are left out up to their own end tag, and without one only the tag is. A head needs no
# entry: what may stand in it has no text beside them, and anything else ends it.
RAW_TAGS = "script style template textarea iframe title".split()
SILENT_TAGS = "noscript select svg math object canvas audio video button".split()
# Elements without content, which are never closed.
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN_TAGS = frozenset(["article", "main"])
SIDE_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
# Words in class, id or role that name a part of the page.
MAIN_NAMES = frozenset("article content entry main post story".split())
SIDE_NAMES = frozenset(
    "ad ads advert advertisement advertising advertorial alert banner breadcrumb breadcrumbs comment comments cookie "
    "cookies consent copyright disclaimer discussion disqus feedback footer gdpr header hidden infobar login masthead "
    "menu menubar modal nav navbar navigation newsletter notice notification paywall popup privacy promo promoted "
    "promotion recommendations recommended related replies reply respond search share sharing sidebar sidebar1 signup "
    "skip social sponsor sponsored subscribe subscription teaser toc toolbar topbar tracking warning widget widgets".split()
)

# What follows a tag's name, up to its end: a quote opens a value after "=" only. A value with "<" in it has to end where
# another attribute or the end of the tag may follow; else its quote was never closed, and the tag ends at the next ">".
_REST = r"""(?:=\s*(?:"[^"<]*"|'[^'<]*'|"[^"]*"(?=[\s/>])|'[^']*'(?=[\s/>]))|[^>])*+"""
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:-->|\Z))"
    r"|<(?P<raw>" + "|".join(RAW_TAGS) + r")(?=[\s/>])" + _REST + r">.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    r"|<(?P<end>/?)(?P<silent>" + "|".join(SILENT_TAGS) + r")(?=[\s/>])(?P<rest>" + _REST + r")>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>" + _REST + r")(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAMED = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_NAME_PARTS = re.compile(r"[a-z]+\d*|\d+")
_CAMEL = re.compile(r"([a-z])([A-Z])")

FEATURES = (
    "words link_density words_before density_before words_after density_after inside_main inside_side nearest heading item"
).split()


@dataclass
class Block:
    text: str
    words: int
    density: float
    inside_main: bool
    inside_side: bool
    nearest: int  # of what encloses the block: 1 main part, -1 other part, 0 unknown
    heading: bool
    item: bool


def part_of(tag: str, attributes: str) -> int:
    """1 for a main part, -1 for another part, 0 for an element that says neither."""
    names: set[str] = set()
    if attributes:
        for name, value in _NAMED.findall(attributes):
            value = value.strip("\"'")
            name = name.lower()
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return -1
            if name == "style":
                if "display:none" in value.replace(" ", "").lower():
                    return -1
            else:
                names.update(_NAME_PARTS.findall(_CAMEL.sub(r"\1-\2", value).lower()))
    if tag in SIDE_TAGS or names & SIDE_NAMES:
        return -1
    return 1 if tag in MAIN_TAGS or names & MAIN_NAMES else 0


def tokens(page: str) -> list[tuple[int, int, re.Match]]:
    """Start, end and match of what is not text, in order. A silent element with an end tag of its own is one token."""
    found: list[tuple[int, int, re.Match]] = []
    open_at: dict[str, list[int]] = {}
    for match in _TOKEN.finditer(page):
        start, end = match.span()
        if match["silent"]:
            name = match["silent"].lower()
            opened = open_at.setdefault(name, [])
            if not match["end"]:
                if not (name in ("svg", "math") and match["rest"].endswith("/")):
                    opened.append(len(found))
            elif opened:
                at = opened.pop()
                start, _, match = found[at]
                del found[at:]
                for others in open_at.values():  # what it holds is gone with it
                    while others and others[-1] >= at:
                        others.pop()
        found.append((start, end, match))
    return found


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in order."""
    found: list[Block] = []
    enclosing: list[tuple[str, int]] = []
    pieces: list[str] = []
    linked: list[str] = []
    in_link = 0

    def end() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                words = len(text.split(" "))
                links = len(" ".join(html.unescape("".join(linked)).split()).split())
                parts = [part for _, part in enclosing if part]
                tags = [tag for tag, _ in enclosing]
                found.append(
                    Block(
                        text,
                        words,
                        min(1.0, links / words),
                        1 in parts,
                        -1 in parts,
                        parts[-1] if parts else 0,
                        any(t[0] == "h" and t[1:].isdigit() for t in tags),
                        "li" in tags,
                    )
                )
            pieces.clear()
            linked.clear()

    def add(text: str) -> None:
        pieces.append(text)
        if in_link:
            linked.append(text + " ")

    at = 0
    for start, stop, match in tokens(page):
        if start > at:
            add(page[at:start])
        at = stop
        tag = match["tag"]
        if tag is None:
            if match["raw"] and match["raw"].lower() in BLOCK_TAGS:
                end()
            continue
        tag = tag.lower()
        if tag == "a":
            in_link = 0 if match["close"] else 1
        elif tag == "br":
            add(" ")
        elif tag == "head":
            end()
        elif tag in BLOCK_TAGS:
            end()
            in_link = 0
            if match["close"]:
                for depth in range(len(enclosing) - 1, -1, -1):
                    if enclosing[depth][0] == tag:
                        del enclosing[depth:]
                        break
            elif tag not in VOID_TAGS:
                if tag in ("p", "li") or enclosing and enclosing[-1][0] == "p":
                    # an open paragraph ends where another block begins, an item where the next one does
                    if enclosing and enclosing[-1][0] in ("p", tag):
                        enclosing.pop()
                enclosing.append((tag, part_of(tag, match["attributes"])))
    if at < len(page):
        add(page[at:])
    end()
    return found


def features(found: list[Block]) -> np.ndarray:
    """A row of ``FEATURES`` for each block; a missing neighbour has no words and no links."""
    own = np.array([(b.words, b.density) for b in found], float).reshape(-1, 2)
    padded = np.concatenate([np.zeros((1, 2)), own, np.zeros((1, 2))])
    rest = np.array([(b.inside_main, b.inside_side, b.nearest, b.heading, b.item) for b in found], float).reshape(-1, 5)
    return np.concatenate([own, padded[:-2], padded[2:], rest], axis=1)


# ------------------------------------------------------------ labelled table

_LONG = "The harbour was quiet that morning, and the boats that had come in late lay close together, so nobody saw her leave."
_MORE = "It took the town a week to notice, because the shop stayed open and the letters were still taken in every day."

# Pages written for training. A block that begins with "+" is main text, one with "-" is not.
LABELLED_PAGES = [
    f"<html><body><nav><ul><li><a>-Home</a></li><li><a>-News</a></li></ul></nav><div class='ad'>-Buy two lamps and pay for one today.</div><article><h1>+The quiet harbour</h1><p>+{_LONG}</p><p>+She left.</p><p>+{_MORE}</p></article><footer>-Copyright notice of the paper</footer></body></html>",
    f"<html><body><header><p>-Daily paper for the coast</p></header><main><h2>+Leaving</h2><p>+{_LONG}</p><p>+So.</p><ul><li>+one boat</li><li>+two nets and a lamp</li></ul><blockquote>+{_MORE}</blockquote></main><aside><p>-{_MORE}</p><ul><li><a>-Most read today</a></li></ul></aside></body></html>",
    f"<html><body><div id='menu'><a>-Start</a> <a>-About us</a></div><div id='content'><h1>+Leaving</h1><div><p>+{_MORE}</p></div><p>+No.</p></div><div class='sidebar'><p>-{_LONG}</p></div><div class='comments'><p>-{_LONG}</p><p>-Nice read.</p></div></body></html>",
    f"<html><body><div class='cookie-notice'><p>-We use cookies to remember what you have read, and you may refuse them at any time you like.</p></div><article><p>+{_LONG}</p><aside><p>-Read this as well</p></aside><p>+{_MORE}</p><section class='comments'><h3>-Comments</h3><p>-{_MORE}</p></section></article><form><p>-Write to us with your name</p></form></body></html>",
    f"<html><body><ul><li><a>-Home</a></li><li><a>-Sports</a></li><li><a>-Weather and tides</a></li></ul><h1>+The quiet harbour</h1><p>+{_LONG}</p><p>+{_MORE} {_LONG}</p><p>+{_LONG}</p><p><a>-Older</a> <a>-Newer</a></p><p>-All rights reserved</p></body></html>",
    f"<html><body><table><tr><td><a>-Home</a> | <a>-Archive</a></td></tr><tr><td>+{_LONG} <a>as told</a> {_MORE}</td></tr><tr><td>+{_MORE} {_MORE}</td></tr><tr><td><a>-Imprint</a> <a>-Terms of use</a></td></tr></table></body></html>",
    f"<html><body><div class='post'><p>+Hello.</p></div><div class='newsletter'><p>-{_LONG}</p></div><div class='related'><a>-The other harbour</a></div></body></html>",
    "<html><body><nav><a>-Home</a></nav><article><h1>+Ebb</h1><p>+Ti.</p></article><footer><p>-Ti.</p></footer></body></html>",
    f"<html><body><article><header><h1>-Harbour news</h1></header><p>+{_MORE}</p><div class='share'>-Tell your friends</div><footer>-Filed under boats</footer></article></body></html>",
    f"<html><body><article><p><a>+{_LONG}</a></p><p>+See <a>the map of the harbour</a></p><ul><li><a>+A list of all the boats</a></li></ul></article></body></html>",
    f"<html><body><h1>+Ebb</h1><p>+{_LONG}</p><p>+{_LONG}</p><p>-Share</p><p>-Top</p></body></html>",
    f"<html><body><div><a>-Home and news</a> <a>-Weather and tides</a> <a>-Boats for sale</a> <a>-All letters</a> <a>-The old archive</a></div><p>+{_LONG}</p><p>+{_MORE}</p><div><a>-Terms of use</a> and <a>-how we treat data</a> and <a>-who we are and where</a> and <a>-jobs at the paper</a></div></body></html>",
]


_WORDS = f"{_LONG} {_MORE}".replace(",", "").replace(".", "").split()


def _plain(sizes: list[int]) -> str:
    """Paragraphs of main text of some numbers of words."""
    return "".join(f"<p>+{' '.join((_WORDS * 3)[at : at + size])}.</p>" for at, size in enumerate(sizes))


# Articles whose paragraphs are short before and after short and long ones, with and without a heading or anything around.
_SIZES = [[8, 40, 10, 1, 12, 2, 45, 6, 30, 9], [3, 60, 5, 7, 2, 11, 50], [10, 9, 8], [1, 30, 4, 14, 13, 20, 1], [55, 6], [6, 55], [2, 10, 3, 8]]
LABELLED_PAGES += [
    f"<html><body>{before}<article>{head}{_plain(sizes)}</article>{after}</body></html>"
    for sizes in _SIZES
    for before, head, after in (
        ("<nav><a>-Home</a> <a>-News</a></nav>", "<h1>+Ebb and flood</h1>", "<footer>-The paper</footer>"),
        ("", "", ""),
        (f"<aside><p>-{_LONG}</p></aside>", "", f"<div class='comments'><p>-{_MORE}</p><p>-Yes.</p></div>"),
    )
]
# Pages that name no parts: long blocks of links are not text, short ones between long ones are.
_LINKS = "<a>-Home and news</a> <a>-Weather and tides</a> <a>-Boats for sale</a> <a>-All letters</a> <a>-The old archive of the paper</a> <a>-Jobs</a> <a>-Terms</a>"
LABELLED_PAGES += [
    f"<html><body><div>{_LINKS} {_LINKS}</div><h1>+Low water</h1><p>+{_LONG}</p><p>+She left.</p><p>+{_MORE}</p><p>+So it was.</p><p>+{_LONG}</p><div>{_LINKS}</div></body></html>",
    f"<html><body><p>+{_MORE}</p><p>+No.</p><p>+{_LONG}</p><p>+Nobody asked.</p><p>+{_MORE}</p><div>{_LINKS} {_LINKS}</div><p>-Contact</p></body></html>",
]

# Pages that the tree has not seen: what doesn't help on them is cut off.
HELD_OUT_PAGES = [
    f"<html><body><nav><a>-Start</a> <a>-Shop</a></nav><main><h1>+Boats</h1>{_plain([5, 35, 7, 9, 2])}<ul><li>+two oars</li></ul></main><footer>-Imprint</footer></body></html>",
    f"<html><body><div class='content'>{_plain([12, 4, 25, 11, 6])}</div><div class='share'><p>-Tell others</p></div><aside><p>-{_MORE}</p></aside></body></html>",
    f"<html><body><ul><li><a>-Home</a></li><li><a>-Tides</a></li></ul><h2>+Low water</h2><p>+{_LONG}</p><p>+{_MORE}</p><p><a>-Next</a></p></body></html>",
    f"<html><body><article>{_plain([9, 10, 8, 44, 3])}<p>+See <a>the list of boats</a></p></article><form><p>-Your name</p></form></body></html>",
    f"<html><body><div><a>-Home</a> <a>-All letters</a></div><p>+{_MORE}</p><p>+{_LONG} <a>as told</a></p><div><a>-Terms of use</a></div></body></html>",
    f"<html><body><div>{_LINKS}</div><p>+{_LONG}</p><p>+And then?</p><p>+{_MORE} <a>as told</a></p><div>{_LINKS} {_LINKS}</div></body></html>",
    f"<html><body><div><a>-Start</a></div><div>{_LINKS} {_LINKS}</div><h2>+Low water</h2><p>+{_MORE}</p><p>+It rained.</p><p>+{_LONG}</p><p>-Imprint</p></body></html>",
]


def labelled_table(pages: list[str] = LABELLED_PAGES) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of labelled pages."""
    rows, labels = [], []
    for page in pages:
        found = blocks(page)
        rows.append(features(found))
        labels += [b.text.startswith("+") for b in found]
    return np.concatenate(rows), np.array(labels)


# --------------------------------------------------------------------- tree


@dataclass
class DecisionTree:
    """Nodes in arrays; a feature below zero marks a leaf, whose share of main text is ``value``."""

    feature: np.ndarray
    threshold: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def predict(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), np.int64)
        while True:
            inner = np.flatnonzero(self.feature[at] >= 0)
            if not len(inner):
                return self.value[at] >= 0.5
            node = at[inner]
            above = rows[inner, self.feature[node]] > self.threshold[node]
            at[inner] = np.where(above, self.right[node], node + 1)


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 8) -> DecisionTree:
    """A tree by Gini impurity. Of equal splits the first feature and lowest threshold win."""
    nodes: list[list[float]] = []

    def split(chosen: np.ndarray, left_depth: int) -> None:
        own = labels[chosen]
        nodes.append([-1, 0.0, 0, own.mean()])
        here = len(nodes) - 1
        best = (own.mean() * (1 - own.mean()) * len(own) - 1e-9, -1, 0.0)
        if left_depth and 0 < own.mean() < 1:
            for f in range(rows.shape[1]):
                values = np.unique(rows[chosen, f])
                for cut in (values[1:] + values[:-1]) / 2:
                    over = rows[chosen, f] > cut
                    cost = sum(part.mean() * (1 - part.mean()) * len(part) for part in (own[over], own[~over]))
                    if cost < best[0] - 1e-12:
                        best = (cost, f, cut)
        if best[1] >= 0:
            over = rows[chosen, best[1]] > best[2]
            nodes[here][:2] = best[1:]
            split(chosen[~over], left_depth - 1)
            nodes[here][2] = len(nodes)
            split(chosen[over], left_depth - 1)

    split(np.arange(len(rows)), depth)
    table = np.array(nodes)
    return DecisionTree(table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int), table[:, 3])


def pruned(tree: DecisionTree, rows: np.ndarray, labels: np.ndarray) -> DecisionTree:
    """The tree with every split made a leaf that does not lessen the errors on some rows it was not grown on."""
    feature = tree.feature.copy()

    def errors(node: int, chosen: np.ndarray) -> int:
        alone = int((labels[chosen] != (tree.value[node] >= 0.5)).sum())
        if feature[node] < 0:
            return alone
        over = rows[chosen, feature[node]] > tree.threshold[node]
        split = errors(node + 1, chosen[~over]) + errors(int(tree.right[node]), chosen[over])
        if alone <= split:
            feature[node] = -1
            return alone
        return split

    errors(0, np.arange(len(rows)))
    return DecisionTree(feature, tree.threshold, tree.right, tree.value)


@lru_cache(maxsize=1)
def trained() -> DecisionTree:
    return pruned(grow(*labelled_table()), *labelled_table(HELD_OUT_PAGES))


# ----------------------------------------------------------------- operator


def main_texts(pages: list[str | None], tree: DecisionTree) -> list[str]:
    """The main text of each page, all blocks of all pages classified at once."""
    found = [blocks(page or "") for page in pages]
    rows = [features(f) for f in found if f]
    kept = iter(tree.predict(np.concatenate(rows)).tolist() if rows else [])
    return ["\n".join([b.text for b in f if next(kept)]) for f in found]


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) for every row of ``pages``.

    The whole ``html`` is read; a null or empty one, and one without main text, gives an
    empty text. Broken or cut-off markup is read as far as it goes. Rows that repeat are
    extracted alike, null identifiers and urls are passed on, an empty table gives an empty one.
    """
    tree = trained()

    def make():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = main_texts(batch.column("html").to_pylist(), tree)
            return pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

        return apply

    narrow = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return per_batch(narrow, make, "page_id long, url string, text string, n_chars long")
