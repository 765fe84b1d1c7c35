"""The main text of web pages, as a minimum cut between content and boilerplate.

A page becomes blocks of text below its elements. A logistic model gives each block the
cost of being called content or boilerplate; both costs are capacities from the source and
to the sink. Neighbouring blocks, and blocks and the elements that hold them, are joined
by edges whose capacity is the cost of calling the two ends differently. The maximal flow
finds the cheapest labelling of the whole page: a short paragraph goes with the article
around it, a long advertisement does not.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import in_batches, in_parts

# Element names by what they do to text.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe textarea title svg math object select".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote center details div dl fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
# An element that ends open ones of these kinds, up to the nearest of the second kinds.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
_P_SCOPE = frozenset("article aside body div footer form header main nav section table td th li".split())

# How sure an element's name makes that its text is the article.
_BY_WORD, _BY_MAIN, _BY_ARTICLE = 1, 2, 3

# Marks of boilerplate and of content in element names, roles, classes, ids.
_AWAY_TAGS = frozenset("nav footer aside form button menu dialog fieldset".split())
_AWAY_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu "
    "menubar toolbar".split()
)
_AWAY_WORDS = frozenset(
    "ad ads adv advert advertisement advertising adverts banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies copyright disclaimer disqus donate feedback footer gdpr "
    "header legal login masthead menu modal nav navbar navigation newsletter notice notices "
    "notification pager pagination paywall popup promo promotion recommended related replies "
    "reply respond search share sharing shares sidebar signup skip social sponsor sponsored "
    "subscribe subscription syndication toolbar trending widget widgets".split()
)
_MAIN_TAGS = {"article": _BY_ARTICLE, "main": _BY_MAIN}
_MAIN_WORDS = frozenset("article articlebody content main post story text entry body".split())
_NEUTRAL = frozenset({"html", "body"})
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Values in quotes may hold any sign; a quote that is never closed does not count.
_TAG = re.compile(
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)"
)
_MARK = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(\"[^\"]*+\"|'[^']*+'|[^\s>]++))?", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
# Layout names such as with-sidebar or no-ads say nothing about what is inside.
_LAYOUT_WORDS = frozenset("no not has have with without hide is".split())
# What ends at its end tag or with the page.
_TO_THE_END = frozenset("script style textarea title iframe".split())

FEATURES = (
    "one", "words", "link_share", "marks", "starts_upper", "heading", "item", "away", "main", "late",
)

# The other weights stay as they are, since their marks make the labels.
_LEARNED = np.array([name not in ("away", "main") for name in FEATURES])


@dataclass(frozen=True)
class PageRules:
    """Costs of the cut, and the bound of the training sample.

    `prior` are the weights of FEATURES before training, `firmness` how many blocks'
    worth they resist it. What is learned from the text counts `most_from_text` at most,
    so that marks of the page decide where there are any. `beside` joins neighbours below one element, `across` other
    neighbours, `inside` blocks and elements with the element around them.
    `sample` pages are wanted for training, with at most `blocks` of each.
    """

    prior: tuple[float, ...] = (-1.5, 1.0, -3.0, 1.5, 0.3, 0.3, -1.0, -12.0, 4.0, -0.5)
    firmness: float = 50.0
    most_from_text: float = 3.0
    beside: float = 0.6
    across: float = 0.15
    inside: float = 1.2
    sample: int = 1000
    blocks: int = 100


@dataclass
class _Element:
    """`main`: how sure it is that the element is in the article, 0 in boilerplate."""

    tag: str
    parent: int
    away: bool
    main: int


@dataclass
class Block:
    """A run of text below one element, not broken by another."""

    element: int
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


class Page:
    """Elements and blocks of a page. Unclosed, misnested and unknown elements are
    borne with; scripts, styles, comments and hidden forms of text are left out."""

    def __init__(self, source: str):
        self.elements = [_Element("", -1, False, 0)]
        self.blocks: list[Block] = []
        self.open = [0]
        self.links = 0
        self.block: Block | None = None
        self.unclosed: set[str] = set()
        self._read(source)
        kept = []
        for block in self.blocks:
            block.text = " ".join("".join(block.pieces).split())
            if block.text:
                kept.append(block)
        self.blocks = kept
        self.sure = max((self.elements[block.element].main for block in kept), default=0)

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            tag = source.find("<", at)
            if tag < 0:
                self._text(source[at:])
                return
            if tag > at:
                self._text(source[at:tag])
            if source.startswith("<!--", tag):
                close = source.find("-->", tag + 4)
                at = end if close < 0 else close + 3
                continue
            follows = source[tag + 1 : tag + 2]
            if follows in ("!", "?"):
                close = source.find(">", tag)
                at = end if close < 0 else close + 1
                continue
            found = _TAG.match(source, tag)
            if found is None:
                if source.startswith("</", tag):
                    close = source.find(">", tag)
                    at = end if close < 0 else close + 1
                else:
                    self._text("<")
                    at = tag + 1
                continue
            at = found.end()
            name = found[2].lower()
            if found[1]:
                self._close(name)
            elif name in _RAW:
                at = self._skip(source, name, at, found[3])
            else:
                self._start(name, found[3])

    def _skip(self, source: str, name: str, at: int, marks: str) -> int:
        """Behind an element whose text is not shown."""
        if marks.endswith("/") and name in ("svg", "math") or name in self.unclosed:
            return at
        close = re.compile(f"</{name}[^>]*>", re.I).search(source, at)
        if close:
            return close.end()
        self.unclosed.add(name)
        return len(source) if name in _TO_THE_END else at

    def _text(self, text: str) -> None:
        if "&" in text:
            text = references.unescape(text)
        if self.block is None:
            if not text.strip():
                return
            self.block = Block(self.open[-1])
            self.blocks.append(self.block)
        self.block.pieces.append(text)
        if self.links:
            self.block.linked += len(text)

    def _start(self, name: str, marks: str) -> None:
        if name in _INLINE:
            if name == "a":
                self.links = 1
            elif name == "br" and self.block is not None:
                self.block.pieces.append(" ")
            return
        self.block = None
        if name in _VOID:
            return
        self.links = 0
        if name in _CLOSES_P:
            self._end({"p"}, _P_SCOPE)
        if name in _ENDS:
            self._end(*_ENDS[name])
        away, main, told = _marks(name, marks)
        parent = self.open[-1]
        above = self.elements[parent]
        if name == "header" and above.main >= _BY_MAIN:
            away = told
        away |= above.away
        main = 0 if away else max(above.main, main)
        self.elements.append(_Element(name, parent, away, main))
        if not marks.endswith("/"):
            self.open.append(len(self.elements) - 1)

    def _end(self, kinds, scope) -> None:
        """Close the nearest open element of these kinds within the scope."""
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.elements[self.open[depth]].tag
            if tag in kinds:
                del self.open[depth:]
                if tag == "p" or depth == 1:
                    return
            elif tag in scope:
                return

    def _close(self, name: str) -> None:
        if name in _INLINE:
            if name == "a":
                self.links = 0
            return
        self.block = None
        self.links = 0
        for depth in range(len(self.open) - 1, 0, -1):
            if self.elements[self.open[depth]].tag == name:
                del self.open[depth:]
                return


def _marks(name: str, marks: str) -> tuple[bool, int, bool]:
    """Boilerplate or not, how sure to be content, and whether role, class or id say
    that it is boilerplate."""
    away = name in _AWAY_TAGS or name == "header"
    main = _MAIN_TAGS.get(name, 0)
    told = False
    if marks and name not in _NEUTRAL:
        for key, value in _MARK.findall(marks):
            key = key.lower()
            value = value.strip("\"'")
            if key == "role":
                told |= value.lower() in _AWAY_ROLES
                main = max(main, _MAIN_TAGS.get(value.lower(), 0))
            elif key == "style":
                told |= bool(_HIDDEN.search(value))
            elif key == "hidden":
                told |= value.lower() != "false"
            elif key == "aria-hidden":
                told |= value.lower() == "true"
            else:
                for one in value.split():
                    words = {word.lower() for word in _NAME.findall(one)}
                    if words & _LAYOUT_WORDS:
                        continue
                    if words & _AWAY_WORDS:
                        told |= name not in _MAIN_TAGS or "comment" in words
                    elif words & _MAIN_WORDS:
                        main = max(main, _BY_WORD)
    return away or told, main, told


_SENTENCE_MARKS = re.compile(r"[.,;:!?。、！？]")


def block_features(page: Page) -> np.ndarray:
    """One row of FEATURES per block."""
    rows = []
    count = len(page.blocks)
    for place, block in enumerate(page.blocks):
        element = page.elements[block.element]
        text = block.text
        words = text.count(" ") + 1
        rows.append(
            (
                1.0,
                min(math.log2(1 + words), 8.0) / 4,
                min(block.linked / max(len(text), 1), 1.0),
                min(len(_SENTENCE_MARKS.findall(text)) / words * 4, 1.0),
                float(text[0].isupper()),
                float(element.tag in _HEADINGS),
                float(element.tag in ("li", "td", "th", "dt")),
                float(element.away),
                1.0 if page.sure and element.main == page.sure else -page.sure / _BY_ARTICLE,
                place / count,
            )
        )
    return np.array(rows, np.float64).reshape(-1, len(FEATURES))


class Flow:
    """Maximal flow by levels and blocking paths, on small graphs with float capacities."""

    def __init__(self, nodes: int):
        self.edges: list[list[int]] = [[] for _ in range(nodes)]
        self.target: list[int] = []
        self.room: list[float] = []

    def join(self, a: int, b: int, there: float, back: float) -> None:
        self.edges[a].append(len(self.target))
        self.target.append(b)
        self.room.append(there)
        self.edges[b].append(len(self.target))
        self.target.append(a)
        self.room.append(back)

    def levels(self, source: int) -> list[int]:
        level = [-1] * len(self.edges)
        level[source] = 0
        queue = deque([source])
        target, room = self.target, self.room
        while queue:
            node = queue.popleft()
            for edge in self.edges[node]:
                other = target[edge]
                if level[other] < 0 and room[edge] > 1e-9:
                    level[other] = level[node] + 1
                    queue.append(other)
        return level

    def saturate(self, source: int, sink: int) -> list[bool]:
        """Push all flow; which nodes the source still reaches: its side of the cut."""
        target, room, edges = self.target, self.room, self.edges
        while True:
            level = self.levels(source)
            if level[sink] < 0:
                return [found >= 0 for found in level]
            at = [0] * len(edges)
            path: list[int] = []
            node = source
            while True:
                if node == sink:
                    least = min(room[edge] for edge in path)
                    cut = 0
                    for place, edge in enumerate(path):
                        room[edge] -= least
                        room[edge ^ 1] += least
                        if room[edge] <= 1e-9 and not cut:
                            cut = place + 1
                    # Go on from the first full edge.
                    node = target[path[cut - 1] ^ 1]
                    del path[cut - 1 :]
                    continue
                out = edges[node]
                while at[node] < len(out):
                    edge = out[at[node]]
                    if room[edge] > 1e-9 and level[target[edge]] == level[node] + 1:
                        break
                    at[node] += 1
                if at[node] < len(out):
                    path.append(out[at[node]])
                    node = target[out[at[node]]]
                elif path:
                    edge = path.pop()
                    node = target[edge ^ 1]
                    at[node] += 1
                else:
                    break


def content_blocks(page: Page, weights: np.ndarray, rules: PageRules) -> list[bool]:
    """Which blocks are on the content side of the least cut."""
    blocks = page.blocks
    count = len(blocks)
    if not count:
        return []
    features = block_features(page)
    from_text = features[:, _LEARNED] @ weights[_LEARNED]
    from_marks = features[:, ~_LEARNED] @ weights[~_LEARNED]
    odds = np.clip(from_text, -rules.most_from_text, rules.most_from_text) + from_marks
    odds = odds.tolist()
    # Elements that hold blocks, and all around them.
    node_of: dict[int, int] = {}
    for block in blocks:
        element = block.element
        while element > 0 and element not in node_of:
            node_of[element] = count + len(node_of)
            element = page.elements[element].parent
    source, sink = count + len(node_of), count + len(node_of) + 1
    flow = Flow(sink + 1)
    for place, odd in enumerate(odds):
        # A block on the wrong side costs the odds against it.
        if odd > 0:
            flow.join(source, place, odd, 0.0)
        elif odd < 0:
            flow.join(place, sink, -odd, 0.0)
    for place, block in enumerate(blocks):
        if place:
            before = blocks[place - 1].element
            near = before == block.element or (
                page.elements[before].parent == page.elements[block.element].parent
            )
            strength = rules.beside if near else rules.across
            flow.join(place - 1, place, strength, strength)
        if block.element > 0:
            flow.join(place, node_of[block.element], rules.inside, rules.inside)
    for element, node in node_of.items():
        parent = page.elements[element].parent
        one, other = page.elements[element], page.elements[parent]
        # No pull across the edge of an article, a menu, a box of comments.
        if parent > 0 and one.away == other.away and one.main == other.main:
            flow.join(node, node_of[parent], rules.inside, rules.inside)
    return flow.saturate(source, sink)[:count]


def main_text(source: str | None, weights: np.ndarray, rules: PageRules = PageRules()) -> str:
    page = Page(source or "")
    kept = content_blocks(page, weights, rules)
    return " ".join(block.text for block, good in zip(page.blocks, kept) if good)


def weak_labels(page: Page) -> list[int | None]:
    """1 in a marked article, 0 in marked boilerplate, None where nothing is marked."""
    found = []
    for block in page.blocks:
        element = page.elements[block.element]
        sure = page.sure >= _BY_MAIN and element.main == page.sure
        found.append(0 if element.away else 1 if sure else None)
    return found


def fit_weights(features: np.ndarray, labels: np.ndarray, rules: PageRules) -> np.ndarray:
    """Logistic regression by Newton steps, held to the prior weights.

    Only the weights of the text's features are learned, both labels counting alike.
    """
    prior = np.array(rules.prior)
    weights = prior.copy()
    x = features[:, _LEARNED]
    if not len(x):
        return weights
    share = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1))
    times = share * len(labels)
    w = weights[_LEARNED]
    for _ in range(20):
        chance = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (times * (chance - labels)) + rules.firmness * (w - prior[_LEARNED])
        bend = (x * (times * chance * (1 - chance))[:, None]).T @ x
        step = np.linalg.solve(bend + rules.firmness * np.eye(len(w)), slope)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    weights[_LEARNED] = w
    return weights


_LABELLED = pa.schema([("features", pa.list_(pa.float64())), ("label", pa.int32())])


def train_weights(pages: DataFrame, rules: PageRules = PageRules(), html_col="html") -> np.ndarray:
    """Weights of the classifier from marked blocks of a sample of pages, chosen by their
    hash: about `sample` pages and at most `blocks` of each, spread over the page."""
    count = pages.count()
    every = max(count // max(rules.sample, 1), 1)

    def labelled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for source in batch.column("html").to_pylist():
                    page = Page(source)
                    features = block_features(page)
                    marked = [(i, l) for i, l in enumerate(weak_labels(page)) if l is not None]
                    step = -(-len(marked) // rules.blocks) or 1
                    for place, label in marked[::step]:
                        yield features[place].tolist(), label

        yield from in_batches(_LABELLED, rows())

    found = (
        pages.select(F.col(html_col).cast("string").alias("html"))
        .where(F.col("html").isNotNull() & (F.pmod(F.xxhash64("html"), F.lit(every)) == 0))
        .mapInArrow(labelled, "features array<double>, label int")
        .collect()
    )
    # In one order, so that a repeated run gives the same weights.
    rows = sorted((tuple(row["features"]), row["label"]) for row in found)
    features = np.array([row[0] for row in rows]).reshape(-1, len(FEATURES))
    return fit_weights(features, np.array([row[1] for row in rows], np.float64), rules)


def extract_text(
    pages: DataFrame, rules: PageRules = PageRules(), weights: np.ndarray | None = None,
    id_col="page_id", url_col="url", html_col="html",
) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page.

    A null or empty page, and one without content, has an empty text; repeated rows and
    null ids and urls stay as they are; other columns are not read; an empty table gives
    an empty result. Character references are decoded, white space inside a block becomes
    one space, blocks are joined by one space. Weights are trained unless they are given.
    """
    if weights is None:
        weights = train_weights(pages, rules, html_col)

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            texts = [main_text(s, weights, rules) for s in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(text) for text in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    return rows.mapInArrow(extract, "page_id bigint, url string, text string, n_chars bigint")
