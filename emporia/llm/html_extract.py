"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element of a page is a node that is content (1) or not (0). Its
potentials come from features of the element (tag, parent's tag, words of class
and id, length and links of its own text and of all text below it, that text's
share of the page), and a 2 x 2 potential joins it with its parent. Sum-product
messages run up the tree and down again, which gives each node's marginal; the
text of the nodes that are more likely content than not is the page's main
text, in page order.

The weights are trained by gradient ascent on the likelihood of labelled pages
(observed minus expected features under the same message passing). The labelled
pages are written by :mod:`emporia.llm.labelled_pages`; others can be passed.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache
from html.parser import HTMLParser
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from emporia.llm.common import map_batches, utf8

#: Formulas: all of it stands in the block around it.
_MATH = "math semantics mrow mi mn mo ms mtext mspace msup msub msubsup mfrac msqrt mroot munder mover munderover mstyle mpadded menclose mtable mtr mtd"
#: Elements that do not break a block of text; their text belongs to the block around them.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
    + _MATH.split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start of one of these ends an open p.
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
#: An open element of the key's set is ended by the start of the key.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Where the search for an open element to end stops.
_SCOPE = frozenset("html body table ul ol dl select article section aside nav footer header main div form td th".split())
#: Elements whose text is never shown as text of the page.
SILENT = frozenset("script style noscript template title head textarea select option button iframe object svg canvas annotation annotation-xml".split())
#: What may stand in a head; anything else that starts there, and text, ends a head left open.
_METADATA = frozenset("html head title meta link style script base noscript template basefont bgsound noframes".split())
_NAME = re.compile(r"[a-z]+")


@dataclass
class Page:
    """Nodes in page order (parents first): parent, features; the text runs, each with its node; labels if the page has them."""

    parents: list[int]
    features: list[list[str]]
    runs: list[tuple[int, str]]
    marks: list[int | None]


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parents, self.tags, self.own, self.marks = [-1], ["#page"], [[]], [None]
        self.runs: list[tuple[int, list[str]]] = []
        self.stack: list[tuple[str, int]] = [("#page", 0)]  # open elements; an inline one has its block's node
        self.lengths, self.linked = [0], [0]
        self.links = self.silent = 0

    def _end(self, depth: int) -> None:
        for tag, _ in self.stack[depth:]:
            self.links -= tag == "a"
            self.silent -= tag in SILENT
        del self.stack[depth:]

    def _end_open(self, tags, scope) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[depth][0]
            if tag in tags:
                self._end(depth)
                return
            if tag in scope:
                return

    def _end_head(self, inside: bool) -> None:
        """Ends an open head: where it is the innermost element, or (``inside``) with what is open in it, but no template's."""
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth][0] == "head":
                self._end(depth)
                return
            if not inside or self.stack[depth][0] == "template":
                return

    def handle_starttag(self, tag, attrs):
        if tag not in _METADATA and self.silent:
            self._end_head(inside=tag == "body")
        if tag in _CLOSES_P:
            self._end_open({"p"}, _SCOPE)
        if tag in _CLOSES:
            self._end_open(_CLOSES[tag], _SCOPE)
        if tag in VOID:
            if tag in ("br", "hr"):
                self.handle_data(" ")
            return
        node = self.stack[-1][1]
        if tag not in INLINE:
            parent = node
            node = len(self.parents)
            self.parents.append(parent)
            self.tags.append(tag)
            own = []
            mark = None
            for name, value in attrs:
                if name in ("class", "id", "role"):
                    own += _NAME.findall((value or "").lower())
                elif name == "data-content":
                    mark = int(value)
            self.own.append(own)
            self.marks.append(mark)
            self.lengths.append(0)
            self.linked.append(0)
        elif tag == "a":
            self.links += 1
        self.silent += tag in SILENT
        self.stack.append((tag, node))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth][0] == tag:
                self._end(depth)
                return
            if tag in INLINE and self.stack[depth][0] not in INLINE:
                return

    def handle_data(self, data):
        if self.silent and not data.isspace():
            self._end_head(inside=False)
        if self.silent:
            return
        node = self.stack[-1][1]
        if self.runs and self.runs[-1][0] == node and len(self.parents) == self.seen:
            self.runs[-1][1].append(data)
        else:
            self.runs.append((node, [data]))
        self.seen = len(self.parents)
        size = len(data) - data.count(" ")
        self.lengths[node] += size
        if self.links:
            self.linked[node] += size

    seen = 0


def parse(html: str) -> Page:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    features, parents, n = [], builder.parents, len(builder.tags)
    sizes, linked, long_own = builder.lengths[:], builder.linked[:], [x >= 80 for x in builder.lengths]
    long = long_own[:]
    for i in range(n - 1, 0, -1):  # all text below a node, and how many of its nodes hold much
        sizes[parents[i]] += sizes[i]
        linked[parents[i]] += linked[i]
        long[parents[i]] += long[i]
    for i, tag in enumerate(builder.tags):
        size, above = builder.lengths[i], builder.tags[parents[i]] if i else ""
        own = ["tag " + tag, f"tag {above}>{tag}"]
        own += ["name " + x for x in dict.fromkeys(builder.own[i])] or ["unnamed " + tag]
        own += ["under " + x for x in dict.fromkeys(builder.own[parents[i]])] if i else []
        if size:
            own.append("size " + ("tiny" if size < 20 else "short" if size < 80 else "long"))
            share = builder.linked[i] / size
            own.append("links " + ("none" if not share else "some" if share < 0.5 else "most"))
        else:
            own.append("size none")
        if sizes[i] > size:
            own.append("below " + ("tiny" if sizes[i] < 40 else "short" if sizes[i] < 200 else "long" if sizes[i] < 1000 else "much"))
            share = linked[i] / sizes[i]
            own.append("below links " + ("none" if not share else "some" if share < 0.5 else "most"))
            own.append("below long " + ("none" if not long[i] else "one" if long[i] == 1 else "more"))
        if i:
            own.append(f"{tag} {own[-1] if not size else 'long' if long_own[i] else 'short'}")
        if not size:
            share = sizes[i] / max(1, sizes[0])
            own.append("share " + ("small" if share < 0.1 else "some" if share < 0.35 else "large" if share < 0.7 else "most"))
        features.append(own)
    runs = [(node, text) for node, parts in builder.runs if (text := " ".join("".join(parts).split()))]
    return Page(builder.parents, features, runs, builder.marks)


@dataclass
class Model:
    """Weights of features for label 1 (label 0 has none), and log potentials of (parent's label, child's label)."""

    weights: dict[str, float]
    edges: list[list[float]]


def marginals(page: Page, model: Model) -> tuple[list[float], list[list[float]]]:
    """P(node is content) for every node, and the expected counts of the four kinds of edges.

    Parents stand before children, so one backward and one forward sweep send
    all messages; each is kept as a log ratio (label 1 to label 0).
    """
    (e00, e01), (e10, e11) = [[exp(x) for x in row] for row in model.edges]
    weight, parents = model.weights.get, page.parents
    n = len(parents)
    local = [sum(weight(f, 0.0) for f in own) for own in page.features]
    up = [0.0] * n  # message of a node to its parent
    below = local[:]  # own potential and the messages from all children
    for i in range(n - 1, 0, -1):
        odds = exp(max(-50.0, min(50.0, below[i])))
        up[i] = log((e10 + e11 * odds) / (e00 + e01 * odds))
        below[parents[i]] += up[i]
    belief, counts = below[:], [[0.0, 0.0], [0.0, 0.0]]
    out = [1 / (1 + exp(-max(-50.0, min(50.0, belief[0]))))]
    for i in range(1, n):
        parent = parents[i]
        others = exp(max(-50.0, min(50.0, belief[parent] - up[i])))
        belief[i] = below[i] + log((e01 + e11 * others) / (e00 + e10 * others))
        out.append(1 / (1 + exp(-max(-50.0, min(50.0, belief[i])))))
        odds = exp(max(-50.0, min(50.0, below[i])))
        p00, p01, p10, p11 = e00, e01 * odds, e10 * others, e11 * others * odds
        total = p00 + p01 + p10 + p11
        counts[0][0] += p00 / total
        counts[0][1] += p01 / total
        counts[1][0] += p10 / total
        counts[1][1] += p11 / total
    return out, counts


def labels(page: Page) -> list[int]:
    """Labels from the marks of a labelled page: a mark holds below it until the next one; what holds content is content."""
    out = []
    for mark, parent in zip(page.marks, page.parents):
        out.append(mark if mark is not None else out[parent] if parent >= 0 else 0)
    for i in range(len(out) - 1, 0, -1):
        if out[i]:
            out[page.parents[i]] = 1
    return out


class Forest:
    """All labelled pages side by side, for message passing over all trees at once, one depth after the other."""

    def __init__(self, pages: list[Page]):
        begins = np.cumsum([0] + [len(p.parents) for p in pages])
        self.truth = np.concatenate([labels(p) for p in pages]) if pages else np.zeros(0, dtype=np.int64)
        self.parents = np.concatenate([np.where(np.array(p.parents) < 0, -1, np.array(p.parents) + a) for p, a in zip(pages, begins)])
        depth = np.zeros(len(self.parents), dtype=np.int64)
        for i, parent in enumerate(self.parents.tolist()):
            if parent >= 0:
                depth[i] = depth[parent] + 1
        self.levels = [np.flatnonzero(depth == d) for d in range(int(depth.max()) + 1)]
        self.names = sorted({f for p in pages for own in p.features for f in own})
        number = {f: i for i, f in enumerate(self.names)}
        each = [own for p in pages for own in p.features]
        self.node = np.repeat(np.arange(len(each)), [len(own) for own in each])
        self.feature = np.array([number[f] for own in each for f in own])

    def expected(self, weights: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The marginals of all nodes, and the expected counts of the four kinds of edges (as ``marginals`` has them)."""
        (e00, e01), (e10, e11) = np.exp(edges)
        below = np.bincount(self.node, weights[self.feature], minlength=len(self.parents))
        up = np.zeros_like(below)
        for own in self.levels[:0:-1]:
            odds = np.exp(np.clip(below[own], -50, 50))
            up[own] = np.log((e10 + e11 * odds) / (e00 + e01 * odds))
            np.add.at(below, self.parents[own], up[own])
        belief, counts = below.copy(), np.zeros((2, 2))
        for own in self.levels[1:]:
            others = np.exp(np.clip(belief[self.parents[own]] - up[own], -50, 50))
            belief[own] = below[own] + np.log((e01 + e11 * others) / (e00 + e10 * others))
            odds = np.exp(np.clip(below[own], -50, 50))
            kinds = np.stack([e00 * np.ones_like(odds), e01 * odds, e10 * others, e11 * others * odds])
            counts += (kinds / kinds.sum(axis=0)).sum(axis=1).reshape(2, 2)
        return 1 / (1 + np.exp(-np.clip(belief, -50, 50))), counts

    def observed(self) -> np.ndarray:
        counts, own = np.zeros((2, 2)), np.flatnonzero(self.parents >= 0)
        np.add.at(counts, (self.truth[self.parents[own]], self.truth[own]), 1)
        return counts


def train(pages: list[str], rounds: int = 400, rate: float = 0.3, ridge: float = 0.0002) -> Model:
    """Gradient ascent (with Adagrad steps) on the mean log likelihood of labelled pages."""
    forest = Forest([parse(x) for x in pages])
    weights, edges, truth = np.zeros(len(forest.names)), np.zeros((2, 2)), forest.observed()
    squares, edge_squares = np.full(len(weights), 1e-8), np.full((2, 2), 1e-8)
    for _ in range(rounds):
        found, counts = forest.expected(weights, edges)
        gap = forest.truth - found
        for now, g, held in (
            (weights, np.bincount(forest.feature, gap[forest.node], minlength=len(weights)), squares),
            (edges, truth - counts, edge_squares),
        ):
            g = g / len(pages) - ridge * now
            held += g * g
            now += rate * g / np.sqrt(held)
    return Model(dict(zip(forest.names, weights.tolist())), edges.tolist())


@cache
def default_model() -> Model:
    """The model trained on the written pages; the same weights in every process, fitted once in each that asks."""
    from emporia.llm.labelled_pages import labelled_pages

    return train(labelled_pages())


def main_text(html: str, model: Model) -> str:
    """The content blocks of a page, each with single spaces, joined by one space."""
    page = parse(html)
    found, _ = marginals(page, model)
    return " ".join(text for node, text in page.runs if found[node] >= 0.5)


def extract(pages: DataFrame, model: Model | None = None, keep: list[str] | None = None) -> DataFrame:
    """``pages`` (column html) with ``text``, the main text, and ``n_chars``, its code points.

    A null or empty page, or one without content, gives an empty text; repeated
    rows give the same text each. A very long page is read whole, with memory
    in proportion to it. An empty table gives no rows. An input column called
    text or n_chars is replaced.
    """
    model = default_model() if model is None else model

    def fn(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = [main_text(x.decode(errors="replace"), model) for x in utf8(batch.column("html"))]
        return [pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())]

    new = {"text": "string", "n_chars": "bigint"}
    return map_batches(pages.drop(*new), fn, new, [c for c in (keep or pages.columns) if c not in new])
