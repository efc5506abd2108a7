"""Main text of web pages by a tree-structured graphical model over the DOM.

The nodes are the block elements of a page; each is content or not. A node's potential is log-linear in
its tag, the words of its class, id and role, and a little about its text; each parent-child pair has a
potential by the kind of the child. Sum-product messages go up the tree and down again and yield
every node's marginal, exactly, as the graph is a tree. The weights maximise the likelihood of labelled pages:
the gradient is what the labels count less what the marginals expect.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import raws, slices
from .html_pages import labelled_pages

#: Elements whose text is never shown as text.
HIDDEN = frozenset("script style noscript template svg math iframe object select textarea button head title audio video canvas datalist map".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img input".split())
#: A start tag of the second kind ends an open element of the first.
CLOSED_BY_BLOCK = frozenset(["p"])
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table body html".split())
#: Start tags that end an unclosed svg or math, and those that don't end the head.
BREAK_OUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var article main section header footer nav aside form".split())
IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template head html".split())
#: An attribute as browsers cut it: a name runs to white space, / > or =, so it may hold quotes; a value is quoted or runs to white space or >.
_VALUE = r"""(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*))"""
ATTRIBUTE = re.compile(rf"([^\s/>][^\s/>=]*)(?:\s*=\s*{_VALUE}?)?")
_ATTRIBUTES = r"""(?>(?:[\s/]+|[^\s/>][^\s/>=]*(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*)?)?)*)"""
TOKEN = re.compile(rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</(?:>|[^a-zA-Z>][^>]*(?:>|\Z))|<(/?)([a-zA-Z][^\s/>]*)({_ATTRIBUTES})(?:>|\Z)", re.S)


@dataclass
class Tree:
    """Parents come before children. runs: (node, text) in page order, a run for each block."""

    tag: list[str] = field(default_factory=list)
    words: list[tuple[str, ...]] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    runs: list[tuple[int, str]] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)


def parse(page: str) -> Tree:
    """The block tree of a page, however broken its markup: what is left open ends with the page."""
    t = Tree(["#page"], [()], [-1], [], [0])
    stack, text, inside = [0], [], 0
    hidden: list[str] = []  # open elements that hide their text, and what opened in them
    below: Counter[str] = Counter()

    def flush() -> None:
        if text:
            run = " ".join(html.unescape("".join(text)).split())
            if run:
                t.runs.append((stack[-1], run))
            text.clear()

    def close(tags: tuple[str, ...], within: frozenset[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if t.tag[stack[i]] in tags:
                flush()
                del stack[i:]
                return
            if t.tag[stack[i]] in within:
                return

    at = 0
    search = TOKEN.search
    while True:
        hit = search(page, at)
        piece = page[at : hit.start() if hit else len(page)]
        if hidden == ["head"] and piece.strip():
            hidden.clear()  # text ends the head
        if piece and not hidden:
            text.append(piece)
            if inside:
                t.linked[stack[-1]] += len(piece)
        if not hit:
            break
        at = hit.end()
        name = hit[2]
        if not name:
            continue
        name, ending = name.lower(), bool(hit[1])
        if name in RAW and not ending:
            end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
            gone = page.find(">", end.end() - 1) + 1 if end else 0
            at = (gone or len(page)) if end else len(page)
            continue
        if hidden and not ending:
            if hidden[-1] in ("svg", "math") and name in BREAK_OUT or hidden == ["head"] and name not in IN_HEAD:
                hidden.pop()
            elif name == "body":
                hidden.clear()
        if hidden and ending and name not in hidden:
            if below[name]:
                below[name] -= 1
            elif name not in VOID and any(t.tag[i] == name for i in stack):
                hidden.clear()  # an end tag of what is open around ends what was left open inside
        if name in HIDDEN:
            if not ending:
                if not (name in ("svg", "math") and hit[3].rstrip().endswith("/")):
                    hidden.append(name)
            elif name in hidden:
                del hidden[len(hidden) - 1 - hidden[::-1].index(name) :]
            if not hidden:
                below.clear()
            continue
        if hidden:
            if not ending and name not in VOID:
                below[name] += 1
            continue
        if name in ("br", "hr"):
            text.append(" ")
            if name == "hr":
                flush()
            continue
        if name in INLINE:
            if name == "a":
                inside = 0 if ending else 1
            continue
        if name in VOID:
            continue
        if ending:
            if name == "p" and "p" not in (t.tag[i] for i in stack[-3:]):
                flush()
            close((name,), frozenset(["body"]) if name not in ("body", "html") else frozenset())
            continue
        flush()
        if name in ("html", "body") and name in t.tag:
            continue
        if t.tag[stack[-1]] in CLOSED_BY_BLOCK:
            stack.pop()
        elif name in SAME:
            close(SAME[name], SCOPE)
        found: list[str] = []
        for own in ATTRIBUTE.finditer(hit[3]) if hit[3] else ():
            if own[1].lower() in ("class", "id", "role"):
                found += re.findall(r"[a-z]+", (own[2] or own[3] or own[4] or "").lower())
        t.tag.append(name)
        t.words.append(tuple(dict.fromkeys(found)))
        t.parent.append(stack[-1])
        t.linked.append(0)
        stack.append(len(t.tag) - 1)
        inside = 0
    flush()
    return t


#: Elements that hold others: how much of the page's text lies in them says something.
GROUPS = frozenset("article main section div aside nav header footer form dialog td ul ol".split())


def _features(t: Tree) -> list[list[str]]:
    sizes, copied = [0] * len(t.tag), [False] * len(t.tag)
    for node, run in t.runs:
        sizes[node] += len(run)
        copied[node] |= "©" in run
    whole, titled = list(sizes), [tag == "h1" for tag in t.tag]
    for i in range(len(t.tag) - 1, 0, -1):
        whole[t.parent[i]] += whole[i]
        titled[t.parent[i]] |= titled[i]
    out = []
    for i, tag in enumerate(t.tag):
        own = ["bias", f"tag={tag}", *(f"word={w}" for w in t.words[i])]
        if t.words[i]:
            own.append("marked")
        if whole[i] and tag in GROUPS:
            own += [f"share={4 * whole[i] // (whole[0] + 1)}", f"titled={titled[i]}"]
        if sizes[i]:
            own.append(f"size={0 if sizes[i] < 30 else 1 if sizes[i] < 150 else 2}")
            if 2 * t.linked[i] > sizes[i]:
                own.append("linked")
            if copied[i]:
                own.append("copyright")
        out.append(own)
    return out


SECTIONS = frozenset("article main section div aside nav header footer form dialog body html".split())


def _edge(t: Tree, i: int) -> int:
    """The kind of a parent-child pair: whether the child says something by itself."""
    return 0 if t.words[i] or t.tag[i] in SECTIONS and t.tag[i] != "div" else 1 if t.tag[i] == "div" else 2


class Forest:
    """Trees side by side, as arrays by depth."""

    def __init__(self, trees: list[Tree], vocabulary: dict[str, int], grow: bool = False):
        parent, edge, depth, rows, columns, self.base = [], [], [], [], [], []
        for t in trees:
            base = len(parent)
            self.base.append(base)
            for i, own in enumerate(_features(t)):
                p = t.parent[i]
                parent.append(p + base if p >= 0 else -1)
                edge.append(_edge(t, i))
                depth.append(depth[base + p] + 1 if p >= 0 else 0)
                for f in own:
                    k = vocabulary.setdefault(f, len(vocabulary)) if grow else vocabulary.get(f)
                    if k is not None:
                        rows.append(base + i)
                        columns.append(k)
        self.n, self.parent, self.edge = len(parent), np.array(parent), np.array(edge)
        self.rows, self.columns = np.array(rows, np.int64), np.array(columns, np.int64)
        depth = np.array(depth)
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)

    def unary(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros((self.n, 2))
        out[:, 1] = np.bincount(self.rows, weights[self.columns], self.n)
        return out

    def marginals(self, weights: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(node) of shape (n, 2), and P(parent, node) of (n, 2, 2), by messages up and down."""
        belief, psi = self.unary(weights), pair[self.edge]
        up = np.zeros((self.n, 2))
        for level in self.levels[:0:-1]:
            up[level] = np.logaddexp.reduce(psi[level] + belief[level][:, None, :], axis=2)
            np.add.at(belief, self.parent[level], up[level])
        # below holds what comes from a node's own side; down what comes from above it
        below, down = belief, np.zeros((self.n, 2))
        both = np.zeros((self.n, 2, 2))
        for level in self.levels[1:]:
            p = self.parent[level]
            rest = below[p] + down[p] - up[level]
            joint = rest[:, :, None] + psi[level]
            down[level] = np.logaddexp.reduce(joint, axis=1)
            joint = joint + below[level][:, None, :]
            both[level] = np.exp(joint - np.logaddexp.reduce(joint.reshape(len(level), 4), axis=1)[:, None, None])
        node = below + down
        return np.exp(node - np.logaddexp.reduce(node, axis=1)[:, None]), both


@dataclass
class Model:
    vocabulary: dict[str, int]
    weights: np.ndarray
    pair: np.ndarray

    def content(self, trees: list[Tree]) -> list[np.ndarray]:
        """For each tree, the probability of each node to be content."""
        forest = Forest(trees, self.vocabulary)
        p = forest.marginals(self.weights, self.pair)[0][:, 1]
        return np.split(p, forest.base[1:])


def _labels(t: Tree, main: str) -> np.ndarray:
    """1 for nodes that hold main text, for what holds all of it and what lies between, and around that for
    what holds nothing else; 0 for the others."""
    left, own = main, np.full(len(t.tag), -1)
    for node, run in t.runs:
        at = left.find(run)
        if at == 0 or at == 1 and left[0] == " ":
            left = left[at + len(run) :]
            own[node] = 1
        elif own[node] < 0:
            own[node] = 0
    inside = np.zeros((len(t.tag), 2), int)
    for i in range(len(t.tag) - 1, -1, -1):
        if own[i] >= 0:
            inside[i, own[i]] += 1
        if t.parent[i] >= 0:
            inside[t.parent[i]] += inside[i]
    around = inside[:, 1] == inside[0, 1]  # what holds all main text; the last of these is the innermost
    root = int(np.flatnonzero(around)[-1]) if inside[0, 1] else 0
    around[root] = False
    between = np.where(around, inside[:, 0] == 0, inside[:, 1] > 0)
    return np.where(own >= 0, own, between).astype(int) * (np.array(t.parent) >= 0)


def train(pages: list[tuple[str, str]], steps: int = 150, rate: float = 0.5, decay: float = 1e-4) -> Model:
    """The model that makes the labels of (html, main text) pages likeliest, by exact gradients."""
    trees = [parse(x) for x, _ in pages]
    vocabulary: dict[str, int] = {}
    forest = Forest(trees, vocabulary, grow=True)
    y = np.concatenate([_labels(t, main) for t, (_, main) in zip(trees, pages, strict=True)])
    target = np.bincount(forest.columns, y[forest.rows], len(vocabulary))
    child = np.flatnonzero(forest.parent >= 0)
    counted = np.zeros((3, 2, 2))
    np.add.at(counted, (forest.edge[child], y[forest.parent[child]], y[child]), 1)
    weights, pair = np.zeros(len(vocabulary)), np.zeros((3, 2, 2))
    past_w, past_p = np.full(len(vocabulary), 1e-6), np.full((3, 2, 2), 1e-6)
    for _ in range(steps):
        node, both = forest.marginals(weights, pair)
        g = target - np.bincount(forest.columns, node[forest.rows, 1], len(vocabulary)) - decay * len(pages) * weights
        e = counted.copy()
        np.subtract.at(e, forest.edge[child], both[child])
        e -= decay * len(pages) * pair
        past_w += g * g
        past_p += e * e
        weights += rate * g / np.sqrt(past_w)
        pair += rate * e / np.sqrt(past_p)
    return Model(vocabulary, weights, pair)


def main_texts(pages: list[str], model: Model) -> list[str]:
    trees = [parse(x) for x in pages]
    out = []
    for t, p in zip(trees, model.content(trees), strict=True):
        out.append(" ".join(run for node, run in t.runs if p[node] > 0.5))
    return out


TRAINING_PAGES = 800
_TRAINED: dict[int, Model] = {}


def trained(n: int = TRAINING_PAGES) -> Model:
    if n not in _TRAINED:
        _TRAINED[n] = train(labelled_pages(n))
    return _TRAINED[n]


def extract(pages: DataFrame, model: Model | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), a row per page.

    Null, empty and blank html, and pages without main text, give an empty text. Null ids and urls
    stay. Rows that repeat are treated alike. A page is a task's unit of memory, however long. Other
    columns aren't read.
    """
    model = model or trained()
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, held, size = [], [], 0
            for raw in raws(batch.column(2)):
                held.append((raw or b"").decode("utf-8", "replace"))
                size += len(held[-1])
                if size > 2 << 20:
                    texts += main_texts(held, model)
                    held, size = [], 0
            texts += main_texts(held, model) if held else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(work, f"page_id {kind}, url string, text string, n_chars long")
