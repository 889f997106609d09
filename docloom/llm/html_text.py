"""Main text of web pages by a tree-structured graphical model.

Nodes are the block elements of a page and the runs of text in them; each is content or
not.  A node's own evidence (tag, class and id words, lengths, links) gives its potential,
and each pair of parent and child has one that depends on the kind of the child.
Sum-product messages up and down the tree give every node's exact marginal; runs of text
whose marginal is at least one half are kept.  All potentials are learned by maximum
likelihood from labelled pages (``labelled_pages``).
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import Shared, slices
from docloom.llm.labelled_pages import MARK, composed_pages

#: Pages of the table that are learned from, besides the composed ones; a hash of the id chooses them.
MOST_PAGES = 400
#: Most features of the model; rarer ones than LEAST_NODES nodes are left out.
MOST_FEATURES, LEAST_NODES = 4000, 3
ROUNDS, RATE, PENALTY = 250, 0.2, 1e-4

# Fixed values of HTML: elements that break the text, that have no end tag, whose content is not text.
BLOCKS = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header html label legend li main menu nav ol option p pre search section select "
    "summary table tbody td textarea tfoot th thead tr ul caption".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OPAQUE = frozenset("script style head title template noscript iframe svg math object canvas audio video".split())
RAW = frozenset(("script", "style"))
# An opening tag ends these open elements, if they are nearer than the elements after the colon.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody", "tr", "td", "th"), ("table",)),
    "tfoot": (("thead", "tbody", "tr", "td", "th"), ("table",)),
    "option": (("option",), ("select",)),
}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # A quote opens a value only behind =, and closes it only where the attribute can end: else the tag ends at the next >.
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*+\"[^\"]*\"(?=[\s/>]|\Z)|=\s*+'[^']*'(?=[\s/>]|\Z)|=)*+)(?:>|\Z)|[^<]+|<",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+(?![a-z])")
#: Parts that are content or not as a whole when a page of the table is labelled by its own marks.
_INSIDE, _OUTSIDE = ("article", "main"), ("nav", "aside", "footer", "form", "button", "select")


@dataclass
class Page:
    """A page as a tree in document order; node 0 is the root and text runs are leaves."""

    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    tag: list[str] = field(default_factory=lambda: ["#root"])
    attributes: list[str] = field(default_factory=lambda: [""])
    text: list[str] = field(default_factory=lambda: [""])  # of text runs, white space made single
    linked: list[int] = field(default_factory=lambda: [0])  # signs inside links

    def add(self, parent: int, tag: str, attributes: str = "", text: str = "", linked: int = 0) -> int:
        for column, value in (
            (self.parent, parent), (self.depth, self.depth[parent] + 1), (self.tag, tag),
            (self.attributes, attributes), (self.text, text), (self.linked, linked),
        ):
            column.append(value)
        return len(self.parent) - 1


def _endings(source: str, name: str) -> dict[int, int]:
    """For the opening tags of ``name`` (by the place behind the name) that have an end tag, the place behind that."""
    found, opened = {}, []
    for tag in re.finditer(rf"<(/?){name}(?=[\s/>]|\Z)", source, re.IGNORECASE):
        if not tag.group(1):
            opened.append(tag.end())
        elif opened:
            stop = source.find(">", tag.end())
            found[opened.pop()] = stop + 1 if stop >= 0 else len(source)
    return found


def parse(source: str | None) -> Page:
    """Read tag soup: unclosed, stray and cut-off tags are repaired, never an error.

    Scripts and styles without an end tag reach to the end of the page; of other elements
    whose content is not text (noscript, svg, video ...) only the tag is skipped then.
    """
    page, source = Page(), source or ""
    names, nodes = ["#root"], [0]  # open elements and the tree node each belongs to
    words: list[str] = []
    linked = links = at = 0
    endings: dict[str, dict[int, int]] = {}

    def end_run() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(words)).split())
        if text:
            page.add(nodes[-1], "#text", "", text, min(linked, len(text)))
        words.clear()
        linked = 0

    def close(down_to: int) -> None:
        nonlocal links
        if any(name in BLOCKS for name in names[down_to:]):
            end_run()
        links -= names[down_to:].count("a")
        del names[down_to:], nodes[down_to:]

    def nearest(wanted: tuple[str, ...], stops: tuple[str, ...] = ()) -> int:
        for i in range(len(names) - 1, 0, -1):
            if names[i] in wanted:
                return i
            if names[i] in stops:
                break
        return 0

    while match := _TOKEN.match(source, at):
        at = match.end()
        slash, name, rest = match.groups()
        if name is None:
            token = match.group()
            if token.startswith("<![CDATA["):
                token = html.escape(token[9:].removesuffix("]]>"))
            if token[0] != "<" or token == "<" or match.group().startswith("<![CDATA["):
                words.append(token)
                linked += len(token) if links else 0
            continue
        name = name.lower()
        if slash:
            if found := nearest((name,), () if name in BLOCKS else tuple(BLOCKS)):
                close(found)
            continue
        if name in RAW:
            ending = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
            at = ending.end() if ending else len(source)
            continue
        if name in OPAQUE:
            if not rest.rstrip().endswith("/"):
                if name not in endings:
                    endings[name] = _endings(source, name)
                at = max(at, endings[name].get(match.end(2), at))
            continue
        if name == "br" or name == "hr":
            words.append(" ")
            if name == "hr":
                end_run()
            continue
        if name in VOID:
            continue
        if name in BLOCKS:
            end_run()
            if name not in ("button", "label", "option", "select", "textarea") and (found := nearest(("p",), ("button", "td", "th", "table"))):
                close(found)
            ended, stops = CLOSES.get(name, ((), ()))
            while ended and (found := nearest(ended, stops)):
                close(found)
            if rest.rstrip().endswith("/"):
                rest = rest.rstrip()[:-1]
            nodes.append(page.add(nodes[-1], name, rest))
            names.append(name)
        elif not rest.rstrip().endswith("/"):
            names.append(name)
            nodes.append(nodes[-1])
            links += name == "a"
    end_run()
    return page


def _bucket(n: float, *limits: float) -> int:
    return sum(n >= x for x in limits)


def describe(page: Page) -> tuple[list[list[str]], list[int]]:
    """Features of every node, and the kind of its bond to its parent."""
    n = len(page.parent)
    size, linked = [len(t) for t in page.text], list(page.linked)
    paragraphs, kids = [0] * n, [0] * n
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        size[up] += size[i]
        linked[up] += linked[i]
        kids[up] += 1
        paragraphs[up] += page.tag[i] == "p"
    total, before = max(1, size[0]), 0
    found, kinds = [], []
    for i in range(n):
        tag, length = page.tag[i], size[i]
        own = ["bias", "tag:" + tag]
        density = linked[i] / length if length else 0.0
        if tag == "#text":
            text = page.text[i]
            outer = page.tag[page.parent[i]]
            spaces = text.count(" ")
            own += [
                "in:" + outer, f"words:{_bucket(spaces, 1, 3, 8, 20, 60)}", f"linked:{_bucket(density, 0.01, 0.3, 0.7)}",
                f"ends:{text[-1] in '.!?:;…。'}", f"place:{_bucket(before / total, 0.02, 0.1, 0.5, 0.9, 0.98)}",
            ]
            if text[0] in "©®" or "©" in text[:40]:
                own.append("sign:©")
            before += length
            kinds.append(0 if outer[0] == "h" and outer[1:].isdigit() else 1 if outer == "p" else 2)
        else:
            own += [
                f"share:{_bucket(length / total, 0.02, 0.1, 0.3, 0.6)}", f"links:{_bucket(density, 0.01, 0.3, 0.7)}",
                f"paragraphs:{_bucket(paragraphs[i], 1, 2, 4)}", f"depth:{_bucket(page.depth[i], 2, 3, 4, 6)}",
            ]
            for key, *values in _ATTRIBUTE.findall(page.attributes[i]):
                key, value = key.lower(), "".join(values)
                if key in ("class", "id", "role", "itemprop", "aria-label"):
                    own += {"name:" + w.lower() for w in _NAME_WORD.findall(value) if len(w) > 1}
                elif key == "hidden" or key == "style" and "none" in value or key == "aria-hidden" and value == "true":
                    own.append("hidden")
            kinds.append(3 if tag == "p" else 4 if tag in ("li", "td", "dd", "dt") else 5 if tag in ("div", "section") else 6)
        found.append(own)
    return found, kinds


KINDS = 7


@dataclass
class Forest:
    """The nodes of many pages; arrays over nodes, and (node, feature) pairs."""

    parent: np.ndarray
    depth: np.ndarray
    kind: np.ndarray
    node: np.ndarray
    feature: np.ndarray

    def scores(self, weight: np.ndarray) -> np.ndarray:
        return np.bincount(self.node, weight[self.feature], len(self.parent))

    def levels(self) -> list[np.ndarray]:
        order = np.argsort(self.depth, kind="stable")
        return np.split(order, np.flatnonzero(np.diff(self.depth[order])) + 1)


def marginals(forest: Forest, score: np.ndarray, bonds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum-product on every tree: P(node is content), and P(parent, child) of every bond.

    ``bonds[kind, parent, child]`` are log potentials.  Messages go up from the deepest
    level and down again, all nodes of a level at once.
    """
    n = len(score)
    own = np.stack([np.zeros(n), score], axis=1)
    up, message = np.zeros((n, 2)), np.zeros((n, 2))
    levels = forest.levels()
    for nodes in reversed(levels[1:]):
        inner = (own[nodes] + up[nodes])[:, None, :] + bonds[forest.kind[nodes]]
        message[nodes] = np.logaddexp(inner[:, :, 0], inner[:, :, 1])
        for y in (0, 1):
            up[:, y] += np.bincount(forest.parent[nodes], message[nodes, y], n)
    down, pair = np.zeros((n, 2)), np.zeros((n, 2, 2))
    for nodes in levels[1:]:
        outer = forest.parent[nodes]
        rest = own[outer] + up[outer] + down[outer] - message[nodes]
        joint = rest[:, :, None] + bonds[forest.kind[nodes]]
        down[nodes] = np.logaddexp(joint[:, 0, :], joint[:, 1, :])
        both = joint + (own[nodes] + up[nodes])[:, None, :]
        both = np.exp(both - both.max(axis=(1, 2), keepdims=True))
        pair[nodes] = both / both.sum(axis=(1, 2), keepdims=True)
    belief = own + up + down
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -700, 700))), pair


@dataclass
class Model:
    """Potentials by feature and by kind of bond; bounded by MOST_FEATURES."""

    features: dict[str, int]
    weight: np.ndarray
    bonds: np.ndarray

    def forest(self, pages: list[tuple[list[int], list[int], list[list[str]], list[int]]]) -> Forest:
        parent, depth, kind, node, feature, start = [], [], [], [], [], 0
        for parents, depths, described, kinds in pages:
            parent += [p + start if p >= 0 else -1 for p in parents]
            depth += depths
            kind += kinds
            for i, names in enumerate(described, start):
                known = [self.features[f] for f in names if f in self.features]
                node += [i] * len(known)
                feature += known
            start += len(parents)
        return Forest(*(np.array(x, np.int64) for x in (parent, depth, kind, node, feature)))

    def texts(self, sources: list[str | None]) -> list[str]:
        """The main text of each page; empty if there is none."""
        pages = [parse(s) for s in sources]
        forest = self.forest([(p.parent, p.depth, *describe(p)) for p in pages])
        chance, _ = marginals(forest, forest.scores(self.weight), self.bonds)
        out, start = [], 0
        for page in pages:
            kept = chance[start : start + len(page.parent)] >= 0.5
            out.append("\n\n".join(t for t, k in zip(page.text, kept, strict=True) if t and k))
            start += len(page.parent)
        return out


Labelled = tuple[list[int], list[int], list[list[str]], list[int], list[int]]


def _label(page: Page, content: list[bool]) -> Labelled:
    """A training page: a block is content if most of its text is."""
    size, good = [len(t) for t in page.text], [len(t) * c for t, c in zip(page.text, content, strict=True)]
    for i in range(len(size) - 1, 0, -1):
        size[page.parent[i]] += size[i]
        good[page.parent[i]] += good[i]
    described, kinds = describe(page)
    return page.parent, page.depth, described, kinds, [int(2 * g > s) for g, s in zip(good, size, strict=True)]


def label_composed(source: str) -> Labelled:
    """A page whose content blocks carry the attribute MARK; the mark itself is taken away."""
    page = parse(source)
    marked = [MARK in a for a in page.attributes]
    page.attributes = [a.replace(MARK, "") for a in page.attributes]
    content = list(marked)
    for i in range(1, len(content)):
        content[i] = marked[i] or content[page.parent[i]] and page.tag[i] == "#text"
    return _label(page, content)


def label_by_marks(source: str | None) -> Labelled | None:
    """A page of the table by its own semantic elements; None if it has no article or main element."""
    page = parse(source)
    if not any(t in _INSIDE for t in page.tag):
        return None
    state = [False] * len(page.tag)
    for i in range(1, len(state)):
        tag = page.tag[i]
        state[i] = tag in _INSIDE or state[page.parent[i]] and tag not in _OUTSIDE
    return _label(page, state)


def learn(pages: list[Labelled]) -> Model:
    """Maximum likelihood by gradient ascent: observed minus expected, expectations from the messages."""
    counts = Counter(f for p in pages for names in p[2] for f in names)
    ranked = sorted((f for f, n in counts.items() if n >= LEAST_NODES), key=lambda f: (-counts[f], f))
    model = Model({f: i for i, f in enumerate(ranked[:MOST_FEATURES])}, np.zeros(min(len(ranked), MOST_FEATURES)), np.zeros((KINDS, 2, 2)))
    forest = model.forest([p[:4] for p in pages])
    label = np.array([y for p in pages for y in p[4]])
    child = np.flatnonzero(forest.parent >= 0)
    seen = np.zeros((KINDS, 2, 2))
    np.add.at(seen, (forest.kind[child], label[forest.parent[child]], label[child]), 1)
    steps = [np.zeros_like(model.weight), np.zeros_like(model.bonds)]
    size = max(1, len(pages))
    for _ in range(ROUNDS):
        chance, pair = marginals(forest, forest.scores(model.weight), model.bonds)
        expected = np.zeros((KINDS, 2, 2))
        np.add.at(expected, forest.kind[child], pair[child])
        slopes = [
            np.bincount(forest.feature, (label - chance)[forest.node], len(model.weight)) / size - PENALTY * model.weight,
            (seen - expected) / size - PENALTY * model.bonds,
        ]
        for value, slope, step in zip((model.weight, model.bonds), slopes, steps, strict=True):
            step += slope * slope
            value += RATE * 4 * slope / np.sqrt(step + 1e-8)
    return model


def fit(pages: DataFrame, id_column: str = "page_id", html_column: str = "html") -> Model:
    """Learn from composed pages and from about MOST_PAGES of ``pages`` that mark their content themselves (runs a job)."""
    share = MOST_PAGES / max(MOST_PAGES, pages.count())
    picked = pages.select(F.xxhash64(F.col(id_column).cast("string")).alias("h"), F.col(html_column).alias("html"))
    picked = picked.where(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            found = [label_by_marks(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([cloudpickle.dumps(f) for f in found], pa.binary())], ["h", "page"])

    rows = picked.mapInArrow(scan, "h long, page binary").collect()
    own = [cloudpickle.loads(r["page"]) for r in sorted(rows, key=lambda r: (r["h"], bytes(r["page"])))]
    return learn([label_composed(s) for s in composed_pages()] + [p for p in own if p is not None])


def extract(pages: DataFrame, model: Model, html_column: str = "html", output: str = "text") -> DataFrame:
    """``pages`` with the main text of the whole ``html_column`` in ``output``.

    Character references are decoded, white space inside a block becomes one space, and
    blocks are joined in page order by two line ends.  A null or empty page, and one
    without content, has the empty text.  All rows and other columns stay (``output`` is
    replaced, ``html_column`` is dropped); nothing is shuffled.
    """
    shared = Shared(pages.sparkSession, model)
    pages = pages.drop(output) if output != html_column else pages
    kinds = [c for c in pages.columns if c != html_column]
    schema = pages.select(*kinds, F.lit("").alias(output)).schema

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.get()
        for batch in slices(batches, html_column, 2 << 20):
            texts = pa.array(own.texts(batch.column(batch.schema.names.index(html_column)).to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.select(kinds).columns, texts], [*kinds, output])

    return pages.mapInArrow(scan, schema)
