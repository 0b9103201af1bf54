"""Main text of web pages by a tree-structured graphical model.

The nodes of a page's tree are its block elements and the runs of text in them. Each node is
content or not. A node has weights for its features (tag, words of class, id and role,
length, links), an edge has weights for the labels of parent and child by the child's kind.
Sum-product messages run from the leaves to the root and back; the resulting marginals are
exact, because the graph is a tree. Weights are trained by the gradient of the likelihood,
which needs the same marginals, on the pages of ``labelled_pages``. Runs of text whose
marginal exceeds one half are the main text.

All pages of a batch are one forest: messages of one depth are computed together. A map over
whole pages, without a shuffle; only the weights are sent.

Reading takes time in proportion to the page, however deep its elements lie.

Defined results: a null or empty page, and one without content, gives an empty text; very long
pages are read whole, one at a time; broken markup is read as far as it goes (unclosed elements end with their parent, a head also before
what cannot stand in it, a button, select or drawing before a part of the page; an unfinished
tag at the end is dropped, a bare "<" is text); repeated rows give equal results; an empty table
gives no rows; other columns stay.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from turnloom.llm.common import ship, table
from turnloom.llm.labelled_pages import labelled_pages

COPIES = 6
STEPS = 600
RATE = 0.1
DECAY = 0.0005
BATCH_CHARS = 2_000_000

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>"
    r"|</?[a-zA-Z][^>]*+(?:>|\Z)|(?P<text>[^<]++|<)",
    re.DOTALL,
)
NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Elements by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea xmp iframe noembed noframes".split())
SKIPPED = set("head template noscript svg math object select button".split())
HEAD_PARTS = set("base basefont bgsound head html link meta noframes noscript script style template title".split())
DRAWINGS = set("svg math".split())
# Parts of a page, which stand in no button, select or drawing.
PAGE_PARTS = set("article aside body footer form header main nav section table".split())
# By these a browser ends a drawing, but for text that stands in its INSETS.
NOT_DRAWN = set("blockquote center dd div dl dt h1 h2 h3 h4 h5 h6 li menu ol p pre ul".split())
INSETS = set("foreignobject desc annotation-xml".split())
KINDS = {
    "main": "article main",
    "section": "section div center figure details hgroup",
    "paragraph": "p blockquote pre address figcaption summary",
    "heading": "h1 h2 h3 h4 h5 h6",
    "list": "ul ol dl menu",
    "item": "li dt dd",
    "table": "table thead tbody tfoot tr td th caption",
    "nav": "nav",
    "header": "header",
    "footer": "footer",
    "aside": "aside dialog",
    "form": "form fieldset legend label",
    "root": "html body",
}
HINTS = {
    "content": "article content main post entry story body text",
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs toc pagination",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo banner",
    "foot": "footer foot copyright legal contentinfo",
    "head": "header head masthead topbar",
    "side": "sidebar side aside related recommended widget complementary",
    "comment": "comment comments reply replies discussion disqus respond",
    "notice": "notice cookie cookies consent alert modal popup newsletter subscribe message",
    "share": "share social sharing follow",
    "field": "form search login signup",
}
AFFIX = 4  # letters that a hint has at least, to count as part of a longer word
KIND_OF = {tag: kind for kind, tags in KINDS.items() for tag in tags.split()}
HINT_OF = {word: hint for hint, words in HINTS.items() for word in words.split()}
ENDS_ITSELF = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
}
STOPS = ("ul", "ol", "dl", "table", "body", "html", "menu")
RIGHTS = re.compile(r"©|\(c\)|copyright|rights reserved", re.IGNORECASE)

KIND_LIST = [*KINDS, "text"]
FEATURES = [
    "one", *(f"kind {k}" for k in KIND_LIST), *(f"in {k}" for k in KINDS), *(f"hint {h}" for h in HINTS),
    "words 1", "words 2", "words 5", "words 10", "words 20", "words 40", "all links", "some links", "stop",
    "rights",
]
PLACE = {name: k for k, name in enumerate(FEATURES)}


@dataclass
class Page:
    """Nodes in page order (parents first); ``text`` is set for runs of text only."""

    parent: list[int] = field(default_factory=list)
    kind: list[str] = field(default_factory=list)
    features: list[list[str]] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    marked: list[int] = field(default_factory=list)

    def add(self, parent: int, kind: str, features: list[str], text: str | None, marked: int) -> int:
        self.parent.append(parent)
        self.kind.append(kind)
        self.features.append(features)
        self.text.append(text)
        self.marked.append(marked)
        return len(self.parent) - 1


class Open:
    """Names of open elements, outermost first, and the places of each name among them."""

    def __init__(self, names: list[str] | None = None) -> None:
        self.names: list[str] = []
        self.places: dict[str, list[int]] = {}
        for name in names or []:
            self.push(name)

    def __len__(self) -> int:
        return len(self.names)

    def push(self, name: str) -> None:
        self.places.setdefault(name, []).append(len(self.names))
        self.names.append(name)

    def cut(self, depth: int) -> None:
        for name in self.names[depth:]:
            self.places[name].pop()
        del self.names[depth:]

    def last(self, *names: str) -> int:
        """The innermost place of any of ``names``, -1 if none is open."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def ended_by(self, tag: str) -> int:
        """The place of the item or cell that the start of ``tag`` ends, -1 if there is none."""
        ended = self.last(*ENDS_ITSELF.get(tag, ()))
        return ended if ended > self.last(*STOPS) else -1


@lru_cache(maxsize=100_000)
def hint_of(word: str) -> str | None:
    """The hint of ``word``; a longer word has that of its end, else of its start."""
    parts = [word, *(word[k:] for k in range(1, len(word) - AFFIX + 1))]
    parts += [word[:k] for k in range(len(word) - 1, AFFIX - 1, -1)]
    return next((HINT_OF[part] for part in parts if part in HINT_OF), None)


def ends_skipped(skipped: Open, tag: str, above: Open) -> bool:
    """Whether the start of ``tag`` ends the first of ``skipped``; ``above`` are the elements
    that it stands in."""
    outer = skipped.names[0]
    if tag == "body" or (skipped.names == ["head"] and tag not in HEAD_PARTS):
        return True
    if skipped.last("template") >= 0:
        return False
    drawn = outer in DRAWINGS and skipped.last(*INSETS) < 0
    if outer in ("button", "select") or drawn:
        if tag in PAGE_PARTS or tag == outer and outer not in DRAWINGS:
            return True
    if drawn and tag in NOT_DRAWN:
        return True
    if skipped.names == ["head", "noscript"] and tag in PAGE_PARTS:
        return True
    # The next item or cell ends the one that the skipped element stands in.
    if tag in ENDS_ITSELF and skipped.last(*STOPS, *ENDS_ITSELF[tag]) < 0:
        return above.ended_by(tag) >= 0
    return False


def read_page(source: str | None) -> Page:
    """The tree of block elements and runs of text; decoded, white space made single."""
    page = Page()
    nodes = [page.add(-1, "root", ["one", "kind root"], None, 0)]  # of the elements in ``stack``
    stack = Open([""])
    run: list[str] = []
    linked = 0  # characters of the run inside links
    link_depth = 0
    skipped = Open()  # the skipped element and what is open in it
    unclosed: set[str] = set()  # raw elements without an end in the rest of the page

    def flush() -> None:
        nonlocal linked
        words = entities.unescape("".join(run)).split()
        if words:
            text = " ".join(words)
            top = nodes[-1]
            found = ["one", "kind text", f"in {page.kind[top]}"]
            found += [f"words {n}" for n in (1, 2, 5, 10, 20, 40) if len(words) >= n]
            if linked:
                found.append("all links" if linked * 10 >= 8 * len(text) else "some links")
            if text[-1] in ".!?:;\"'":
                found.append("stop")
            if RIGHTS.search(text):
                found.append("rights")
            page.add(top, "text", found, text, page.marked[top])
        run.clear()
        linked = 0

    def pop_to(depth: int) -> None:
        nonlocal link_depth
        flush()
        stack.cut(depth)
        del nodes[depth:]
        if link_depth > len(stack):
            link_depth = 0

    at, source = 0, source or ""
    while found := TOKEN.match(source, at):
        at = found.end()
        text, tag = found["text"], (found["tag"] or "").lower()
        if skipped:
            if text is not None:
                ended = skipped.names == ["head"] and not text.isspace()
            elif found["close"]:
                ended = skipped.last(tag) < 0 and stack.last(tag) >= 0
            else:
                ended = bool(tag) and ends_skipped(skipped, tag, stack)
            if ended:
                skipped.cut(0)
        if text is not None:
            if not skipped:
                run.append(text)
                linked += len(text) if link_depth else 0
        elif not tag:
            continue
        elif tag in RAW and not found["close"]:
            # In a drawing they may be empty or unclosed elements like others.
            drawn = skipped.last(*DRAWINGS) >= 0
            if tag not in unclosed and not (drawn and found["rest"].endswith("/")):
                end = re.compile(rf"</{tag}[\s/>]", re.IGNORECASE).search(source, at)
                if end is not None:
                    at = end.start()
                else:
                    unclosed.add(tag)
            if tag in unclosed and not drawn:
                at = len(source)
        elif skipped:
            if found["close"]:
                if skipped.last(tag) >= 0:
                    skipped.cut(skipped.last(tag))
            elif (tag in KIND_OF or tag in SKIPPED or tag in INSETS) and not found["rest"].endswith("/"):
                skipped.push(tag)
        elif found["close"]:
            if tag in KIND_OF:
                if stack.last(tag) > 0:
                    pop_to(stack.last(tag))
            elif tag == "a":
                link_depth = 0
        elif tag in SKIPPED:
            if not found["rest"].endswith("/"):
                skipped.push(tag)
        elif tag in KIND_OF:
            if stack.names[-1] == "p":
                pop_to(len(stack) - 1)
            if tag in ENDS_ITSELF and stack.ended_by(tag) > 0:
                pop_to(stack.ended_by(tag))
            flush()
            top, kind, rest = nodes[-1], KIND_OF[tag], found["rest"]
            names = " ".join(a or b or c for a, b, c in NAMED.findall(rest)) if rest else ""
            hints = {f"hint {hint_of(w.lower())}" for w in PART.findall(names)} - {"hint None"}
            marked = 0 if "data-side" in rest else 1 if "data-main" in rest else page.marked[top]
            features = ["one", f"kind {kind}", f"in {page.kind[top]}", *sorted(hints)]
            nodes.append(page.add(top, kind, features, None, marked))
            stack.push(tag)
        elif tag == "a":
            link_depth = len(stack)
        elif tag in VOID:
            run.append(" ")
            if tag == "hr":
                flush()
    flush()
    return page


@dataclass
class Forest:
    """Pages as arrays; ``levels`` are the nodes of each depth from the second on."""

    features: np.ndarray
    at: np.ndarray
    parent: np.ndarray
    kind: np.ndarray
    levels: list[np.ndarray]
    size: int

    @classmethod
    def of(cls, pages: list[Page]) -> Forest:
        parent, depth, kind, names, at = [], [], [], [], []
        for page in pages:
            base = len(parent)
            for k, p in enumerate(page.parent):
                depth.append(0 if p < 0 else depth[base + p] + 1)
                parent.append(base + max(p, 0))
                kind.append(KIND_LIST.index(page.kind[k]))
                names += [PLACE[n] for n in page.features[k]]
                at += [base + k] * len(page.features[k])
        depth = np.array(depth)
        order = np.argsort(depth, kind="stable")
        edges = np.searchsorted(depth[order], np.arange(1, depth.max(initial=0) + 2))
        levels = [order[a:b] for a, b in zip(edges[:-1], edges[1:])]
        return cls(np.array(names), np.array(at), np.array(parent), np.array(kind), levels, len(parent))


class TreeModel:
    """Weights of nodes (features) and of edges (kind of child, label of parent and child)."""

    def __init__(self) -> None:
        self.node = np.zeros(len(FEATURES))
        self.edge = np.zeros((len(KIND_LIST), 2, 2))

    def marginals(self, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
        """Of each node (content), and of each node's edge to its parent [parent, child]."""
        n = forest.size
        up = np.zeros((n, 2))  # potential of a node and all below it
        up[:, 1] = np.bincount(forest.at, self.node[forest.features], n)
        edge = self.edge[forest.kind]
        sent = np.zeros((n, 2))  # message to the parent, by the parent's label
        for level in reversed(forest.levels):
            sent[level] = np.logaddexp.reduce(edge[level] + up[level][:, None, :], axis=2)
            np.add.at(up, forest.parent[level], sent[level])
        belief, pairs = up.copy(), np.zeros((n, 2, 2))
        for level in forest.levels:
            above = belief[forest.parent[level]] - sent[level]
            joint = above[:, :, None] + edge[level]
            belief[level] += np.logaddexp.reduce(joint, axis=1)
            joint = joint + up[level][:, None, :]
            joint -= np.logaddexp.reduce(joint.reshape(-1, 4), axis=1)[:, None, None]
            pairs[level] = np.exp(joint)
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500))), pairs

    @classmethod
    def trained(cls, pages: list[Page]) -> TreeModel:
        """Gradient steps on the mean likelihood of the labels of all nodes."""
        model, forest = cls(), Forest.of(pages)
        y = np.array([m for page in pages for m in page.marked])
        below = np.concatenate(forest.levels)
        seen = np.zeros_like(model.edge)
        np.add.at(seen, (forest.kind[below], y[forest.parent[below]], y[below]), 1)
        moments = [np.zeros_like(model.node), np.zeros_like(model.edge)]
        for _ in range(STEPS):
            marginal, pairs = model.marginals(forest)
            node = np.bincount(forest.features, (y - marginal)[forest.at], len(FEATURES))
            edge = seen.copy()
            np.subtract.at(edge, forest.kind[below], pairs[below])
            for k, (w, g) in enumerate(((model.node, node), (model.edge, edge))):
                g = g / len(pages) - DECAY * w
                moments[k] += 0.1 * (g * g - moments[k])
                w += RATE * g / (np.sqrt(moments[k]) + 1e-3)
        return model


def trained_model() -> TreeModel:
    return TreeModel.trained([read_page(p) for p in labelled_pages(COPIES)])


def main_texts(model: TreeModel, sources: list[str | None]) -> list[str]:
    pages = [read_page(s) for s in sources]
    if not pages:
        return []
    marginal, _ = model.marginals(Forest.of(pages))
    out, at = [], 0
    for page in pages:
        chosen = marginal[at : at + len(page.text)] > 0.5
        out.append("\n".join(t for t, c in zip(page.text, chosen) if t is not None and c))
        at += len(page.text)
    return out


def extract(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """``pages`` with ``html`` replaced by ``text`` (a column of that name is replaced)."""
    ship(pages.sparkSession)
    model = model or trained_model()
    weights = (model.node, model.edge)
    kept = [f for f in pages.schema.fields if f.name not in ("html", "text")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = TreeModel()
        own.node, own.edge = weights
        for batch in batches:
            texts, part, size = [], [], 0
            for cell in batch.column("html"):
                part.append(cell.as_py())
                size += len(part[-1] or "")
                if size >= BATCH_CHARS:
                    texts += main_texts(own, part)
                    part, size = [], 0
            texts += main_texts(own, part)
            columns = [batch.column(f.name) for f in kept]
            names = [*(f.name for f in kept), "text"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names)

    return pages.select(*[F.col(f"`{f.name}`") for f in kept], "html").mapInArrow(
        read, T.StructType([*kept, T.StructField("text", T.StringType())])
    )


def op8_tree_model(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))
