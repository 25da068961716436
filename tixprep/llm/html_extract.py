"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element is a node with a hidden label (content or furniture). Its own evidence (tag,
names in class, id and role, text length, link share, punctuation) gives a node potential; each
parent and child share a potential that depends on the kind of child. Sum-product messages go up the
tree and down again and give each node's exact content marginal; blocks whose marginal reaches one
half are the main text.

The weights are fitted by gradient steps on the log-likelihood (marginals of the same messages) of
labelled pages: the hand-made ones, and a bounded sample (``sample_pages``, smallest hash of the
id, at most ``sample_chars`` characters each) of the table whose own ``article`` or ``main`` element
marks the content. Half of these are seen with that mark taken off, so that other evidence counts.

Pages are independent: nothing shuffles, a task holds one batch. Levels of all trees of a step are
worked on together with numpy."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tixprep.llm.batches import arrow_map, column
from tixprep.llm.html_pages import LABELLED_PAGES

SAMPLE_PAGES = 200
SAMPLE_CHARS = 100_000

# Fixed values of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
HIDDEN = RAW | {"head", "noscript", "template", "svg", "object", "canvas", "audio", "video", "select", "datalist", "button", "map"}
# An open head ends at the first other tag or text.
HEAD_CONTENT = set("base basefont bgsound head html link meta noframes noscript script style template title".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr output progress q rp rt ruby "
             "s samp small span strike strong sub sup time tt u var wbr "
             "math annotation annotation-xml maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms "
             "mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
               "hgroup hr main menu nav ol p pre search section table ul".split())
# An opening tag of the key ends an open element of the set, within the given bounds.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"})}
IMPLIED["tfoot"] = IMPLIED["thead"] = IMPLIED["tbody"]

TAG_KINDS = [{"nav", "menu"}, {"header"}, {"footer"}, {"aside"}, {"form", "fieldset", "dialog"}, {"article", "main"}, {"p", "blockquote", "pre"},
             {"h1", "h2", "h3", "h4", "h5", "h6"}, {"ul", "ol", "dl"}, {"li", "dt", "dd"}, {"table", "tbody", "thead", "tfoot", "tr", "td", "th"}, {"div", "section"}, {"figure", "figcaption"},
             {"html", "body", "#root"}]
MARK_KIND = 5  # article, main
NAME_KINDS = [
    {"nav", "navigation", "menu", "navbar", "breadcrumb", "breadcrumbs", "pagination", "pager", "toc"},
    {"header", "masthead", "footer", "copyright", "legal", "imprint", "topbar"},
    {"sidebar", "side", "aside", "widget", "related", "recommended", "popular", "rail"},
    {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "outbrain", "taboola"},
    {"cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "paywall"},
    {"comment", "comments", "reply", "replies", "disqus", "respond", "discussion", "reader", "readers"},
    {"share", "social", "sharing", "tags", "meta", "byline", "search", "login", "form"},
    {"article", "content", "post", "entry", "main", "body", "story", "text", "page"}]

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Node:
    """One block element: its parent's number, tag, evidence of its attributes, and its blocks."""

    parent: int
    tag: str
    names: tuple = ()
    depth: int = 0
    main: bool = False
    chars: int = 0
    links: int = 0
    marks: int = 0
    words: int = 0


@dataclass
class Page:
    nodes: list = field(default_factory=list)
    blocks: list = field(default_factory=list)  # (node, text)


def _names(attrs: str) -> tuple[tuple, dict]:
    if not attrs or attrs.isspace():
        return (), {}
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}
    words = {w.lower() for key in ("class", "id", "role") for w in _NAME.findall(found.get(key, ""))}
    return tuple(k for k, kind in enumerate(NAME_KINDS) if words & kind), found


def parse(text: str) -> Page:
    """Block elements and text blocks of a page, without recursion; broken markup is closed as
    browsers do in the common cases."""
    page = Page()
    page.nodes.append(Node(-1, "#root"))
    # open elements: (tag, node number, whether in a link, whether hidden, label of the training pages)
    stack = [("#root", 0, False, 0, False)]
    run: list[str] = []
    linked = 0

    def flush():
        nonlocal linked
        if run:
            block = " ".join(html.unescape("".join(run)).split())
            if block:
                node = page.nodes[stack[-1][1]]
                page.blocks.append((stack[-1][1], block))
                node.chars += len(block)
                node.links += min(linked, len(block))
                node.words += block.count(" ") + 1
                node.marks += sum(map(block.count, ".,;:!?"))
            run.clear()
        linked = 0

    def pop_to(k):
        """Closes all elements from place ``k`` of the stack on."""
        if any(e[1] != stack[k - 1][1] for e in stack[k:]):
            flush()
        del stack[k:]

    def add(data):
        nonlocal linked
        if stack[-1][0] == "head" and data.strip(" \t\n\f\r"):
            pop_to(len(stack) - 1)
        if data and not stack[-1][3]:
            run.append(data)
            if stack[-1][2]:
                linked += len(data)

    at, n = 0, len(text)
    while at < n:
        m = _TOKEN.search(text, at)
        if m is None:
            add(text[at:])
            break
        add(text[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:  # an end tag
            if tag == "br":
                add(" ")
            place = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag), None)
            if place is not None:
                pop_to(place)
            continue
        if stack[-1][0] == "head" and tag not in HEAD_CONTENT:
            pop_to(len(stack) - 1)
        if tag in CLOSES_P:
            place = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] not in INLINE), None)
            if place is not None and stack[place][0] == "p":
                pop_to(place)
        if tag in IMPLIED:
            ends, bounds = IMPLIED[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in bounds:
                    break
                if stack[k][0] in ends:
                    outer = next((q for q in range(k - 1, 0, -1) if stack[q][0] in bounds or stack[q][0] not in ends), 0)
                    pop_to(outer + 1 if tag in ("tr", "tbody", "thead", "tfoot") else k)
                    break
        _, node, in_link, hidden, main = stack[-1]
        if tag in ("br", "hr", "wbr", "img", "input", "mtd"):
            if tag == "hr":
                flush()
            elif tag != "wbr":
                add(" ")
        if tag in VOID:
            continue
        names, attrs = _names(m[3] or m[6] or "")
        off = tag in HIDDEN or "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "")
        if tag not in INLINE and not (tag in HIDDEN):
            flush()
            main = (main or "data-main" in attrs) and "data-not" not in attrs
            page.nodes.append(Node(node, tag, names, page.nodes[node].depth + 1, main))
            node = len(page.nodes) - 1
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(text, at)
            at = text.find(">", end.end()) + 1 or n if end else n
            continue
        stack.append((tag, node, in_link or tag == "a", hidden or off, main))
    flush()
    return page


def _kind(tag: str) -> int:
    return next((k for k, kind in enumerate(TAG_KINDS) if tag in kind), len(TAG_KINDS))


# Per node: bias, tag kind, name kinds, kinds of the next block element above with a telling tag or name, and
# eight numbers of the own text and that of the whole subtree.
N_TEXT = 8
N_FEATURES = 1 + len(TAG_KINDS) + 1 + len(NAME_KINDS) + N_TEXT
# A child's kind picks its parent-child potential: plain blocks, sections, and children with telling names.
EDGE_KINDS = 4


def _edge_kind(node: Node) -> int:
    if any(k < len(NAME_KINDS) - 1 for k in node.names):
        return 3
    k = _kind(node.tag)
    return 2 if k in (0, 1, 2, 3, 4) else 1 if k in (5, 11, 13) else 0


@dataclass
class Forest:
    """Nodes of many pages: numbers of the parents (-1 at the roots), by depth, and their evidence."""

    parent: np.ndarray
    depth: np.ndarray
    edge: np.ndarray
    x: np.ndarray
    label: np.ndarray


def forest(pages: list[Page], unmark: list[bool] | None = None) -> Forest:
    parent, depth, edge, label, rows = [], [], [], [], []
    for number, page in enumerate(pages):
        base, nodes = len(parent), page.nodes
        sub = np.array([(v.chars, v.links, v.words, v.marks) for v in nodes], float)
        own = sub.copy()
        for k in range(len(nodes) - 1, 0, -1):  # children come after their parents
            sub[nodes[k].parent] += sub[k]
        for k, v in enumerate(nodes):
            f = np.zeros(N_FEATURES)
            f[0] = 1
            kind = _kind(v.tag)
            if unmark and unmark[number] and kind == MARK_KIND:
                kind = 11
            f[1 + kind] = 1
            for name in v.names:
                f[2 + len(TAG_KINDS) + name] = 1
            for place, (chars, links, words, marks) in ((0, own[k]), (4, sub[k])):
                f[-N_TEXT + place:][:4] = (np.log1p(chars) / 5, links / max(chars, 1), marks / max(words, 1), chars > 80)
            rows.append(f)
            parent.append(v.parent + base if v.parent >= 0 else -1)
            depth.append(v.depth)
            edge.append(_edge_kind(v))
            label.append(v.main)
    return Forest(np.array(parent), np.array(depth), np.array(edge), np.array(rows).reshape(-1, N_FEATURES), np.array(label, float))


@dataclass
class Potentials:
    node: np.ndarray  # one weight per feature, for the label content
    edge: np.ndarray  # [kind of child, label of parent, label of child]


def marginals(trees: Forest, p: Potentials) -> tuple[np.ndarray, np.ndarray]:
    """Sum-product on all trees at once: messages upward level by level, then downward. Returns the
    marginals of the nodes [n, 2] and of each node's link to its parent [n, 2, 2]."""
    n = len(trees.parent)
    up = np.zeros((n, 2))
    up[:, 1] = trees.x @ p.node
    levels = [np.flatnonzero(trees.depth == d) for d in range(int(trees.depth.max()) + 1)] if n else []
    to_parent = np.zeros((n, 2))
    for rows in reversed(levels[1:]):
        m = np.logaddexp.reduce(p.edge[trees.edge[rows]] + up[rows][:, None, :], axis=2)
        to_parent[rows] = m - m.max(axis=1, keepdims=True)
        np.add.at(up, trees.parent[rows], to_parent[rows])
    down = np.zeros((n, 2))
    pair = np.zeros((n, 2, 2))
    for rows in levels[1:]:
        above = trees.parent[rows]
        rest = up[above] + down[above] - to_parent[rows]
        joint = rest[:, :, None] + p.edge[trees.edge[rows]]
        m = np.logaddexp.reduce(joint, axis=1)
        down[rows] = m - m.max(axis=1, keepdims=True)
        joint = joint + up[rows][:, None, :]
        joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        pair[rows] = joint / joint.sum(axis=(1, 2), keepdims=True)
    belief = up + down
    belief = np.exp(belief - belief.max(axis=1, keepdims=True)) if n else belief
    return belief / np.maximum(belief.sum(axis=1, keepdims=True), 1e-300), pair


def fit(trees: Forest, steps: int = 300, rate: float = 0.1, decay: float = 0.02) -> Potentials:
    """Gradient steps on the log-likelihood of the labels: observed minus expected features."""
    p = Potentials(np.zeros(N_FEATURES), np.zeros((EDGE_KINDS, 2, 2)))
    child = np.flatnonzero(trees.parent >= 0)
    seen_edge = np.zeros_like(p.edge)
    np.add.at(seen_edge, (trees.edge[child], trees.label[trees.parent[child]].astype(int), trees.label[child].astype(int)), 1)
    n = max(len(trees.parent), 1)
    grads = [np.zeros_like(p.node), np.zeros_like(p.edge)]
    for _ in range(steps):
        node, pair = marginals(trees, p)
        expected = np.zeros_like(p.edge)
        np.add.at(expected, trees.edge[child], pair[child])
        for w, g, square in ((p.node, trees.x.T @ (trees.label - node[:, 1]), grads[0]), (p.edge, seen_edge - expected, grads[1])):
            g = g / n - decay / n * w
            square += g * g
            w += rate * g / (np.sqrt(square) + 1e-8)
    return p


def _weakly_labelled(page: Page) -> bool:
    """Labels a page by its own article or main element; False if it has none."""
    found = False
    for v in page.nodes:
        above = page.nodes[v.parent].main if v.parent >= 0 else False
        kind = _kind(v.tag)
        found |= kind == MARK_KIND
        v.main = (above or kind == MARK_KIND) and kind not in (0, 1, 2, 3, 4) and not any(k < len(NAME_KINDS) - 1 for k in v.names)
    return found


def trained(pages: DataFrame | None = None, id_col: str = "page_id", html_col: str = "html", sample_pages: int = SAMPLE_PAGES, sample_chars: int = SAMPLE_CHARS) -> Potentials:
    """Potentials from the hand-made pages and the sample of the table."""
    made = [parse(t) for t in LABELLED_PAGES]
    known, unmark = made * 8, [False] * (len(made) * 8)
    if pages is not None:
        rows = (pages.select(F.col(id_col).cast("string").alias("id"), F.col(html_col).alias("html")).filter(F.length("html") <= sample_chars)
                .orderBy(F.xxhash64("id"), "id", F.xxhash64("html")).limit(sample_pages).collect())
        for k, r in enumerate(rows):
            page = parse(r["html"])
            if _weakly_labelled(page):
                known.append(page)
                unmark.append(k % 2 == 1)
    return fit(forest(known, unmark))


def extract(pages: list[Page], p: Potentials) -> list[str]:
    """Main text of each page: the blocks of nodes that are more likely content than not."""
    trees = forest(pages)
    content = marginals(trees, p)[0][:, 1] >= 0.5
    out, base = [], 0
    for page in pages:
        out.append("\n\n".join(text for node, text in page.blocks if content[base + node]))
        base += len(page.nodes)
    return out


PAGES_AT_ONCE = 64


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              sample_pages: int = SAMPLE_PAGES, sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """One row per input row: ``page_id, url, text, n_chars``. A null or empty page, or one without main
    text, gives an empty text; repeated rows each get a row; text outside any element counts as
    text of the page's root."""
    shared = pages.sparkSession.sparkContext.broadcast(trained(pages, id_col, html_col, sample_pages, sample_chars))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, source = [], column(batch, "html")
        for k in range(0, len(source), PAGES_AT_ONCE):
            texts += extract([parse(t.as_py() or "") for t in source.slice(k, PAGES_AT_ONCE)], shared.value)
        return pa.RecordBatch.from_arrays([column(batch, "page_id"), column(batch, "url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                          ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return arrow_map(rows, run, f"page_id {dict(rows.dtypes)['page_id']}, url string, text string, n_chars long")
