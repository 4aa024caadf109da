"""Main text of web pages by boosted trees over DOM nodes.

A page becomes a tree of elements; every element gets features: its tag's
sort, tokens of its class, id and role attributes, the same summed up over its
ancestors, the length, link and mark-up density of its subtree, depth, place
among its siblings and their likeness. Gradient-boosted trees give each
element a log-odds of being main text. Decoding is by a dynamic programme: a
kept element must have kept ancestors, and the sum of log-odds over the kept
text is largest; so a rejected container never leaves kept text inside, and
a kept one may still drop an advert in it.

Training. Labels come from the pages themselves: landmark elements (article,
main against nav, aside, header, footer, form and the like) on a bounded
sample of pages. Each sampled page is also trained on in variants that put
its own boilerplate and text into other frames (article as a div with content
tokens, boilerplate inside the article, lists and headers as divs, comments),
so that the trees learn tokens and densities, not one template.

Blocks are cut at block elements; white space in a block becomes one space;
blocks are joined by line breaks in page order. Scripts, styles and other
unseen elements never count.

Edge cases. Null and empty html: empty text. Broken mark-up: unclosed elements
end with their parent, stray end tags are ignored. A page without an element
is one text. Without training pages everything but landmarks of boilerplate is
kept. Repeated rows are each extracted. Empty table: empty result.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Parameters: training pages, variants of each, trees, depth, rate, histogram bins.
SAMPLE_PAGES = 400
VARIANTS = 6
#: Elements of a page that train, drawn at random from all of them; features and labels are computed over the whole page.
SAMPLE_NODES = 400
TREES, DEPTH, RATE, BINS = 40, 4, 0.25, 32

# Element sorts of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg select option head xmp noframes".split())
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
TEXT_ONLY = frozenset("script style textarea title iframe noscript xmp noframes".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
                  "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"br", "html", "body", "caption", "legend", "td", "th", "tr", "tbody", "thead", "tfoot"}
SIBLING_END = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dd dt", ("dl",)), "dd": ("dd dt", ("dl",)), "tr": ("tr td th", ("table",)),
               "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
# Tokens of attribute names by what they announce.
GOOD_TOKENS = frozenset("article body content entry main post story text page blog news prose markdown richtext articlebody maincontent".split())
BAD_TOKENS = frozenset("ad ads advert advertisement adsense banner sponsor sponsored promo promoted nav navbar navigation menu breadcrumb breadcrumbs footer header "
                       "masthead sidebar side aside widget related recommend recommended share sharing social comment comments reply replies respond disqus cookie consent notice "
                       "notification alert popup modal overlay newsletter subscribe signup login form search toolbar pager pagination meta byline tags tag copyright legal disclaimer "
                       "skip hidden outbrain taboola toc".split())
COMMENT_TOKENS = frozenset("comment comments reply replies respond disqus discussion thread".split())
GOOD_TAGS, BAD_TAGS = frozenset("article main".split()), frozenset("nav aside footer header form menu dialog search".split())

_MARK = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
# a tag whose quotes do not close ends at the next ">"
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>")
_START = re.compile(r"<(?:!|\?|/?[a-zA-Z])")
_ATTR = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_TOKEN = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "attrs", "parent", "items", "depth")

    def __init__(self, tag: str, attrs: str, parent: "Node | None"):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.items: list = []          # texts and nodes in page order
        self.depth = parent.depth + 1 if parent else 0


def parse(page: str) -> Node:
    """Lenient tree of a page."""
    root = Node("#root", "", None)
    at, pos, n, last = root, 0, len(page), page.rfind(">")
    opened: dict[str, int] = {}  # open elements by tag, so that a stray end tag costs no walk

    def leave(node: Node, at: Node) -> Node:
        """Close ``node`` and all open below it."""
        while True:
            opened[at.tag] -= 1
            if at is node:
                return at.parent
            at = at.parent

    while pos < n:
        m, look = None, pos
        while m is None and (s := _START.search(page, look)):
            m = _MARK.match(page, s.start()) or (_LOOSE.match(page, s.start()) if s.start() < last else None)
            if m is None and s.start() > last:
                break
            look = s.end()
        text = page[pos:m.start()] if m else page[pos:]
        if at.tag == "head" and text.strip():
            at = leave(at, at)
        if text:
            at.items.append(text)
        if not m:
            break
        pos = m.end()
        if not m.group(2):
            continue
        tag = m.group(2).lower()
        if m.group(1):
            if opened.get(tag):
                x = at
                while x.tag != tag:
                    x = x.parent
                at = leave(x, at)
            continue
        # like text above, an element that cannot stand in a head ends an open one
        if at.tag == "head" and tag not in IN_HEAD and tag != "head":
            at = leave(at, at)
        if tag in CLOSES_P:
            x = at
            while x is not root and x.tag not in ("p", "td", "li", "div", "article", "body", "table"):
                x = x.parent
            if x.tag == "p":
                at = leave(x, at)
        if tag in SIBLING_END:
            ends, scope = SIBLING_END[tag]
            x = at
            while x is not root and x.tag not in scope and x.tag not in ends.split():
                x = x.parent
            if x.tag in ends.split():
                at = leave(x, at)
        node = Node(tag, m.group(3), at)
        at.items.append(node)
        if tag in VOID or m.group(3).endswith("/"):
            continue
        if tag in TEXT_ONLY:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, pos)
            pos = end.end() if end else n
            continue
        opened[tag] = opened.get(tag, 0) + 1
        at = node
    return root


def elements(root: Node) -> list[Node]:
    """All visible elements, parents before children."""
    out, todo = [], [root]
    while todo:
        x = todo.pop()
        out.append(x)
        todo += [y for y in reversed(x.items) if isinstance(y, Node) and y.tag not in RAW]
    return out


N_FEATURES = 26


def features(nodes: list[Node]) -> np.ndarray:
    """One row of features per element."""
    k = len(nodes)
    index = {id(x): i for i, x in enumerate(nodes)}
    parent = np.array([index[id(x.parent)] if x.parent is not None else -1 for x in nodes])
    own = np.zeros((k, 12))
    for i, x in enumerate(nodes):
        text = "".join(y for y in x.items if isinstance(y, str))
        stripped = len(text) - text.count(" ") - text.count("\n")
        tokens = set()
        if x.attrs:
            for m in _ATTR.finditer(x.attrs):
                tokens.update(_TOKEN.findall((m.group(2) or m.group(3) or m.group(4) or "").lower()))
        own[i] = (stripped, stripped if x.tag == "a" else 0, 1, x.tag == "p", x.tag == "li", x.tag in ("h1", "h2", "h3", "h4"),
                  text.count(".") + text.count(",") + text.count("!") + text.count("?"), len(tokens & GOOD_TOKENS), len(tokens & BAD_TOKENS),
                  len(tokens & COMMENT_TOKENS), x.tag in GOOD_TAGS, x.tag in BAD_TAGS or bool(x.attrs and _HIDDEN.search(x.attrs)))
    under, above = own[:, :7].copy(), own[:, 7:].copy()
    for i in range(k - 1, 0, -1):
        under[parent[i]] += under[i]
    for i in range(1, k):
        above[i] += above[parent[i]]
    depth = np.array([x.depth for x in nodes], float)
    children = np.bincount(parent[1:], minlength=k) if k > 1 else np.zeros(k)
    place = np.zeros(k)
    seen: dict[int, int] = {}
    for i in range(1, k):
        place[i] = seen.get(parent[i], 0)
        seen[parent[i]] = seen.get(parent[i], 0) + 1
    p = np.maximum(parent, 0)
    size, page = under[:, 0], max(1.0, under[0, 0])
    tag_sort = np.array([0 if x.tag in ("p", "pre", "blockquote") else 1 if x.tag in ("div", "section", "td") else 2 if x.tag in ("ul", "ol", "li", "dl") else
                         3 if x.tag[:1] == "h" and len(x.tag) == 2 else 4 if x.tag in BLOCK else 5 for x in nodes], float)
    return np.column_stack([
        np.log1p(size), size / page, under[:, 1] / np.maximum(1, size), np.log1p(size / under[:, 2]), under[:, 2], under[:, 3], under[:, 4] / under[:, 2],
        under[:, 5], under[:, 6] / np.maximum(1, size), np.log1p(own[:, 0]), own[:, 7], own[:, 8], own[:, 9], own[:, 10], own[:, 11],
        above[:, 0], above[:, 1], above[:, 2], above[:, 3], above[:, 4], depth, children, place / np.maximum(1, children[p]), size / np.maximum(1, size[p]),
        tag_sort, np.log1p(size[p])])


# --- boosted trees ------------------------------------------------------------

class Forest:
    """Boosted regression trees on the logistic loss, over binned features."""

    def __init__(self, edges: list[np.ndarray] | None = None, trees: list[tuple] | None = None, base: float = 0.0):
        self.edges, self.trees, self.base = edges or [], trees or [], base

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)])

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Forest":
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1])) for j in range(x.shape[1])]
        b = self.binned(x)
        self.base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        f = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-f))
            tree = self._grow(b, y - p, p * (1 - p))
            self.trees.append(tree)
            f += self._apply(tree, b)
        return self

    def _grow(self, b: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple:
        n_nodes = (1 << (DEPTH + 1)) - 1
        feature, cut, value = np.full(n_nodes, -1), np.zeros(n_nodes, int), np.zeros(n_nodes)
        at = np.zeros(len(b), int)
        for node in range(n_nodes):
            rows = np.flatnonzero(at == node)
            if not len(rows):
                continue
            gs, hs = g[rows].sum(), h[rows].sum()
            value[node] = RATE * gs / (hs + 1.0)
            if node >= (1 << DEPTH) - 1:
                continue
            best = 1e-6
            for j in range(b.shape[1]):
                gl = np.cumsum(np.bincount(b[rows, j], g[rows], BINS))[:-1]
                hl = np.cumsum(np.bincount(b[rows, j], h[rows], BINS))[:-1]
                gain = gl**2 / (hl + 1) + (gs - gl)**2 / (hs - hl + 1) - gs**2 / (hs + 1)
                gain[(hl < 0.5) | (hs - hl < 0.5)] = 0
                k = int(gain.argmax())
                if gain[k] > best:
                    best, feature[node], cut[node] = gain[k], j, k
            if feature[node] >= 0:
                at[rows] = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
        return feature, cut, value

    @staticmethod
    def _apply(tree: tuple, b: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        at, rows = np.zeros(len(b), int), np.arange(len(b))
        for _ in range(DEPTH):
            f = feature[at]
            at = np.where(f >= 0, 2 * at + 1 + (b[rows, np.maximum(f, 0)] > cut[at]), at)
        return value[at]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        b = self.binned(x)
        return self.base + sum((self._apply(t, b) for t in self.trees), np.zeros(len(x)))


# --- labels and variants ------------------------------------------------------

def landmark_labels(nodes: list[Node]) -> np.ndarray:
    """1 inside article or main and not inside boilerplate, 0 inside boilerplate or beside them."""
    out = np.zeros(len(nodes))
    index = {id(x): i for i, x in enumerate(nodes)}
    inside = [x.tag in GOOD_TAGS for x in nodes]
    bad = [False] * len(nodes)
    for i, x in enumerate(nodes):
        p = index[id(x.parent)] if x.parent is not None else -1
        tokens = set(_TOKEN.findall(" ".join(m.group(2) or m.group(3) or m.group(4) or "" for m in _ATTR.finditer(x.attrs)).lower())) if x.attrs else set()
        bad[i] = (p >= 0 and bad[p]) or x.tag in BAD_TAGS or bool(tokens & BAD_TOKENS)
        inside[i] = inside[i] or (p >= 0 and inside[p]) or bool(tokens & GOOD_TOKENS)
        out[i] = inside[i] and not bad[i]
    # containers of kept text are kept, so that decoding can reach it
    for i in range(len(nodes) - 1, 0, -1):
        if out[i] and nodes[i].parent is not None:
            out[index[id(nodes[i].parent)]] = 1
    return out


def variant(page: str, rng: random.Random) -> str:
    """The page in another frame: its article under other names, its boilerplate moved and renamed."""
    m = re.search(r"<article\b[^>]*>(.*?)</article>", page, re.S | re.I)
    body = re.search(r"<body\b[^>]*>(.*?)</body>", page, re.S | re.I)
    if not m or not body:
        return page
    inner = m.group(1)
    rest = (body.group(1).replace(m.group(0), " ")).strip()
    junk = [x for x in re.findall(r">([^<>]{3,400})<", rest) if x.strip()] or ["more"]
    good, bad = sorted(GOOD_TOKENS), sorted(BAD_TOKENS)

    def box(n: int) -> str:
        texts = [rng.choice(junk) for _ in range(n)]
        form = rng.randrange(4)
        if form == 0:
            rows = "".join(f'<li><a href="#">{t}</a></li>' for t in texts)
            return f"<ul>{rows}</ul>"
        if form == 1:
            return "".join(f"<p>{t}</p>" for t in texts)
        if form == 2:
            return "".join(f'<div class="{rng.choice(["item", "row", "box"])}">{t} <a href="#">{rng.choice(junk)[:20]}</a></div>' for t in texts)
        return " ".join(texts)

    def boiler() -> str:
        if rng.random() < 0.4:
            tag = rng.choice(sorted(BAD_TAGS - {"menu", "search", "dialog"}))
            return f"<{tag}>{box(rng.randint(1, 5))}</{tag}>"
        token = rng.choice(bad)
        attr = rng.choice(["class", "class", "id"])
        name = rng.choice([token, f"{token}-box", f"site-{token}", f"{token} block"])
        sentences = re.findall(r">([^<>]{20,300})<", inner)
        # readers' comments read like the article
        content = "".join(f"<p>{rng.choice(sentences)}</p>" for _ in range(rng.randint(1, 4))) if token in COMMENT_TOKENS and sentences else box(rng.randint(1, 5))
        return f'<{rng.choice(["div", "div", "section"])} {attr}="{name}">{content}</div>'.replace("<section", "<div")

    parts = re.split(r"(?=<p>|<h[1-6]>)", inner)
    for _ in range(rng.randint(0, 2)):
        parts.insert(rng.randint(0, len(parts)), boiler())
    text = "".join(parts)
    frame = rng.randrange(4)
    if frame == 0:
        text = f"<article>{text}</article>"
    elif frame == 1:
        text = f'<div class="{rng.choice(good)}">{text}</div>'
    elif frame == 2:
        text = f'<main><div id="{rng.choice(good)}">{text}</div></main>'
    else:
        text = f'<div class="wrap"><section class="{rng.choice(good)}-{rng.choice(["area", "inner", "main"])}">{text}</section></div>'
    around = [boiler() for _ in range(rng.randint(1, 4))] + ([rest] if rng.random() < 0.5 else [])
    k = rng.randint(0, len(around))
    return f"<html><body>{''.join(around[:k])}{text}{''.join(around[k:])}</body></html>"


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Forest:
    """Fit on landmark labels of sampled pages and their variants; labels and features are made
    by tasks. About sample_pages pages are chosen by a hash of the whole row, equal rows once, so reruns choose
    alike; 1 + VARIANTS matrices of at most SAMPLE_NODES rows for each reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page, order in zip(batch.column("html").to_pylist(), batch.column("order").to_pylist()):
                rng = random.Random(order)
                rows, labels = [], []
                for k in range(VARIANTS + 1):
                    nodes = elements(parse(variant(page, rng) if k else page))
                    some = sorted(rng.sample(range(len(nodes)), min(len(nodes), SAMPLE_NODES)))
                    rows.append(features(nodes)[some])
                    labels.append(landmark_labels(nodes)[some])
                yield pa.RecordBatch.from_pylist([{"x": np.concatenate(rows).tobytes(), "y": np.concatenate(labels).tobytes(), "order": order}],
                                                 schema=pa.schema([("x", pa.binary()), ("y", pa.binary()), ("order", pa.int64())]))

    able = pages.filter(F.length("html") > 0)
    n = able.count()
    share = min(1.0, sample_pages / n) if n else 1.0
    chosen = able.select("html", F.xxhash64("page_id", "url", "html", F.lit(3)).alias("order")).filter(F.col("order") / 2.0**64 + 0.5 < share).dropDuplicates(["order"])
    got = sorted(((r["order"], bytes(r["x"]), bytes(r["y"])) for r in chosen.mapInArrow(run, "x binary, y binary, order long").collect()))
    if not got:
        return Forest(edges=[np.zeros(0)] * N_FEATURES, base=1.0)
    x = np.concatenate([np.frombuffer(a, float).reshape(-1, N_FEATURES) for _, a, _ in got])
    y = np.concatenate([np.frombuffer(b, float) for _, _, b in got])
    return Forest().fit(x, y)


# --- decoding and text --------------------------------------------------------

def decode(nodes: list[Node], odds: np.ndarray) -> set[int]:
    """Ids of the kept elements: of all sets closed under parents, the one with the largest sum of
    log-odds, each weighted by the element's own text."""
    k = len(nodes)
    index = {id(x): i for i, x in enumerate(nodes)}
    own = np.array([sum(len(y) for y in x.items if isinstance(y, str) and not y.isspace()) for x in nodes], float)
    value = odds * np.sqrt(own)
    for i in range(k - 1, 0, -1):
        if value[i] > 0:
            value[index[id(nodes[i].parent)]] += value[i]
    kept: set[int] = set()
    for i, x in enumerate(nodes):
        if (x.parent is None or id(x.parent) in kept) and (value[i] > 0 or x.parent is None):
            kept.add(id(x))
    return kept


def block_text(root: Node, kept: set[int]) -> str:
    """Text of the kept elements, block by block."""
    blocks: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = _SPACE.sub(" ", entities.unescape("".join(line))).strip()
        if text:
            blocks.append(text)
        line.clear()

    todo: list = [root]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            line.append(x)
        elif isinstance(x, Node):
            block = x.tag in BLOCK or x is root
            if block:
                end()
            if id(x) in kept:
                if block:
                    todo.append(None)
                todo += reversed(x.items)
        else:
            end()
    end()
    return "\n".join(blocks)


def extract(pages: DataFrame, forest: Forest) -> DataFrame:
    """page_id, url, text, n_chars, n_nodes, n_kept of every page."""
    state = (forest.edges, forest.trees, forest.base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Forest(*state)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                trees = [parse(p or "") for p in part.column("html").to_pylist()]
                nodes = [elements(t) for t in trees]
                odds = model.log_odds(np.concatenate([features(x) for x in nodes]))
                cuts = np.cumsum([len(x) for x in nodes])[:-1]
                kept = [decode(x, o) for x, o in zip(nodes, np.split(odds, cuts))]
                texts = [block_text(t, s) for t, s in zip(trees, kept)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id").cast(pa.int64()), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                     pa.array([len(x) for x in nodes], pa.int64()), pa.array([len(s) for s in kept], pa.int64())],
                    names=["page_id", "url", "text", "n_chars", "n_nodes", "n_kept"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long, n_nodes long, n_kept long")
