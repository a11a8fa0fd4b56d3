"""HTML main text by a tree-structured graphical model over the DOM.

Every block element of a page, and every inline element with a telling class, id or role, is a
node that is content or not (``html_tree``). Its own evidence is linear in
features of its tag, class and id words, text and links; parent-child potentials connect the
nodes, one table for block children and one for inline ones (an advert within a paragraph says
little against the paragraph). On a tree sum-product is exact: one pass of messages from the leaves to the root and one
back give each node's content marginal. Text belongs to its nearest node and is kept where
that marginal is at least one half.

Weights are fitted to labelled pages by gradient ascent on the conditional likelihood (the same
messages give its gradient). The labelled pages are the layouts of this module or the caller's
own; the table itself is never labelled, so one model serves tables of every size.

Defined cases: null and empty HTML give an empty text; pages without content give an empty text;
pages of any size and depth are read whole (no recursion); broken markup is read as far as it
goes (``html_tree``): unknown end tags are ignored, open elements end with the page; repeated rows and null ids
are extracted like any other; an empty table gives an empty one; only the named
columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.llm.common import read, ship
from shelfspark.llm.html_tree import BLOCKS, GROUP_OF, GROUPS, WORDS, Page, word_flags

SIZES = (1, 25, 80, 200)
N_TAGS, N_WORDS = len(GROUPS) + 1, len(WORDS)
EXTRA = ("linked", "sentence", "copyright", "subtree_large", "subtree_linked", "empty_subtree", "in_main", "in_other")
N_FEATURES = 1 + N_TAGS + N_WORDS + len(SIZES) + len(EXTRA)
BOILERPLATE = {"nav", "header", "footer", "aside", "form", "button", "dialog", "menu", "fieldset", "label"}


def feature_matrix(page: Page) -> np.ndarray:
    n = len(page.parent)
    own = [0] * n
    texts: list[list[str]] = [[] for _ in range(n)]
    for owner, piece in page.pieces:
        if piece != " ":
            texts[owner].append(piece)
    f = np.zeros((n, N_FEATURES))
    f[:, 0] = 1
    base_words, base_size = 1 + N_TAGS, 1 + N_TAGS + N_WORDS
    base_extra = base_size + len(SIZES)
    linked = page.linked
    for i in range(n):
        f[i, 1 + GROUP_OF.get(page.tag[i], N_TAGS - 1)] = 1
        for k in word_flags(page.marks[i]):
            f[i, base_words + k] = 1
        joined = " ".join("".join(texts[i]).split())
        own[i] = size = len(joined)
        for k, least in enumerate(SIZES):
            if size >= least:
                f[i, base_size + k] = 1
        if size:
            f[i, base_extra] = linked[i] > 0.5 * size
            f[i, base_extra + 1] = joined[-1] in ".!?\"'" and not linked[i] > 0.5 * size
            f[i, base_extra + 2] = "©" in joined or "copyright" in joined.lower()
    total, total_linked = own[:], list(linked)
    for i in range(n - 1, 0, -1):
        total[page.parent[i]] += total[i]
        total_linked[page.parent[i]] += total_linked[i]
    for i in range(n):
        f[i, base_extra + 3] = total[i] >= 0.5 * total[0] and total[0] > 0
        f[i, base_extra + 4] = total_linked[i] > 0.5 * total[i]
        f[i, base_extra + 5] = total[i] == 0
        above = page.parent[i]
        if i:  # inside the page's main element, inside a part that is named as something else
            f[i, base_extra + 6] = page.tag[i] in ("article", "main") or f[above, base_extra + 6]
            f[i, base_extra + 7] = f[above, base_extra + 7] or page.tag[i] in BOILERPLATE or (
                f[i, base_words:base_words + N_WORDS - 1].any() and not f[i, base_words + N_WORDS - 1])
    return f


def _logadd(a, b):
    return np.logaddexp(a, b)


class Forest:
    """The trees of several pages as arrays, with their nodes listed by depth."""

    def __init__(self, pages: list[Page]):
        self.first = np.cumsum([0] + [len(p.parent) for p in pages])
        parents, depths = [], []
        for p, base in zip(pages, self.first):
            depth = [0] * len(p.parent)
            for i in range(1, len(p.parent)):
                depth[i] = depth[p.parent[i]] + 1
            parents.extend(x + base if x >= 0 else -1 for x in p.parent)
            depths.extend(depth)
        self.parent, depth = np.array(parents, dtype=np.int64), np.array(depths, dtype=np.int64)
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if len(order) else []
        self.kind = np.array([int(tag not in BLOCKS) for p in pages for tag in p.tag], dtype=np.int64)  # 1: inline
        self.features = np.concatenate([feature_matrix(p) for p in pages]) if pages else np.zeros((0, N_FEATURES))

    def marginals(self, weights: np.ndarray, edge: np.ndarray):
        """Sum-product: content marginal of every node, and joint marginals of the edges (n, 2, 2).

        ``edge`` holds the potential of (kind of child, parent's state, child's state)."""
        n = len(self.parent)
        inner = np.zeros((n, 2))  # own evidence and the messages of the children
        inner[:, 1] = self.features @ weights
        message = np.zeros((n, 2))
        for level in self.levels[:0:-1]:
            table = edge[self.kind[level]]
            for a in (0, 1):
                message[level, a] = _logadd(table[:, a, 0] + inner[level, 0], table[:, a, 1] + inner[level, 1])
            for a in (0, 1):
                np.add.at(inner[:, a], self.parent[level], message[level, a])
        belief = inner.copy()
        joint = np.zeros((n, 2, 2))
        for level in self.levels[1:]:
            rest = belief[self.parent[level]] - message[level]
            table = edge[self.kind[level]]
            for b in (0, 1):
                belief[level, b] += _logadd(table[:, 0, b] + rest[:, 0], table[:, 1, b] + rest[:, 1])
            for a in (0, 1):
                for b in (0, 1):
                    joint[level, a, b] = rest[:, a] + table[:, a, b] + inner[level, b]
            top = joint[level].max(axis=(1, 2), keepdims=True)
            p = np.exp(joint[level] - top)
            joint[level] = p / p.sum(axis=(1, 2), keepdims=True)
        return 1.0 / (1.0 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -700, 700))), joint


def train(pages: list[Page], labels: list[np.ndarray], weight: list[float], steps: int = 1500,
          rate: float = 0.1, ridge: float = 0.003) -> tuple[np.ndarray, np.ndarray]:
    """Node weights and edge potentials of the largest penalised conditional likelihood (Adam)."""
    forest = Forest(pages)
    y = np.concatenate(labels).astype(float)
    w = np.repeat(weight, [len(p.parent) for p in pages])
    child = np.flatnonzero(forest.parent >= 0)
    want = np.zeros((2, 2, 2))
    np.add.at(want, (forest.kind[child], y[forest.parent[child]].astype(int), y[child].astype(int)), w[child])
    theta = np.zeros(N_FEATURES + 8)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    scale = w.sum()
    for step in range(1, steps + 1):
        p, joint = forest.marginals(theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2, 2))
        found = np.zeros((2, 2, 2))
        np.add.at(found, forest.kind[child], (w[:, None, None] * joint)[child])
        grad = np.concatenate([forest.features.T @ (w * (y - p)),
                               (want - found).ravel()]) / scale - ridge * theta / len(theta)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    return theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2, 2)


def labels_of(page: Page) -> np.ndarray:
    """1 for the nodes that the page marks by ``data-main``, else 0."""
    y = np.zeros(len(page.parent), dtype=np.int8)
    y[page.labelled] = 1
    return y


def labelled_layouts() -> list[str]:
    """Labelled pages: common layouts with invented text; ``data-main`` marks the content elements."""
    long = "The committee met on Tuesday to discuss the harbour wall, which had been damaged by the storm of last winter. " * 3
    mid = "Nobody expected the result, and few had prepared for it."
    short = "It rained."
    menu = "<ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li><li><a href='/c'>Contact us</a></li></ul>"
    m = "data-main"
    def body(h: str = "h1") -> str:
        return (f"<{h} {m}>The harbour wall</{h}><p {m}>{long}</p><p {m}>{mid}</p><p {m}>{long}<a href='/x'>the report</a> says.</p>"
                f"<ul {m}><li {m}>{mid}</li><li {m}>{short}</li></ul><blockquote {m}>{mid}</blockquote><p {m}>{short}</p>")
    foot = "<p>&copy; 2020 The Daily. All rights reserved.</p>"
    comments = ("<div class='{0}'><h3>3 comments</h3><div class='{1}'><p>I do not agree with any of this, it was much worse in my day.</p></div>"
                "<div class='{1}'><p>Great read, thanks.</p></div></div>")
    return [
        f"<body><nav>{menu}</nav><div class='ad'>{mid}</div><article {m}>{body()}</article><footer>&copy; site &middot; {mid}</footer></body>",
        f"<body><header><a href='/'>The Daily</a>{menu}</header><main {m}><article {m}>{body()}</article></main><aside><h2>Related</h2><p>{mid}</p>{menu}</aside><footer>{foot}</footer></body>",
        f"<body><div id='header'><div class='logo'>The Daily</div><div class='menu'>{menu}</div></div><div id='content' {m}><div class='post' {m}>{body('h2')}</div></div><div id='sidebar'><p>{mid}</p><p>{long}</p></div><div id='footer'>{foot}</div></body>",
        f"<body><div class='cookie-banner'><p>We use cookies to give you the best experience. {mid}</p><button>Accept</button></div><div class='page'><div class='article-body' {m}>{body()}</div>{comments.format('comments', 'comment')}</div></body>",
        f"<body><div class='nav-bar'>{menu}</div><article {m}>{body()}<aside class='promo'><p>{long}</p></aside><p {m}>{long}</p><div class='advert'><p>{mid}</p></div>{comments.format('comment-list', 'reply')}</article><form class='newsletter'><label>Your e-mail</label><p>Sign up for our letter. {mid}</p></form></body>",
        f"<body><header><h1>The Daily</h1><p>News since 1900</p></header><section class='story' {m}>{body('h2')}</section><section id='comments'><h2>Comments</h2><p>{mid}</p><p>{long}</p></section><section class='related-posts'>{menu}</section><footer><p>{mid}</p>{menu}</footer></body>",
        f"<body><table><tr><td class='nav'>{menu}</td><td class='text' {m}>{body()}</td></tr></table><div class='legal'>{foot}</div></body>",
        f"<body><h1 {m}>The harbour wall</h1><p {m}>{long}</p><p {m}>{mid}</p><p {m}>{long}</p><div class='share'><a href='/t'>Tweet</a> <a href='/f'>Share</a></div><p class='copyright'>&copy; 2021 {mid}</p></body>",
        f"<body><div class='wrapper'><div class='breadcrumbs'><a href='/'>Home</a> / <a href='/n'>News</a></div><div class='entry-content' {m}>{body()}</div><div class='sponsored'><p>{long}</p></div><div class='widget'><h3>Most read</h3>{menu}</div></div><div class='notice'><p>This site is moving. {mid}</p></div><form action='/s'><p>Search this site: {mid}</p><button>Go</button></form></body>",
        f"<body><nav>{menu}</nav><article {m}><h1 {m}>Rain</h1><p {m}>{short}</p></article><div class='ad'>{mid}</div><footer>{foot}</footer></body>",
        f"<body><header>{menu}</header><main {m}><h1 {m}>Rain</h1><p {m}>{mid}</p></main><aside><p>{long}</p></aside><footer>{foot}{menu}</footer></body>",
        f"<body><article {m}><header {m}><h1 {m}>Rain</h1></header><p {m}>{mid}</p><h2 {m}>Wind</h2><p {m}>{short}</p><table {m}><tr {m}><td {m}>1</td><td {m}>{short}</td></tr></table></article><div class='comments'><p>{long}</p></div></body>",
        f"<body><h1 {m}>Rain</h1><p {m}>{long}</p><p {m}>{short}</p><p {m}>{long}</p><hr><p>&copy; {mid}</p></body>",
        f"<body><nav><a class='menu-link' href='/'>Home</a> <a class='menu-link' href='/n'>News</a></nav><article {m}><h1 {m}>Rain <span class='text-muted' {m}>and wind</span></h1><p {m}>{mid} <span class='ad'>Buy now!</span> {mid} <a class='post-ref' {m} href='/p'>An earlier report</a> says so.</p><p {m}>{long}<span class='share-links'><a href='/t'>Tweet this</a></span></p></article><footer>{foot}</footer></body>",
        f"<body><div id='content' {m}><h2 {m}>The harbour wall</h2><p {m}><em class='body-text' {m}>{mid}</em> {long}<span class='sponsor-note'>Brought to you by the bank. {mid}</span></p><p {m}>{short} <span class='comment-count'>3 replies</span></p><p {m}>{mid}<span class='content-strong' {m}>{long}</span></p></div><p class='footer'><span class='copyright'>&copy; 2018</span> {mid}</p></body>",
        f"<body><article {m}><h1 {m}>Rain</h1><p {m}>{mid} <span class='advert'>{mid}</span> {short} <span class='widget'>{short}</span> {mid} <b class='promo'>{long}</b> {mid}<span class='share'>{short}</span></p><p {m}><span class='ad'>{short}</span>{mid}<span class='related'>{mid}</span></p></article><footer>{foot}</footer></body>",
        f"<body><div><div><a href='/1'>One</a> <a href='/2'>Two</a></div><div {m}><p {m}>{long}</p><p {m}>{long}</p><p {m}>{short}</p><p {m}>{mid}</p></div><div>&copy; 2019 Someone</div></div></body>",
    ]


def extract(pages: list[Page], weights: np.ndarray, edge: np.ndarray, at_least: float = 0.5) -> list[str]:
    """Main text of each page: kept pieces, white space collapsed, blocks joined by one space."""
    if not pages:
        return []
    forest = Forest(pages)
    p, _ = forest.marginals(weights, edge)
    out = []
    for page, base in zip(pages, forest.first):
        keep = p[base:base + len(page.parent)] >= at_least
        out.append(" ".join("".join(piece for owner, piece in page.pieces if piece == " " or keep[owner]).split()))
    return out


def fitted(labelled: list[str] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Model from labelled pages, whose content elements carry ``data-main`` (default: the layouts)."""
    pages = [Page(x) for x in (labelled_layouts() if labelled is None else labelled)]
    return train(pages, [labels_of(p) for p in pages], [1.0] * len(pages))


def extract_pages(pages: DataFrame, model: tuple[np.ndarray, np.ndarray], id_col: str = "page_id",
                  html_col: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per input row: id, ``keep`` columns, text and n_chars."""
    ship(pages.sparkSession)
    weights, edge = model
    fields = [pages.schema[c] for c in (id_col, *keep)]
    schema = T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                texts = extract([Page(x.as_py() or "") for x in part.column(part.num_columns - 1)], weights, edge)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(k) for k in range(part.num_columns - 1)], pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], schema.names)

    return pages.select(id_col, *keep, F.col(html_col).alias("_html")).mapInArrow(run, schema)


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return extract_pages(pages, fitted(), keep=("url",))
