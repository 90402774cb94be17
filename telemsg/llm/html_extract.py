"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element is a binary variable: part of the article or not. Node potentials come from what the element looks
like (tag, words of its class and id, amount of text below it, share of that text in links); parent-child potentials
say how likely an element of a kind is in the article given whether its parent is. Sum-product messages go from the
leaves to the root and back, for all pages of a batch at once, one tree level at a time, and give each element's
marginal; text whose element has a marginal of a half or more is the main text.

The potentials are smoothed counts over labelled pages: seeded made-up pages of many layouts, whose regions carry
their labels, and at most ``n_marked`` pages of the corpus that mark exactly one region as ``<article>``.

Defined cases: null or empty html gives an empty text; broken markup is read as browsers read it in the main
(unclosed paragraphs and items end where the next begins, unknown end tags are ignored, a cut tag is dropped);
pages of any length or depth are read whole; repeated rows are read alike; a null url passes through; extra columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import html as html_lib
import random
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|title|textarea|noscript|template|iframe|svg|select)\b[^>]*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[a-zA-Z/!?][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_MARK = re.compile(r'\bdata-main="([01])"')
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var".split()
)
#: Elements that end an open one of the same group.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
TAGS = (
    "html head body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th blockquote pre "
    "figure figcaption nav header footer aside form button label a b i em strong span address details summary"
).split()
_TAG = {t: i for i, t in enumerate(TAGS)}
#: Groups of words in class, id and role; what they mean for the text is learnt.
NAME_GROUPS = (
    "ad ads advert adverts advertisement advertorial sponsor sponsored promo promotion banner commercial",
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar",
    "sidebar side aside widget widgets related recommended recommendations more rail complementary",
    "comment comments reply replies respond discussion disqus feedback",
    "cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe signup paywall",
    "footer foot copyright legal imprint colophon contentinfo disclaimer",
    "header head masthead topbar top logo branding",
    "article content post entry story main body text prose",
    "share sharing social tags tag meta byline author toc",
    "search form login contact",
)
_GROUP = {w: i + 1 for i, g in enumerate(NAME_GROUPS) for w in g.split()}
N_TAG, N_GROUP, N_SIZE, N_LINK = len(TAGS) + 1, len(NAME_GROUPS) + 1, 9, 5
N_KIND = N_TAG + N_GROUP


@dataclass
class Tree:
    """Elements in page order, and the page as a list of text pieces and block boundaries."""

    parent: list[int] = field(default_factory=list)
    tag: list[int] = field(default_factory=list)
    group: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    own: list[int] = field(default_factory=list)
    link: list[int] = field(default_factory=list)
    mark: list[int] = field(default_factory=list)  # label written in the page: 0, 1, or -1
    pieces: list[tuple[int, str]] = field(default_factory=list)  # node -1 is a block boundary


def name_group(attrs: str) -> int:
    """The last group found wins: ids and classes often begin with a general word."""
    found = 0
    for m in _NAMES.finditer(attrs):
        for word in re.split(r"[^a-z0-9]+", (m.group(1) or m.group(2) or m.group(3) or "").lower()):
            g = _GROUP.get(word, 0)
            if g and (not found or found == 8):  # a special word beats a general one such as "content"
                found = g
    return found


def parse(page: str) -> Tree:
    t = Tree()
    stack: list[tuple[str, int]] = []

    def add(tag: str, attrs: str) -> int:
        k = len(t.parent)
        up = stack[-1][1] if stack else -1
        t.parent.append(up)
        t.tag.append(_TAG.get(tag, N_TAG - 1))
        t.group.append(name_group(attrs) if attrs.strip() else 0)
        t.depth.append(t.depth[up] + 1 if up >= 0 else 0)
        t.own.append(0)
        t.link.append(0)
        m = _MARK.search(attrs) if attrs else None
        t.mark.append(int(m.group(1)) if m else -1)
        return k

    def close(depth: int) -> None:
        if any(tag not in INLINE for tag, _ in stack[depth:]):
            t.pieces.append((-1, ""))
        del stack[depth:]

    def text(raw: str) -> None:
        if not raw:
            return
        s = html_lib.unescape(raw)
        node = stack[-1][1]
        n = len(_SPACE.sub(" ", s).strip())
        t.own[node] += n
        if n and any(tag == "a" for tag, _ in stack[-4:]):
            t.link[node] += n
        t.pieces.append((node, s))

    stack.append(("#root", add("#root", "")))
    at = 0
    for m in _TOKEN.finditer(page):
        text(page[at : m.start()])
        at = m.end()
        tag = m.group("tag")
        if not tag:
            continue
        tag = tag.lower()
        if m.group("end"):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
            else:
                if tag not in INLINE:
                    t.pieces.append((-1, ""))
            continue
        if tag == "br":
            t.pieces.append((stack[-1][1], "\n"))
            continue
        if tag in VOID:
            if tag == "hr":
                t.pieces.append((-1, ""))
            continue
        if tag not in INLINE:
            ends, scope = _ENDS.get(tag, ()), _SCOPE.get(tag, ())
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p" or stack[k][0] in ends:
                    close(k)
                    if stack and stack[-1][0] in ends:
                        continue
                    break
                if stack[k][0] in scope or (stack[k][0] not in INLINE and not ends):
                    break
            t.pieces.append((-1, ""))
        attrs = m.group("attrs") or ""
        node = add(tag, attrs)
        if not attrs.rstrip().endswith("/") or tag in ("p", "div", "a"):
            stack.append((tag, node))
    text(page[at:] if not re.match(r"<[a-zA-Z/!?]", page[at:]) else "")
    return t


def blocks(tree: Tree, chosen: np.ndarray) -> str:
    """The text of the chosen elements: white space in a block as one space, blocks joined by one space."""
    out, now = [], []
    for node, s in [*tree.pieces, (-1, "")]:
        if node >= 0:
            now.append(s if chosen[node] else "")
        elif now:
            block = _SPACE.sub(" ", "".join(now)).strip(" ")
            if block:
                out.append(block)
            now = []
    return " ".join(out)


class Forest:
    """The trees of a batch side by side, with the features of their nodes."""

    def __init__(self, trees: list[Tree]):
        sizes = np.array([len(t.parent) for t in trees], np.int64)
        self.first = np.cumsum(sizes) - sizes
        join = lambda name: np.array([x for t in trees for x in getattr(t, name)], np.int64)
        self.parent, self.tag, self.group = join("parent"), join("tag"), join("group")
        self.depth, own, link = join("depth"), join("own").astype(float), join("link").astype(float)
        self.parent = np.where(self.parent >= 0, self.parent + np.repeat(self.first, sizes), -1)
        order = np.argsort(self.depth, kind="stable")
        edges = np.searchsorted(self.depth[order], np.arange(self.depth.max() + 2 if len(order) else 1))
        self.levels = [order[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        for level in self.levels[:0:-1]:
            np.add.at(own, self.parent[level], own[level])
            np.add.at(link, self.parent[level], link[level])
        self.size = np.minimum(np.log2(1 + own).astype(np.int64) * 2 // 3, N_SIZE - 1)
        share = np.where(own > 0, link / np.maximum(own, 1), 0.0)
        self.link = np.digitize(share, [0.001, 0.25, 0.5, 0.8])
        self.kind = np.where(self.group > 0, N_TAG + self.group, self.tag)


class DomModel:
    """Log potentials: one table per node feature, and child-given-parent by the child's kind."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.node = {}
        for name in ("tag", "group", "size", "link"):
            c = counts[name] + 0.5
            self.node[name] = np.log(c / c.sum(axis=1, keepdims=True))
        # a kind not seen below some parent mostly goes the way of its parent
        prior = np.array([[8.0, 0.4], [0.4, 8.0]]) / 4
        c = counts["edge"] + prior
        self.edge = np.log(c / c.sum(axis=2, keepdims=True))

    @staticmethod
    def empty() -> dict[str, np.ndarray]:
        return {
            "tag": np.zeros((2, N_TAG)),
            "group": np.zeros((2, N_GROUP)),
            "size": np.zeros((2, N_SIZE)),
            "link": np.zeros((2, N_LINK)),
            "edge": np.zeros((N_KIND + 1, 2, 2)),
        }

    @classmethod
    def train(cls, trees: list[Tree], labels: list[np.ndarray]) -> DomModel:
        counts = cls.empty()
        f, y = Forest(trees), np.concatenate(labels)
        for name in ("tag", "group", "size", "link"):
            np.add.at(counts[name], (y, getattr(f, name)), 1)
        child = np.flatnonzero(f.parent >= 0)
        np.add.at(counts["edge"], (f.kind[child], y[f.parent[child]], y[child]), 1)
        return cls(counts)

    def marginals(self, f: Forest) -> np.ndarray:
        """Probability of being in the article, of every node: messages up, then down."""
        belief = sum(self.node[n][:, getattr(f, n)].T for n in ("tag", "group", "size", "link"))
        root = f.levels[0] if f.levels else np.empty(0, np.int64)
        belief[root, 1] = -50.0  # the page as a whole is not the article
        up = np.zeros_like(belief)
        for level in f.levels[:0:-1]:
            pair = self.edge[f.kind[level]] + belief[level][:, None, :]
            up[level] = np.logaddexp(pair[:, :, 0], pair[:, :, 1])
            np.add.at(belief, f.parent[level], up[level])
        for level in f.levels[1:]:
            rest = belief[f.parent[level]] - up[level]
            pair = self.edge[f.kind[level]] + rest[:, :, None]
            belief[level] += np.logaddexp(pair[:, 0, :], pair[:, 1, :])
            belief[level] -= belief[level].max(axis=1, keepdims=True)
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))


def inherited(tree: Tree) -> np.ndarray:
    """Labels from the marks: an unmarked element has its parent's."""
    y = np.zeros(len(tree.parent), np.int64)
    for k, (up, mark) in enumerate(zip(tree.parent, tree.mark, strict=True)):
        y[k] = mark if mark >= 0 else (y[up] if up >= 0 else 0)
    return y


def marked_article(tree: Tree) -> np.ndarray | None:
    """Labels of a page that marks exactly one ``<article>``: it is the main text, but for what is never that."""
    roots = [k for k, tag in enumerate(tree.tag) if tag == _TAG["article"]]
    if len(roots) != 1:
        return None
    never = {_TAG[x] for x in ("nav", "footer", "aside", "form", "button")}
    y = np.zeros(len(tree.parent), np.int64)
    for k, up in enumerate(tree.parent):
        if k == roots[0]:
            y[k] = 1
        elif up >= 0 and y[up] and tree.tag[k] not in never and tree.group[k] in (0, 8):
            y[k] = 1
    return y


def labelled_page(rng: random.Random) -> str:
    """A made-up page of a random layout; ``data-main`` says where the main text begins and what in it is none."""
    syllables = "ka lo mi ren tu sol vat per dun eri fos gam hil jov".split()
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    words = lambda n: " ".join(word() for _ in range(max(1, n)))
    sentence = lambda: words(rng.randint(4, 18)).capitalize() + rng.choice([".", ".", "!", "?", "&hellip;"])
    name = lambda group: f'class="{rng.choice(NAME_GROUPS[group].split())}{rng.choice(["", "-box", " wide", "-1"])}"'

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{word()}">{words(rng.randint(1, 3))}</a></li>' for _ in range(n)) + "</ul>"

    def paragraphs(n: int) -> str:
        out = []
        for _ in range(n):
            body = " ".join(sentence() for _ in range(rng.randint(1, 9)))
            if rng.random() < 0.3:
                body += f' <a href="/{word()}">{word()}</a> <b>{words(2)}</b> <i>{word()}</i> <span>{word()}</span>'
            kind = rng.random()
            if kind < 0.75:
                out.append(f"<p>{body}" + rng.choice(["</p>", "</p>", "", "<br>"]))
            elif kind < 0.8:
                out.append(f"<{(h := rng.choice(['h2', 'h3', 'h4']))}>{words(4)}</{h}>")
            elif kind < 0.85:
                out.append("<ul>" + "".join(f"<li>{sentence()}</li>" for _ in range(3)) + "</ul>")
            elif kind < 0.9:
                out.append(f"<blockquote><p>{body}</p></blockquote>")
            elif kind < 0.94:
                out.append(f"<table><tr><th>{word()}</th><td>{words(3)}</td></tr><tr><td>{word()}</td></tr></table>")
            elif kind < 0.97:
                out.append(f"<figure><img src=x><figcaption>{sentence()}</figcaption></figure>")
            else:
                out.append(f"<div>{body}</div>")
        return "".join(out)

    def junk(inside: bool) -> str:
        no = ' data-main="0"' if inside else ""
        kinds = [
            lambda: f"<div {name(0)}{no}>{sentence()}</div>",
            lambda: f"<div {name(0)}{no}><p>{sentence()}</p>{links(1)}</div>",
            lambda: f"<aside {name(2)}{no}><h3>{words(2)}</h3>{links(3)}</aside>",
            lambda: f"<div {name(2)}{no}><h3>{words(2)}</h3><p>{sentence()}</p></div>",
            lambda: f"<aside{no}><p>{sentence()}</p></aside>",
            lambda: f"<div {name(4)}{no}><p>{sentence()}</p><button>{word()}</button></div>",
            lambda: f"<section {name(3)}{no}><h2>{words(1)}</h2>" + "".join(
                f"<{(e := rng.choice(['div', 'article', 'li']))} {name(3)}><b>{word()}</b><p>{sentence()} {sentence()}</p></{e}>"
                for _ in range(rng.randint(1, 5))
            ) + "</section>",
            lambda: f"<form action=/x {rng.choice(['', name(9)])}{no}><label>{words(2)}</label><input name=q>"
            f"<button>{word()}</button></form>",
            lambda: f"<div {name(8)}{no}>{links(3)}</div>",
            lambda: f"<nav {rng.choice(['', name(1)])}{no}>{links(rng.randint(2, 8))}</nav>",
            lambda: f"<div {name(1)}{no}>{links(rng.randint(2, 8))}</div>",
        ]
        return rng.choice(kinds)()

    title = words(rng.randint(2, 8))
    root = rng.choice(
        ["article", "article", "main", f"div {name(7)}", f"section {name(7)}", f'div id="{rng.choice(["content", "main", "post"])}"']
    )
    inner = [f"<h1>{title}</h1>"] if rng.random() < 0.8 else []
    for _ in range(rng.randint(1, 4)):
        inner.append(paragraphs(rng.randint(1, 5)))
        if rng.random() < 0.35:
            inner.append(junk(True))
    body = f'<{root} data-main="1">{"".join(inner)}</{root.split()[0]}>'
    for wrap in rng.sample(["div", "section", f"div {name(7)}", "div id=wrap"], rng.choice([0, 0, 1, 2])):
        body = f"<{wrap}>{junk(False) if rng.random() < 0.4 else ''}{body}{junk(False) if rng.random() < 0.4 else ''}</{wrap.split()[0]}>"
    before, after = [], []
    if rng.random() < 0.6:
        before.append(f"<header {rng.choice(['', name(6)])}><h1>{words(2)}</h1><p>{words(4)}</p></header>")
    if rng.random() < 0.8:
        before.append(f"<nav {rng.choice(['', '', name(1)])}>{links(rng.randint(2, 9))}</nav>")
    before += [junk(False) for _ in range(rng.choice([0, 1, 1, 2]))]
    after += [junk(False) for _ in range(rng.choice([0, 0, 1, 2, 3]))]
    if rng.random() < 0.8:
        after.append(rng.choice(
            [f"<footer {rng.choice(['', name(5)])}>&copy; {words(3)} &middot; {sentence()}</footer>",
             f"<div {name(5)}><p>&copy; {words(6)}</p></div>",
             f"<footer><p>{sentence()}</p>{links(3)}</footer>"]
        ))
    return (
        f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style></head><body>"
        f"{''.join(before)}{body}{''.join(after)}</body></html>"
    )


def train(pages: DataFrame | None = None, html_col: str = "html", n_made: int = 1500, n_marked: int = 300, seed: int = 5):
    """The model from ``n_made`` made-up pages and up to ``n_marked`` marked ones of the corpus, of at most 100,000
    characters each, chosen by a hash. Both bounds hold whatever the size of the corpus."""
    rng = random.Random(seed)
    trees = [parse(labelled_page(rng)) for _ in range(n_made)]
    labels = [inherited(t) for t in trees]
    if pages is not None and n_marked:
        # about n_marked rows by a hash of the page, so that few rows reach the driver whatever the number of files
        every = F.lit(max(1, pages.count() // n_marked))
        some = (
            pages.select(F.col(html_col).alias("h"))
            .where(F.contains(F.col("h"), F.lit("<article")) & (F.length("h") <= 100_000))
            .where(F.pmod(F.xxhash64("h"), every) == 0)
            .limit(n_marked)
        )
        for r in some.collect():
            tree = parse(r["h"])
            y = marked_article(tree)
            if y is not None:
                trees.append(tree)
                labels.append(y)
    return DomModel.train(trees, labels)


def extract(pages: list[str], model: DomModel) -> list[str]:
    """The main text of each page."""
    trees = [parse(p) for p in pages]
    if not trees:
        return []
    f = Forest(trees)
    chosen = model.marginals(f) >= 0.5
    return [blocks(t, chosen[a : a + len(t.parent)]) for t, a in zip(trees, f.first.tolist(), strict=True)]


_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def _run(model: DomModel, step: int = 256):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                texts = extract([x or "" for x in part.column(2).to_pylist()], model)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), part.column(1).cast(pa.string()), pa.array(texts, pa.string())],
                    schema=_SCHEMA,
                )

    return run


def html_extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: DomModel | None = None
) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every page."""
    model = model or train(pages, html_col)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    out = rows.mapInArrow(_run(model), "page_id long, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
