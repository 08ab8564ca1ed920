"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded over the tree.

The trees are trained on pages made up by a generator, with and without telling
names, so that structure counts and not only vocabulary. A node's label is whether it
holds any of the article. Decoding maximises the sum of log odds under one rule: what
lies in a dropped node is dropped.
"""

from __future__ import annotations

import random
import string
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import boost
from .dom import BLOCK, MARK, Page, parse

#: Pages that the trees are trained on, and the generator's seed.
TRAIN_PAGES, SEED = 900, 7
#: Pages whose nodes the trees see at once, and their characters.
RUN_PAGES, RUN_CHARS = 64, 1 << 20

# Names that say what an element holds.
GOOD = frozenset("article content main post entry story body text page blog news prose copy".split())
BAD_KINDS = {
    "menu": frozenset("nav navigation menu navbar breadcrumb breadcrumbs pagination pager toolbar tabs toc skip".split()),
    "edge": frozenset("header footer masthead foot bottom top copyright legal colophon banner".split()),
    "side": frozenset("sidebar aside side rail widget related recommended popular trending more tags".split()),
    "advert": frozenset("ad ads advert advertisement advertising sponsor sponsored promo promotion commercial".split()),
    "notice": frozenset("cookie cookies consent gdpr notice alert popup modal overlay subscribe newsletter paywall privacy".split()),
    "talk": frozenset("comment comments reply replies respond discussion disqus feedback reactions".split()),
    "form": frozenset("form login signin signup search register contact input".split()),
    "share": frozenset("share social sharing follow buttons like".split()),
}
TAGS = ("p", "li", "ul", "ol", "div", "section", "article", "main", "nav", "header", "footer", "aside", "form", "table", "td", "blockquote", "pre", "figure", "figcaption", "a", "span")


def features(page: Page) -> np.ndarray:
    """One row for each node: its subtree's text, links and density, its names and those
    above it, its depth, and how its siblings are."""
    nodes = page.nodes
    n = len(nodes)
    own = np.zeros((n, 5))  # characters, words, punctuation, characters in links, pieces
    in_link = np.zeros(n, bool)
    for i, x in enumerate(nodes):
        in_link[i] = x.tag == "a" or (x.parent >= 0 and in_link[x.parent])
    for at, _, text in page.texts:
        size = len(text.strip())
        if size:
            own[at] += (size, text.count(" ") + 1, sum(map(text.count, ".,;:!?")), size * in_link[at], 1)
    parent = np.array([x.parent for x in nodes])
    end = np.array([x.end for x in nodes])
    sums = np.concatenate((np.zeros((1, 5)), own.cumsum(0)))
    below = sums[end] - sums[:n]
    before = sums[:n, 0] / max(1.0, sums[-1, 0])
    tags = end - np.arange(n)
    tag = np.array([TAGS.index(x.tag) if x.tag in TAGS else (len(TAGS) if x.tag[0] == "h" and x.tag[1:].isdigit() else -1) for x in nodes])
    links = np.concatenate(([0], np.cumsum([x.tag == "a" for x in nodes])))
    links = links[end] - links[:n]
    paragraphs = np.concatenate(([0], np.cumsum([x.tag == "p" for x in nodes])))
    paragraphs = paragraphs[end] - paragraphs[:n]
    inputs = np.concatenate(([0], np.cumsum([x.tag in ("input", "button", "select", "textarea", "label") for x in nodes])))
    inputs = inputs[end] - inputs[:n]
    named = np.zeros((n, 1 + len(BAD_KINDS)))
    semantic = np.zeros((n, 3))
    for i, x in enumerate(nodes):
        if x.tokens:
            said = set(x.tokens)
            named[i, 0] = bool(said & GOOD)
            for k, words in enumerate(BAD_KINDS.values()):
                named[i, k + 1] = bool(said & words)
        semantic[i] = (x.tag in ("article", "main"), x.tag in ("nav", "aside", "footer", "form", "dialog"), x.tag == "header")
    above = np.zeros((n, named.shape[1] + 3))
    for i in range(1, n):
        above[i] = np.maximum(above[parent[i]], np.concatenate((named[parent[i]], semantic[parent[i]])))
    count = np.bincount(np.maximum(parent, 0), minlength=n)
    mean_below = np.bincount(np.maximum(parent, 0)[1:], below[1:, 0], minlength=n) / np.maximum(1, np.bincount(np.maximum(parent, 0)[1:], minlength=n))
    up = np.maximum(parent, 0)
    index = np.zeros(n)
    seen = np.zeros(n)
    for i in range(1, n):
        index[i] = seen[parent[i]]
        seen[parent[i]] += 1
    same = np.zeros(n)
    kinds: dict[tuple, int] = {}
    for i in range(1, n):
        kinds[parent[i], tag[i]] = kinds.get((parent[i], tag[i]), 0) + 1
    for i in range(1, n):
        same[i] = kinds[parent[i], tag[i]]
    chars = below[:, 0]
    dense = chars / np.maximum(1, tags)
    one_hot = (tag[:, None] == np.arange(len(TAGS) + 1)).astype(float)
    return np.column_stack([
        np.log1p(chars), np.log1p(below[:, 1]), below[:, 2] / np.maximum(1, below[:, 1]), below[:, 3] / np.maximum(1, chars), chars / np.maximum(1, below[:, 1]),
        np.log1p(dense), np.log1p(dense[up]), np.log1p(own[:, 0]), chars / max(1.0, sums[-1, 0]), chars / np.maximum(1, chars[up]), before,
        np.log1p(tags), np.log1p(links), np.log1p(paragraphs), np.log1p(inputs), paragraphs[up] / np.maximum(1, count[up]),
        [x.depth for x in nodes], [x.children for x in nodes], np.log1p(count[up]), index / np.maximum(1, count[up]), same, np.log1p(mean_below[up]),
        below[up, 3] / np.maximum(1, chars[up]), one_hot, named, above, semantic,
    ])


def decode(page: Page, margin: np.ndarray) -> np.ndarray:
    """keep[i] for every node: the choice of greatest total log odds in which no kept node
    lies in a dropped one. The root and the page's frame are kept."""
    nodes = page.nodes
    n = len(nodes)
    keep_sum, drop_sum = margin.copy(), -margin
    for i, x in enumerate(nodes):
        if x.tag in ("#root", "html", "body"):
            keep_sum[i], drop_sum[i] = 0.0, -1e9
        elif x.tag not in BLOCK or x.hidden:  # inline elements go with their block
            keep_sum[i] = drop_sum[i] = 0.0
    for i in range(n - 1, 0, -1):
        up = nodes[i].parent
        keep_sum[up] += max(keep_sum[i], drop_sum[i])
        drop_sum[up] += drop_sum[i]
    keep = np.zeros(n, bool)
    keep[0] = True
    for i in range(1, n):
        keep[i] = keep[nodes[i].parent] and keep_sum[i] >= drop_sum[i]
    return keep


def blocks(page: Page, keep: np.ndarray) -> list[str]:
    """Kept text in page order, one string a block, white space folded."""
    out, last, parts = [], None, []
    for at, block, text in page.texts:
        if block != last and parts:
            out.append("".join(parts))
            parts = []
        last = block
        if keep[at]:
            parts.append(text)
    out.append("".join(parts))
    return [y for y in (" ".join(x.split()) for x in out) if y]


def main_texts(sources: list[str | None], model: boost.Boosted) -> list[str]:
    """The main text of each page; the trees are asked for all pages' nodes at once."""
    pages = [parse(x) if x else None for x in sources]
    known = [p for p in pages if p]
    if not known:
        return [""] * len(sources)
    margin = model.margin(np.concatenate([features(p) for p in known]))
    parts = iter(np.split(margin, np.cumsum([len(p.nodes) for p in known])[:-1]))
    return ["\n".join(blocks(p, decode(p, next(parts)))) if p else "" for p in pages]


class Maker:
    """Made-up pages: (html, labels) where the article's pieces are marked."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        r = self.r
        out = ["".join(r.choices(string.ascii_lowercase, k=r.randint(1, 10))) for _ in range(r.randint(low, high))]
        for i in range(len(out)):
            if r.random() < 0.1:
                out[i] += r.choice(".,,.;:?!")
        return " ".join(out).capitalize() + r.choice([".", ".", ".", "", "!"])

    def tag(self, tag: str, inner: str, names: tuple[str, ...] = (), main: bool = False) -> str:
        r = self.r
        attrs = MARK if main else ""
        if names and self.telling and r.random() < 0.85:
            name = r.choice(names)
            if r.random() < 0.3:
                name = r.choice(["site-", "page-", "my", "c-", "block-"]) + name
            attrs += f' {r.choice(["class", "class", "id"])}="{name}"'
        elif r.random() < 0.4:
            attrs += f' class="{"".join(r.choices(string.ascii_lowercase, k=4))}{r.randint(1, 99)}"'
        return f"<{tag}{attrs}>{inner}</{tag}>"

    def links(self, low: int, high: int, tag: str = "li") -> str:
        return "".join(self.tag(tag, f'<a href="/x">{self.words(1, 4)}</a>') for _ in range(self.r.randint(low, high)))

    def prose(self) -> str:
        r, out = self.r, []
        for _ in range(r.choice([1, 2, 3, 5, 8, 14, 25])):
            k = r.random()
            if k < 0.72:
                text = self.words(*r.choice([(1, 4), (5, 20), (20, 80), (60, 200)]))
                if r.random() < 0.25:
                    text = text.replace(" ", f' <a href="/y">{self.words(1, 3)}</a> ', 1)
                if r.random() < 0.15:
                    text = f"<b>{text}</b>" if r.random() < 0.5 else f"<b>{text}<br>"
                out.append(self.tag("p", text, main=True))
            elif k < 0.82:
                out.append(self.tag(r.choice(["h2", "h3", "h4"]), self.words(1, 8), main=True))
            elif k < 0.9:
                out.append(self.tag(r.choice(["ul", "ol"]), "".join(self.tag("li", self.words(2, 25), main=True) for _ in range(r.randint(1, 7)))))
            elif k < 0.95:
                out.append(self.tag("blockquote", self.tag("p", self.words(8, 40), main=True)))
            elif k < 0.98:
                rows = "".join(self.tag("tr", "".join(self.tag("td", self.words(1, 6), main=True) for _ in range(3))) for _ in range(r.randint(1, 5)))
                out.append(self.tag("table", rows))
            else:
                out.append(self.tag("figure", "<img src=x>" + self.tag("figcaption", self.words(3, 14), main=True)))
        return "".join(out)

    def page(self) -> str:
        r = self.r
        self.telling = r.random() < 0.75
        semantic = r.random() < 0.7
        pick = lambda t: t if semantic else "div"
        head = self.tag("h1", self.words(1, 14), main=True) if r.random() < 0.9 else ""
        if head and r.random() < 0.2:
            head = self.tag("header", head)
        body = head + self.prose()
        if r.random() < 0.3:
            body = head + self.tag("div", self.prose(), ("content", "entry-content", "text", "post-body", "article-body"))
        if r.random() < 0.25:
            cut = body.rfind("<p")
            body = body[:cut] + self.noise(("advert", "related", "share")) + body[cut:]
        article = self.tag(r.choice(["article", "main", "article", "section", "div"]) if semantic else "div", body, ("article", "post", "main", "content", "story", "entry"))
        nav = self.tag(pick("nav"), self.tag("ul", self.links(2, 9)) if r.random() < 0.8 else self.links(2, 9, "span"), ("nav", "menu", "navigation", "navbar"))
        top = nav if r.random() < 0.5 else self.tag(pick("header"), self.tag(r.choice(["h1", "h2", "div", "p"]), self.words(1, 4)) + nav, ("header", "masthead", "top"))
        foot = self.tag(pick("footer"), r.choice([self.tag("p", f"&copy; {self.words(2, 12)}"), f"&copy; {self.words(2, 12)} &middot; {self.words(2, 12)}", self.tag("ul", self.links(2, 8)), self.tag("div", self.words(4, 30))]), ("footer", "foot", "copyright", "colophon"))
        before = "".join(self.noise(("notice", "advert", "form", "sidebar", "share")) for _ in range(r.choice([0, 1, 1, 2])))
        after = "".join(self.noise(("comments", "related", "sidebar", "form", "advert", "notice", "share")) for _ in range(r.choice([0, 1, 1, 2, 3])))
        middle = before + article + after
        if r.random() < 0.35:
            middle = self.tag("div", middle, ("wrapper", "container", "page"))
        out = top + middle + foot
        tail = r.choice(["</body></html>", ""])
        return f"<!DOCTYPE html><html><head><title>{self.words(1, 9)}</title><style>p{{}}</style></head><body>{out}{tail}"

    def noise(self, kinds: tuple[str, ...]) -> str:
        r, kind = self.r, self.r.choice(kinds)
        semantic = r.random() < 0.6
        box = lambda t: t if semantic else "div"
        if kind == "advert":
            inner = r.choice([self.words(2, 25), self.tag("p", self.words(3, 25)), f'<a href="/z">{self.words(2, 9)}</a>'])
            return "<!-- x -->" + self.tag("div", inner, ("ad", "ads", "advert", "sponsored", "promo", "ad-banner"))
        if kind == "notice":
            return self.tag("div", self.tag("p", self.words(6, 40)) + r.choice(["", "<button>ok</button>"]), ("cookie", "consent", "notice", "alert", "popup", "newsletter"))
        if kind == "form":
            rows = "".join(f"<label>{self.words(1, 3)}</label><input name=a>" for _ in range(r.randint(1, 4)))
            return self.tag("form" if r.random() < 0.85 else "div", self.tag("p", self.words(2, 15)) + rows, ("login", "search", "signup", "contact-form"))
        if kind == "share":
            return self.tag("div", self.links(2, 5, "span"), ("share", "social", "sharing"))
        if kind == "comments":
            each = "".join(self.tag(r.choice(["div", "li", "article"]), self.tag("span", self.words(1, 2)) + self.tag("p", self.words(3, 60)), ("comment", "reply")) for _ in range(r.randint(1, 7)))
            return self.tag(box("section"), r.choice(["", self.tag("h3", self.words(1, 3))]) + each, ("comments", "discussion", "replies", "reader-comments"))
        inner = self.tag("h3", self.words(1, 4)) + self.tag("ul", self.links(2, 8))
        if kind == "sidebar" and r.random() < 0.5:
            inner += self.tag("p", self.words(5, 40))
        names = ("sidebar", "side", "widget", "rail") if kind == "sidebar" else ("related", "recommended", "more", "popular")
        return self.tag(box("aside"), inner, names)


def labels(page: Page) -> np.ndarray:
    """Whether each node holds, or lies in, a marked piece."""
    marked = np.array([x.mark for x in page.nodes])
    sums = np.concatenate(([0], marked.cumsum()))
    end = np.array([x.end for x in page.nodes])
    inside = sums[end] - sums[: len(end)] > 0
    for i, x in enumerate(page.nodes):
        if x.parent > 0 and marked[x.parent]:
            marked[i] = True
    return inside | marked


@lru_cache(maxsize=4)
def trained(pages: int = TRAIN_PAGES, seed: int = SEED) -> boost.Boosted:
    """Trees from ``pages`` made-up pages; the same arguments give the same trees."""
    maker, xs, ys = Maker(seed), [], []
    for _ in range(pages):
        page = parse(maker.page())
        scored = np.array([x.tag in BLOCK and not x.hidden and x.tag not in ("html", "body") for x in page.nodes])
        xs.append(features(page)[scored])
        ys.append(labels(page)[scored])
    return boost.fit(np.concatenate(xs), np.concatenate(ys).astype(float))


def extract(pages: DataFrame, *, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url"), model: boost.Boosted | None = None) -> DataFrame:
    """``keep``, text and n_chars (code points) of every page.

    Null and empty pages, and pages without an article, have an empty text; repeated
    rows stay; an empty table gives an empty result; other columns are left out.
    """
    held = pages.sparkSession.sparkContext.broadcast(model or trained())
    fields = [pages.schema[c] for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = held.value
        for b in batches:
            column, texts, at = b.column(b.num_columns - 1), [], 0
            while at < len(column):  # runs of pages of bounded size
                run_, size = [], 0
                while at < len(column) and (not run_ or size < RUN_CHARS) and len(run_) < RUN_PAGES:
                    run_.append(column[at].as_py())
                    size += len(run_[-1] or "")
                    at += 1
                texts += main_texts(run_, trees)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    source = pages[html_col].alias("html_in")
    return pages.select(*[pages[c] for c in keep], source).mapInArrow(run, f"{schema}, text string, n_chars bigint")
