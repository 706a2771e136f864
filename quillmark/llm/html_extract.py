"""Main text of web pages by a minimum cut over their blocks.

A page is cut into blocks of text with the open elements around each. A logistic
classifier gives every block the odds of being content; these become the capacities of
its edges to the two terminals. Neighbouring blocks, and blocks next to each other under
one parent, are tied by edges that are the stronger the closer the two stand in the
document tree. The maximum flow then separates content from boilerplate at least cost.

The classifier learns from blocks whose place says what they are: those below article or
main are content, those below navigation, footers, forms and the like are not. Half of
the examples hide these hints, so that pages without them are read by the rest. It is
fitted on a bounded sample of blocks (``SAMPLE_PAGES``, ``SAMPLE_BLOCKS``) and starts
from plain prior weights, which hold where nothing can be learned.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm.common import read, sigmoid, small_batches

SAMPLE_PAGES = 400
SAMPLE_CHARS = 200_000
SAMPLE_BLOCKS = 20_000
#: Strength of ties: neighbours in general, and under one parent.
TIE, CLOSE = 0.4, 1.2
LIMIT = 6.0

#: Elements of HTML by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template head svg math iframe object select button textarea canvas audio video datalist".split())
RAW = frozenset("script style noscript iframe textarea title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
BOILER_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
CONTENT_TAGS = frozenset("article main".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
BOILER_WORDS = frozenset(
    """ad ads advert advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice
    notices alert sidebar side aside widget related recommended share sharing social follow comment comments reply replies
    respond disqus footer foot header masthead nav navigation navbar menu breadcrumb breadcrumbs pagination pager toolbar
    newsletter subscribe subscription signup login popup modal overlay form search copyright legal skip toc tags""".split()
)
CONTENT_WORDS = frozenset("article content post entry story body text main".split())

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|style|aria-hidden)(?=[\s=/>]|$)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_WORDS = re.compile(r"[a-z]+")
#: An element with more than this share of a page's text is no boilerplate by its name;
#: on pages with and without articles.
MOST, NEARLY_ALL = 0.6, 0.85
N_FEATURES = 15


class Element:
    """An element with what its own name and attributes say, and what that comes to below."""

    __slots__ = ("tag", "parent", "depth", "own_boiler", "own_content", "own_named_boiler", "own_named_content", "boiler", "content", "named_boiler", "named_content", "hidden", "link", "head", "held", "articles")

    def __init__(self, tag: str, parent: Element | None, attributes: str):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.hidden = tag in HIDDEN or bool(parent and parent.hidden)
        self.link = tag == "a" or bool(parent and parent.link)
        self.head = (len(tag) == 2 and tag[0] == "h" and tag[1] in "123456") or bool(parent and parent.head)
        self.own_boiler = tag in BOILER_TAGS
        self.own_content = tag in CONTENT_TAGS
        self.own_named_boiler = self.own_named_content = False
        self.boiler = self.content = self.named_boiler = self.named_content = False
        self.held = self.articles = 0
        if attributes and tag not in ("html", "body"):
            for name, value in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), value.strip("\"'").lower()
                if name in ("class", "id"):
                    words = set(_WORDS.findall(value))
                    self.own_named_boiler |= bool(words & BOILER_WORDS)
                    self.own_named_content |= bool(words & CONTENT_WORDS)
                elif name == "role":
                    self.own_boiler |= value in BOILER_ROLES
                    self.own_content |= value in ("main", "article")
                elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                    self.hidden = True
                elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                    self.hidden = True

    def place(self, total: int, articles: int) -> None:
        """Hints from the elements around, outermost first.

        What a boilerplate element holds stays boilerplate, inside an article as well. An
        element that holds most of the page's text, and all of what stands in articles,
        is no boilerplate whatever it is called: a form around the page, say.
        """
        above = self.parent
        neutral = self.held > (MOST if articles else NEARLY_ALL) * total and self.articles == articles
        self.boiler = bool(above and above.boiler) or (self.own_boiler and not neutral)
        self.boiler |= self.tag == "header" and not (above and above.content) and not neutral
        self.named_boiler = bool(above and above.named_boiler) or (self.own_named_boiler and not neutral)
        self.named_content = self.own_named_content or bool(above and above.named_content)


def place_all(found: list[Block]) -> None:
    """Fills in the hints of every element that holds a block, each element once."""
    seen: dict[int, Element] = {}
    for b in found:
        up = b.at
        while up and id(up) not in seen:
            seen[id(up)] = up
            up = up.parent
    elements = sorted(seen.values(), key=lambda e: e.depth)
    for e in elements:
        e.content = e.own_content or bool(e.parent and e.parent.content)
    for b in found:
        b.at.held += len(b.text)
        b.at.articles += len(b.text) * b.at.content
    for e in reversed(elements):
        if e.parent:
            e.parent.held += e.held
            e.parent.articles += e.articles
    if elements:
        total, articles = elements[0].held, elements[0].articles
        for e in elements:
            e.place(total, articles)


class Block:
    __slots__ = ("text", "at", "linked")

    def __init__(self, text: str, at: Element, linked: int):
        self.text, self.at, self.linked = text, at, linked


def blocks(page: str) -> list[Block]:
    """Visible blocks in page order: character references decoded, white space folded."""
    root = Element("#root", None, "")
    now, out = root, []
    parts: list[tuple[str, bool]] = []
    owner = root

    def end_block() -> None:
        nonlocal parts
        if parts:
            text = " ".join(entities.unescape("".join(p for p, _ in parts)).split())
            if text:
                linked = sum(len(p.strip()) for p, link in parts if link)
                out.append(Block(text, owner, linked))
            parts = []

    def add(piece: str) -> None:
        nonlocal owner
        if piece and not now.hidden:
            if not parts:
                holder = now
                while holder.tag in INLINE and holder.parent:
                    holder = holder.parent
                owner = holder
            parts.append((piece, now.link))

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            up = now
            while up is not root and up.tag != tag:
                up = up.parent
            if tag not in INLINE:
                end_block()
            if up is not root:
                now = up.parent
            continue
        if tag == "br":
            add(" ")
            continue
        if tag not in INLINE:
            end_block()
            if tag in CLOSES_P or tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                now = _closed(now, tag)
        if tag in VOID:
            continue
        element = Element(tag, now, m[3])
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = close.end() if close else size
            continue
        if not m[3].rstrip().endswith("/") or tag in INLINE or tag in CLOSES_P:
            now = element
    end_block()
    place_all(out)
    return out


def _closed(now: Element, tag: str) -> Element:
    """The element that a new block element of this name stands in: open paragraphs end."""
    up = now
    while up.parent and (up.tag in INLINE or up.tag == "p" or up.tag == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option")):
        if up.tag not in INLINE:
            return up.parent
        up = up.parent
    return now


def features(found: list[Block]) -> np.ndarray:
    """One row per block: hints of its place first, then what it looks like."""
    total = sum(len(b.text) for b in found) or 1
    out, before = np.zeros((len(found), N_FEATURES)), 0
    for k, b in enumerate(found):
        n, at = len(b.text), b.at
        words = b.text.count(" ") + 1
        stops = sum(map(b.text.count, ".,;!?"))
        out[k] = (
            at.boiler,
            at.content and not at.boiler,
            at.named_boiler,
            at.named_content,
            np.log1p(words) / 4,
            min(1.0, b.linked / n),
            min(1.0, 4 * stops / words),
            at.head,
            at.tag == "p",
            at.tag in ("li", "td", "th", "dd", "dt"),
            words < 5,
            b.text[-1] in ".!?:\"'”»",
            before / total,
            "©" in b.text,
            n / total,
        )
        before += n
    return out


HINTS = (0, 1, 2, 3)
#: Where learning starts: hints count most, long unlinked prose is content.
PRIOR = np.array([-4.0, 3.0, -4.0, 0.5, 2.0, -3.0, 0.5, 0.5, 0.7, -0.5, -0.5, 0.3, 0.0, -2.0, 0.5, -1.0])


def fit(rows: list[tuple[list[float], int]]) -> np.ndarray:
    """Weights and intercept, pulled to the prior; every example also with hidden hints."""
    if len({y for _, y in rows}) < 2:
        return PRIOR
    x = np.array([r[0] for r in rows])
    blind = x.copy()
    blind[:, HINTS] = 0
    x = np.column_stack([np.concatenate([x, blind]), np.ones(2 * len(rows))])
    y = np.array([r[1] for r in rows] * 2, float)
    share = np.array([1 / max(1, (y == k).sum()) for k in (0, 1)])[y.astype(int)]
    w = PRIOR.copy()
    for _ in range(25):
        p = sigmoid(x @ w)
        gradient = x.T @ (share * (p - y)) + 0.02 * (w - PRIOR)
        hessian = (x * (share * p * (1 - p))[:, None]).T @ x + 0.02 * np.eye(len(w))
        w = w - np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return w


def ties(found: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between neighbours, and from each block to the one before it under its parent."""
    out, last = [], {}
    for k, b in enumerate(found):
        if k:
            a = found[k - 1]
            steps = _apart(a.at, b.at)
            # An article and a menu next to each other are hardly tied at all.
            same = a.at.content == b.at.content and a.at.boiler == b.at.boiler and a.at.named_boiler == b.at.named_boiler
            out.append((k - 1, k, CLOSE / steps if same else TIE / (2 * steps)))
        parent = b.at.parent or b.at
        j = last.get(id(parent))
        if j is not None and j != k - 1:
            out.append((j, k, CLOSE / 2))
        last[id(parent)] = k
    return out


def _apart(a: Element, b: Element) -> int:
    """Steps up to the nearest element that holds both, the longer way, at least 1."""
    way = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        if b.depth > a.depth:
            b = b.parent
        way += 1
        if a is None or b is None:
            break
    return max(1, way)


def minimum_cut(odds: np.ndarray, edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source, by maximum flow.

    Positive odds are capacities from the source, negative ones to the sink. Each phase
    measures every node's steps to the sink once and then sends flow along shortest paths
    only, leaving each edge behind once it is of no more use; the few phases that blocks
    in page order need are each linear in the edges.
    """
    n = len(odds)
    source = [max(0.0, float(o)) for o in odds]
    sink = [max(0.0, -float(o)) for o in odds]
    # Edge 2k goes from a to b, its other way is 2k + 1.
    to: list[int] = []
    room: list[float] = []
    around: list[list[int]] = [[] for _ in range(n)]
    for a, b, c in edges:
        around[a].append(len(to))
        around[b].append(len(to) + 1)
        to += (b, a)
        room += (c, c)
    tiny = 1e-9
    while True:
        steps = [-1] * n
        queue = deque(k for k in range(n) if sink[k] > tiny)
        for k in queue:
            steps[k] = 0
        while queue:
            k = queue.popleft()
            for e in around[k]:
                j = to[e]
                if steps[j] < 0 and room[e ^ 1] > tiny:
                    steps[j] = steps[k] + 1
                    queue.append(j)
        starts = [k for k in range(n) if source[k] > tiny and steps[k] >= 0]
        if not starts:
            break
        tried = [0] * n
        for start in starts:
            path: list[int] = []
            k = start
            while source[start] > tiny:
                if sink[k] > tiny and steps[k] == 0:
                    flow = min([source[start], sink[k], *(room[e] for e in path)])
                    source[start] -= flow
                    sink[k] -= flow
                    for e in path:
                        room[e] -= flow
                        room[e ^ 1] += flow
                    # Go on from the first edge that is full.
                    full = next((i for i, e in enumerate(path) if room[e] <= tiny), len(path))
                    if full < len(path):
                        k = to[path[full] ^ 1]
                        del path[full:]
                    continue
                while tried[k] < len(around[k]):
                    e = around[k][tried[k]]
                    if room[e] > tiny and steps[to[e]] == steps[k] - 1:
                        break
                    tried[k] += 1
                if tried[k] < len(around[k]):
                    path.append(around[k][tried[k]])
                    k = to[path[-1]]
                elif path:
                    e = path.pop()
                    k = to[e ^ 1]
                    tried[k] += 1
                else:
                    break
    kept = [c > tiny for c in source]
    queue = deque(k for k in range(n) if kept[k])
    while queue:
        k = queue.popleft()
        for e in around[k]:
            if room[e] > tiny and not kept[to[e]]:
                kept[to[e]] = True
                queue.append(to[e])
    return kept


def main_text(page: str, weights: np.ndarray) -> str:
    """Content blocks in page order, joined by one space; empty if there are none."""
    found = blocks(page)
    if not found:
        return ""
    odds = np.clip(features(found) @ weights[:-1] + weights[-1], -LIMIT, LIMIT)
    chosen = minimum_cut(odds, ties(found))
    return " ".join(b.text for b, keep in zip(found, chosen) if keep)


def train(pages: DataFrame) -> np.ndarray:
    """Fit on the blocks of a sample of pages that is chosen by a hash of the page's html."""
    sample = (
        pages.where(F.length("html") <= SAMPLE_CHARS)
        .select("html", F.xxhash64("html").alias("h"))
        .orderBy("h")
        .limit(SAMPLE_PAGES)
        .select("html")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in small_batches(batches):
            out = []
            for page in batch["html"]:
                found = blocks(page)
                for b, x in zip(found, features(found)):
                    bad = b.at.boiler or b.at.named_boiler
                    if bad or b.at.content:
                        out.append((list(x), int(not bad)))
            yield pd.DataFrame(out, columns=["x", "y"])

    rows = sample.mapInPandas(run, "x array<double>, y int").limit(SAMPLE_BLOCKS).collect()
    return fit([(r.x, r.y) for r in rows])


def extract(pages: DataFrame, weights: np.ndarray) -> DataFrame:
    """page_id, url, text and n_chars of every row; null html gives the empty text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in small_batches(batches):
            text = [main_text(x, weights) for x in batch["html"]]
            yield pd.DataFrame(
                {"page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "text": text, "n_chars": list(map(len, text))}
            )

    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    return rows.mapInPandas(run, "page_id bigint, url string, text string, n_chars bigint")


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page; null, empty and text-free pages give the empty text."""
    pages = read(spark, sf_dir, "pages")
    return extract(pages, train(pages))
