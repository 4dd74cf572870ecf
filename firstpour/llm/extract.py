"""Main text of web pages: boosted trees over DOM nodes, decoded so that no choice contradicts another.

A page is read into its block elements. Each is described by its tag, the words in its class and id,
its depth, how much text, links, punctuation and paragraphs its subtree has, and how it compares with
its siblings. Gradient-boosted trees give the probability that a node holds article text. Decoding
takes the most likely set of nodes in which every kept node's ancestors are kept too, by dynamic
programming from the leaves up; so nothing is kept inside of what is dropped.

Pages carry no labels. The trees are trained on nodes whose role is plain from their tag or their
class (a menu, a footer, a paragraph of an article), each once as it is and once with its naming and
ancestry hidden, so that they also judge nodes that say nothing of themselves. Each page is used a few
times more with some of its own text set into a menu, notice, form or the like, inside or beside the
article, since a site's pages may show few kinds of these. Training takes
``PAGES`` different pages at most, those with the smallest hash, each once however often it occurs, and
``NODES`` nodes.

Scripts, styles, buttons and the like never count as text. Character references are decoded, white
space inside a block becomes one blank, a head whose end tag is left out ends where it must, blocks are joined by a line end. Null and empty pages have
empty text. Whole pages are read. Rows are independent of each other but for training; repeated rows
get repeated results, an empty table gives none, and without nodes to train on the plain roles decide.
Other columns stay as they are.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstpour.llm.tasks import map_text, ship, slices

#: Pages and nodes that training takes at most.
PAGES, NODES = 800, 30_000
TAG = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>?)")
NAMED = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PART = re.compile(r"[a-z]+|[0-9]+")
VOID = frozenset("area base basefont bgsound br col embed hr img input link meta source track wbr".split())
#: Elements whose content is not markup, and elements that hold no text of the page.
RAW = frozenset("script style textarea title xmp noembed noframes plaintext".split())
MUTE = RAW | frozenset("head noscript template iframe svg math object select button datalist canvas audio video map dialog".split())
#: What a head may hold; anything else ends it, as its end tag may be left out.
HEAD = frozenset("head base basefont bgsound link meta title noscript noframes style script template".split())
BLOCK = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th "
    "blockquote pre figure figcaption address details summary header footer nav aside form fieldset legend hgroup center".split()
)
#: What an opening tag ends, up to the nearest of the second set.
ENDS = {
    **{t: (frozenset(["p"]), frozenset("td th table button".split())) for t in BLOCK - frozenset("html body td th tr thead tbody tfoot caption".split())},
    "li": (frozenset(["li", "p"]), frozenset("ul ol".split())),
    "dt": (frozenset("dt dd p".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd p".split()), frozenset(["dl"])),
    "tr": (frozenset("tr td th p".split()), frozenset(["table"])),
    "td": (frozenset("td th p".split()), frozenset(["tr", "table"])),
    "th": (frozenset("td th p".split()), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
#: Tags and words of classes and ids that tell a node's role.
OUTSIDE = frozenset("nav footer aside form fieldset address".split())
INSIDE = frozenset("article main".split())
POOR = frozenset(
    "ad ads advert advertisement adsense sponsor sponsored promo banner nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "aside footer masthead topbar toolbar cookie cookies consent gdpr notice alert popup modal overlay comment comments reply replies "
    "disqus respond discussion share sharing social related recommended recommendations trending newsletter subscribe signup login "
    "search widget widgets pagination pager copyright legal skip tags meta byline".split()
)
RICH = frozenset("article content entry post story body text main prose blog news".split())
PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption".split())
STOPS = re.compile(r"[.,;:!?]")

FEATURES = (
    "article outside paragraph heading list cell generic header poor rich poor_above rich_above "
    "depth siblings place alike log_text log_own links link_share tags_per_char stops_per_char words_per_block "
    "paragraphs start share of_parent of_siblings digits"
).split()
#: Features that tell what a node or one above calls itself, hidden in half of the training rows.
NAMING = [FEATURES.index(f) for f in "article outside header poor rich poor_above rich_above".split()]
#: Further versions of each page, with text set into surroundings.
VARIANTS = 3
#: Surroundings that text is set into for training.
AROUND = (
    "footer", "aside", "header", "form", 'div class="comments"', 'div id="cookie-notice"', 'div class="sidebar"', 'section class="related"',
    'div class="ad"', 'div class="menu"', 'div class="newsletter"', 'section id="comments"', 'div class="share"', 'div id="footer"', 'div class="comment"',
)


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    poor: bool
    rich: bool


@dataclass
class Page:
    """Block elements in page order, and runs of text as (node, text, characters inside links)."""

    nodes: list[Node]
    runs: list[tuple[int, str, int]]
    tags: list[int]  # tags inside each node itself
    links: list[int]


def parse(source: str) -> Page:
    page = Page([Node("html", -1, 0, False, False)], [], [0], [0])
    stack: list[tuple[str, int]] = [("html", 0)]  # open elements, and the block each belongs to
    mute = linked = 0  # how many open elements are mute, are links
    held: list[str] = []
    in_links = 0

    def flush() -> None:
        nonlocal in_links
        if held:
            text = " ".join("".join(held).split())
            if text:
                page.runs.append((stack[-1][1], text, min(in_links, len(text))))
            held.clear()
        in_links = 0

    def pop() -> None:
        nonlocal mute, linked
        tag, _ = stack[-1]
        if tag in BLOCK:
            flush()
        stack.pop()
        mute -= tag in MUTE
        linked -= tag == "a"

    at, size = 0, len(source)
    while at < size:
        opening = source.find("<", at)
        m = TAG.match(source, opening) if opening >= 0 else None
        upto = opening if opening >= 0 else size
        if opening >= 0 and m is None:
            upto = opening + 1  # a lone bracket is text
        if stack[-1][0] == "head" and source[at:upto].strip():
            pop()
        if upto > at and not mute:
            piece = source[at:upto]
            if "&" in piece:
                piece = html.unescape(piece)
            held.append(piece)
            if linked:
                in_links += len(piece)
        if m is None:
            at = upto
            continue
        if m[2] is None:
            if m[0] == "<!--":
                end = source.find("-->", opening + 4)
                at = end + 3 if end >= 0 else size
            else:
                end = source.find(">", opening)
                at = end + 1 if end >= 0 else size
            continue
        at, tag = m.end(), m[2].lower()
        if m[1]:
            if any(t == tag for t, _ in stack[1:]):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if stack[-1][0] == "head" and tag not in HEAD and tag != "html":
            pop()
        elif tag == "body" and any(t == "head" for t, _ in stack) and all(t != "template" for t, _ in stack):
            while any(t == "head" for t, _ in stack):
                pop()
        if tag == "br" or tag == "hr":
            if not mute:
                held.append(" ")
            if tag == "hr":
                flush()
        block = stack[-1][1]
        page.tags[block] += 1
        if tag in VOID:
            continue
        if tag in ("html", "body") and any(t == tag for t, _ in stack):
            continue
        if tag in ENDS:
            ended, upper = ENDS[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in upper or stack[k][0] in INSIDE:
                    break
                if stack[k][0] in ended:
                    while len(stack) > k:
                        pop()
            block = stack[-1][1]
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(source, at)
            at = end.end() if end else size
            continue
        if m[3].rstrip().endswith("/") and tag not in BLOCK:
            continue
        if tag == "a":
            linked += 1
            page.links[block] += 1
        mute += tag in MUTE
        if tag in BLOCK and not mute:
            flush()
            words: set[str] = set()
            if m[3]:
                for found in NAMED.findall(m[3]):
                    words.update(PART.findall("".join(found).lower()))
            page.nodes.append(Node(tag, block, page.nodes[block].depth + 1, bool(words & POOR), bool(words & RICH)))
            page.tags.append(0)
            page.links.append(0)
            block = len(page.nodes) - 1
        stack.append((tag, block))
    while len(stack) > 1:
        pop()
    flush()
    return page


def described(page: Page) -> np.ndarray:
    """A row of features per node."""
    n = len(page.nodes)
    own, first, blocks, words, stops, digits, linked = ([0] * n for _ in range(7))
    seen = 0
    first = [-1] * n
    for node, text, in_links in page.runs:
        own[node] += len(text)
        if first[node] < 0:
            first[node] = seen
        seen += len(text)
        blocks[node] += 1
        words[node] += text.count(" ") + 1
        stops[node] += len(STOPS.findall(text))
        digits[node] += sum(map(text.count, "0123456789"))
        linked[node] += in_links
    parents = [x.parent for x in page.nodes]
    paragraphs = [int(x.tag == "p") for x in page.nodes]
    tags, links, text = page.tags[:], page.links[:], own[:]
    children: list[list[int]] = [[] for _ in range(n)]
    after = [0] * n  # siblings that follow
    for i in range(n - 1, 0, -1):  # children come after their parents
        p = parents[i]
        after[i] = len(children[p])
        children[p].append(i)
        for sums in (text, blocks, words, stops, digits, linked, paragraphs, tags, links):
            sums[p] += sums[i]
        if first[i] >= 0 and (first[p] < 0 or first[i] < first[p]):
            first[p] = first[i]
    rows = np.zeros((n, len(FEATURES)), np.float32)
    above = [(False, False)] * n
    for i, x in enumerate(page.nodes):
        if i:
            p = parents[i]
            up = page.nodes[p]
            above[i] = (above[p][0] or up.poor or up.tag in OUTSIDE, above[p][1] or up.rich or up.tag in INSIDE)
            count = len(children[p])
            place = count - 1 - after[i]
        else:
            count, place = 1, 0
        size = text[i]
        rows[i] = (
            x.tag in INSIDE, x.tag in OUTSIDE, x.tag == "p" or x.tag == "blockquote", len(x.tag) == 2 and x.tag[0] == "h" and x.tag != "hr",
            x.tag in ("ul", "ol", "li", "dl", "dt", "dd"), x.tag in ("table", "tr", "td", "th", "tbody"), x.tag in ("div", "section", "center"),
            x.tag == "header", x.poor, x.rich, above[i][0], above[i][1],
            x.depth, count, (place + 1) / count, 0, math.log1p(size), math.log1p(own[i]), links[i], linked[i] / (size + 1), tags[i] / (size + 1),
            stops[i] / (size + 1), words[i] / (blocks[i] + 1), paragraphs[i], max(first[i], 0) / (seen + 1), size / (seen + 1),
            size / (text[parents[i]] + 1) if i else 1, 0, digits[i] / (size + 1),
        )
    alike, largest = FEATURES.index("alike"), FEATURES.index("of_siblings")
    for brothers in children:
        if brothers:
            tags_of = [page.nodes[b].tag for b in brothers]
            most = max(text[b] for b in brothers)
            times = {t: tags_of.count(t) for t in set(tags_of)}
            for b, t in zip(brothers, tags_of, strict=True):
                rows[b, alike] = times[t]
                rows[b, largest] = text[b] / (most + 1)
    return rows


def plain(page: Page) -> list[int]:
    """1 for nodes that plainly hold article text, 0 for those that plainly do not, -1 where it is not plain.

    Ancestors of article text hold it as well.
    """
    n = len(page.nodes)
    inside, outside, role = [False] * n, [False] * n, [-1] * n
    filled = {r[0] for r in page.runs}
    for i, x in enumerate(page.nodes):
        p = x.parent
        if i:
            inside[i] = inside[p] or x.tag in INSIDE or x.rich
            outside[i] = outside[p] or x.tag in OUTSIDE or x.poor or x.tag == "header" and not inside[p]
        if outside[i]:
            role[i] = 0
        elif inside[i] and x.tag in PLAIN and i in filled:
            role[i] = 1
    for i in range(n - 1, 0, -1):
        if role[i] == 1 and not outside[page.nodes[i].parent]:
            role[page.nodes[i].parent] = 1
    return role


class Trees:
    """Gradient-boosted regression trees for a yes or no, grown on binned features."""

    def __init__(self, rounds: int = 40, depth: int = 4, rate: float = 0.25, bins: int = 24):
        self.rounds, self.depth, self.rate, self.bins = rounds, depth, rate, bins
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # feature, threshold, value by node of a full tree
        self.start = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1], method="lower")) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
        self.start = math.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))
        score = np.full(len(y), self.start)
        inner, width = (1 << self.depth) - 1, self.bins + 1
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            slope, curve = y - p, p * (1 - p)
            feature, threshold, value = np.zeros(inner, int), np.full(inner, np.inf), np.zeros(1 << self.depth)
            at = np.zeros(len(y), int)
            for level in range(self.depth):
                first, count = (1 << level) - 1, 1 << level
                best = np.full(count, 1e-6)
                total = [np.bincount(at, w, count) for w in (slope, curve)]
                for j, e in enumerate(edges):
                    if not len(e):
                        continue
                    cell = at * width + binned[:, j]
                    g, h = (np.bincount(cell, w, count * width).reshape(count, width).cumsum(axis=1) for w in (slope, curve))
                    gain = g**2 / (h + 1) + (total[0][:, None] - g) ** 2 / (total[1][:, None] - h + 1) - (total[0] ** 2 / (total[1] + 1))[:, None]
                    gain = gain[:, : len(e)]
                    pick = gain.argmax(axis=1)
                    better = gain[np.arange(count), pick] > best
                    for node in np.flatnonzero(better):
                        best[node] = gain[node, pick[node]]
                        feature[first + node], threshold[first + node] = j, e[pick[node]]
                at = at * 2 + (x[np.arange(len(y)), feature[first + at]] > threshold[first + at])
            g, h = (np.bincount(at, w, 1 << self.depth) for w in (slope, curve))
            value = self.rate * g / (h + 1)
            score += value[at]
            self.trees.append((feature, threshold, value))
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        score, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, threshold, value in self.trees:
            at = np.zeros(len(x), int)
            for level in range(self.depth):
                k = (1 << level) - 1 + at
                at = at * 2 + (x[rows, feature[k]] > threshold[k])
            score += value[at]
        return 1 / (1 + np.exp(-score))


def decode(page: Page, probability: np.ndarray) -> list[bool]:
    """The likeliest choice of nodes with every kept one's parent kept."""
    p = np.clip(probability, 1e-6, 1 - 1e-6)
    keep, drop = np.log(p).tolist(), np.log(1 - p).tolist()
    takes = [False] * len(keep)
    for i in range(len(keep) - 1, 0, -1):
        takes[i] = keep[i] > drop[i]
        up = page.nodes[i].parent
        keep[up] += max(keep[i], drop[i])
        drop[up] += drop[i]
    kept = [keep[0] > drop[0]] + [False] * (len(keep) - 1)
    for i in range(1, len(keep)):
        kept[i] = kept[page.nodes[i].parent] and takes[i]
    return kept


def main_text(page: Page, kept: list[bool]) -> str:
    return "\n".join(text for node, text, _ in page.runs if kept[node])


def surrounded(source: str, seed: int) -> str:
    """The page with two groups of its own text set into surroundings that are no article, and one into plain elements."""
    runs = [html.escape(t) for _, t, _ in parse(source).runs]
    if not runs:
        return source
    random = np.random.default_rng(seed & 0xFFFFFFFF)
    for around in (*np.array(AROUND)[random.integers(len(AROUND), size=2)], None):
        tags = ["p", "p", "li", "div", "h3"] if around else ["td", "li", "dd", "blockquote", "pre"]
        inner = "".join(
            f"<{tag}>{runs[random.integers(len(runs))][: random.integers(20, 400)]}</{tag}>"
            for tag in np.array(tags)[random.integers(5, size=random.integers(1, 6))]
        )
        places = [m.start() for m in re.finditer(r"</?(?:article|main|p)\b" if around else r"<p\b", source, re.I)] or [len(source)]
        place = places[random.integers(len(places))]
        inner = f"<{around}>{inner}</{around.split()[0]}>" if around else f"<section>{inner}</section>"
        source = source[:place] + inner + source[place:]
    return source


def sample(pages: DataFrame, source: str, at_most: int) -> DataFrame:
    """Different pages with the smallest hashes, in their order. Only hashes are compared over all pages."""
    hashed = pages.select(F.col(source).alias("html")).where("html is not null").withColumn("h", F.xxhash64("html"))
    smallest = hashed.select("h").distinct().orderBy("h").limit(at_most)
    return hashed.join(F.broadcast(smallest), "h", "left_semi").select("html", "h").distinct().orderBy("h", "html").limit(at_most)


def learn(pages: DataFrame, source: str = "html", pages_at_most: int = PAGES, nodes_at_most: int = NODES) -> Trees | None:
    """Trees from the nodes of a sample of pages whose role is plain; none without nodes of both kinds."""
    picked = sample(pages, source, pages_at_most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "html"):
                found, roles, keys = [], [], []
                for text, h in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                    for page, extra in ((parse(text), 0), *((parse(surrounded(text, h + k)), 2) for k in range(VARIANTS))):
                        role = np.array(plain(page))
                        own = described(page)[role >= 0]
                        found.append(own)
                        roles.append(role[role >= 0] + extra)
                        order = np.random.default_rng([h & 0xFFFFFFFF, len(keys)])
                        keys.append(order.integers(1 << 62, size=len(own)))
                flat = np.concatenate(found).astype(np.float32)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(flat.ravel()), len(FEATURES)).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([lists, pa.array(np.concatenate(roles).astype(np.int32)), pa.array(np.concatenate(keys))], names=["x", "y", "k"])

    nodes = picked.mapInArrow(run, "x array<float>, y int, k long").orderBy("k").limit(nodes_at_most).collect()
    return fit(np.array([r[0] for r in nodes], np.float32).reshape(-1, len(FEATURES)), np.array([r[1] for r in nodes], int))


def fit(x: np.ndarray, role: np.ndarray) -> Trees | None:
    """Trees from nodes and roles; 2 is added to the roles of nodes of pages with text set into them."""
    y = (role % 2).astype(float)
    if len(np.unique(y)) < 2:
        return None
    hidden = x[role < 2].copy()
    hidden[:, NAMING] = 0
    return Trees().fit(np.concatenate([x, hidden]), np.concatenate([y, y[role < 2]]))


def extract(pages: DataFrame, trees: Trees | None, source: str = "html", into: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``pages`` with the main text of each whole page."""
    shipped = ship(pages, trees)

    def work(_: pa.RecordBatch, texts: list[str]) -> dict[str, object]:
        model, read = shipped.value, [parse(t) for t in texts]
        if model is None:
            chances = [np.array(plain(p)) * 0.4 + 0.5 for p in read]
        elif read:
            flat = model.probability(np.concatenate([described(p) for p in read]))
            chances = np.split(flat, np.cumsum([len(p.nodes) for p in read])[:-1])
        return {into: [main_text(p, decode(p, c)) for p, c in zip(read, chances, strict=True)]}

    return map_text(pages, source, f"`{into}` string", work, keep)
