"""Main text of web pages by minimum-cut labelling of their blocks.

A page is read into blocks: runs of text between block-level tags, each with its
place in the element tree and the region that it lies in.  What becomes of them is
decided by one minimum cut:

* every block is a node; its terminal capacity is the cost of either label by a
  linear classifier of its text alone (length, share of linked text, sentence end,
  kind of element), no larger than ``MOST``;
* every region (``article``, ``nav``, a whole class name such as ``ad``) is a node
  too; its terminal capacity says what such a region holds;
* smoothness edges tie neighbours in page order, close places in the element tree, a
  block to its region and a region to the one around it.

So a short line between two paragraphs, or a list of links inside an article, follows
its surroundings against its own text, and a long sentence in a menu does too.  Only
regions by tag (and comments) have ties that no text can outweigh; a name that merely
contains a word such as ``share`` weighs less than a paragraph.

The classifier is fitted to the pages at hand: blocks of a bounded sample of pages
inside ``article`` and ``main`` are examples of content, those inside ``nav``,
``footer``, ``aside`` and ``form`` of boilerplate, and logistic regression in numpy
finds the weights, drawn towards ``PRIOR`` where there are few examples.

Nodes whose terminal capacities outweigh all their edges keep their label in any
minimum cut; they are fixed first and max-flow runs over the rest.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import chunks, ship

CHUNK = 1 << 20

# elements that end a run of text
_BLOCK = frozenset("""address article aside blockquote body br button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav
ol option optgroup p pre section select summary table tbody td tfoot th thead title tr ul""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# elements whose content is never page text
_SKIP = frozenset("script style noscript template iframe object svg canvas textarea title audio video xmp".split())
# a start tag of the key ends an open element of the value
_ENDS = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
         "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
_CLOSES_P = _BLOCK - {"br", "button", "option", "body", "html", "head"}

# regions of tags and roles: boilerplate for good, content
_HARD_TAGS = frozenset("nav footer aside form menu dialog button select head".split())
_HARD_ROLES = frozenset("navigation contentinfo complementary search dialog alert alertdialog form menu".split())
_CONTENT_TAGS = frozenset("article main".split())
# whole class names and ids: reader comments, boilerplate, content
_COMMENTS = frozenset("comment comments commentlist reply replies respond disqus".split())
_NAMED = frozenset("""ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion
cookie cookies consent gdpr notice notification alert social recommended recommendations subscribe subscription
newsletter popup modal overlay login signup signin register pagination pager breadcrumb breadcrumbs nav navbar
navigation navi footer copyright sidebar side aside menu menubar header masthead banner topbar toolbar widget
widgets""".split())
# names that an article may use for its own parts: evidence, not a verdict
_WEAK = _NAMED | frozenset("discussion related share sharing search".split())
_CONTENT_NAMES = frozenset("article post entry story content main maincontent".split())

# capacity of a region's node (positive: content) and of the tie of each of its blocks
_REGIONS = {"open": (0.0, 0.0), "outside": (-1000.0, 5.0), "beside": (-6.0, 1.0), "hard": (-1000.0, 100.0),
            "named": (-20.0, 6.0), "weak": (-1.5, 0.8), "content": (1000.0, 3.5), "named content": (6.0, 2.0)}
#: tie of a region to the one around it
_AROUND = {"weak": 3.0, "content": 0.5, "named content": 0.5}

_ATTR = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|(?<![\w-])(hidden)(?![\w-])""")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_TO_END = re.compile(r"""[^>"']*""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_END = re.compile(r"""[.!?…:。！？]["'”’»)\]]*$""")

FEATURES = ("bias", "length", "links", "sentence", "paragraph", "heading", "list")
#: weights before any example is seen: log-odds of content
PRIOR = (-1.5, 0.5, -4.0, 0.8, 0.8, 0.6, -0.3)
#: largest terminal capacity of a block
MOST = 3.0
#: smoothness between neighbours in page order, and between blocks of one parent; halved per tree step
_NEXT, _SIBLING = 0.8, 1.2
#: bounds of the sample that the weights are fitted to
SAMPLE_PAGES, SAMPLE_BLOCKS = 400, 400


class Region:
    __slots__ = ("kind", "around")

    def __init__(self, kind, around):
        self.kind, self.around = kind, around


class Block:
    __slots__ = ("text", "parent", "tag", "region", "linked", "chars")

    def __init__(self, text, parent, tag, region, linked, chars):
        self.text, self.parent, self.tag, self.region, self.linked, self.chars = \
            text, parent, tag, region, linked, chars


def _region(tag: str, raw: str, around: Region) -> Region | None:
    """Region of an element: its own if it opens one, else that around it; None if it is hidden."""
    attrs = {}
    if raw and ("=" in raw or "hidden" in raw):
        for k, v, lone in _ATTR.findall(raw):
            attrs[(k or lone).lower()] = v.strip("\"'")
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or _HIDDEN.search(attrs.get("style", "")):
        return None
    if around.kind == "hard":
        return around
    role = attrs.get("role", "").lower()
    names = [n for k in ("class", "id") for n in attrs.get(k, "").split()]
    whole = {n.lower() for n in names}
    if tag in _HARD_TAGS or role in _HARD_ROLES:
        return Region("hard", around)
    words = [[w.lower() for w in _WORDS.findall(n)] for n in names]
    comments = any(w and w[0] in _COMMENTS for w in words)
    if tag in _CONTENT_TAGS or role in ("main", "article"):
        if whole & _COMMENTS or comments and not whole & _CONTENT_NAMES:
            return Region("hard", around)
        return Region("named" if whole & _NAMED else "content", around)
    if tag in ("body", "html") or not (names or tag == "header" or role == "banner"):
        return around
    if whole & _COMMENTS or comments:
        return Region("hard", around)
    inside = around.kind in ("content", "named content")
    if whole & _NAMED or (tag == "header" or role == "banner") and not inside:
        return Region("named", around)
    if any(w in _WEAK for x in words for w in x):
        return Region("weak", around)
    if whole & _CONTENT_NAMES and around.kind == "open":
        return Region("named content", around)
    return around


class _Tags:
    """The tags of a page in order, each character looked at a bounded number of times.

    A tag ends at the first > outside quotes.  Where quotes leave none, they are not
    looked at from there on, and a < that no > follows is text."""

    def __init__(self, page: str):
        self.page, self.last, self.quotes = page, page.rfind(">"), True

    def end_of(self, at: int) -> int:
        """Place of the > that ends the tag whose attributes begin at ``at``, or -1."""
        page, k = self.page, at
        while self.quotes:
            k = _TO_END.match(page, k).end()
            if k >= len(page):
                self.quotes = False
            elif page[k] == ">":
                return k
            else:
                close = page.find(page[k], k + 1)
                if close < 0:
                    self.quotes = False
                k = close + 1
        return page.find(">", at)

    def next(self, at: int):
        """(start, end, closing, name, attributes) of the next tag from ``at``; name is empty for comments."""
        page = self.page
        while True:
            at = page.find("<", at)
            if at < 0 or at > self.last and not page.startswith("<!--", at):
                return None
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                return at, len(page) if end < 0 else end + 3, False, "", ""
            closing = page.startswith("/", at + 1)
            name = _NAME.match(page, at + 1 + closing)
            if name:
                end = self.end_of(name.end())
                if end < 0:
                    return None
                return at, end + 1, closing, name[0].lower(), page[name.end():end]
            if page.startswith(("!", "?", "/"), at + 1):
                return at, page.find(">", at) + 1, False, "", ""
            at += 1


def blocks_of(page: str) -> tuple[list[Block], list[int], list[int]]:
    """Blocks in page order, and parent and depth of every element."""
    parent, depth = [-1], [0]
    top = Region("open", None)
    stack = [(0, "", top)]  # (element, tag, region); the region of a hidden element is None
    inner: list[int] = []   # places of block-level elements in the stack
    count: dict[str, int] = {}
    out: list[Block] = []
    run: list[str] = []
    linked, in_link = 0, 0
    by_tag = by_name = False

    def flush():
        nonlocal linked
        if run:
            words = html.unescape("".join(run)).split()
            if words:
                text = " ".join(words)
                node, tag, region = stack[-1]
                out.append(Block(text, node, tag, region, linked, sum(map(len, run))))
            run.clear()
        linked = 0

    def cut(k):
        """Close the elements of the stack from place k on."""
        if stack[k - 1][2] is not stack[-1][2] and stack[-1][2] is not None and stack[k - 1][2] is not None:
            flush()
        for _, tag, _ in stack[k:]:
            count[tag] -= 1
        del stack[k:]
        while inner and inner[-1] >= k:
            inner.pop()

    tags = _Tags(page)
    at, n = 0, len(page)
    while at < n:
        m = tags.next(at)
        piece = page[at:m[0]] if m else page[at:]
        if piece and stack[-1][2] is not None:
            run.append(piece)
            if in_link:
                linked += len(piece)
        if not m:
            break
        _, at, closing, tag, raw = m
        if not tag:
            continue
        if closing:
            if tag == "a":
                in_link = 0
            if tag in _BLOCK and stack[-1][2] is not None:
                flush()
            if count.get(tag):
                k = len(stack) - 1
                while stack[k][1] != tag:
                    k -= 1
                cut(k)
            continue
        if tag in _SKIP:
            if not raw.rstrip().endswith("/"):
                end = re.compile(rf"</{tag}[\s>/]", re.I).search(page, at)
                close = page.find(">", end.end() - 1) if end else -1
                at = close + 1 if close >= 0 else n
            continue
        if tag in _BLOCK:
            if stack[-1][2] is not None:
                flush()
            ends = _ENDS.get(tag, {"p"} if tag in _CLOSES_P else ())
            while inner and stack[inner[-1]][1] in ends:  # implied end tags, up to the nearest container
                cut(inner[-1])
        if tag in _VOID:
            continue
        if tag == "a":
            in_link = 1
        if raw.endswith("/"):
            continue
        above = stack[-1]
        region = _region(tag, raw, above[2]) if above[2] is not None else None
        if region is not above[2]:
            if region is not None:
                flush()
                by_tag |= region.kind == "content"
                by_name |= region.kind == "named content"
        parent.append(above[0])
        depth.append(depth[above[0]] + 1)
        if tag in _BLOCK:
            inner.append(len(stack))
        count[tag] = count.get(tag, 0) + 1
        stack.append((len(parent) - 1, tag, region))
    if stack[-1][2] is not None:
        flush()
    # text beside an article is not of it
    top.kind = "outside" if by_tag else "beside" if by_name else "open"
    return out, parent, depth


def features(b: Block) -> tuple[float, ...]:
    """What the text of a block tells, in the order of ``FEATURES``."""
    heading = len(b.tag) == 2 and b.tag[0] == "h" and b.tag[1].isdigit()
    return (1.0, math.log2(b.text.count(" ") + 2), min(1.0, b.linked / max(1, b.chars)),
            float(bool(_END.search(b.text))), float(b.tag in ("p", "blockquote", "pre")), float(heading),
            float(b.tag in ("li", "td", "dd")))


def log_odds(b: Block, weights=PRIOR) -> float:
    """The classifier: log-odds that a block is content, by its text alone."""
    return max(-MOST, min(MOST, sum(w * x for w, x in zip(weights, features(b)))))


def fit_weights(x: np.ndarray, y: np.ndarray, pull: float = 20.0) -> tuple[float, ...]:
    """Weights of a logistic regression of labels y on features x; both classes count the same,
    and ``pull`` examples' worth of evidence speaks for ``PRIOR``."""
    prior = np.array(PRIOR)
    w = prior.copy()
    if not len(y) or y.all() or not y.any():
        return PRIOR
    share = np.where(y, 0.5 / y.sum(), 0.5 / (~y).sum()) * len(y)
    for _ in range(25):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (share * (y - p)) - pull * (w - prior)
        hess = (x * (share * p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


def _taught(b: Block) -> bool | None:
    """What the tags around a block say of it, if they do."""
    return {"content": True, "hard": False}.get(b.region.kind)


def _tree_distance(a: int, b: int, parent: list[int], depth: list[int], most: int) -> int:
    steps = 0
    while a != b and steps <= most:
        if depth[a] >= depth[b]:
            a = parent[a]
        else:
            b = parent[b]
        steps += 1
    return steps


def smoothness(blocks: list[Block], parent: list[int], depth: list[int]) -> list[tuple[int, int, float]]:
    """Edges (i, j, weight): next block, and the last block with the same parent or grandparent."""
    edges = []
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            d = _tree_distance(blocks[i - 1].parent, b.parent, parent, depth, 6)
            same = 1.0 if blocks[i - 1].region is b.region else 0.25
            edges.append((i - 1, i, same * (_NEXT + _SIBLING / 2 ** d)))
        for up, weight in ((b.parent, _SIBLING), (parent[b.parent], _SIBLING / 4)):
            if up in last and last[up] < i - 1 and blocks[last[up]].region is b.region:
                edges.append((last[up], i, weight / 2))
        last[b.parent] = i
        if parent[b.parent] >= 0:
            last[parent[b.parent]] = i
    return edges


# -------------------------------------------------------------- minimum cut

def minimum_cut(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (True: source side) that maximise the gains of the True nodes less the
    weights of edges between different labels.

    A positive gain is a capacity from the source, a negative one a capacity to the
    sink.  Nodes that no cut of their edges can turn are fixed first."""
    n = len(gain)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in edges:
        if i != j and w > 0:
            near[i][j] = near[i].get(j, 0.0) + w
            near[j][i] = near[j].get(i, 0.0) + w
    gain = list(gain)
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if label[i] is not None or abs(gain[i]) < sum(near[i].values()) or (not near[i] and gain[i] == 0):
            continue
        label[i] = gain[i] > 0
        for j, w in near[i].items():  # its edges become terminal capacities
            gain[j] += w if label[i] else -w
            del near[j][i]
            todo.append(j)
        near[i] = {}
    free = [i for i in range(n) if label[i] is None]
    if free:
        source = _max_flow(free, gain, near)
        for i in free:
            label[i] = i in source
    return label  # type: ignore[return-value]


def _max_flow(nodes: list[int], gain: list[float], near: list[dict[int, float]]) -> set[int]:
    """Dinic's algorithm; the nodes that the source reaches when no path is left."""
    s, t = -1, -2
    cap: dict[int, dict[int, float]] = {i: dict(near[i]) for i in nodes}
    cap[s], cap[t] = {}, {}
    for i in nodes:
        if gain[i] > 0:
            cap[s][i], cap[i][s] = gain[i], 0.0
        elif gain[i] < 0:
            cap[i][t], cap[t][i] = -gain[i], 0.0
    tiny = 1e-9
    while True:
        level = {s: 0}
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for v, c in cap[u].items():
                if c > tiny and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if t not in level:
            return set(level) - {s}
        arcs = {u: list(cap[u]) for u in level}
        path = [s]
        while path:  # one blocking flow
            u = path[-1]
            if u == t:
                flow = min(cap[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    cap[a][b] -= flow
                    cap[b][a] = cap[b].get(a, 0.0) + flow
                path = [s]
                continue
            while arcs[u]:
                v = arcs[u][-1]
                if cap[u][v] > tiny and level.get(v) == level[u] + 1:
                    path.append(v)
                    break
                arcs[u].pop()
            else:
                path.pop()
                if path:
                    arcs[path[-1]].pop()


def labels_of(blocks: list[Block], parent: list[int], depth: list[int], weights=PRIOR) -> list[bool]:
    """True for the blocks on the content side of the minimum cut."""
    gain = [log_odds(b, weights) for b in blocks]
    edges = smoothness(blocks, parent, depth)
    number: dict[int, int] = {}

    def node(region):
        """The region's node, with those of the regions around it."""
        first = None
        below, tie = None, 0.0
        while region is not None:
            known = number.get(id(region))
            at = known
            if known is None:
                at = number[id(region)] = len(gain)
                gain.append(_REGIONS[region.kind][0])
            if first is None:
                first = at
            if below is not None and tie:
                edges.append((below, at, tie))
            if known is not None:
                break
            below, tie = at, _AROUND.get(region.kind, 0.0)
            region = region.around
        return first

    for i, b in enumerate(blocks):
        region = b.region
        edges.append((i, node(region), _REGIONS[region.kind][1]))
        while region.kind == "weak":  # weak evidence adds to that of the region around it
            region = region.around
        if region is not b.region:
            edges.append((i, node(region), _REGIONS[region.kind][1]))
    return minimum_cut(gain, edges)[:len(blocks)]


def main_text(page: str | None, weights=PRIOR) -> tuple[str, int, int, int]:
    """(text, blocks, content blocks, blocks labelled against their own log-odds) of a page."""
    blocks, parent, depth = blocks_of(page or "")
    labels = labels_of(blocks, parent, depth, weights)
    kept = [b.text for b, keep in zip(blocks, labels) if keep]
    turned = sum((log_odds(b, weights) > 0) != keep for b, keep in zip(blocks, labels))
    return " ".join(kept), len(blocks), len(kept), turned


def fit(pages: DataFrame, html_col: str = "html", pages_bound: int = SAMPLE_PAGES,
        blocks_bound: int = SAMPLE_BLOCKS) -> tuple[float, ...]:
    """Weights fitted to at most ``pages_bound`` pages, those of the smallest hashes of their
    other columns, and of each at most ``blocks_bound`` evenly spaced blocks."""
    ship(pages.sparkSession)
    others = [c for c in pages.columns if c != html_col]
    order = F.xxhash64(*others) if others else F.lit(0).cast("long")
    marked = pages.select(order.alias("h"), F.col(html_col).cast("string").alias("html"))
    last = marked.select("h").orderBy("h").limit(pages_bound).agg(F.max("h")).first()[0]
    if last is None:
        return PRIOR

    def run(batches):
        for ch in chunks(batches, "html", CHUNK):
            rows = []
            for page in ch.column("html").to_pylist():
                taught = [b for b in blocks_of(page or "")[0] if _taught(b) is not None]
                rows += [(list(features(b)), _taught(b)) for b in taught[::max(1, len(taught) // blocks_bound)]]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.list_(pa.float64())),
                                                  pa.array([r[1] for r in rows])], ["x", "y"])

    sample = marked.where(F.col("h") <= last).limit(pages_bound)
    rows = sample.select("html").mapInArrow(run, "x ARRAY<DOUBLE>, y BOOLEAN").collect()
    return fit_weights(np.array([r.x for r in rows]).reshape(-1, len(FEATURES)), np.array([r.y for r in rows], bool))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            weights: tuple[float, ...] | None = None) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks, n_content, n_turned) of every page, from its whole html.

    ``text`` joins the content blocks in page order by one space; character
    references are decoded, white space inside a block is one space.  ``n_turned``
    counts the blocks that the cut labelled against their own text.  Without
    ``weights`` the classifier is fitted to a sample of the pages (``fit``).  A null or
    empty html, and a page without content, give an empty text.  Repeated rows and
    null ids or urls return a row each; other columns are not looked at; an empty
    table gives an empty result."""
    ship(pages.sparkSession)
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                       F.col(html_col).cast("string").alias("html"))
    if weights is None:
        weights = fit(src)

    def run(batches):
        for ch in chunks(batches, "html", CHUNK):
            found = [main_text(h, weights) for h in ch.column("html").to_pylist()]
            text, total, content, turned = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [ch.column("page_id"), ch.column("url"), pa.array(text, pa.string()),
                 pa.array([len(t) for t in text], pa.int64()), pa.array(total, pa.int64()),
                 pa.array(content, pa.int64()), pa.array(turned, pa.int64())],
                ["page_id", "url", "text", "n_chars", "n_blocks", "n_content", "n_turned"])

    kind = src.schema["page_id"].dataType.simpleString()
    return src.mapInArrow(run, f"page_id {kind}, url STRING, text STRING, n_chars BIGINT, n_blocks BIGINT, "
                               "n_content BIGINT, n_turned BIGINT")
