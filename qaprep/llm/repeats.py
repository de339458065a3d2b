"""Exact substring deduplication: maximal repeats from LCP-interval trees.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts
anywhere else.  A suffix array of a whole corpus cannot be sorted in one
place, so the suffixes are first brought together by content:

1. *Anchors.*  The smallest k-gram hash of each 200-byte window is its anchor
   (a content-defined choice: equal windows have equal anchors at equal
   offsets).  One row per run of windows with one anchor: anchor hash, hash of
   the run's context (all bytes that its windows cover), document and place.
   Equal contexts inside a text chunk are combined before anything is shuffled.
2. *Classes.*  Per anchor hash: alone -> unique, nothing to remove; several rows
   with one context -> all of it repeats; several contexts -> step 3.
3. *Interval tree.*  The distinct contexts of an anchor meet in one task, which
   builds their suffix array by prefix doubling, the LCP of neighbours, and
   scans it with a stack.  Each LCP interval of 200 bytes or more whose left
   neighbours differ is a maximal repeat, with all its occurrences.  A context
   knows nothing of the byte before it, so its first window counts as
   left-maximal; repeats longer than a context come out as overlapping pieces.

An anchor with more than ``HOT_CONTEXTS`` distinct contexts is dealt again by
longer cores: its 169 window offsets are cut into ranges of 13, whose windows
share a core of 188 bytes, and the hash of that core is the new anchor; ranges
that are still too large are dealt by single windows, where the whole window
is the core and the classes of step 2 decide.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import batch, chunks, fresh, materialize, mix, prefix_hash, ship, span_hash
from .suffixes import dense

#: bytes in a repeated string (fixed by the contract) and in an anchor k-gram
LENGTH, GRAM = 200, 32
#: window offsets around an anchor, and offsets in a range of a hot anchor
OFFSETS, RANGE = LENGTH - GRAM + 1, 13
#: distinct contexts of one anchor that meet in one task
HOT_CONTEXTS = 1024
#: rows of one anchor, as one in ROUTE_SAMPLE of the rows shows them, from which it is classed without a window
HOT_ROWS, ROUTE_SAMPLE = 2048, 64
#: bytes of text hashed at once, and bytes of contexts in one suffix array
CHUNK, ARRAY_BYTES = 1 << 19, 1 << 20

_POS_BITS = np.uint64(31)  # a Spark string has at most 2**31 - 1 bytes
_POS_MASK = np.uint64((1 << 31) - 1)

# a: anchor hash; c: context hash; lo, hi: first and last window start; x: anchor place; w: copies (2 = more)
_ROWS = pa.schema([("a", pa.int64()), ("c", pa.int64()), ("doc_id", pa.int64()), ("th", pa.int64()),
                   ("lo", pa.int32()), ("hi", pa.int32()), ("x", pa.int32()), ("w", pa.int8())])
_ROWS_SQL = "a BIGINT, c BIGINT, doc_id BIGINT, th BIGINT, lo INT, hi INT, x INT, w TINYINT"
_SPAN = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])
_SPAN_SQL = "doc_id BIGINT, th BIGINT, start INT, end INT"


def _window_anchors(data: np.ndarray, offs: np.ndarray, prefix: np.ndarray):
    """(lo, hi, x) in buffer positions: runs of window starts that share the anchor at x."""
    n = len(data)
    none = np.empty(0, np.int64)
    if n < LENGTH:
        return none, none, none
    pos = np.arange(n - GRAM + 1)
    value = span_hash(prefix, pos, pos + GRAM)
    value = (value >> _POS_BITS << _POS_BITS) | pos.astype(np.uint64)
    width, low = 1, value
    while 2 * width <= OFFSETS:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = OFFSETS - width
    if rest:
        low = np.minimum(low[:-rest], low[rest:])
    x = (low & _POS_MASK).astype(np.int64)  # for window starts 0 .. n - LENGTH
    ends = np.repeat(offs[1:], np.diff(offs))[:len(x)]
    p = np.flatnonzero(np.arange(len(x)) + LENGTH <= ends)
    if not len(p):
        return none, none, none
    new = np.ones(len(p), bool)
    new[1:] = (x[p[1:]] != x[p[:-1]]) | (p[1:] != p[:-1] + 1) | (ends[p[1:]] != ends[p[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(p)) - 1
    return p[first], p[last], x[p[first]]


def _context_hash(prefix, lo, hi, x):
    return mix(span_hash(prefix, lo, hi + LENGTH) + (x - lo).astype(np.uint64))


def _combine(a, c):
    """One row per equal (a, c) and the rows that are not alone."""
    order = np.lexsort((c, a))
    sa, sc = a[order], c[order]
    new = np.ones(len(order), bool)
    new[1:] = (sa[1:] != sa[:-1]) | (sc[1:] != sc[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(order)))
    many = np.repeat(size > 1, size)
    return order[first], np.minimum(size, 2).astype(np.int8), order[many]


def _joined(lo, end, doc):
    """Overlapping or touching byte spans of one document made one: (start, end, document)."""
    order = np.lexsort((lo, doc))
    lo, end, doc = lo[order], end[order], doc[order]
    reach = np.maximum.accumulate(end)  # spans lie in their documents, which follow each other
    new = np.ones(len(lo), bool)
    new[1:] = (lo[1:] > reach[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return lo[first], reach[np.append(first[1:], len(lo)) - 1] if len(lo) else reach, doc[first]


def _anchor_rows(batches):
    """Rows (w = 1 or 2) and, with w = 0, stretches that are known to repeat: the contexts
    that the chunk holds more than once, joined (a run of one character is one row)."""
    for ch in chunks(batches, "text", CHUNK):
        if len(ch.data) < LENGTH:
            continue
        prefix = prefix_hash(ch.data)
        lo, hi, x = _window_anchors(ch.data, ch.offs, prefix)
        if not len(lo):
            continue
        a = span_hash(prefix, x, x + GRAM)
        c = _context_hash(prefix, lo, hi, x)
        one, weight, many = _combine(a, c)
        doc = np.searchsorted(ch.offs, lo, "right") - 1
        start, end, where = _joined(lo[many], hi[many] + LENGTH, doc[many])
        at = ch.offs[np.concatenate([doc[one], where])]
        none = np.zeros(len(start), np.int64)
        pick = pa.array(np.concatenate([doc[one], where]))

        def col(x, known):
            return (np.concatenate([x[one], known]) - at).astype(np.int32)
        yield batch(_ROWS, np.concatenate([a[one].view(np.int64), none]), np.concatenate([c[one].view(np.int64), none]),
                    ch.column("doc_id").cast(pa.int64()).take(pick), ch.column("th").take(pick),
                    col(lo, start), col(hi, end - LENGTH), col(x, start),
                    np.concatenate([weight, np.zeros(len(start), np.int8)]))


def _classes(rows: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows whose anchor is not alone, with ``copies`` of their context (2 = more),
    ``kinds`` (distinct contexts of the anchor) and ``first`` (a row that stands for its context).

    ``rows`` is a stored table.  A sample of it tells the anchors with very many rows:
    those are counted by context and then by anchor with partial sums, and the
    counts are joined back (small, or a join whose skew Spark splits).  All other
    anchors take one window pass.  Either way gives the same rows."""
    seen = rows.where(F.pmod(F.xxhash64("doc_id", "lo", F.lit("route")), F.lit(ROUTE_SAMPLE)) == 0)
    hot = materialize(seen.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
                      .where(F.col("n") * ROUTE_SAMPLE >= hot_rows).select("a"), "hot-anchors")
    if hot.isEmpty():
        return _window_classes(rows)
    cold = _window_classes(rows.join(hot, "a", "left_anti"))
    warm = rows.join(hot, "a", "left_semi")
    place = F.struct("doc_id", "th", "lo", "hi", "x")
    contexts = materialize(warm.groupBy("a", "c").agg(F.sum("w").alias("copies"), F.min(place).alias("rep")),
                           "hot-contexts")
    anchors = materialize(contexts.groupBy("a").agg(F.count(F.lit(1)).alias("kinds"), F.sum("copies").alias("total"))
                          .where("total > 1").select("a", "kinds"), "hot-kinds")
    counted = warm.join(contexts, ["a", "c"]).join(anchors, "a").withColumn("first", place.eqNullSafe(F.col("rep")))
    return cold.unionByName(counted.select(*cold.columns))


def _window_classes(rows: DataFrame) -> DataFrame:
    same = Window.partitionBy("a", "c")
    anchor = Window.partitionBy("a")
    return (rows.withColumn("copies", F.sum("w").over(same))
            .withColumn("first", F.row_number().over(same.orderBy("doc_id", "th", "lo")) == 1)
            .withColumn("total", F.sum("w").over(anchor))
            .where("total > 1")
            .withColumn("kinds", F.sum(F.col("first").cast("int")).over(anchor))
            .drop("total"))


def _whole(classed: DataFrame) -> DataFrame:
    return classed.where("copies > 1").select("doc_id", "th", F.col("lo").alias("start"),
                                              (F.col("hi") + LENGTH).alias("end"))


# ------------------------------------------------------------ interval tree

def interval_tree(lcp: np.ndarray, left: np.ndarray, least: int):
    """(l, r, length) of the LCP intervals with length >= ``least`` whose left
    neighbours differ.

    ``lcp[i]`` belongs to the suffixes i - 1 and i in suffix order (``lcp[0]`` is
    below ``least``); ``left`` holds the symbol before each suffix, negative and
    different for suffixes that have none."""
    n = len(lcp)
    change = np.zeros(n, np.int64)
    change[1:] = np.cumsum(left[1:] != left[:-1])
    out = []
    stack: list[tuple[int, int]] = []  # (length, leftmost suffix)
    values = lcp.tolist()
    for i in range(1, n + 1):
        here = values[i] if i < n else 0
        start = i - 1
        while stack and stack[-1][0] > here:
            length, start = stack.pop()
            if change[i - 1] > change[start]:
                out.append((start, i - 1, length))
        if here >= least and (not stack or stack[-1][0] < here):
            stack.append((here, start))
    return np.array(out, np.int64).reshape(-1, 3)


def maximal_repeats(texts: list[bytes], starts: list[tuple[int, int]] | None = None, least: int = LENGTH):
    """Maximal repeats among ``texts``: groups (length, text numbers, places) with all occurrences.

    ``starts``: first and last suffix of each text that may begin a repeat (all
    by default).  The suffix before the first one is unknown, so the first one
    is left-maximal."""
    if not texts:
        return []
    size = np.array([len(t) for t in texts])
    begin = np.cumsum(size + 1) - size - 1
    n = int(size.sum() + len(texts))
    sym = np.zeros(n, np.int16)  # 0 after each text, else byte + 1
    inside = np.ones(n, bool)
    inside[begin + size] = False
    sym[inside] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int16) + 1
    text_of = np.repeat(np.arange(len(texts), dtype=np.int32), size + 1)
    rest = (begin + size)[text_of] - np.arange(n)
    if starts is None:
        mine = rest >= least
        first = begin
    else:
        s = np.array(starts)
        first = begin + s[:, 0]
        spot = np.arange(n)
        mine = (spot >= first[text_of]) & (spot <= (begin + s[:, 1])[text_of]) & (rest >= least)
    # ranks by 7, 14, 28 ... symbols, up to half of the shortest repeat
    padded = np.concatenate([sym, np.zeros(6, np.int16)])
    key = np.zeros(n, np.int64)
    for k in range(7):
        key = (key << 9) | padded[k:k + n]
    depth, levels = 7, [(7, dense(key)[0].astype(np.int32))]
    while 2 * depth <= max(7, least):
        rank = levels[-1][1]
        key = rank.astype(np.int64) * (n + 1)
        key[:n - depth] += rank[depth:] + 1
        depth *= 2
        levels.append((depth, dense(key)[0].astype(np.int32)))
    del key
    top = levels[-1][1]

    def ranks(at):
        ok = at < n
        return np.where(ok, top[np.minimum(at, n - 1)] + 1, 0)

    # suffixes that share their first ``least`` symbols with another one
    p = np.flatnonzero(mine)
    shared, kinds = dense(top[p].astype(np.int64) * (n + 1) + ranks(p + max(0, least - depth)))
    if depth > least:
        raise ValueError("a repeat has at least 7 symbols")
    p = p[np.bincount(shared, minlength=kinds)[shared] > 1]
    if not len(p):
        return []
    # suffix order of these, by all their symbols
    far = max(1, -(-int(rest[p].max()) // depth))
    p = p[np.lexsort([ranks(p + k * depth) for k in range(far - 1, -1, -1)])]
    a, b = p[:-1], p[1:]
    lcp = np.zeros(len(p), np.int64)
    common = np.zeros(len(a), np.int64)
    for _ in range(far):
        common = np.where((ranks(a + common) == ranks(b + common)) & (a + common < n) & (b + common < n),
                          common + depth, common)
    for d, rank in reversed(levels[:-1]):
        i, j = np.minimum(a + common, n - 1), np.minimum(b + common, n - 1)
        common = np.where((rank[i] == rank[j]) & (a + common < n) & (b + common < n), common + d, common)
    for _ in range(6):
        i, j = np.minimum(a + common, n - 1), np.minimum(b + common, n - 1)
        common = np.where(sym[i] == sym[j], common + 1, common)
    lcp[1:] = np.minimum(common, np.minimum(rest[a], rest[b]))
    lcp[lcp < least] = 0
    left = np.where(p > first[text_of[p]], sym[p - 1].astype(np.int64), -1 - np.arange(len(p)))
    return [(length, text_of[p[l:r + 1]], p[l:r + 1] - begin[text_of[p[l:r + 1]]])
            for l, r, length in interval_tree(lcp, left, least).tolist()]


def covered(texts: list[bytes], starts: list[tuple[int, int]], least: int = LENGTH):
    """(text number, start, end): merged places that maximal repeats cover."""
    size = np.array([len(t) for t in texts])
    begin = np.cumsum(size + 1) - size - 1
    depth = np.zeros(int(size.sum()) + len(texts) + 1, np.int64)
    for length, which, at in maximal_repeats(texts, starts, least):
        np.add.at(depth, begin[which] + at, 1)
        np.add.at(depth, begin[which] + at + length, -1)
    hit = np.cumsum(depth) > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit])))
    a, b = edge[::2], edge[1::2]
    which = np.searchsorted(begin, a, "right") - 1
    return which, a - begin[which], b - begin[which]


def _tree_spans(batches):
    """Spans of sorted rows (a, doc_id, th, lo, x0, x1, ctx): contexts of an anchor are consecutive.

    ``x0`` and ``x1`` are the first and last window start inside the context."""
    held = None

    def solve(t):
        texts = [bytes(v) for v in t.column("ctx").to_pylist()]
        starts = list(zip(t.column("x0").to_pylist(), t.column("x1").to_pylist()))
        which, s, e = covered(texts, starts)
        lo = np.asarray(t.column("lo"))[which]
        pick = pa.array(which)
        return batch(_SPAN, t.column("doc_id").take(pick), t.column("th").take(pick),
                     (lo + s).astype(np.int32), (lo + e).astype(np.int32))

    for b in batches:
        if not b.num_rows:
            continue
        if held is not None:
            b = pa.concat_batches([held, b])
        a = np.asarray(b.column(0))
        ends = np.flatnonzero(a[1:] != a[:-1]) + 1  # group bounds
        bytes_to = np.cumsum(np.asarray(pa.compute.binary_length(b.column("ctx"))).astype(np.int64))
        at, done = 0, 0
        for k, e in enumerate(ends):
            full = k + 1 == len(ends) or bytes_to[ends[k + 1] - 1] - done > ARRAY_BYTES
            if full:
                yield solve(b.slice(at, e - at))
                at, done = int(e), int(bytes_to[e - 1])
        held = b.slice(at)
    if held is not None and held.num_rows:
        yield solve(held)


def _contexts(batches):
    """Cut each document's wanted contexts (column ``need``) out of its text."""
    schema = pa.schema([("a", pa.int64()), ("kinds", pa.int64()), ("doc_id", pa.int64()), ("th", pa.int64()),
                        ("lo", pa.int32()), ("hi", pa.int32()), ("x", pa.int32()), ("ctx", pa.binary())])
    for ch in chunks(batches, "text", CHUNK):
        out = []
        ids, th = ch.column("doc_id").to_pylist(), ch.column("th").to_pylist()
        for d, need in enumerate(ch.column("need").to_pylist()):
            base = int(ch.offs[d])
            for r in need:
                ctx = ch.data[base + r["lo"]:base + r["hi"] + LENGTH].tobytes()
                out.append((r["a"], r["kinds"], ids[d], th[d], r["lo"], r["hi"], r["x"], ctx))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)


def _ranged(width: int):
    """Rows of hot anchors by ranges of ``width`` window offsets, under their longer cores."""
    def run(batches):
        for ch in chunks(batches, "ctx", CHUNK):
            prefix = prefix_hash(ch.data)
            col = lambda k: np.asarray(ch.column(k)).astype(np.int64)
            lo, hi, x, a = col("lo"), col("hi"), col("x"), col("a").view(np.uint64)
            base = ch.offs[:-1] - lo  # of document place 0
            # offsets -(OFFSETS - 1) .. 0 of window starts from the anchor, in ranges
            r0, r1 = (lo - x + OFFSETS - 1) // width, (hi - x + OFFSETS - 1) // width
            count = r1 - r0 + 1
            i = np.repeat(np.arange(len(lo)), count)
            r = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(r0, count)
            o0 = r * width - (OFFSETS - 1)
            o1 = np.minimum(o0 + width - 1, 0)
            s0, s1 = np.maximum(lo[i], x[i] + o0), np.minimum(hi[i], x[i] + o1)
            core = span_hash(prefix, base[i] + x[i] + o1, base[i] + x[i] + o0 + LENGTH)
            key = mix(core + mix(a[i] + r.astype(np.uint64)))
            c = _context_hash(prefix, base[i] + s0, base[i] + s1, base[i] + x[i])
            one, weight, many = _combine(key, c)
            rows = np.concatenate([one, many])
            w = np.concatenate([weight, np.zeros(len(many), np.int8)])
            pick = pa.array(i[rows])
            yield batch(_ROWS, key[rows].view(np.int64), c[rows].view(np.int64), ch.column("doc_id").take(pick),
                        ch.column("th").take(pick), s0[rows].astype(np.int32), s1[rows].astype(np.int32),
                        x[i][rows].astype(np.int32), w)
    return run


def _solve(ctx: DataFrame) -> DataFrame:
    """Interval-tree spans of contexts (a, doc_id, th, lo, hi, ctx)."""
    src = ctx.select("a", "doc_id", "th", "lo", F.lit(0).alias("x0"), F.expr("hi - lo").alias("x1"), "ctx")
    return src.repartition("a").sortWithinPartitions("a").mapInArrow(_tree_spans, _SPAN_SQL)


def _known(rows: DataFrame) -> DataFrame:
    """Contexts that a text chunk holds more than once."""
    return rows.where("w = 0").select("doc_id", "th", F.col("lo").alias("start"), (F.col("hi") + LENGTH).alias("end"))


def repeat_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 hot: int = HOT_CONTEXTS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(doc_id, th, start, end): byte ranges, some overlapping, that 200-byte strings
    occurring more than once cover; ``th`` is a hash of the text."""
    src = _source(docs, id_col, text_col)
    rows = materialize(src.mapInArrow(_anchor_rows, _ROWS_SQL), "anchors")
    classed = materialize(_classes(rows.where("w > 0"), hot_rows), "classes")
    need = (classed.where("kinds > 1 AND first").groupBy("doc_id", "th")
            .agg(F.collect_list(F.struct("a", F.col("kinds").cast("bigint").alias("kinds"), "lo", "hi", "x"))
                 .alias("need")))  # of one document: no longer than its text
    cut = _join_docs(src, need).mapInArrow(
        _contexts, "a BIGINT, kinds BIGINT, doc_id BIGINT, th BIGINT, lo INT, hi INT, x INT, ctx BINARY")
    cut = materialize(cut, "contexts")
    spans = [_known(rows), _whole(classed), _solve(cut.where(F.col("kinds") <= hot))]
    big = cut.where(F.col("kinds") > hot)
    if not big.isEmpty():
        # anchors with too many contexts for one task: longer cores, twice
        rows = materialize(big.mapInArrow(_ranged(RANGE), _ROWS_SQL), "range-rows")
        ranged = materialize(_classes(rows.where("w > 0"), hot_rows), "ranges")
        again = (ranged.where("kinds > 1 AND first")
                 .select(F.col("a").alias("key"), F.col("kinds").cast("bigint").alias("kinds2"), "doc_id", "th", "x",
                         F.col("lo").alias("lo2"), F.col("hi").alias("hi2")))
        parts = (again.join(big.drop("kinds"), (again["x"] == big["x"]) & again["doc_id"].eqNullSafe(big["doc_id"])
                            & (again["th"] == big["th"]))
                 .select(again["key"].alias("a"), "kinds2", again["doc_id"], again["th"], "lo2", "hi2", again["x"],
                         F.expr("substring(ctx, lo2 - lo + 1, hi2 - lo2 + 200)").alias("ctx"))
                 .withColumnsRenamed({"lo2": "lo", "hi2": "hi"}))
        parts = materialize(parts, "range-contexts")
        spans += [_known(rows), _whole(ranged), _solve(parts.where(F.col("kinds2") <= hot))]
        rest = parts.where(F.col("kinds2") > hot)
        if not rest.isEmpty():
            rows = materialize(rest.mapInArrow(_ranged(1), _ROWS_SQL), "window-rows")
            spans += [_known(rows), _whole(_classes(rows.where("w > 0"), hot_rows))]
    out = spans[0]
    for s in spans[1:]:
        out = out.unionByName(s)
    return out


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    ship(docs.sparkSession)
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("th"))


def _join_docs(src: DataFrame, per_doc: DataFrame, how: str = "inner") -> DataFrame:
    right = per_doc.withColumnsRenamed({"doc_id": "__d", "th": "__t"})
    on = src["doc_id"].eqNullSafe(right["__d"]) & (src["th"] == right["__t"])
    return src.join(right, on, how).drop("__d", "__t")


def _merged(spans) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted((r["start"], r["end"]) for r in spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def kept_bytes(text: bytes, spans: list) -> bytes:
    parts, at = [], 0
    for s, e in spans:
        parts.append(text[at:s])
        at = e
    return b"".join(parts) + text[at:]


def _whole_characters(text: bytes, spans: list) -> list:
    """Spans drawn in to character bounds, for a text that must stay UTF-8."""
    out = []
    for s, e in spans:
        while s < e and text[s] & 0xC0 == 0x80:
            s += 1
        while e > s and e < len(text) and text[e] & 0xC0 == 0x80:
            e -= 1
        if e > s:
            out.append([s, e])
    return out


def _per_document(spans: DataFrame) -> DataFrame:
    """Spans by document: one per start, so a list has at most a span per byte, whatever
    the number of copies that share an id and a text."""
    return (spans.groupBy("doc_id", "th", "start").agg(F.max("end").alias("end"))
            .groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "end")).alias("spans")))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                hot: int = HOT_CONTEXTS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept_text) per document.

    Removes each byte that a 200-byte string covers which also starts anywhere
    else, in the same or another document; matches are judged on the input and
    never cross documents.  ``spans`` are the maximal removed byte runs,
    ``kept_text`` the text without the characters that lie wholly inside them.
    A null text is empty; texts under 200 bytes lose nothing.  Repeated rows, and
    rows that share an id or have none, are documents of their own and repeat each
    other.  Other columns are not looked at.  An empty table gives an empty result."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
                        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                        ("kept_text", pa.string())])

    def run(batches):
        for ch in chunks(batches, "text", CHUNK):
            rows = []
            for d, (doc_id, spans) in enumerate(zip(ch.column("doc_id").to_pylist(),
                                                    ch.column("spans").to_pylist())):
                text, cut = ch.text(d), _merged(spans or [])
                kept = kept_bytes(text, cut)
                whole = kept_bytes(text, _whole_characters(text, cut)).decode() if cut else text.decode()
                rows.append((doc_id, len(text), len(text) - len(kept), len(cut), hashlib.sha256(kept).hexdigest(),
                             [{"start": s, "end": e} for s, e in cut], whole))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    src = _source(docs, id_col, text_col)
    found = _per_document(repeat_spans(docs, id_col, text_col, hot, hot_rows))
    return _join_docs(src, found, "left").mapInArrow(
        run, "doc_id BIGINT, n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept_sha256 STRING, "
             "spans ARRAY<STRUCT<start: INT, end: INT>>, kept_text STRING")


def cut_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  chars_col: str = "n_chars") -> DataFrame:
    """``docs`` without the repeated passages: same columns, shorter texts.

    Characters that lie wholly inside a removed run go and ``n_chars`` (if there)
    follows; a document that loses characters and has no word left is dropped.
    Documents that lose nothing come back as they are, null texts included."""
    d, t, own = fresh(docs, "d", "t", "spans")
    found = _per_document(repeat_spans(docs, id_col, text_col)).withColumnsRenamed({"doc_id": d, "th": t, "spans": own})
    on = F.col(id_col).cast("bigint").eqNullSafe(F.col(d)) & (F.xxhash64(F.col(text_col).cast("string")) == F.col(t))
    joined = docs.join(found, on, "left").drop(d, t)
    at = joined.columns.index(text_col)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches):
        for ch in chunks(batches, text_col, CHUNK):
            if not any(ch.column(own).is_valid().to_pylist()):
                yield ch.rows.drop_columns([own])
                continue
            texts, keep = [], []
            whole = ch.column(text_col).to_pylist()
            for d, spans in enumerate(ch.column(own).to_pylist()):
                text = whole[d]
                if spans:
                    raw = ch.text(d)
                    text = kept_bytes(raw, _whole_characters(raw, _merged(spans))).decode()
                texts.append(text)
                keep.append(not spans or bool(text.split()))
            out = ch.rows.drop_columns([own])
            kind = out.schema.field(at)
            yield out.set_column(at, kind, pa.array(texts, kind.type)).filter(pa.array(keep))

    out = joined.mapInArrow(run, fields)
    if chars_col in docs.columns:
        size = F.length(text_col).cast(docs.schema[chars_col].dataType)
        out = out.withColumn(chars_col, F.coalesce(size, F.col(chars_col)))
    return out
