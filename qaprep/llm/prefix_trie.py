"""Trie of conversation prefixes by truncation peeling.

A conversation is a path of turns; a node is a distinct sequence of first turns.
Peeling descends from the deepest level: the conversations that end at a depth are
merged with the nodes that survived from below, each distinct path is a node whose
totals (conversations, children, leaves, tokens saved) are then complete, and its
last turn is stripped, which makes it a contribution to its parent one level up.
Nodes are found and aggregated in that one pass; no table of all prefixes is made.

How the work is dealt:

* Turns are shuffled once, as two 64-bit hashes and a word count, never as text.
* Equal conversations are combined into one path with a count before any peeling.
* A path is dealt by the shortest of its prefixes of 1, 2, 4, ... turns below which
  little work lies (``MANY_PATHS``, ``MANY_TURNS``); a task then peels whole
  subtrees, vectorised over all that it holds, down to that prefix.  A very common
  first turn is so split by what follows it.
* What is left, one summary per dealt prefix, is peeled by a Spark aggregation per
  level, with partial sums before each shuffle, so the root needs no large task.

A task keeps at least one conversation whole, at 24 bytes a turn.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize, mix, ship

#: a prefix is split further while more paths, and more turns, than this lie below it ...
MANY_PATHS, MANY_TURNS = 256, 1 << 11
#: ... and, with more than one path, in any case above this
MOST_TURNS = 1 << 20
#: heavy prefixes that are broadcast; more of them are joined by a shuffle whose skew Spark splits
HEAVY_ROWS = 1 << 18
#: turns that a task peels at once (whole subtrees)
PEEL_TURNS = 1 << 18
#: turns that a task rebuilds at once
BLOCK_ROWS = 1 << 16
#: characters of ids joined before the hash of a long list of ids is taken
ID_CHARS = 1 << 16

EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_NODE = ("conv_id BIGINT, depth BIGINT, parent_conv_id BIGINT, n_convs BIGINT, n_children BIGINT, n_leaves BIGINT, "
         "saved_tokens BIGINT, ends_sha256 STRING")


def _lists(col) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and flat values of a list column."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    off = np.asarray(col.offsets).astype(np.int64)
    return off - off[0], np.asarray(col.flatten()).astype(np.int64)


def _list_array(off: np.ndarray, flat: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(flat.astype(np.int64)))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, ..., start + size - 1 of each range, one after the other."""
    total = int(sizes.sum())
    return np.arange(total) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _prefix_keys(off: np.ndarray, t1: np.ndarray, t2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit key of every prefix: running xor of the turn hashes mixed with their positions."""
    pos = (np.arange(len(t1)) - np.repeat(off[:-1], np.diff(off))).astype(np.uint64)
    out = []
    for t, salt in ((t1, 0x9E3779B97F4A7C15), (t2, 0xC2B2AE3D27D4EB4F)):
        x = np.bitwise_xor.accumulate(mix(mix(t.view(np.uint64)) + (pos + np.uint64(1)) * np.uint64(salt)))
        start = off[:-1][np.diff(off) > 0]
        before = np.where(start > 0, x[start - 1], np.uint64(0))
        out.append((x ^ np.repeat(before, np.diff(off)[np.diff(off) > 0])).view(np.int64))
    return out[0], out[1]


# ------------------------------------------------------- rebuilt conversations

def _rebuild(batches, heads: int, block: int):
    """Rebuilt conversations from turns sorted by (family, head conversation first, conv_id, turn)."""
    names = ["g", "conv_id", "h", "t1", "t2", "w"]

    def out(cols, last: bool):
        g, conv, h, t1, t2, w = cols
        first = np.flatnonzero(np.concatenate([[True], (conv[1:] != conv[:-1]) | (g[1:] != g[:-1])]))
        size = np.diff(np.append(first, len(conv)))
        n = len(first) if last else len(first) - 1
        # the head conversation of a family is its first, if it is there
        fam = np.concatenate([[True], g[first][1:] != g[first][:-1]])
        lead = np.maximum.accumulate(np.where(fam, np.arange(len(first)), 0))
        head_at = first[lead]
        head_n = np.where(conv[head_at] == g[head_at], size[lead], 0)
        hh = h[first]
        a = np.minimum(hh, head_n)
        b = np.maximum(size - hh, 0)
        sel = np.arange(n)
        if seen and n:
            sel = sel[1:]  # the carried head was given out before
        a, b = a[sel], b[sel]
        seg_start = np.stack([head_at[sel], first[sel] + hh[sel]], 1).ravel()
        at = _ranges(seg_start, np.stack([a, b], 1).ravel())
        off = np.concatenate([[0], np.cumsum(a + b)])
        r1, r2, rw = t1[at], t2[at], w[at]
        k1, k2 = _prefix_keys(off, r1, r2) if len(r1) else (r1, r2)
        size_out = a + b
        # keys of the prefixes of 1, 2, 4, ... turns, and of the whole
        steps = np.frexp(size_out)[1].astype(np.int64) * (size_out > 0)
        exps = _ranges(np.zeros(len(sel), np.int64), steps)
        spot = np.repeat(off[:-1], steps) + (1 << exps) - 1
        soff = np.concatenate([[0], np.cumsum(steps)])
        end = off[1:] - 1
        f1, f2 = (np.where(size_out > 0, k[np.maximum(end, 0)] if len(k) else 0, 0) for k in (k1, k2))
        rec = pa.RecordBatch.from_arrays(
            [pa.array(conv[first[sel]]), pa.array(size_out), pa.array(f1), pa.array(f2),
             *(_list_array(soff, k[spot]) for k in (k1, k2)), *(_list_array(off, x) for x in (r1, r2, rw))],
            ["conv_id", "len", "f1", "f2", "c1", "c2", "t1", "t2", "w"])
        # carried on: the first turns of the open family's head, then the open conversation
        keep = np.empty(0, np.int64)
        again = False
        if not last:
            tail = np.arange(first[-1], len(conv))
            top = lead[-1]
            if top != len(first) - 1 and head_n[-1]:
                keep, again = np.arange(first[top], first[top] + min(heads - 1, size[top])), True
            keep = np.concatenate([keep, tail])
        return rec, [c[keep] for c in cols], again

    held, wait, rows, seen = None, [], 0, False
    for t in batches:
        wait.append([np.asarray(t.column(t.schema.get_field_index(c))).astype(np.int64) for c in names])
        rows += t.num_rows
        # twice the rows carried on, so that a long conversation is not copied once a batch
        if rows < max(block, 2 * len(held[0]) if held else 0):
            continue
        held = [np.concatenate(p) for p in zip(*([held] if held else []), *wait)]
        wait, rows = [], 0
        rec, held, seen = out(held, False)
        if rec.num_rows:
            yield rec
    if rows or held:
        held = [np.concatenate(p) for p in zip(*([held] if held else []), *wait)]
        rec, _, _ = out(held, True)
        if rec.num_rows:
            yield rec


def rebuilt(convs: DataFrame, family: int = 20, heads: int = 4, block: int = BLOCK_ROWS) -> DataFrame:
    """One row per conversation: hashes and words of its turns after its first
    h = crc32(conv_id) % ``heads`` turns gave way to those of conversation
    c - c % ``family``, and the keys of its prefixes of 1, 2, 4, ... turns."""
    ship(convs.sparkSession)
    c = F.col("conv_id").cast("long")
    turn = F.struct(F.coalesce(F.col("role").cast("string"), F.lit("")).alias("r"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    rows = (convs.where(c.isNotNull())
            .select(c.alias("conv_id"), F.col("turn"), turn.alias("x"))
            .select("conv_id", "turn", (F.col("conv_id") - F.col("conv_id") % family).alias("g"),
                    (F.crc32(F.col("conv_id").cast("string")) % heads).alias("h"),
                    F.xxhash64("x.r", "x.t").alias("t1"), F.xxhash64("x.t", F.lit(1), "x.r").alias("t2"),
                    F.regexp_count("x.t", F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("w")))
    order = ["g", (F.col("conv_id") != F.col("g")), "conv_id", F.col("turn").asc_nulls_first(), "t1", "t2"]
    dealt = rows.repartition("g").sortWithinPartitions(*order).select("g", "conv_id", "h", "t1", "t2", "w")
    return dealt.mapInArrow(lambda batches: _rebuild(batches, heads, block), "conv_id BIGINT, len BIGINT, f1 BIGINT, f2 BIGINT, c1 ARRAY<BIGINT>, "
                                      "c2 ARRAY<BIGINT>, t1 ARRAY<BIGINT>, t2 ARRAY<BIGINT>, w ARRAY<BIGINT>")


# --------------------------------------------------------------- equal paths

def _join_ids(batches):
    """Ids of one path, sorted, as strings of about ``ID_CHARS`` characters."""
    schema = pa.schema([("f1", pa.int64()), ("f2", pa.int64()), ("first", pa.int64()), ("n", pa.int64()),
                        ("ids", pa.string())])
    for t in batches:
        f1, f2, conv = (np.asarray(t.column(t.schema.get_field_index(c))) for c in ("f1", "f2", "conv_id"))
        if not len(f1):
            continue
        cut = np.flatnonzero(np.concatenate([[True], (f1[1:] != f1[:-1]) | (f2[1:] != f2[:-1])]))
        step = ID_CHARS // 20
        starts = np.concatenate([np.arange(a, b, step) for a, b in zip(cut, np.append(cut[1:], len(f1)))])
        ends = np.append(starts[1:], len(f1))
        texts = conv.astype(str).tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(f1[starts]), pa.array(f2[starts]), pa.array(conv[starts]), pa.array(ends - starts),
             pa.array([",".join(texts[a:b]) for a, b in zip(starts, ends)])], schema=schema)


def _hash_ids(batches):
    """Smallest id, count and SHA-256 of each path's ids, from strings sorted by (path, first id)."""
    names = ["f1", "f2", "conv_id", "n", "ends_sha256"]
    key, sha, first, n = None, None, 0, 0
    for t in batches:
        rows = [t.column(t.schema.get_field_index(c)).to_pylist() for c in ("f1", "f2", "first", "n", "ids")]
        done = []
        for a, b, c, m, ids in zip(*rows):
            if key != (a, b):
                if key is not None:
                    done.append((*key, first, n, sha.hexdigest()))
                key, sha, first, n = (a, b), hashlib.sha256(ids.encode()), c, m
            else:
                sha.update(b"," + ids.encode())
                n += m
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, first, n, sha.hexdigest())], names)


def distinct_paths(paths: DataFrame) -> DataFrame:
    """Each distinct path once: its smallest conversation, their number and the hash of their ids."""
    ids = (paths.select("f1", "f2", "conv_id").repartitionByRange("f1", "f2", "conv_id")
           .sortWithinPartitions("f1", "f2", "conv_id")
           .mapInArrow(_join_ids, "f1 BIGINT, f2 BIGINT, first BIGINT, n BIGINT, ids STRING"))
    ends = (ids.repartition("f1", "f2").sortWithinPartitions("f1", "f2", "first")
            .mapInArrow(_hash_ids, "f1 BIGINT, f2 BIGINT, conv_id BIGINT, n BIGINT, ends_sha256 STRING"))
    return paths.join(ends.select("conv_id", "n", "ends_sha256"), "conv_id")


def dealt_paths(paths: DataFrame, many_paths: int, many_turns: int, most_turns: int) -> DataFrame:
    """``paths`` with ``p`` and key (d1, d2): the prefix by which each is dealt.

    The shortest prefix of 1, 2, 4, ... turns that is not heavy, else the whole path."""
    at = (paths.select("conv_id", "len", F.posexplode(F.arrays_zip("c1", "c2")).alias("e", "k"))
          .select("conv_id", "len", F.expr("shiftleft(1L, e)").alias("p"), "k.c1", "k.c2"))
    heavy = (at.groupBy("p", "c1", "c2").agg(F.count("*").alias("paths"), F.sum("len").alias("turns"))
             .where((F.col("paths") > 1) & ((F.col("paths") > many_paths) & (F.col("turns") > many_turns)
                                            | (F.col("turns") > most_turns))).select("p", "c1", "c2"))
    # few where subtrees are light; a checked size sends them to the paths, which then stay where they are
    heavy = materialize(heavy, "trie-heavy")
    if heavy.count() <= HEAVY_ROWS:
        heavy = F.broadcast(heavy)
    light = (at.join(heavy, ["p", "c1", "c2"], "left_anti").groupBy("conv_id")
             .agg(F.min(F.struct("p", F.col("c1").alias("d1"), F.col("c2").alias("d2"))).alias("at")))
    return (paths.drop("c1", "c2").join(light, "conv_id", "left")
            .select("*", F.coalesce("at.p", "len").alias("p"), F.coalesce("at.d1", "f1").alias("d1"),
                    F.coalesce("at.d2", "f2").alias("d2"), F.col("at.p").isNull().alias("whole")).drop("at", "f1", "f2"))


# -------------------------------------------------------------------- peeling

def peel(conv, n, length, low, group, off, k1, k2, w):
    """Nodes of whole subtrees, level by level from the deepest.

    ``group`` numbers the dealt prefixes, ``low`` is the depth of a path's one; paths
    are distinct.  Returns the nodes below the prefixes as arrays (conv, depth,
    parent, n, children, leaves, saved, end) and the summaries of the prefixes, as
    (conv, n, children, leaves, saved, end, path); ``end`` is the path that ends there
    or -1.  ``saved`` of a summary leaves out its own turn."""
    nodes, tops = [], []
    by_len = np.argsort(-length, kind="stable")
    at = 0
    live = {x: np.empty(0, np.int64) for x in ("path", "conv", "n", "kids", "leaves", "saved", "end")}
    depth = int(length[by_len[0]]) if len(by_len) else -1
    while depth >= 0 and (len(live["path"]) or at < len(by_len)):
        to = at
        while to < len(by_len) and length[by_len[to]] == depth:
            to += 1
        new = by_len[at:to]
        at = to
        z = np.zeros(len(new), np.int64)
        had = len(live["path"])
        rows = {"path": new, "conv": conv[new], "n": n[new], "kids": z, "leaves": z, "saved": z, "end": new}
        rows = {x: np.concatenate([live[x], rows[x]]) for x in rows}
        if not len(rows["path"]):
            depth -= 1
            continue
        r = rows["path"]
        spot = np.maximum(off[r] + depth - 1, 0)
        a, b = (k1[spot], k2[spot]) if depth else (np.zeros_like(r), np.zeros_like(r))
        order = np.lexsort((b, a, group[r]))
        a, b, gr = a[order], b[order], group[r][order]
        first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (gr[1:] != gr[:-1])]))
        s = {x: v[order] for x, v in rows.items()}
        node = np.empty(len(r), np.int64)
        node[order] = np.cumsum(np.isin(np.arange(len(r)), first)) - 1
        path = s["path"][first]
        got = {"path": path, "conv": np.minimum.reduceat(s["conv"], first), "end": np.maximum.reduceat(s["end"], first)}
        for x in ("n", "kids", "leaves", "saved"):
            got[x] = np.add.reduceat(s[x], first)
        if had:  # the children emitted one level below now know their parents
            nodes[-1]["parent"] = got["conv"][node[:had]]
        top = low[path] == depth
        if top.any():
            tops.append({x: v[top] for x, v in got.items()})
        up = {x: v[~top] for x, v in got.items()}
        if len(up["path"]):
            words = w[off[up["path"]] + depth - 1]
            up["leaves"] = np.where(up["kids"] == 0, 1, up["leaves"])
            up["saved"] = up["saved"] + (up["n"] - 1) * words
            nodes.append({**{x: up[x] for x in ("conv", "n", "leaves", "saved", "end")}, "kids": up["kids"],
                          "depth": np.full(len(up["path"]), depth)})
        live = {**up, "kids": np.ones(len(up["path"]), np.int64), "end": np.full(len(up["path"]), -1)}
        depth -= 1
    return nodes, tops


_PEELED = _NODE + (", p BIGINT, f1 ARRAY<BIGINT>, f2 ARRAY<BIGINT>, fw ARRAY<BIGINT>")


def _peel_groups(limit: int):
    """Peel the paths of a task, which come sorted by dealt prefix, in blocks of whole prefixes."""
    names = ["conv_id", "n", "len", "p", "d1", "d2", "whole"]

    def work(t: pa.Table):
        conv, n, length, low, d1, d2 = (np.asarray(t.column(c)).astype(np.int64) for c in names[:6])
        whole = np.asarray(t.column("whole")).astype(bool)
        off, t1 = _lists(t.column("t1"))
        _, t2 = _lists(t.column("t2"))
        _, w = _lists(t.column("w"))
        k1, k2 = _prefix_keys(off, t1, t2) if len(t1) else (t1, t2)
        group = np.cumsum(np.concatenate([[True], (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1]) | (low[1:] != low[:-1])
                                          | (whole[1:] != whole[:-1])]))
        nodes, tops = peel(conv, n, length, low, group, off, k1, k2, w)
        sha = pa.concat_arrays([t.column("ends_sha256").combine_chunks().cast(pa.string()), pa.array([EMPTY_SHA])])
        none = pa.array([None], pa.list_(pa.int64()))

        def column(parts, key):
            return np.concatenate([p[key] for p in parts])

        def ends(e):
            return sha.take(pa.array(np.where(e < 0, len(conv), e)))

        if nodes:
            size = sum(len(p["conv"]) for p in nodes)
            empty = none.take(pa.array(np.zeros(size, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(column(nodes, x)) for x in ("conv", "depth", "parent", "n", "kids", "leaves", "saved")),
                 ends(column(nodes, "end")), pa.array([None] * size, pa.int64()), empty, empty, empty],
                schema=_peeled_schema)
        if tops:
            path = column(tops, "path")
            size = low[path]
            flat = _ranges(off[path], size)
            to = np.concatenate([[0], np.cumsum(size)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(column(tops, "conv")), pa.array(size), pa.array([None] * len(path), pa.int64()),
                 *(pa.array(column(tops, x)) for x in ("n", "kids", "leaves", "saved")), ends(column(tops, "end")),
                 pa.array(size), *(_list_array(to, x[flat]) for x in (t1, t2, w))], schema=_peeled_schema)

    def run(batches):
        held, turns = [], 0
        for t in batches:
            if not t.num_rows:
                continue
            held.append(t)
            turns += int(np.asarray(t.column(t.schema.get_field_index("len"))).sum()) + t.num_rows
            if turns < limit:
                continue
            whole = pa.Table.from_batches(held)
            key = np.stack([np.asarray(whole.column(c)).astype(np.int64) for c in ("p", "d1", "d2", "whole")])
            last = int(np.flatnonzero((key != key[:, -1:]).any(0))[-1]) + 1 if (key != key[:, -1:]).any() else 0
            if not last:
                continue  # one prefix so far
            yield from work(whole.slice(0, last).combine_chunks())
            rest = whole.slice(last).combine_chunks()
            held = rest.to_batches()
            turns = int(np.asarray(rest.column("len")).sum()) + rest.num_rows
        if held:
            yield from work(pa.Table.from_batches(held).combine_chunks())
    return run


_peeled_schema = pa.schema([(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                                                      "n_leaves", "saved_tokens")]
                           + [("ends_sha256", pa.string()), ("p", pa.int64())]
                           + [(c, pa.list_(pa.int64())) for c in ("f1", "f2", "fw")])


def _top_levels(tops: DataFrame, deepest: int) -> list[DataFrame]:
    """The levels above the dealt prefixes, one aggregation each: strip, regroup, add up."""
    def entering(d):
        return tops.where(F.col("p") == d).select(
            F.arrays_zip("f1", "f2", "fw").alias("path"), "conv_id", F.lit(0).cast("long").alias("up"),
            "n_convs", F.col("n_children").alias("kids"), F.col("n_leaves").alias("leaves"),
            F.col("saved_tokens").alias("saved"), F.when(F.col("ends_sha256") != EMPTY_SHA, F.col("ends_sha256")).alias("sha"))

    done, survivors = [], None
    for d in range(deepest, -1, -1):
        rows = entering(d) if survivors is None else entering(d).unionByName(survivors)
        level = rows.groupBy("path").agg(
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("kids").alias("n_children"),
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("sha").alias("sha"))
        words = F.element_at("path", -1)["fw"] if d else F.lit(0).cast("long")
        level = level.select(
            "path", "conv_id", F.lit(d).cast("long").alias("depth"), "n_convs", "n_children",
            F.when(F.col("n_children") == 0, F.lit(1).cast("long")).otherwise(F.col("leaves")).alias("n_leaves"),
            (F.col("saved") + (F.col("n_convs") - 1) * words).alias("saved_tokens"),
            F.coalesce("sha", F.lit(EMPTY_SHA)).alias("ends_sha256"))
        level = materialize(level, "trie-level")
        done.append(level)
        survivors = level.select(
            F.slice("path", 1, d - 1).alias("path") if d > 1 else F.slice("path", 1, 0).alias("path"), "conv_id",
            F.lit(1).cast("long").alias("up"), "n_convs", F.lit(1).cast("long").alias("kids"),
            F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"), F.lit(None).cast("string").alias("sha"))
    return done


_OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(convs: DataFrame, family: int = 20, heads: int = 4, many_paths: int = MANY_PATHS,
                many_turns: int = MANY_TURNS, most_turns: int = MOST_TURNS, peel_turns: int = PEEL_TURNS,
                block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per node of the trie of rebuilt conversations, the root included.

    Turns of a conversation are in the order of ``turn`` (null first; equal ones by a
    hash of role and text, so repeated rows count as turns); null role or text is
    empty.  Rows without ``conv_id`` belong to no conversation and are left out.  Other
    columns are not looked at; an empty table gives an empty result."""
    paths = materialize(rebuilt(convs, family, heads, block_rows), "trie-paths")
    paths = materialize(distinct_paths(paths), "trie-distinct")
    dealt = dealt_paths(paths, many_paths, many_turns, most_turns)
    dealt = dealt.repartition("p", "d1", "d2", "whole").sortWithinPartitions("p", "d1", "d2", "whole")
    peeled = materialize(dealt.mapInArrow(_peel_groups(peel_turns), _PEELED), "trie-nodes")
    tops = peeled.where("p IS NOT NULL")
    deepest = tops.agg(F.max("p")).first()[0]
    out = peeled.where("p IS NULL").select(*_OUT)
    levels = _top_levels(tops, deepest) if deepest is not None else []
    for child, parent in zip(levels, levels[1:]):  # parents with children here only
        up = (parent.where("n_children > 0").select(F.col("path").alias("above"), F.col("conv_id").alias("parent_conv_id")))
        d = F.size("path")
        out = out.unionByName(child.join(up, F.slice("path", F.lit(1), d - 1) == F.col("above"), "left").select(*_OUT))
    if levels:
        out = out.unionByName(levels[-1].withColumn("parent_conv_id", F.lit(None).cast("long")).select(*_OUT))
    return out
