"""Packing documents into fixed windows by Karmarkar-Karp multiway differencing.

A document's token ids (and an end id) are cut into whole windows of
``CAPACITY`` ids and a rest; from the rest a half, a quarter ... of a window are
cut where they fit, down to ``LEAST`` ids, and what is left is the last piece
(2.9 pieces a document on average).  Whole windows stand alone.  The pieces are dealt by hash into groups of
about ``GROUP_WINDOWS`` windows, and each group is packed by itself:

every piece starts as a partial partition of k windows with one window filled;
the two partial partitions with the largest imbalance (fullest less emptiest
window) are merged with opposing imbalances, the fullest window of one onto the
emptiest of the other, until one partition is left.  Its windows are near-equal,
about total / k; k starts at the least possible number and rises by one whenever
the fullest window exceeds the capacity.

Texts are tokenized once: a piece's checksum is known before it is packed, so
only piece rows (a few numbers each) are shuffled, by a hash that spreads any
hot document or source.  A group's size is bounded by construction.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import chunks, materialize, ship

#: ids in a window, in the smallest fraction of it that is cut off, the id that ends a document
CAPACITY, LEAST, END_ID = 2048, 128, 1
#: windows that are packed together
GROUP_WINDOWS = 128
CHUNK = 1 << 20
#: white-space characters in a row that are not given to the fast tokenizer, which fails on about a million
LONG_SPACE = 100_000

_SPACE = re.compile(r"\s+")
_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("deal", pa.int64()),
                     ("ids", pa.list_(pa.int32()))])
_PIECES_SQL = "doc_id BIGINT, start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT, deal BIGINT, " \
              "ids ARRAY<INT>"


# ---------------------------------------------------------------- tokenizing

def long_space(text: str) -> bool:
    """Whether ``LONG_SPACE`` or more white-space characters follow one another."""
    return len(text) >= LONG_SPACE and any(m.end() - m.start() >= LONG_SPACE for m in _SPACE.finditer(text))


class Tokens:
    """Ids of the byte-level BPE file, the same that ``tokenizers`` gives.

    The vocabulary's rank file is encoded several times faster; a text that holds
    a special token's string or a very long run of white space goes to ``tokenizers``
    itself."""

    def __init__(self, vocabulary: str, ranks: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer
        self.exact = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            import tiktoken
            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or any(s in text for s in self.special) or long_space(text):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.fast.encode_ordinary(text), np.uint32)


def default_tokens() -> Tokens:
    """``byte_bpe_50k`` of the installed ``public_tokenizers``."""
    import public_tokenizers as files
    return Tokens(files.path("byte_bpe_50k.json"), files.path("byte_bpe_50k.tiktoken"), files.PATTERN)


def cut(n: int, capacity: int = CAPACITY, least: int = LEAST) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole windows, halves, quarters ... and a rest."""
    out, at, size = [], 0, capacity
    while size >= least and size:
        while n - at >= size:
            out.append((at, size))
            at += size
        size //= 2
    if at < n:
        out.append((at, n - at))
    return out


# ------------------------------------------------------------------ packing

def differencing(sizes: list[int], k: int) -> tuple[np.ndarray, list[list[int]]]:
    """Karmarkar-Karp: (window sums, items of each window) for k windows."""
    if not sizes:
        return np.zeros(k, np.int64), [[] for _ in range(k)]
    # a node is an item or a pair of nodes; -1 is an empty window
    left, right = list(range(len(sizes))), [-2] * len(sizes)
    heap = []
    for i, n in enumerate(sizes):
        sums, nodes = np.zeros(k, np.int64), np.full(k, -1)
        sums[0], nodes[0] = n, i
        heap.append((-(n if k > 1 else 0), i, sums, nodes))
    heapq.heapify(heap)
    order = len(sizes)
    while len(heap) > 1:
        _, _, a, na = heapq.heappop(heap)
        _, _, b, nb = heap[0]
        sums, nodes = a + b[::-1], na.copy()  # both from fullest to emptiest
        other = nb[::-1]
        both = np.flatnonzero((na >= 0) & (other >= 0))
        nodes[na < 0] = other[na < 0]
        nodes[both] = np.arange(len(left), len(left) + len(both))
        left.extend(na[both].tolist())
        right.extend(other[both].tolist())
        turn = np.argsort(-sums, kind="stable")
        sums, nodes = sums[turn], nodes[turn]
        heapq.heapreplace(heap, (int(sums[-1] - sums[0]), order, sums, nodes))
        order += 1
    _, _, sums, nodes = heap[0]
    windows = []
    for root in nodes.tolist():
        items, todo = [], [root] if root >= 0 else []
        while todo:
            node = todo.pop()
            if right[node] == -2:
                items.append(left[node])
            else:
                todo += [left[node], right[node]]
        windows.append(items)
    return sums, windows


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows of at most ``capacity`` with near-equal sums; one more window whenever it is exceeded."""
    if not sizes:
        return []
    if max(sizes) > capacity:
        raise ValueError("a piece is longer than a window")
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        sums, windows = differencing(sizes, k)
        if sums.max() <= capacity:
            return [w for w in windows if w]
        k += 1


def _pack_group(capacity: int, spread: int):
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        length = np.asarray(t.column("length")).astype(np.int64)
        # an order of the rows that does not depend on how they arrived
        rank = np.lexsort([np.asarray(t.column(c)).astype(np.int64) for c in ("deal", "ids_crc32", "start")]
                          + [-length])
        whole = length[rank] == capacity
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        sequence[rank[whole]] = np.arange(whole.sum())
        parts = rank[~whole]
        for w, items in enumerate(pack(length[parts].tolist(), capacity)):
            rows = parts[sorted(items)]
            sequence[rows] = whole.sum() + w
            offset[rows] = np.cumsum(length[rows]) - length[rows]
        sequence = sequence * spread + key[0].as_py()
        keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        return pa.Table.from_arrays([t.column(c) for c in keep]
                                    + [pa.array(sequence), pa.array(offset), t.column("ids")],
                                    names=[*keep, "sequence_id", "offset", "ids"])
    return run


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokens=default_tokens,
                 capacity: int = CAPACITY, least: int = LEAST, keep_ids: bool = False) -> DataFrame:
    """The pieces of every document: place, length, checksum, the document's ids and a number to deal by."""
    ship(docs.sparkSession)

    def run(batches):
        made, coder = 0, None
        for ch in chunks(batches, "text", CHUNK):
            coder = coder or tokens()
            cols = [[] for _ in _PIECES]
            texts = ch.column("text").to_pylist()
            for doc_id, text in zip(ch.column("doc_id").to_pylist(), texts):
                ids = np.append(coder.ids(text or ""), np.uint32(END_ID)).astype("<u4")
                raw, n = ids.tobytes(), len(ids)
                for s, size in cut(n, capacity, least):
                    crc = zlib.crc32(raw[4 * s:4 * (s + size)])
                    made += 1
                    row = (doc_id, s, size, crc, n, zlib.crc32(b"%d %d %d" % (crc, s, made)),
                           ids[s:s + size].astype(np.int32) if keep_ids else None)
                    for c, v in zip(cols, row):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, _PIECES)], schema=_PIECES)

    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, _PIECES_SQL)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokens=default_tokens,
                   capacity: int = CAPACITY, least: int = LEAST, group: int = GROUP_WINDOWS,
                   keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    (and ``ids`` with ``keep_ids``).

    A null text is empty: its document is the end id alone.  Repeated rows and rows
    without id are documents of their own.  Sequence ids are unique, not gapless.
    Other columns are not looked at.  An empty table gives an empty result."""
    pieces = materialize(token_pieces(docs, id_col, text_col, tokens, capacity, least, keep_ids), "pieces")
    total = pieces.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(total / (group * capacity)))
    dealt = pieces.withColumn("__g", F.pmod(F.xxhash64("deal", "ids_crc32", "start"), F.lit(groups)))
    return dealt.groupBy("__g").applyInArrow(
        _pack_group(capacity, groups),
        "doc_id BIGINT, start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT, sequence_id BIGINT, "
        "offset BIGINT, ids ARRAY<INT>").drop(*([] if keep_ids else ["ids"]))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_ids, input_ids, doc_ids): the windows of ``pack_documents(keep_ids=True)``;
    a window is no longer than the capacity."""
    part = F.struct("offset", "doc_id", "ids")
    return (packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("p"))
            .select("sequence_id", F.flatten("p.ids").alias("input_ids"), F.col("p.doc_id").alias("doc_ids"))
            .withColumn("n_ids", F.size("input_ids")))
