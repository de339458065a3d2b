"""Benchmark decontamination with an FM-index per shard of the corpus.

Each task indexes its documents, shard by shard (some MB of text): the words
become ids of the benchmark vocabulary, a suffix array of the id sequence
gives the Burrows-Wheeler transform, and a wavelet matrix answers rank on it.
Benchmark windows are searched backwards, all windows of a shard at once;
occurrences are located by walking to sampled suffix positions, and the word
spans that they cover are merged per document.

Words outside the benchmark vocabulary cannot be part of a window, so they
only separate segments, and a segment shorter than the shortest window cannot
hold one; both are left out of the index without changing any answer.

Documents are never shuffled.  The windows are the query set: their number is
counted first, and they are sent to the tasks in blocks of ``BLOCK_WINDOWS``;
with more than one block the documents' state goes from pass to pass.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ALNUM, Chunk, chunks, lower_ascii, materialize, prefix_hash, ship, span_hash, word_bounds
from .suffixes import suffix_array

#: words in a window, and windows sent to the tasks at once (8 bytes a word)
WINDOW, BLOCK_WINDOWS = 13, 200_000
#: every so many text positions have their suffix position stored
SAMPLE = 8
#: bytes of text in one index
SHARD_BYTES = 8 << 20


class WaveletMatrix:
    """Rank over a sequence of small integers, one bit level after the other."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.n, self.bits = len(seq), max(1, int(sigma - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (seq >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int64)]))
            self.zeros.append(self.n - int(self.ones[-1][-1]))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each c among the first i symbols."""
        start = np.zeros(len(c), np.int64)
        for level, ones, zeros in zip(range(self.bits - 1, -1, -1), self.ones, self.zeros):
            one = ((c >> level) & 1).astype(bool)
            i = np.where(one, zeros + ones[i], i - ones[i])
            start = np.where(one, zeros + ones[start], start - ones[start])
        return i - start

    def access(self, i: np.ndarray) -> np.ndarray:
        """The symbols at positions i."""
        c = np.zeros(len(i), np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            bit = ones[i + 1] - ones[i]
            c = 2 * c + bit
            i = np.where(bit == 1, zeros + ones[i], i - ones[i])
        return c


class FMIndex:
    """Over symbols 1..sigma-1; zeros separate segments and match nothing.

    Separators rank by position, so suffixes of different segments never tie."""

    def __init__(self, seq: np.ndarray, sigma: int):
        n = len(seq)
        seps = np.flatnonzero(seq == 0)
        first = seq + len(seps)
        first[seps] = np.arange(len(seps))
        sa = suffix_array(first)
        before = seq[sa - 1]  # position 0 is a separator, and so is the last one
        self.wavelet = WaveletMatrix(before, sigma)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=sigma))])[:sigma]
        marked = (sa % SAMPLE == 0) | (before == 0)
        self.marks = np.concatenate([[0], np.cumsum(marked)])
        self.samples = sa[marked]
        self.n = n

    def search(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix-array ranges [lo, hi) of equally long phrases (one per row)."""
        lo = np.zeros(len(words), np.int64)
        hi = np.full(len(words), self.n, np.int64)
        live = np.arange(len(words))
        for k in range(words.shape[1] - 1, -1, -1):
            c = words[live, k]
            lo[live] = self.smaller[c] + self.wavelet.rank(c, lo[live])
            hi[live] = self.smaller[c] + self.wavelet.rank(c, hi[live])
            live = live[lo[live] < hi[live]]
        hi = np.maximum(lo, hi)
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows."""
        at, steps = rows.copy(), np.zeros(len(rows), np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            r = at[todo]
            todo = todo[self.marks[r + 1] == self.marks[r]]
            r = at[todo]
            c = self.wavelet.access(r)
            at[todo] = self.smaller[c] + self.wavelet.rank(c, r)
            steps[todo] += 1
        return self.samples[self.marks[at]] + steps


# ------------------------------------------------------------ benchmark windows

def _word_hashes(c: Chunk):
    low = lower_ascii(c.data)
    starts, ends, doc = word_bounds(low, c.offs, ALNUM)
    return span_hash(prefix_hash(low), starts, ends) if len(low) else np.empty(0, np.uint64), starts, ends, doc


def benchmark_windows(bench: DataFrame, id_col: str = "item_id", text_col: str = "text",
                      window: int = WINDOW) -> DataFrame:
    """(window, item_id), distinct: the hashed words of every window of every item
    (8 bytes a word); an item of fewer words is one window, one without words has none."""
    schema = pa.schema([("window", pa.binary()), ("item_id", pa.int64())])

    def run(batches):
        for c in chunks(batches, "text"):
            h, _, _, doc = _word_hashes(c)
            ids = c.column("item_id").to_pylist()
            out, items = [], []
            bounds = np.searchsorted(doc, np.arange(len(c) + 1))
            for d in range(len(c)):
                words = h[bounds[d]:bounds[d + 1]]
                for s in range(max(1, len(words) - window + 1) if len(words) else 0):
                    out.append(words[s:s + window].tobytes())
                    items.append(ids[d])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(items, pa.int64())], schema=schema)

    src = bench.select(F.col(id_col).cast("bigint").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return src.where("item_id IS NOT NULL AND text IS NOT NULL") \
        .mapInArrow(run, "window BINARY, item_id BIGINT").distinct()


class _Queries:
    """One block of windows: vocabulary, and distinct windows by length with their items."""

    def __init__(self, pairs: list[tuple[bytes, int]]):
        pairs = sorted(pairs)
        texts = list(dict.fromkeys(w for w, _ in pairs))
        number = {w: i for i, w in enumerate(texts)}
        owner = np.array([number[w] for w, _ in pairs], np.int64)
        self.item = np.array([i for _, i in pairs], np.int64)
        self.first = np.searchsorted(owner, np.arange(len(texts) + 1))
        self.vocabulary = np.unique(np.frombuffer(b"".join(texts), np.uint64))
        self.by_length = {}
        for length in sorted({len(w) // 8 for w in texts}):
            mine = np.array([i for i, w in enumerate(texts) if len(w) == 8 * length])
            words = np.frombuffer(b"".join(texts[i] for i in mine), np.uint64).reshape(-1, length)
            self.by_length[length] = mine, np.searchsorted(self.vocabulary, words) + 1

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary numbers from 1; 0 for words that no window has."""
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def find(self, ids: np.ndarray, doc: np.ndarray):
        """(word number, length, window number) of every occurrence; no match crosses a document."""
        none = np.empty(0, np.int64)
        least = min(self.by_length)
        edge = np.zeros(len(ids) + 1, bool)
        edge[0] = edge[-1] = True
        inside = ids > 0
        edge[1:-1] = (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1])
        cut = np.flatnonzero(edge)
        size = np.diff(cut)
        good = np.flatnonzero((size >= least) & inside[cut[:-1]])
        if not len(good):
            return none, none, none
        a, n = cut[good], size[good]
        # the segments, a zero before each and after the last
        words = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)
        spot = np.arange(n.sum()) + np.repeat(np.arange(1, len(n) + 1), n)
        seq = np.zeros(n.sum() + len(n) + 1, np.int64)
        where = np.full(len(seq), -1, np.int64)
        seq[spot], where[spot] = ids[words], words
        index = FMIndex(seq, len(self.vocabulary) + 1)
        found = []
        for length, (mine, phrases) in self.by_length.items():
            lo, hi = index.search(phrases)
            hit = np.flatnonzero(hi > lo)
            if not len(hit):
                continue
            count = (hi - lo)[hit]
            rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo[hit], count)
            at = where[index.locate(rows)]
            found.append((at, np.full(len(at), length), np.repeat(mine[hit], count)))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (none, none, none)


_SPANS = "array<struct<start: int, end: int>>"
_STATE = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_words", pa.int64()),
                    ("words", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    ("bytes", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    ("items", pa.list_(pa.int64()))])
_STATE_SQL = f"doc_id BIGINT, text STRING, n_words BIGINT, words {_SPANS}, bytes {_SPANS}, items ARRAY<BIGINT>"


def _spans(a: np.ndarray, b: np.ndarray, doc: np.ndarray, n: int) -> pa.Array:
    pairs = pa.StructArray.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32())], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(n + 1)), pa.int32()), pairs)


def _mark(c: Chunk, queries: _Queries | None, keep_text: bool, carried: list[str]) -> pa.RecordBatch:
    """Merged hit spans and item ids of a chunk's documents, with those of earlier passes."""
    hashes, starts, ends, doc = _word_hashes(c)
    n, ids = len(c), c.column("doc_id").cast(pa.int64())
    bounds = np.searchsorted(doc, np.arange(n + 1))
    change = np.zeros(len(starts) + 1, np.int64)
    pairs = np.empty((0, 2), np.int64)
    if queries is not None and len(starts):
        at, length, which = queries.find(queries.ids(hashes), doc)
        np.add.at(change, at, 1)
        np.add.at(change, at + length, -1)
        once = np.unique(np.stack([doc[at], which], 1), axis=0)
        many = queries.first[once[:, 1] + 1] - queries.first[once[:, 1]]
        item = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) \
            + np.repeat(queries.first[once[:, 1]], many)
        pairs = np.stack([np.repeat(once[:, 0], many), queries.item[item]], 1)
    if "words" in c.rows.schema.names:
        for d, (spans, items) in enumerate(zip(c.column("words").to_pylist(), c.column("items").to_pylist())):
            for s in spans:
                change[bounds[d] + s["start"]] += 1
                change[bounds[d] + s["end"]] -= 1
            if items:
                pairs = np.concatenate([pairs, np.stack([np.full(len(items), d), np.array(items)], 1)])
    pairs = np.unique(pairs, axis=0)
    hit = np.cumsum(change[:-1]) > 0
    edge = np.ones(len(hit), bool)
    edge[1:] = (doc[1:] != doc[:-1]) | (hit[1:] != hit[:-1])
    a = np.flatnonzero(edge)
    b = np.append(a[1:], len(hit))
    a, b = a[hit[a]], b[hit[a]]
    d = doc[a]
    rest = [c.column(k) for k in carried]
    schema = pa.schema([*_STATE, *(pa.field(k, a.type) for k, a in zip(carried, rest))])
    return pa.RecordBatch.from_arrays([
        ids, c.column("text").cast(pa.string()) if keep_text else pa.nulls(n, pa.string()),
        pa.array(np.diff(bounds), pa.int64()),
        _spans(a - bounds[d], b - bounds[d], d, n),
        _spans(starts[a] - c.offs[d], ends[b - 1] - c.offs[d], d, n),
        pa.ListArray.from_arrays(pa.array(np.searchsorted(pairs[:, 0], np.arange(n + 1)), pa.int32()),
                                 pa.array(pairs[:, 1], pa.int64())), *rest], schema=schema)


def _search(src: DataFrame, bench: DataFrame, item_col: str, window: int, block: int, shard_bytes: int,
            keep_text: bool) -> DataFrame:
    """``src`` (doc_id, text, carried columns) with its hit spans and item ids."""
    spark = src.sparkSession
    ship(spark)
    carried = src.columns[2:]
    fields = _STATE_SQL + "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[2:])
    windows = materialize(benchmark_windows(bench, item_col, "text", window), "windows")
    blocks = max(1, -(-windows.count() // block))
    state = src
    for b in range(blocks):
        # about ``block`` windows of 8 bytes a word: the blocks are dealt by hash
        mine = windows.where(F.pmod(F.xxhash64("window", "item_id"), F.lit(blocks)) == b)
        sent = spark.sparkContext.broadcast([(bytes(r[0]), r[1]) for r in mine.toLocalIterator()])
        last = b + 1 == blocks

        def run(batches, sent=sent, text=keep_text or not last):
            queries = _Queries(sent.value) if sent.value else None
            for c in chunks(batches, "text", shard_bytes):
                yield _mark(c, queries, text, carried)

        state = state.mapInArrow(run, fields)
        if not last:
            state = materialize(state, "contamination")
    n_hit = F.aggregate("words", F.lit(0).cast("bigint"), lambda s, x: s + (x["end"] - x["start"]))
    return state.withColumn("n_hit", n_hit).withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))


def contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", window: int = WINDOW, block: int = BLOCK_WINDOWS,
                  shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per document: n_words, n_hit (words inside an occurring window), n_items,
    items_sha256, contaminated (n_hit > 0 and at least 5 % of the words), ``spans``
    (merged byte ranges of the hits in the UTF-8 text) and ``items``.

    A null or empty text has no words; it is never contaminated.  Items with a
    null id or text are skipped, repeated items count once.  Repeated documents
    return a row each.  An empty benchmark hits nothing; an empty corpus gives
    an empty result.  Other columns are not looked at."""
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = _search(src, bench, item_col, window, block, shard_bytes, False)
    text_ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join(text_ids, ","), 256).alias("items_sha256"), "contaminated",
                        F.col("bytes").alias("spans"), "items")


def drop_contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_col: str = "item_id", block: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` without the contaminated documents, each row judged alone; the rest unchanged.

    Nulls and empty tables as in ``contamination``."""
    names = {c: f"__k{i}" for i, c in enumerate(docs.columns) if c != text_col}
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      *(F.col(c).alias(k) for c, k in names.items()))
    clean = _search(src, bench, item_col, WINDOW, block, SHARD_BYTES, True).where("NOT contaminated")
    return clean.select(*(F.col(names.get(c, "text")).alias(c) for c in docs.columns))


def items_digest(ids) -> str:
    """What ``items_sha256`` holds for these item ids."""
    return hashlib.sha256(",".join(sorted(map(str, set(ids)))).encode()).hexdigest()
