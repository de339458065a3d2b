"""Spelling variants of the words of a corpus, found with a variable-length gram index.

1. *Words*: runs of letters of all texts, counted (map-side sums before the shuffle).
2. *Gram dictionary*: all grams of ``QMIN`` characters of the distinct words, and a
   longer gram only where the gram without its last character is frequent (more
   than a ``FREQUENT``-th of all gram places), up to ``QMAX``.  At most ``FREQUENT``
   grams of a length are frequent and the alphabet has 92 signs, so the dictionary
   has a bound whatever the corpus; it is collected and broadcast.
3. *Decomposition*: a word, with a sign at either end, becomes the longest dictionary
   grams at its places, without those inside an earlier one.
4. *Affected grams*: for each word the largest number of its grams that one edit can
   change or hide.  Two words at distance one share all but these; so among the
   rarest (that number + 1) grams of both there is one that both keep.
5. *Lists*: the index holds each word under those rarest grams only, and, as the
   edit lies on one side of a kept gram, with the whole other side: words that meet
   share the gram and all that is before it, or all that is after it.  A list that
   is still long is dealt again by halves of the side with the edit.
6. *Verification*: the pairs of a list are compared letter by letter.

Words that one edit may leave without a common gram (short ones of long grams) also
enter a second index with the dictionary of ``QMIN``-grams, among themselves; there an
edit never reaches all grams of a word of three letters or more.  Runs of more than
``LONG_WORD`` letters are no words of a language and may repeat one gram without end:
they stand in lists by their halves (step 5 without a gram).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize, mix, pack_model, prefix_hash, ship, span_hash, unpack_model

QMIN, QMAX = 2, 5
#: at most so many grams of a length count as frequent and are made longer
FREQUENT = 1 << 12
#: longer words are listed by halves; those of this length and one more by both ways
LONG_WORD = 64
#: words of a list: above the first a task deals it again in memory, above the second all tasks do
LONG_LIST, HOT_LIST = 32, 1 << 16
#: letters compared at once
COMPARE = 1 << 22
#: rows of the index that a task handles at once (whole lists)
BLOCK_ROWS = 1 << 17

_HEAD, _TAIL = "^", "$"


# ---------------------------------------------------------------------- words

def words(docs: DataFrame, least_chars: int = 5, least_n: int = 3, one_in: int = 97,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of letters, A-Z in lower case; of one run in ``one_in`` (by crc32 of
    ``id:run``) a letter is left out.  A null text has no words, a null id is empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(
        F.translate(F.col(text_col).cast("string"), upper, upper.lower()), F.lit("[a-zÀ-ÿ]+"), F.lit(0)))
        .alias("run")).where(F.length("run") >= least_chars)
    runs = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    cut = F.expr("concat(substring(run, 1, cast(h % length(run) AS INT)), "
                 "substring(run, cast(h % length(run) AS INT) + 2))")
    word = F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).where(F.length("word") >= least_chars)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_n))


# ---------------------------------------------------------- gram dictionary

class Grams:
    """Dictionary of grams: ``rank`` orders them from rare to common, ``longer`` holds
    those with a longer one, ``endings`` all that a gram ends with but the whole gram."""

    def __init__(self, grams: list[str]):
        self.rank = {g: i for i, g in enumerate(grams)}
        self.longer = {g[:-1] for g in grams}
        self.endings = {g[i:] for g in grams for i in range(1, len(g))}
        self.most = max(map(len, grams), default=QMIN)

    def decompose(self, s: str) -> list[tuple[int, int]]:
        """Spans of the longest grams of ``s``, without those inside an earlier one."""
        out, reach, n = [], 0, len(s)
        rank, longer = self.rank, self.longer
        for p in range(n - QMIN + 1):
            e = p + QMIN
            g = s[p:e]
            while g in longer and e < n:
                g = s[p:e + 1]
                if g not in rank:
                    break
                e += 1
            if e > reach:
                out.append((p, e))
                reach = e
        return out

    def affected(self, s: str, spans: list[tuple[int, int]]) -> int:
        """The most grams of ``s`` that one edit of an inner letter can change or hide.

        A gram that holds the edit changes.  One that ends right before it may become
        longer, if the dictionary has a longer one.  One behind it stays the longest
        at its place, and is hidden only by a gram over the edit that reaches its end:
        then the letters from the edit to its end are an ending of a dictionary gram."""
        n = len(s)
        swap, put = [0] * (n + 1), [0] * (n + 1)  # edits of letter i; letters put before i
        for a, e in spans:
            for i in range(a, e):
                swap[i] += 1
            for i in range(a + 1, e):
                put[i] += 1
            if s[a:e] in self.longer:
                swap[e] += 1
                put[e] += 1
            i = a
            while i > 0 and s[i:e] in self.endings:
                put[i] += 1
                swap[i - 1] += 1
                i -= 1
        return max(max(swap[1:n - 1], default=0), max(put[1:n], default=0))

    def entries(self, s: str) -> tuple[list[tuple[int, int]], bool]:
        """The gram places of ``s`` that the index needs; whether any gram outlives each edit."""
        spans = self.decompose(s)
        bad = self.affected(s, spans)
        by_rank = sorted(spans, key=lambda x: self.rank.get(s[x[0]:x[1]], -1))
        rare = {s[a:e] for a, e in by_rank[:bad + 1]}
        return [x for x in spans if s[x[0]:x[1]] in rare], bad < len(spans)


def gram_dictionary(vocabulary: DataFrame, frequent: int = FREQUENT, most: int = QMAX) -> list[str]:
    """Grams of the dictionary, the rarest first (then by code point)."""
    padded = (vocabulary.where(F.length("word") <= LONG_WORD + 1)
              .select(F.concat(F.lit(_HEAD), "word", F.lit(_TAIL)).alias("s")))
    grams = padded.select(F.explode(F.expr(
        f"flatten(transform(sequence(1, length(s) - {QMIN - 1}), p -> "
        f"transform(sequence({QMIN}, least({most}, length(s) - p + 1)), q -> substring(s, p, q))))")).alias("gram"))
    counts = materialize(grams.groupBy("gram").agg(F.count("*").alias("n")), "grams")
    total = counts.where(F.length("gram") == QMIN).agg(F.sum("n")).first()[0] or 0
    short = counts.where(F.length("gram") == QMIN)
    long = counts.where(F.length("gram") > QMIN)
    common = counts.where((F.length("gram") < most) & (F.col("n") * frequent > total)).select(F.col("gram").alias("stem"))
    kept = long.join(common, F.expr("substring(gram, 1, length(gram) - 1) = stem"), "left_semi")
    rows = short.unionByName(kept).collect()  # bounded: see the head of this module
    return [r.gram for r in sorted(rows, key=lambda r: (r.n, r.gram))]


# ---------------------------------------------------------------------- index

_INDEX = "key BIGINT, word STRING, n BIGINT, a INT, b INT"
_index_schema = pa.schema([("key", pa.int64()), ("word", pa.string()), ("n", pa.int64()), ("a", pa.int32()),
                           ("b", pa.int32())])


def _flat(col: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all words back to back (a byte each) and their bounds."""
    data = np.frombuffer("".join(col).encode("latin-1"), np.uint8)
    return data, np.concatenate([[0], np.cumsum(np.fromiter(map(len, col), np.int64, len(col)))])


def _salted(h: np.ndarray, salt) -> np.ndarray:
    return mix(h ^ (np.asarray(salt).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def _index(blob):
    """Index rows of words: (key, word, n, a, b); the edit lies in letters [a, b)."""
    def run(batches):
        grams = unpack_model(blob.value)["grams"].tolist()
        every, short = Grams(grams), Grams([g for g in grams if len(g) == QMIN])
        for t in batches:
            if not t.num_rows:
                continue
            ws, ns = t.column(0).to_pylist(), np.asarray(t.column(1))
            data, off = _flat([_HEAD + w + _TAIL for w in ws])
            row, tier, left, start, end = [], [], [], [], []
            for i, w in enumerate(ws):
                if len(w) > LONG_WORD + 1:
                    continue
                s = _HEAD + w + _TAIL
                found, outlives = every.entries(s)
                tiers = [(0, found)] if outlives else [(0, found), (1, short.entries(s)[0])]
                for k, spans in tiers:
                    for a, e in spans:
                        if e < len(s):
                            row.append(i); tier.append(k); left.append(1); start.append(0); end.append(e)  # noqa: E702
                        if a > 0:
                            row.append(i); tier.append(k); left.append(0); start.append(a); end.append(len(s))  # noqa: E702
            row, tier, left, start, end = (np.array(x, np.int64) for x in (row, tier, left, start, end))
            key = _salted(span_hash(prefix_hash(data), off[row] + start, off[row] + end), 2 * tier + left + 1)
            a = np.where(left == 1, end - 1, 0)
            size = np.diff(off) - 2
            b = np.where(left == 1, size[row], start - 1)
            long = np.flatnonzero(size >= LONG_WORD)
            if len(long):
                z = np.zeros(len(long), np.int64)
                halves = deal_again(z, data, off + 1, long, z, size[long])
                key, row, a, b = (np.concatenate(x) for x in zip((key.view(np.int64), row, a, b), halves))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), t.column(0).take(pa.array(row)), pa.array(ns[row]),
                 pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], schema=_index_schema)
    return run


def deal_again(key, data, off, row, a, b):
    """Lists dealt by halves of the letters with the edit: (key, row, a, b), several per entry.

    Words whose open letters number c and c or c + 1 meet in class c, under the first
    c // 2 of them or under those behind the edit's half.  With more than two open
    letters each round leaves fewer; words that share all but two are few."""
    size = b - a
    pre = prefix_hash(data)
    at = off[row]
    out = []
    for longer in (0, 1):
        ok = size >= longer
        k, r, lo, hi, c = key[ok], row[ok], a[ok], b[ok], size[ok] - longer
        s, h = at[ok], c // 2
        first = span_hash(pre, s + lo, s + lo + h)
        out.append((_salted(mix(k.view(np.uint64)) ^ first, 2 * c + 1), r, lo + h, hi))
        second = span_hash(pre, s + lo + h + longer, s + hi)
        out.append((_salted(mix(k.view(np.uint64)) ^ second, 2 * c + 2), r, lo, lo + h + longer))
    key, row, a, b = (np.concatenate(x) for x in zip(*out))
    return key.view(np.int64), row, a, b


def _deal_rows(batches):
    for t in batches:
        if not t.num_rows:
            continue
        data, off = _flat(t.column(1).to_pylist())
        key, a, b = (np.asarray(t.column(i)).astype(np.int64) for i in (0, 3, 4))
        key, row, a, b = deal_again(key, data, off, np.arange(t.num_rows), a, b)
        at = pa.array(row)
        yield pa.RecordBatch.from_arrays([pa.array(key), t.column(1).take(at), t.column(2).take(at),
                                          pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))],
                                         schema=_index_schema)


# --------------------------------------------------------------- verification

def one_edit(data: np.ndarray, off: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """True where words x and y (row numbers) differ by exactly one letter put, left out or replaced."""
    lx, ly = off[x + 1] - off[x], off[y + 1] - off[y]
    least, most = np.minimum(lx, ly), np.maximum(lx, ly)
    ok = np.zeros(len(x), bool)
    todo = np.flatnonzero((most - least <= 1) & (least > 0))
    ends = np.cumsum(least[todo])
    at = 0
    while at < len(todo):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + COMPARE, "right")))
        i = todo[at:to]
        size = least[i]
        seg = np.cumsum(size) - size
        step = np.arange(size.sum()) - np.repeat(seg, size)
        long = np.repeat(size, size)
        same = []
        for p, q, sign in ((off[x[i]], off[y[i]], 1), (off[x[i] + 1] - 1, off[y[i] + 1] - 1, -1)):
            eq = data[np.repeat(p, size) + sign * step] == data[np.repeat(q, size) + sign * step]
            same.append(np.minimum.reduceat(np.where(eq, long, step), seg))
        head, tail = same
        # one letter apart: the equal head and tail leave one letter of the longer word, or of both
        ok[i] = np.where(most[i] == size, head + tail + 1 == size, head + tail >= size)
        at = to
    return ok | ((least == 0) & (most == 1))


def _pairs(first: np.ndarray, size: np.ndarray):
    """All pairs of places of lists that start at ``first``."""
    width = np.concatenate([np.arange(s - 1, -1, -1) for s in size]) if len(size) else np.empty(0, np.int64)
    place = np.concatenate([np.arange(f, f + s) for f, s in zip(first, size)]) if len(size) else width
    i = np.repeat(place, width)
    j = i + 1 + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
    return i, j


def near_pairs(key, data, off, a, b, long_list: int = LONG_LIST):
    """Pairs of row numbers of words one edit apart that share a key."""
    row = np.arange(len(key))
    found = []
    while len(key):
        order = np.argsort(key, kind="stable")
        key, row, a, b = key[order], row[order], a[order], b[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(first, len(key)))
        open_letters = np.maximum.reduceat(b - a, first)
        again = (size > long_list) & (open_letters > 2)
        plain = (size > 1) & ~again
        at, first_p, size_p = 0, first[plain], size[plain]
        ends = np.cumsum(size_p * size_p)
        while at < len(first_p):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 20), "right")))
            i, j = _pairs(first_p[at:to], size_p[at:to])
            i, j = row[i], row[j]
            ok = one_edit(data, off, i, j)
            found.append((i[ok], j[ok]))
            at = to
        more = np.repeat(again, size)
        key, row, a, b = deal_again(key[more], data, off, row[more], a[more], b[more])
    if not found:
        z = np.empty(0, np.int64)
        return z, z
    return tuple(np.concatenate(x) for x in zip(*found))


_LINK = "word STRING, near STRING, near_n BIGINT"


def _verify(block: int):
    """Links of the lists of a task, which come sorted by key, in blocks of whole lists."""
    schema = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])

    def work(t: pa.Table):
        key, n, a, b = (np.asarray(t.column(c)).astype(np.int64) for c in ("key", "n", "a", "b"))
        words = t.column("word").combine_chunks()
        data, off = _flat(words.to_pylist())
        i, j = near_pairs(key, data, off, a, b)
        if len(i):
            x, y = np.concatenate([i, j]), np.concatenate([j, i])
            # each link once, though several lists of the block hold it
            ids = pa.compute.dictionary_encode(words)
            code = np.asarray(ids.indices).astype(np.int64)
            _, once = np.unique(code[x] * len(ids.dictionary) + code[y], return_index=True)
            x, y = x[once], y[once]
            yield pa.RecordBatch.from_arrays([words.take(pa.array(x)), words.take(pa.array(y)), pa.array(n[y])],
                                             schema=schema)

    def run(batches):
        held, rows = [], 0
        for t in batches:
            if not t.num_rows:
                continue
            held.append(t)
            rows += t.num_rows
            if rows < block:
                continue
            whole = pa.Table.from_batches(held)
            key = np.asarray(whole.column("key"))
            last = int(np.searchsorted(key, key[-1]))
            if not last:
                continue  # one list so far; it has at most HOT_LIST words
            yield from work(whole.slice(0, last))
            rest = whole.slice(last).combine_chunks()
            held, rows = rest.to_batches(), rest.num_rows
        if held:
            yield from work(pa.Table.from_batches(held))
    return run


def near_words(vocabulary: DataFrame, frequent: int = FREQUENT, most: int = QMAX, hot_list: int = HOT_LIST) -> DataFrame:
    """(word, near, near_n): every ordered pair of words of ``vocabulary`` (word, n; distinct
    words of letters below U+0100) that one edit separates, once."""
    spark = vocabulary.sparkSession
    ship(spark)
    grams = gram_dictionary(vocabulary, frequent, most)
    model = spark.sparkContext.broadcast(pack_model({"grams": np.array(grams or [""])}))
    rows = materialize(vocabulary.select("word", "n").mapInArrow(_index(model), _INDEX), "gram-index")
    links = []
    while True:
        hot = rows.groupBy("key").agg(F.count("*").alias("size"), F.max(F.col("b") - F.col("a")).alias("open")) \
            .where((F.col("size") > hot_list) & (F.col("open") > 2)).select("key")
        hot = materialize(hot, "hot-lists")
        light = rows.join(hot, "key", "left_anti").repartition("key").sortWithinPartitions("key")
        links.append(light.mapInArrow(_verify(BLOCK_ROWS), _LINK))
        if hot.isEmpty():
            break
        rows = materialize(rows.join(hot, "key", "left_semi").mapInArrow(_deal_rows, _INDEX), "gram-index")
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out.repartition("word").dropDuplicates(["word", "near"])


# ----------------------------------------------------------------------- forms

def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word with a form, level by level from the last forms down.

    A form is at least twice as common as its word, so there are no rings, and the
    rounds are at most the binary logarithm of the largest count.  A round joins on
    the form, which has no more words than there are words one edit away from it."""
    ends = forms.select(F.col("form").alias("word")).distinct().join(forms, "word", "left_anti")
    level = ends.select("word", F.col("word").alias("root"))
    out = None
    while True:
        level = materialize(forms.join(level.select(F.col("word").alias("form"), "root"), "form")
                            .select("word", "root"), "roots")
        if level.isEmpty():
            return out if out is not None else level
        out = level if out is None else out.unionByName(level)


def variants(docs: DataFrame, times: int = 2, **kw) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs``.

    ``form`` is the most common word one edit away (ties: the smallest in code-point
    order) if it is at least ``times`` as common, else null; ``root`` the last of the
    chain of forms.  A null or empty text has no words; a null id counts as an empty
    one; repeated rows count again; other columns are not looked at; an empty table
    gives an empty result."""
    ship(docs.sparkSession)
    vocabulary = materialize(words(docs), "words")
    best = (near_words(vocabulary, **kw).groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best")))
    joined = vocabulary.join(best, "word", "left")
    form_n = -F.col("best.m")
    takes = form_n >= times * F.col("n")
    rows = materialize(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(takes, F.col("best.near")).alias("form"), F.when(takes, form_n).alias("form_n")), "word-forms")
    roots = _roots(rows.where("form IS NOT NULL").select("word", "form"))
    return (rows.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
