"""Toxicity: a convolutional text classifier over hashed word embeddings.

Words and their first bytes (``STEMS``) are hashed; the most frequent hashes of the
training sample own an embedding, all others are the zero vector, and a word's vector is the sum over its hashes, so an unseen inflection
of a known stem is known as well.  Filters over one, two
and three words, ReLU, max pooling over the whole text and a logistic layer give
a logit.  Every labelled row outside the held-out fold is learned from, whole and as Spark
jobs over one stored table of them: the vocabulary and the evidence of its hashes are
grouped counts; an epoch is a pass in which each task runs the gradient steps of its own
rows, after which the tasks' parameters are averaged (an embedding by how often a task
touched it).  Only counts of the vocabulary and averages reach the driver, whose size is
the model's, not the table's.  Thresholds are calibrated by language on all calibration
rows: the language is guessed from the text alone (a word-presence model of the same
rows), and each language's threshold is moved to score 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import (ALNUM, byte_set, chunks, held_out_column, lower_ascii, materialize, pack_model, pieces,
                     prefix_hash, ship, span_hash, unpack_model, word_bounds)

#: hashes with an embedding; labelled rows of one training task; visits of rows that few rows get, and bounds of epochs
VOCABULARY, LEARNER_ROWS, VISITS, EPOCHS = 1 << 15, 8192, 30_000, (3, 10)
#: words that are pooled at once, parts of a packed parameter vector, width of a bin of logits
SLAB, BLOCKS, BIN = 1 << 17, 16, 1 / 256
#: bits of the hash table, embedding size, filters of each width, filter widths
HASH_BITS, SIZE, FILTERS, WIDTHS = 21, 8, 4, (1, 2, 3)
#: lengths in bytes of the stems that are hashed beside the word
STEMS = (4, 5, 6, 7)
#: labelled calibration rows that a language needs for a threshold of its own
OWN_THRESHOLD = 40
CHUNK = 1 << 19


_STEM_MULT = np.uint64(0xD6E8FEB86659FD93)


def word_hashes(data: np.ndarray, offs: np.ndarray):
    """(words x hashes, document) of the words of a chunk: the word, then its stems."""
    low = lower_ascii(data)
    s, e, doc = word_bounds(low, offs, ALNUM)
    if not len(s):
        return np.empty((0, 1 + len(STEMS)), np.uint64), doc
    word = span_hash(prefix_hash(low), s, e)
    # the first bytes of each word as a number, and its lower bytes per stem
    head = np.zeros(len(s), np.uint64)
    padded = np.concatenate([low, np.zeros(max(STEMS), np.uint8)])
    for k in range(max(STEMS)):
        head |= np.where(s + k < e, padded[s + k], 0).astype(np.uint64) << np.uint64(8 * k)
    out = np.empty((len(s), 1 + len(STEMS)), np.uint64)
    out[:, 0] = word
    for j, k in enumerate(STEMS):
        out[:, 1 + j] = ((head & np.uint64((1 << 8 * k) - 1)) + np.uint64(k << 60)) * _STEM_MULT
    return out, doc


def _blocks(texts: list[bytes], size: int = CHUNK):
    """(first text, word hashes, text number within the block) of runs of texts of about ``size`` bytes."""
    at = 0
    while at < len(texts):
        to, total = at, 0
        while to < len(texts) and (to == at or total + len(texts[to]) <= size):
            total += len(texts[to])
            to += 1
        data = np.frombuffer(b"".join(texts[at:to]), np.uint8)
        yield at, *word_hashes(data, np.concatenate([[0], np.cumsum([len(t) for t in texts[at:to]])]).astype(np.int64))
        at = to


def _presence(texts: list[bytes], skip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the different hashes of every text that is not skipped."""
    docs, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for first, h, doc in _blocks(texts):
        bounds = np.searchsorted(doc, np.arange(doc[-1] + 2 if len(doc) else 1))
        for d, (a, b) in enumerate(zip(bounds, bounds[1:])):
            if a < b and not skip[first + d]:
                kinds = np.unique(h[a:b])
                hashes.append(kinds)
                docs.append(np.full(len(kinds), first + d))
    return np.concatenate(docs), np.concatenate(hashes)


def slot_table(words: np.ndarray):
    """Lookup of hashes: row number from 1 in ``words`` (no two in one slot), 0 if not there."""
    shift = np.uint64(64 - HASH_BITS)
    slots = np.zeros(1 << HASH_BITS, np.int32)
    slots[words >> shift] = np.arange(1, len(words) + 1)
    known = np.concatenate([np.zeros(1, np.uint64), words])

    def find(h: np.ndarray) -> np.ndarray:
        row = slots[h >> shift]
        row[known[row] != h] = 0
        return row
    return find


def _vectors(emb: np.ndarray, ids: np.ndarray) -> np.ndarray:
    out = emb[ids[:, 0]]
    for k in range(1, ids.shape[1]):
        out = out + emb[ids[:, k]]
    return out


def _pool(vec: np.ndarray, filters: list[np.ndarray], bias: np.ndarray, doc: np.ndarray, n: int, places=False):
    """Max-pooled activations (documents x filters) and, if asked for, the winning positions.

    A window that would cross the end of a document sees zero vectors there."""
    total = len(WIDTHS) * FILTERS
    best, where = np.zeros((n, total)), np.full((n, total), -1)
    if not len(vec):
        return best, where
    starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    docs, ends = doc[starts], np.append(starts[1:], len(vec))
    for k, width in enumerate(WIDTHS):
        cols = slice(k * FILTERS, (k + 1) * FILTERS)
        act = vec @ filters[k][0] + bias[cols]
        for o in range(1, width):
            if len(vec) > o:
                act[:-o] += np.where((doc[o:] == doc[:-o])[:, None], vec[o:] @ filters[k][o], 0)
        best[docs, cols] = np.maximum(np.maximum.reduceat(act, starts), 0)
        if places:
            for d, a, b in zip(docs, starts, ends):
                where[d, cols] = a + act[a:b].argmax(0)
    return best, where


def _kept(words: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Places of the vocabulary in ``words`` (hashes in ascending order): the most frequent
    hashes in more than two texts; of those that share a slot the most frequent one stays."""
    top = np.argsort(-count, kind="stable")[:VOCABULARY]
    top = top[count[top] > 2]
    return np.sort(top[np.unique(words[top] >> np.uint64(64 - HASH_BITS), return_index=True)[1]])


def _initial(tot, pos, by_lang, rows: int, positives: int, lang_rows, seed: int):
    """(training state, language table) from the vocabulary's counts: texts with a hash, those
    of class 1, those of each language; training rows, those of class 1, those of each language."""
    v = len(tot) + 1  # row 0: every other hash
    prior = (positives + 1) / (rows + 2)
    rate = (pos + prior * 4) / (tot + 4)
    odds = np.log(rate / (1 - rate)) - np.log(prior / (1 - prior))
    table = np.zeros((v, len(lang_rows)))
    table[1:] = np.log((by_lang + 0.1) / (np.asarray(lang_rows) + 1))
    if table.size:
        table[1:] -= table[1:].mean(1, keepdims=True)
    rnd = np.random.default_rng(seed)
    emb = rnd.normal(0, 0.05, (v, SIZE))
    emb[1:, 0] = odds / 4
    emb[0] = 0
    filters = [rnd.normal(0, 0.2, (w, SIZE, FILTERS)) for w in WIDTHS]
    for f in filters:
        f[0, 0, :4] = 1.0
    total = len(WIDTHS) * FILTERS
    params = [*filters, np.full(total, -0.2), np.full(total, 0.2), np.array([np.log(prior / (1 - prior))])]
    # m, s: Adam's moments; seen: AdaGrad sums of the embedding rows
    return {"emb": emb, "params": params, "m": [np.zeros_like(p) for p in params],
            "s": [np.zeros_like(p) for p in params], "seen": np.full(v, 0.01), "step": 0}, table


def _pool_long(emb: np.ndarray, ids: np.ndarray, filters, bias):
    """``_pool`` with places of one long text, with vectors of ``SLAB`` words at a time."""
    total, over = len(WIDTHS) * FILTERS, max(WIDTHS) - 1
    best, where = np.full((1, total), -np.inf), np.full((1, total), -1)
    for a in range(0, len(ids), SLAB):
        n = min(SLAB, len(ids) - a)
        vec = _vectors(emb, ids[a:a + n + over])
        for k, width in enumerate(WIDTHS):
            cols = slice(k * FILTERS, (k + 1) * FILTERS)
            act = vec[:n] @ filters[k][0] + bias[cols]
            for o in range(1, width):
                part = vec[o:o + n]
                act[:len(part)] += part @ filters[k][o]
            top, at = act.max(0), a + act.argmax(0)
            where[0, cols] = np.where(top > best[0, cols], at, where[0, cols])
            best[0, cols] = np.maximum(best[0, cols], top)
    return np.maximum(best, 0), where


def _step(state: dict, ids: np.ndarray, local: np.ndarray, y: np.ndarray, touched: np.ndarray | None = None) -> None:
    """One gradient step on a few texts: their words' rows, text numbers, and classes.

    ``touched`` counts the words of the winning windows by embedding row."""
    emb, params, m, s, seen = (state[k] for k in ("emb", "params", "m", "s", "seen"))
    nf = len(WIDTHS)
    filters, bias, out, base = params[:nf], params[nf], params[nf + 1], params[nf + 2]
    if len(y) == 1 and len(ids) > SLAB:
        pooled, where = _pool_long(emb, ids, filters, bias)
    else:
        pooled, where = _pool(_vectors(emb, ids), filters, bias, local, len(y), places=True)
    p = 1 / (1 + np.exp(-(pooled @ out + base)))
    g = (p - y) / len(y)
    gp = np.where(pooled > 0, g[:, None] * out, 0)  # through max pooling and ReLU
    grads = [np.zeros_like(x) for x in params]
    grads[nf], grads[nf + 1], grads[nf + 2] = gp.sum(0), pooled.T @ g + 1e-4 * out, np.array([g.sum()])
    spots, deltas = [], []
    for k, width in enumerate(WIDTHS):
        for j in range(FILTERS):
            c = k * FILTERS + j
            live = np.flatnonzero((gp[:, c] != 0) & (where[:, c] >= 0))
            for o in range(width):
                spot = where[live, c] + o
                inside = spot < len(ids)
                inside[inside] &= local[spot[inside]] == live[inside]
                gd = gp[live[inside], c]
                grads[k][o, :, j] += gd @ _vectors(emb, ids[spot[inside]])
                spots.append(spot[inside])
                deltas.append(gd[:, None] * filters[k][o, :, j])
    spots, deltas = np.concatenate(spots), np.concatenate(deltas)
    rows, back = np.unique(ids[spots].ravel(), return_inverse=True)
    ge = np.zeros((len(rows), SIZE))
    np.add.at(ge, back, np.repeat(deltas, ids.shape[1], 0))
    ge = (ge + 1e-4 * emb[rows]) * (rows > 0)[:, None]
    if touched is not None:
        touched[rows] += np.bincount(back, minlength=len(rows))
    seen[rows] += (ge * ge).mean(1)
    emb[rows] -= 0.05 * ge / np.sqrt(seen[rows])[:, None]
    state["step"] += 1
    for i, grad in enumerate(grads):
        m[i] += 0.1 * (grad - m[i])
        s[i] += 0.001 * (grad * grad - s[i])
        params[i] -= 0.01 * (m[i] / (1 - 0.9 ** state["step"])) / (np.sqrt(s[i] / (1 - 0.999 ** state["step"])) + 1e-8)


def _steps(state: dict, ids: np.ndarray, bounds: np.ndarray, y: np.ndarray, order: np.ndarray, touched=None) -> None:
    """Gradient steps on texts in an order: 32 at once, or as many as have ``SLAB`` words."""
    words = bounds[order + 1] - bounds[order]
    at = 0
    while at < len(order):
        to = at + max(1, int(np.searchsorted(np.cumsum(words[at:at + 32]), SLAB, "right")))
        some = order[at:to]
        _step(state, np.concatenate([ids[bounds[d]:bounds[d + 1]] for d in some]),
              np.repeat(np.arange(len(some)), bounds[some + 1] - bounds[some]), y[some], touched)
        at = to


def _model(state: dict, words: np.ndarray, by_lang: np.ndarray, names: list[str]) -> dict[str, np.ndarray]:
    nf, params = len(WIDTHS), state["params"]
    model = {"words": words, "by_lang": by_lang.astype(np.float32), "emb": state["emb"].astype(np.float32),
             "bias": params[nf].astype(np.float32), "out": params[nf + 1], "base": params[nf + 2],
             "langs": np.array(names, dtype=np.str_), "shift": np.zeros(len(names) or 1)}
    for k in range(nf):
        model[f"filter{k}"] = params[k].astype(np.float32)
    return model


def fit(texts: list[bytes], toxic: list[int], langs: list[str], calibrate: list[bool], epochs: int = EPOCHS[1],
        seed: int = 11) -> dict[str, np.ndarray]:
    """Model from labelled texts at hand (``train``: from a table); ``calibrate`` marks those that only set
    thresholds."""
    y, cal = np.array(toxic, np.float64), np.array(calibrate, bool)
    learn = np.flatnonzero(~cal)
    # vocabulary: hashes in the most training documents
    of_doc, kinds = _presence(texts, cal)
    words, number, count = np.unique(kinds, return_inverse=True, return_counts=True)
    del kinds
    top = _kept(words, count)
    slot = np.full(len(words), -1, np.int32)
    slot[top] = np.arange(len(top))
    words = words[top]
    col = slot[number]
    of_doc, col = of_doc[col >= 0], col[col >= 0]
    names = sorted(set(langs))
    lang = np.array([names.index(x) for x in langs], np.int64)
    mine = [np.bincount(col[lang[of_doc] == j], minlength=len(words)) for j in range(len(names))]
    state, by_lang = _initial(np.bincount(col, minlength=len(words)), np.bincount(col, y[of_doc], len(words)),
                              np.stack(mine, 1) if names else np.zeros((len(words), 0)), len(learn), y[learn].sum(),
                              np.bincount(lang[learn], minlength=len(names)), seed)
    find, found, doc = slot_table(words), [np.empty((0, 1 + len(STEMS)), np.int32)], [np.empty(0, np.int64)]
    for at, h, d in _blocks(texts):
        found.append(find(h))
        doc.append(d + at)
    ids_all, doc = np.concatenate(found), np.concatenate(doc)
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    rnd = np.random.default_rng(seed)
    for _ in range(epochs if len(learn) and 0 < y[learn].sum() < len(learn) else 0):
        _steps(state, ids_all, bounds, y, rnd.permutation(learn))
    model = _model(state, words, by_lang, names)
    if cal.any():
        mine = cal[doc]
        logit, guess = _logits(model, ids_all[mine], doc[mine], len(texts))
        _calibrate(model, guess[cal], logit[cal], logit[cal], logit[cal], np.ones(cal.sum()), y[cal])
    return model


def _cut(spot: np.ndarray, low: np.ndarray, high: np.ndarray, n: np.ndarray, pos: np.ndarray) -> float:
    """Threshold with the best F1 of class 1, midway between neighbouring bins of logits
    (number, least and greatest logit, rows, rows of class 1; a number may come several times)."""
    kinds, back = np.unique(-spot, return_inverse=True)  # from the greatest logits down
    least, most = np.full(len(kinds), np.inf), np.full(len(kinds), -np.inf)
    np.minimum.at(least, back, low)
    np.maximum.at(most, back, high)
    t, w = np.bincount(back, pos), np.bincount(back, n)
    best = int(np.argmax(2 * np.cumsum(t) / (np.cumsum(w) + t.sum())))
    return float((least[best] + most[best + 1]) / 2 if best + 1 < len(kinds) else least[best] - 1)


def _calibrate(model, lang, *bins) -> None:
    """Thresholds from bins of calibration rows: guessed language, then as in ``_cut``."""
    n, pos = bins[-2:]
    if not 0 < pos.sum() < n.sum():
        return
    # a language's own threshold is drawn towards the common one where its positives are few
    common = _cut(*bins)
    model["shift"][:] = common
    for j in range(len(model["langs"])):
        mine = lang == j
        if n[mine].sum() >= OWN_THRESHOLD and 5 <= pos[mine].sum() < n[mine].sum():
            trust = pos[mine].sum() / (pos[mine].sum() + OWN_THRESHOLD)
            model["shift"][j] += trust * (_cut(*(x[mine] for x in bins)) - common)


def _logits(model, ids, doc, n):
    filters = [model[f"filter{k}"] for k in range(len(WIDTHS))]
    pooled, _ = _pool(_vectors(model["emb"], ids), filters, model["bias"], doc, n)
    lang = np.zeros(n, np.int64)
    if len(model["langs"]):
        known = np.flatnonzero(ids[:, 0])
        votes = model["by_lang"][ids[known, 0]]
        lang = np.stack([np.bincount(doc[known], votes[:, j], n) for j in range(len(model["langs"]))], 1).argmax(1)
    return pooled @ model["out"] + model["base"], lang


class Scorer:
    """A fitted model ready to score chunks."""

    def __init__(self, model: dict[str, np.ndarray]):
        self.model = model
        self.rows = slot_table(model["words"])

    def logits(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logit and guessed language of every text."""
        h, doc = word_hashes(data, offs)
        return _logits(self.model, self.rows(h), doc, len(offs) - 1)

    def scores(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        logit, lang = self.logits(data, offs)
        return 1 / (1 + np.exp(-np.clip(logit - self.model["shift"][lang], -50, 50)))

    def score_long(self, data: np.ndarray, size: int) -> float:
        """Score of one text read in pieces, as ``scores`` gives it."""
        logit, lang = self.logit_long(data, size)
        return float(1 / (1 + np.exp(-np.clip(logit - self.model["shift"][lang], -50, 50))))

    def logit_long(self, data: np.ndarray, size: int) -> tuple[float, int]:
        """Logit and guessed language of one text read in pieces, as ``logits`` gives them.

        The last words of a piece are looked at again before the next one, where the
        windows that begin at them are complete."""
        m, held = self.model, None
        filters = [m[f"filter{k}"] for k in range(len(WIDTHS))]
        best = np.zeros(len(WIDTHS) * FILTERS)
        votes = np.zeros(len(m["langs"]))
        over = max(WIDTHS) - 1
        bounds = list(pieces(data, size, ALNUM | byte_set("A-Z")))
        for at, to in bounds:
            h, _ = word_hashes(data[at:to], np.array([0, to - at]))
            new = self.rows(h)
            if len(votes) and len(new):
                known = np.flatnonzero(new[:, 0])
                votes += m["by_lang"][new[known, 0]].sum(0)
            ids = new if held is None else np.concatenate([held, new])
            begins = len(ids) if to == len(data) else max(0, len(ids) - over)
            if begins:
                vec = _vectors(m["emb"], ids)
                for k, width in enumerate(WIDTHS):
                    cols = slice(k * FILTERS, (k + 1) * FILTERS)
                    act = vec[:begins] @ filters[k][0] + m["bias"][cols]
                    for o in range(1, width):
                        part = vec[o:o + begins]
                        act[:len(part)] += part @ filters[k][o]
                    best[cols] = np.maximum(best[cols], act.max(0))
            held = ids[begins:]
        return float(np.asarray(best @ m["out"] + m["base"]).ravel()[0]), int(votes.argmax()) if len(votes) else 0


def _rows_of(ch, find) -> tuple[np.ndarray, np.ndarray]:
    """(embedding rows of the words, text bounds) of a chunk; one long text is hashed in pieces."""
    if len(ch) == 1 and len(ch.data) > CHUNK:
        parts = [find(word_hashes(ch.data[a:b], np.array([0, b - a]))[0])
                 for a, b in pieces(ch.data, CHUNK, ALNUM | byte_set("A-Z"))]
        ids = np.concatenate(parts)
        return ids, np.array([0, len(ids)])
    h, doc = word_hashes(ch.data, ch.offs)
    return find(h), np.searchsorted(doc, np.arange(len(ch) + 1))


def _kinds_of(ch) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the different hashes of each text of a chunk."""
    if len(ch) == 1 and len(ch.data) > CHUNK:
        kinds = np.empty(0, np.uint64)
        for a, b in pieces(ch.data, CHUNK, ALNUM | byte_set("A-Z")):
            kinds = np.union1d(kinds, word_hashes(ch.data[a:b], np.array([0, b - a]))[0])
        return np.zeros(len(kinds), np.int64), kinds
    h, doc = word_hashes(ch.data, ch.offs)
    flat, doc = h.ravel(), np.repeat(doc, h.shape[1])
    order = np.lexsort((flat, doc))
    flat, doc = flat[order], doc[order]
    new = np.ones(len(flat), bool)
    new[1:] = (flat[1:] != flat[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], flat[new]


def _vocabulary(learn: DataFrame, most: int = 1 << 21) -> np.ndarray:
    """Hashes with an embedding, ascending, from the counts of all training rows.

    A task adds up its texts' counts and sends them on when it holds ``most`` hashes."""
    def count(batches):
        words, n = np.empty(0, np.uint64), np.empty(0, np.int64)
        held, size = [], 0

        def merged():
            nonlocal words, n
            w, back = np.unique(np.concatenate([words, *held]), return_inverse=True)
            n = np.bincount(back, np.concatenate([n, np.ones(size, np.int64)]), len(w)).astype(np.int64)
            words = w

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["h", "n"])

        for ch in chunks(batches, "text", CHUNK):
            held.append(_kinds_of(ch)[1])
            size += len(held[-1])
            if size > most:
                merged()
                held, size = [], 0
                if len(words) > most:
                    yield rows()
                    words, n = words[:0], n[:0]
        merged()
        yield rows()

    total = learn.select("text").mapInArrow(count, "h BIGINT, n BIGINT").groupBy("h").agg(F.sum("n").alias("n"))
    top = total.where("n > 2").orderBy(F.col("n").desc(), "h").limit(VOCABULARY).collect()
    words = np.array([r["h"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(words)
    words, n = words[order], np.array([r["n"] for r in top], np.int64)[order]
    return words[_kept(words, n)]


def _evidence(learn: DataFrame, words: np.ndarray, names: list[str]):
    """Texts of each language, and texts of class 1, with a hash of the vocabulary."""
    sent = learn.sparkSession.sparkContext.broadcast((words, names))

    def count(batches):
        known, langs = sent.value
        find, number = slot_table(known), {x: i for i, x in enumerate(langs)}
        tot = {}
        for ch in chunks(batches, "text", CHUNK):
            doc, h = _kinds_of(ch)
            row = find(h)
            doc, row = doc[row > 0], row[row > 0] - 1
            lang = np.array([number[x] for x in ch.column("lang").to_pylist()])[doc]
            y = np.asarray(ch.column("toxic"))[doc]
            for j in np.unique(lang):
                n = tot.setdefault(int(j), np.zeros((2, len(known)), np.int64))
                n[0] += np.bincount(row[lang == j], minlength=len(known))
                n[1] += np.bincount(row[(lang == j) & (y == 1)], minlength=len(known))
        for j, n in tot.items():
            there = np.flatnonzero(n[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(there), j, np.int32)), pa.array(there.astype(np.int32)), pa.array(n[0, there]),
                 pa.array(n[1, there])], ["lang", "row", "n", "pos"])

    got = learn.select("text", "lang", "toxic").mapInArrow(count, "lang INT, row INT, n BIGINT, pos BIGINT") \
        .groupBy("lang", "row").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).collect()
    by_lang, pos = np.zeros((len(words), len(names))), np.zeros(len(words))
    for r in got:
        by_lang[r["row"], r["lang"]] = r["n"]
        pos[r["row"]] += r["pos"]
    return by_lang, pos


def _flat(state: dict, touched: np.ndarray, before: dict, rows: int) -> np.ndarray:
    """A task's share of an average as one vector: changes, weighted, and their weights."""
    small = [x.ravel() for k in ("params", "m", "s") for x in state[k]]
    old = [x.ravel() for k in ("params", "m", "s") for x in before[k]]
    return np.concatenate([
        ((state["emb"] - before["emb"]) * touched[:, None]).ravel(), (state["seen"] - before["seen"]) * touched, touched,
        (np.concatenate(small) - np.concatenate(old)) * rows, [rows, (state["step"] - before["step"]) * rows]])


def _averaged(state: dict, total: np.ndarray) -> dict:
    """The state after the tasks' changes (sum of their ``_flat``) are averaged."""
    v = len(state["seen"])
    emb, seen, touched, rest = np.split(total, np.cumsum([v * SIZE, v, v]))
    rows, steps = rest[-2:]
    weight = np.maximum(touched, 1)
    out = {"emb": state["emb"] + emb.reshape(v, SIZE) / weight[:, None], "seen": state["seen"] + seen / weight,
           "step": state["step"] + int(round(steps / max(rows, 1)))}
    at = 0
    for k in ("params", "m", "s"):
        out[k] = []
        for x in state[k]:
            out[k].append(x + rest[at:at + x.size].reshape(x.shape) / max(rows, 1))
            at += x.size
    return out


def _epoch(learn: DataFrame, words: np.ndarray, state: dict, seed: tuple) -> dict:
    """One pass over all training rows: each task steps through its own, then all are averaged.

    The parts of the vectors are summed on the executors, in the order of the tasks."""
    spark = learn.sparkSession
    sent = spark.sparkContext.broadcast((words, state))

    def steps(batches):
        from copy import deepcopy

        from pyspark import TaskContext
        known, before = sent.value
        task = TaskContext.get().partitionId()
        find, mine, rows = slot_table(known), deepcopy(before), 0
        rnd, touched = np.random.default_rng([*seed, task]), np.zeros(len(before["seen"]))
        for ch in chunks(batches, "text", CHUNK):
            ids, bounds = _rows_of(ch, find)
            _steps(mine, ids, bounds, np.asarray(ch.column("toxic")).astype(np.float64), rnd.permutation(len(ch)), touched)
            rows += len(ch)
        if rows:
            parts = np.array_split(_flat(mine, touched, before, rows).astype(np.float32), BLOCKS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(BLOCKS, dtype=np.int32)), pa.array(np.full(BLOCKS, task, np.int32)),
                 pa.array([x.tobytes() for x in parts], pa.binary())], ["block", "task", "part"])

    def add(batches):
        sums = {}
        for b in batches:
            for block, part in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                x = np.frombuffer(part, np.float32).astype(np.float64)
                sums[block] = sums[block] + x if block in sums else x
        for block, x in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([x.tobytes()], pa.binary())],
                                             ["block", "part"])

    done = learn.select("text", "toxic").mapInArrow(steps, "block INT, task INT, part BINARY")
    got = done.repartition(BLOCKS, "block").sortWithinPartitions("block", "task") \
        .mapInArrow(add, "block INT, part BINARY").collect()
    total = np.concatenate([np.frombuffer(r["part"], np.float64) for r in sorted(got, key=lambda r: r["block"])])
    return _averaged(state, total)


def _calibrated(rows: DataFrame, model: dict) -> None:
    """Set the thresholds of ``model`` from the logits of all calibration rows, in bins."""
    sent = rows.sparkSession.sparkContext.broadcast(pack_model(model))

    def logits(batches):
        scorer = Scorer(unpack_model(sent.value))
        for ch in chunks(batches, "text", CHUNK):
            if len(ch) == 1 and len(ch.data) > CHUNK:
                x, j = scorer.logit_long(ch.data, CHUNK)
                x, j = np.array([x]), np.array([j])
            else:
                x, j = scorer.logits(ch.data, ch.offs)
            yield pa.RecordBatch.from_arrays([pa.array(j.astype(np.int32)), pa.array(x.astype(np.float64)),
                                              ch.column("toxic")], ["lang", "x", "toxic"])

    bins = rows.select("text", "toxic").mapInArrow(logits, "lang INT, x DOUBLE, toxic INT") \
        .groupBy("lang", F.floor(F.least(F.greatest("x", F.lit(-50.0)), F.lit(50.0)) / BIN).alias("bin")) \
        .agg(F.min("x"), F.max("x"), F.count(F.lit(1)), F.sum("toxic")).collect()
    if bins:
        _calibrate(model, *(np.array(x, np.float64) for x in zip(*bins)))


def train(docs: DataFrame, marks: DataFrame, seed: int = 11) -> dict:
    """Model from all labelled rows: docs (doc_id, text, lang, calibrate), marks (__id, toxic).

    The rows are stored once, dealt by id; every pass reads them from there."""
    marks = marks.where("toxic IN (0, 1) AND __id IS NOT NULL")
    tasks = max(1, -(-marks.count() // LEARNER_ROWS))
    docs = docs.where("text IS NOT NULL").select("doc_id", "text", F.coalesce(F.col("lang").cast("string"), F.lit(""))
                                                 .alias("lang"), "calibrate")
    rows = docs.repartition(tasks, "doc_id").join(marks.repartition(tasks, "__id"), F.col("doc_id") == F.col("__id"))
    rows = materialize(rows.sortWithinPartitions(F.xxhash64("doc_id"), "text", "toxic", "lang")
                       .select("text", "lang", "toxic", "calibrate"), "toxicity-rows")
    found = rows.groupBy("calibrate", "lang", "toxic").count().collect()
    if not found:
        return {}
    names = sorted({r["lang"] for r in found})
    learn = rows.where("NOT calibrate")
    n, pos = (sum(r["count"] for r in found if not r["calibrate"] and r["toxic"] >= least) for least in (0, 1))
    words = _vocabulary(learn)
    by_lang, with_pos = _evidence(learn, words, names)
    lang_rows = [sum(r["count"] for r in found if not r["calibrate"] and r["lang"] == x) for x in names]
    state, table = _initial(by_lang.sum(1), with_pos, by_lang, n, pos, lang_rows, seed)
    if 0 < pos < n:
        for e in range(min(EPOCHS[1], max(EPOCHS[0], -(-VISITS // n)))):
            state = _epoch(learn, words, state, (seed, e))
    model = _model(state, words, table, names)
    _calibrated(rows.where("calibrate"), model)
    return model


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang", label_col: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, read whole.

    Labels of held-out ids (crc32 of the id mod 5 is 0) are not looked at; of the
    others, remainder 1 calibrates thresholds and the rest trains.  ``lang`` only
    names the languages of training rows; no score depends on lang, source or id.
    A null or empty text has no words and scores what no word says.  Documents
    without label, repeated rows and null ids return a row each; a repeated label
    counts as often as it stands there.  Without any usable label every score is
    0.  An empty table gives an empty result."""
    spark = docs.sparkSession
    ship(spark)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      F.col(lang_col).alias("lang")).withColumn("held_out", held_out_column())
    marks = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("toxic")) \
        .where(~held_out_column("__id"))
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = train(src.where("NOT held_out").withColumn("calibrate", F.coalesce(fold == 1, F.lit(False))), marks)
    sent = spark.sparkContext.broadcast(pack_model(model) if model else b"")
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        scorer = Scorer(unpack_model(sent.value)) if sent.value else None
        for ch in chunks(batches, "text", CHUNK):
            if scorer and len(ch) == 1 and len(ch.data) > CHUNK:
                score = np.array([scorer.score_long(ch.data, CHUNK)])
            else:
                score = scorer.scores(ch.data, ch.offs) if scorer else np.zeros(len(ch))
            yield pa.RecordBatch.from_arrays(
                [ch.column("doc_id"), ch.column("held_out"), pa.array(score),
                 pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return src.drop("lang").mapInArrow(run, f"doc_id {id_type}, held_out BOOLEAN, score DOUBLE, predicted INT")
