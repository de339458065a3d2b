"""Language identification with a linear-chain conditional random field.

Every word of a text is labelled with a language; neighbouring labels are tied
by learned transitions, so a foreign name inside a sentence does not flip it
and a code-switched text is split where it switches.  Features of a word are
its hash (lexicon), its affixes of one to three bytes and its byte trigrams,
all hashed into one weight table.  Posteriors come from forward-backward.

The model is fitted by AdaGrad on the driver, on a bounded sample: at most
``SAMPLE_PER_LANG`` documents of every language.  Above ``FULL_LANGS`` languages
there are fewer documents of each (``LEAST_PER_LANG`` at least), a smaller feature
table and smaller chunks of text, but no language is left out.  The training sequences are spliced from spans of these documents, so transitions
between languages are seen.  Scoring reads every whole text, vectorised over a
chunk: the chain is cut into lanes whose transition products are combined, which
equals the sequential recursion.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import (batch, byte_set, chunks, held_out_column, lower_ascii, mix, pack_model, pieces,
                     prefix_hash, ship,
                     span_hash, unpack_model, word_bounds)

#: documents per language that the model is fitted on, and the least number with very many languages
SAMPLE_PER_LANG, LEAST_PER_LANG = 300, 20
#: languages up to which sample, table and chunks have their full size
FULL_LANGS = 64
#: bits of the feature table, words in a lane
TABLE_BITS, LANE = 18, 64
#: bytes of text handled at once
CHUNK = 1 << 19

_LETTERS = byte_set("A-Za-z\x80-\xff")
_LETTER = regex.compile(r"\p{L}")


# ------------------------------------------------------------------ features

def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bits: int = TABLE_BITS):
    """(words x 7 table rows, table row of the trigram at every byte).

    Columns: the word, its prefixes and suffixes of 1, 2, 3 bytes."""
    prefix = prefix_hash(data)
    shift = np.uint64(64 - bits)
    cols = [span_hash(prefix, starts, ends)]
    for k in (1, 2, 3):
        cols.append(span_hash(prefix, starts, np.minimum(starts + k, ends)) + np.uint64(2 * k))
        cols.append(span_hash(prefix, np.maximum(ends - k, starts), ends) + np.uint64(2 * k + 1))
    fixed = np.stack([(mix(c) >> shift).astype(np.int32) for c in cols], 1)
    d = data.astype(np.uint64)
    tri = np.zeros(len(data), np.uint64)
    if len(data) > 2:
        tri[:-2] = d[:-2] << np.uint64(16) | d[1:-1] << np.uint64(8) | d[2:] | np.uint64(1 << 40)
    return fixed, (mix(tri) >> shift).astype(np.int32)


def table_bits(k: int) -> int:
    """Bits of the feature table for k languages: it grows no more above ``FULL_LANGS``."""
    return TABLE_BITS - max(0, -(-k // FULL_LANGS) - 1).bit_length()


def emissions(weights: np.ndarray, fixed: np.ndarray, tri: np.ndarray, starts, ends) -> np.ndarray:
    """Scores (words x languages): fixed features, plus the mean over the word's trigrams."""
    out = weights[fixed[:, 0]]
    for k in range(1, fixed.shape[1]):
        out = out + weights[fixed[:, k]]
    sums = np.zeros((len(tri) + 1, weights.shape[1]))
    np.cumsum(weights[tri], 0, out=sums[1:])
    n = np.maximum(ends - starts - 2, 0)
    return out + (sums[starts + n] - sums[starts]) / np.maximum(n, 1)[:, None]


# ---------------------------------------------------------- forward-backward

def forward_backward(scores: np.ndarray, first: np.ndarray, trans: np.ndarray, start: np.ndarray,
                     before: np.ndarray | None = None, after: np.ndarray | None = None):
    """Forward and backward messages (each normalised) of label chains laid end to end.

    ``first`` marks the first word of each chain; ``trans`` and ``start`` are log
    potentials.  Chains are cut into lanes of ``LANE`` words: the products of each
    lane's transition matrices give the messages at the lane bounds, and all lanes
    are then run side by side.  ``before`` is the forward message of the word before the
    first one, ``after`` the backward message that reaches the last one, where the chain
    is a piece of a longer one."""
    n, k = scores.shape
    lanes = -(-n // LANE)
    e = np.ones((lanes * LANE, k))
    e[:n] = np.exp(scores - scores.max(1, keepdims=True))
    if after is not None:
        e[n - 1] *= after
    f = np.ones(lanes * LANE, bool)
    f[:n] = first
    e, f = e.reshape(lanes, LANE, k), f.reshape(lanes, LANE)
    a, pi = np.exp(trans - trans.max()), np.exp(start - start.max())
    # lane products
    prod = np.broadcast_to(np.eye(k), (lanes, k, k)).copy()
    for s in range(LANE):
        step = np.where(f[:, s, None, None], prod.sum(2, keepdims=True) * pi, prod @ a) * e[:, s, None, :]
        prod = step / step.sum((1, 2), keepdims=True)
    ahead, behind = np.ones((lanes, k)), np.ones((lanes, k))
    if before is not None:
        ahead[0] = before
    for i in range(1, lanes):
        v = ahead[i - 1] @ prod[i - 1]
        ahead[i] = v / v.sum()
        j = lanes - 1 - i
        v = prod[j + 1] @ behind[j + 1]
        behind[j] = v / v.sum()
    alpha, beta = np.empty_like(e), np.empty_like(e)
    v = ahead
    for s in range(LANE):
        v = np.where(f[:, s, None], pi, v @ a) * e[:, s]
        v = v / v.sum(1, keepdims=True)
        alpha[:, s] = v
    v = behind
    for s in range(LANE - 1, -1, -1):
        beta[:, s] = v
        w = e[:, s] * v
        v = np.where(f[:, s, None], (w @ pi)[:, None], w @ a.T)
        v = v / v.sum(1, keepdims=True)
    return alpha.reshape(-1, k)[:n], beta.reshape(-1, k)[:n], e.reshape(-1, k)[:n]


def posteriors(scores, first, trans, start) -> np.ndarray:
    alpha, beta, _ = forward_backward(scores, first, trans, start)
    p = alpha * beta
    return p / p.sum(1, keepdims=True)


# ------------------------------------------------------------------- fitting

def bounded_sample(rows: DataFrame, label: str, key: str, per_label: int | dict,
                   full: int, least: int = 1) -> tuple[DataFrame, dict]:
    """(rows, share of each label that was taken): about ``per_label`` rows at most of each
    label, picked by a hash of column ``key``.  With more than ``full`` labels a number is
    lowered in proportion, to ``least`` at least."""
    found = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    if len(found) > full and not isinstance(per_label, dict):
        per_label = min(per_label, max(least, per_label * full // len(found)))
    most = {r[label]: per_label[r[label]] if isinstance(per_label, dict) else per_label for r in found}
    share = {r[label]: min(1.0, most[r[label]] / r["n"]) for r in found}
    if not share:
        return rows.limit(0), {}
    low = F.create_map(*(F.lit(v) for kv in share.items() for v in kv))
    spot = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    # keys that repeat fall into or out of the sample together, so its size is bounded once more
    return rows.where(spot < low[F.col(label)]).limit(2 * sum(most.values())), share


def sampled_texts(docs: DataFrame, marks: DataFrame, label: str, per_label: int | dict) -> tuple[list, dict]:
    """Bounded labelled sample of ``docs``: (rows of docs with ``label``, share of each label).

    ``marks`` (__id, label) is sampled by itself; the ids, no more than twice the
    bound, are broadcast to the scan of ``docs``, whose texts are never shuffled."""
    picked, share = bounded_sample(marks, label, "__id", per_label, 2)
    bound = 4 * (sum(per_label.values()) if isinstance(per_label, dict) else 2 * per_label)
    rows = docs.join(F.broadcast(picked), F.col("doc_id") == F.col("__id")).drop("__id", "doc_id")
    return rows.limit(bound).collect(), share


def _sequences(texts: list[tuple[bytes, int]], rnd: np.random.Generator):
    """Training sequences: (words' bytes, labels); spans of documents spliced at random."""
    spans = []
    for text, lang in texts:
        data = np.frombuffer(text, np.uint8)
        s, e, _ = word_bounds(data, np.array([0, len(data)]), _LETTERS)
        at = 0
        while at < len(s):
            to = min(len(s), at + int(rnd.integers(8, 120)))
            spans.append((data[s[at]:e[to - 1]], lang))
            at = to
    order = rnd.permutation(len(spans))
    for i in range(0, len(order), 40):
        yield [spans[j] for j in order[i:i + 40]]


def fit(texts: list[tuple[bytes, str]], epochs: int = 4, seed: int = 7) -> dict[str, np.ndarray]:
    """CRF weights from labelled texts: table, transitions, start scores, languages."""
    langs = sorted({lang for _, lang in texts})
    k = len(langs)
    number = {lang: i for i, lang in enumerate(langs)}
    rnd = np.random.default_rng(seed)
    bits = table_bits(k)
    size = 1 << bits
    w, gw = np.zeros((size, k), np.float32), np.full((size, k), 1e-2, np.float32)
    t, gt = np.eye(k) * 2.0, np.full((k, k), 1.0)
    start = np.zeros(k)
    rows = [(lower_ascii(np.frombuffer(x, np.uint8)).tobytes(), number[lang]) for x, lang in texts]
    for _ in range(epochs if k else 0):
        for spans in _sequences(rows, rnd):
            data = np.concatenate([np.append(s, np.uint8(32)) for s, _ in spans])
            ends_at = np.cumsum([len(s) + 1 for s, _ in spans])
            s, e, _ = word_bounds(data, np.array([0, len(data)]), _LETTERS)
            if not len(s):
                continue
            y = np.array([lang for _, lang in spans])[np.searchsorted(ends_at, s, "right")]
            fixed, tri = word_features(data, s, e, bits)
            first = np.zeros(len(s), bool)
            first[0] = True
            scores = emissions(w, fixed, tri, s, e)
            alpha, beta, pot = forward_backward(scores, first, t, start)
            post = alpha * beta
            post /= post.sum(1, keepdims=True)
            gold = np.zeros_like(post)
            gold[np.arange(len(y)), y] = 1
            g = ((gold - post) / 8).astype(np.float32)
            # table gradient: fixed features, then trigrams with their share of the mean
            n = np.maximum(e - s - 2, 0)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(s, n)
            rows_ = np.concatenate([fixed.ravel(), tri[at]])
            word = np.concatenate([np.repeat(np.arange(len(s)), fixed.shape[1]), np.repeat(np.arange(len(s)), n)])
            share = np.concatenate([np.ones(fixed.size), np.repeat(1 / np.maximum(n, 1), n)]).astype(np.float32)
            touched, where = np.unique(rows_, return_inverse=True)
            grad = np.stack([np.bincount(where, g[word, j] * share, len(touched)) for j in range(k)], 1)
            gw[touched] += (grad * grad).astype(np.float32)
            w[touched] += (0.3 * grad / np.sqrt(gw[touched])).astype(np.float32)
            # transitions
            a, ahead = np.exp(t - t.max()), pot[1:] * beta[1:]
            mass = ((alpha[:-1] @ a) * ahead).sum(1, keepdims=True)
            pair = a * ((alpha[:-1] / mass).T @ ahead)  # summed over the words: no words x k x k table
            seen = np.zeros((k, k))
            np.add.at(seen, (y[:-1], y[1:]), 1)
            grad = (seen - pair) / 8
            gt += grad * grad
            t += 0.3 * grad / np.sqrt(gt)
    return {"weights": w, "trans": t, "start": start, "langs": np.array(langs, dtype=np.str_)}


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", per_lang: int = SAMPLE_PER_LANG) -> dict:
    """Model from a bounded sample of the labelled rows of ``docs``."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    got, _ = bounded_sample(rows.where("text IS NOT NULL AND lang IS NOT NULL"), "lang", "text", per_lang, FULL_LANGS,
                            LEAST_PER_LANG)
    texts = sorted((r["text"].encode(), r["lang"]) for r in got.collect())
    return fit(texts) if texts else {}


# ------------------------------------------------------------------- scoring

def _has_letter(text: bytes) -> bool:
    return bool(_LETTER.search(text.decode("utf-8", "replace")))


def score_chunk(model: dict, data: np.ndarray, offs: np.ndarray):
    """(share of each language among the words' posteriors, mean of the words' largest
    posteriors, words) per document."""
    low = lower_ascii(data)
    s, e, doc = word_bounds(low, offs, _LETTERS)
    n = len(offs) - 1
    words = np.bincount(doc, minlength=n)
    k = len(model["langs"])
    if not len(s):
        return np.zeros((n, k)), np.zeros(n), words
    fixed, tri = word_features(low, s, e, table_bits(len(model["langs"])))
    first = np.ones(len(s), bool)
    first[1:] = doc[1:] != doc[:-1]
    post = posteriors(emissions(model["weights"], fixed, tri, s, e), first, model["trans"], model["start"])
    share = np.stack([np.bincount(doc, post[:, j], n) for j in range(k)], 1)
    sure = np.bincount(doc, post.max(1), n)
    return share / np.maximum(words, 1)[:, None], sure / np.maximum(words, 1), words


def score_long(model: dict, data: np.ndarray, size: int = CHUNK) -> tuple[np.ndarray, float, int, bool]:
    """(share of each language, mean of the largest posteriors, words, has a letter) of one
    text, as ``score_chunk`` gives them, with memory for one piece of it at a time.

    The forward messages at the piece bounds come from a first pass; a second one goes
    from the last piece to the first and carries the backward message."""
    trans, start, bits = model["trans"], model["start"], table_bits(len(model["langs"]))
    k = len(model["langs"])
    bounds = list(pieces(data, size, _LETTERS))
    letter = False

    def scores(lo, hi):
        low = lower_ascii(data[lo:hi])
        s, e, _ = word_bounds(low, np.array([0, hi - lo]), _LETTERS)
        return emissions(model["weights"], *word_features(low, s, e, bits), s, e) if len(s) else np.empty((0, k))

    heads, message = [], None
    for lo, hi in bounds:
        heads.append(message)
        part = data[lo:hi]
        letter = letter or bool((_LETTERS[part] & (part < 128)).any()) or _has_letter(part.tobytes())
        x = scores(lo, hi)
        if len(x):
            first = np.zeros(len(x), bool)
            first[0] = message is None
            message = forward_backward(x, first, trans, start, message)[0][-1]
    share, sure, words, after = np.zeros(k), 0.0, 0, None
    a = np.exp(trans - trans.max())
    for (lo, hi), before in zip(reversed(bounds), reversed(heads)):
        x = scores(lo, hi)
        if not len(x):
            continue
        first = np.zeros(len(x), bool)
        first[0] = before is None
        alpha, beta, e = forward_backward(x, first, trans, start, before, after)
        post = alpha * beta
        post /= post.sum(1, keepdims=True)
        share += post.sum(0)
        sure += float(post.max(1).sum())
        words += len(x)
        after = (e[0] * beta[0]) @ a.T
        after /= after.sum()
    return share / max(words, 1), sure / max(words, 1), words, letter


def identify(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` (a learned language, or ``und``), ``lang_score``
    (share of the words' posterior mass, 0 to 1) and ``lang_sure`` (how sure the words'
    own labels are: mean of the largest posterior of a word, 0 to 1).

    ``und`` with scores 0: null text, a text without a letter, and every text if no
    language was learned (an empty table).  Columns of ``docs`` are carried along
    untouched; one that is named like a result is replaced."""
    spark = docs.sparkSession
    ship(spark)
    keep = [c for c in docs.columns if c not in ("lang_pred", "lang_score", "lang_sure")]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(keep).schema.fields)
    sent = spark.sparkContext.broadcast(pack_model(model) if model else b"")

    def run(batches):
        fitted = unpack_model(sent.value) if sent.value else None
        langs = fitted["langs"].tolist() if fitted else []
        size = max(1, int(CHUNK * min(1, FULL_LANGS / max(1, len(langs))) ** 2))  # lane products: words x k x k
        for ch in chunks(batches, text_col, size):
            n = len(ch)
            pred, score, surest = np.full(n, "und", object), np.zeros(n), np.zeros(n)
            if fitted and n == 1 and len(ch.data) > size:
                share, sure, words, letter = score_long(fitted, ch.data, size)
                if letter and words:
                    best = int(share.argmax())
                    pred[0], score[0], surest[0] = langs[best], min(1.0, share[best]), min(1.0, sure)
            elif fitted:
                share, sure, words = score_chunk(fitted, ch.data, ch.offs)
                plain = np.concatenate([[0], np.cumsum(_LETTERS[ch.data] & (ch.data < 128))])
                letters = plain[ch.offs[1:]] > plain[ch.offs[:-1]]
                for i in np.flatnonzero(~letters & (words > 0)):
                    letters[i] = _has_letter(ch.text(i))
                best = share.argmax(1)
                for i in np.flatnonzero(letters & (words > 0)):
                    pred[i], score[i], surest[i] = langs[best[i]], min(1.0, share[i, best[i]]), min(1.0, sure[i])
            yield pa.RecordBatch.from_arrays(
                [*ch.rows.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                 pa.array(surest, pa.float64())],
                schema=pa.schema([*ch.rows.schema, pa.field("lang_pred", pa.string()),
                                  pa.field("lang_score", pa.float64()), pa.field("lang_sure", pa.float64())]))

    return docs.select(keep).mapInArrow(run, fields + ", lang_pred STRING, lang_score DOUBLE, lang_sure DOUBLE")


def label_words(model: dict, text: str) -> list[tuple[str, str, float]]:
    """(word, language, posterior) for each word of a text: where it switches."""
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    low = lower_ascii(data)
    s, e, _ = word_bounds(low, np.array([0, len(low)]), _LETTERS)
    if not len(s):
        return []
    fixed, tri = word_features(low, s, e, table_bits(len(model["langs"])))
    first = np.arange(len(s)) == 0
    post = posteriors(emissions(model["weights"], fixed, tri, s, e), first, model["trans"], model["start"])
    best = post.argmax(1)
    return [(raw[a:b].decode("utf-8", "replace"), str(model["langs"][j]), float(p[j]))
            for a, b, j, p in zip(s, e, best, post)]


def language_of_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score), learned from the rows that are not held out."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                        F.col(lang_col).alias("lang")).withColumn("held_out", held_out_column())
    model = train(named.where("NOT held_out"))
    return identify(named.drop("lang"), model).select("doc_id", "held_out", "lang_pred",
                                                      F.col("lang_score").alias("score"))


def keep_identified(docs: DataFrame, least: float = 0.4, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang") -> DataFrame:
    """``docs`` without the documents whose language is undetermined (``und``) or whose
    words are labelled with a largest posterior of less than ``least`` on average.  A
    text that is split between languages stays if its words are labelled surely.

    If the table has no labelled row to learn from, nothing is rejected but texts
    without a letter."""
    model = train(docs.withColumn("__held", held_out_column(id_col)).where("NOT __held").drop("__held"),
                  text_col, lang_col)
    if not model:
        return docs.where(F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    names = docs.columns
    src = docs.select(*(F.col(c).alias(f"__k{i}") for i, c in enumerate(names)))
    out = identify(src, model, f"__k{names.index(text_col)}").where(
        (F.col("lang_pred") != "und") & (F.col("lang_sure") >= least))
    return out.select(*(F.col(f"__k{i}").alias(c) for i, c in enumerate(names)))
