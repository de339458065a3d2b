"""Quality by hierarchical empirical Bayes: document evidence within site posteriors.

1. A logistic classifier over text measures (lengths, symbols, letters, repeats)
   gives each document's own evidence; it is fitted in numpy on a bounded sample
   of labelled rows (``SAMPLE_ROWS``).
2. Grouped aggregation counts good and all documents per host and per path of a
   host: labelled ones fully, others by their evidence at weight ``SOFT``.
3. A host's rate is the posterior mean under a Beta prior at the global rate, a
   path's that under a Beta prior at its host's rate.  The prior strengths are
   estimated from the spread between hosts, and between paths within hosts
   (method of moments), so a sparse site stays near the rate above it.
4. The score adds the path's log-odds, relative to the global rate, to the
   document's log-odds.

Sites are only ever aggregated with partial sums, and joined back from a table, so
a host with a third of all documents is split like any other skewed join key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .language import sampled_texts
from .shared import (NON_SPACE, byte_set, chunks, held_out_column, lower_ascii, materialize, pack_model, pieces,
                     prefix_hash, ship, span_hash, unpack_model, word_bounds)

#: labelled rows of either class for the classifier; weight of an unlabelled document in its site
SAMPLE_ROWS, SOFT = 2000, 0.25
#: bounds of a prior's strength, in documents
STRENGTH = (2.0, 1e5)
CHUNK = 1 << 19
#: bytes of one long text read at once
PIECE = 1 << 20

_SETS = [byte_set("#*$%&|<>"), byte_set("0-9"), byte_set("A-Z"), byte_set(".,;:!?"), byte_set("A-Za-z\x80-\xff"),
         byte_set("\n")]


def _counts(member: np.ndarray, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Bytes of a set in each document, with running counts for one piece at a time."""
    at_offs, before = np.zeros(len(offs)), 0
    for a in range(0, len(data), PIECE):
        c = np.cumsum(member[data[a:a + PIECE]], dtype=np.int32)
        mine = slice(*np.searchsorted(offs, [a + 1, a + len(c) + 1]))
        at_offs[mine] = before + c[offs[mine] - a - 1]
        before += int(c[-1])
    # bounds at the very start count nothing; the others were reached above
    return np.diff(at_offs)


def _word_hashes(data: np.ndarray, offs: np.ndarray):
    """(hash, document, bytes) of the words; a text longer than a piece is alone and read in pieces."""
    if len(offs) > 2 or len(data) <= PIECE:
        low = lower_ascii(data)
        s, e, doc = word_bounds(low, offs, NON_SPACE)
        return (span_hash(prefix_hash(low), s, e) if len(s) else np.empty(0, np.uint64)), doc, e - s
    found = []
    for a, b in pieces(data, PIECE, NON_SPACE):
        low = lower_ascii(data[a:b])
        s, e, _ = word_bounds(low, np.array([0, b - a]), NON_SPACE)
        found.append((span_hash(prefix_hash(low), s, e), e - s))
    h, length = (np.concatenate(x) for x in zip(*found))
    return h, np.zeros(len(h), np.int64), length


def text_features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Documents x measures of a chunk's texts."""
    n = len(offs) - 1
    size = np.diff(offs).astype(np.float64)
    share = [_counts(s, data, offs) / np.maximum(size, 1) for s in _SETS]
    h, doc, length = _word_hashes(data, offs)
    words = np.bincount(doc, minlength=n).astype(np.float64)
    chars = np.bincount(doc, length, n)
    kinds = distinct = np.zeros(n)
    if len(h):
        kinds = _distinct(h, doc, n)
        same = doc[1:] == doc[:-1]
        distinct = _distinct((h[:-1] * np.uint64(31) + h[1:])[same], doc[1:][same], n)
    return np.stack([np.log1p(words), chars / np.maximum(words, 1), *share, kinds / np.maximum(words, 1),
                     distinct / np.maximum(words - 1, 1), (words < 10).astype(np.float64)], 1)


def _distinct(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Different values in each document."""
    order = np.lexsort((values, doc))
    v, d = values[order], doc[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
    return np.bincount(d[new], minlength=n)


def _design(x: np.ndarray, mean: np.ndarray, sd: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / sd, -6, 6)
    return np.concatenate([np.ones((len(z), 1)), z, z * z], 1)


def fit(texts: list[bytes], good: list[int], share: dict | None = None, rounds: int = 25) -> dict[str, np.ndarray]:
    """Ridge logistic regression by Newton's method; rows weigh by the part of their class that was sampled."""
    x = []
    for at in range(0, len(texts), 100):
        some = texts[at:at + 100]
        offs = np.concatenate([[0], np.cumsum([len(t) for t in some])]).astype(np.int64)
        x.append(text_features(np.frombuffer(b"".join(some), np.uint8), offs))
    x = np.concatenate(x)
    y = np.array(good, np.float64)
    weight = np.array([1 / (share or {}).get(int(g), 1.0) for g in good])
    weight /= weight.mean()
    mean, sd = x.mean(0), x.std(0) + 1e-6
    a = _design(x, mean, sd)
    w = np.zeros(a.shape[1])
    ridge = np.full(len(w), 1.0)
    ridge[0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (weight * (y - p)) - ridge * w
        hess = (a * (weight * p * (1 - p) + 1e-6)[:, None]).T @ a + np.diag(ridge)
        step = np.linalg.solve(hess, g)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return {"w": w, "mean": mean, "sd": sd}


def document_rates(model: dict, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    z = _design(text_features(data, offs), model["mean"], model["sd"]) @ model["w"]
    return 1 / (1 + np.exp(-np.clip(z, -12, 12)))


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, prior: Column, n: Column, good: Column) -> float:
    """Beta prior strength from the spread of group rates around their priors (method of moments).

    Sum of n (rate - prior)^2 exceeds its binomial expectation by the spread
    between the groups; the more spread, the weaker the prior."""
    r = groups.agg(
        F.sum(n * F.pow(good / n - prior, 2)).alias("seen"), F.sum(prior * (1 - prior)).alias("expected"),
        F.sum(n * prior * (1 - prior)).alias("scale"), F.count(F.lit(1)).alias("groups")).first()
    if not r["groups"] or not r["scale"]:
        return STRENGTH[1]
    # E[seen] = expected + (scale - expected) / (strength + 1)
    extra = (r["seen"] - r["expected"]) / max(r["scale"] - r["expected"], 1e-9)
    strength = 1 / extra - 1 if extra > 0 else STRENGTH[1]
    return float(min(max(strength, STRENGTH[0]), STRENGTH[1]))


def site_rates(docs: DataFrame) -> tuple[DataFrame, float]:
    """Posterior rates of sites and the global rate, from (host, path, n, good) rows:
    (host, path, host_rate, path_rate)."""
    paths = materialize(docs.where("host IS NOT NULL").groupBy("host", "path")
                        .agg(F.sum("n").alias("n"), F.sum("good").alias("good")), "paths")
    total = paths.agg(F.sum("n"), F.sum("good")).first()
    rate = float((total[1] or 0) + 0.5) / float((total[0] or 0) + 1)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("good").alias("hgood"))
    k = _strength(hosts, F.lit(rate), F.col("hn"), F.col("hgood"))
    hosts = materialize(hosts.withColumn("host_rate", (F.col("hgood") + k * rate) / (F.col("hn") + k))
                        .select("host", "host_rate"), "hosts")
    both = materialize(paths.join(hosts, "host"), "sites")
    k = _strength(both, F.col("host_rate"), F.col("n"), F.col("good"))
    rates = both.withColumn("path_rate", (F.col("good") + k * F.col("host_rate")) / (F.col("n") + k))
    return materialize(rates.select("host", "path", "host_rate", "path_rate"), "rates"), rate


def url_site(url: Column) -> tuple[Column, Column]:
    """(host, first path segment) of a url column, for tables that have one."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(host != "", host), F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^/?#]*)", 1)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    host: Column | None = None, path: Column | None = None, label_col: str = "quality",
                    sample: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted, kept, doc_score, host_rate, path_rate) of every document;
    ``predicted`` is 1 and ``kept`` true where quality 1 is likelier (score >= 0.5).

    ``host`` and ``path`` default to the source and to its language section.  Labels
    of held-out ids are not looked at.  A document without a host has the global
    rate; a null path is a path of its own; a null or empty text is scored by its
    (empty) measures.  A document with several labels counts once, by their mean.
    Without a usable label the classifier says 0.5.  Repeated rows and null ids
    return a row each; an empty table gives an empty result."""
    spark = docs.sparkSession
    ship(spark)
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      host.cast("string").alias("host"), path.cast("string").alias("path")) \
        .withColumn("held_out", held_out_column())
    marks = (labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("double").alias("y"))
             .where("y IN (0, 1) AND __id IS NOT NULL").where(~held_out_column("__id"))
             .groupBy("__id").agg(F.avg("y").alias("y")))
    learn = src.where("NOT held_out AND text IS NOT NULL").select("doc_id", "text")
    got, share = sampled_texts(learn, marks.withColumn("y", F.col("y").cast("int")), "y", sample)
    got = sorted((r["text"], r["y"]) for r in got)
    model = fit([t.encode() for t, _ in got], [y for _, y in got], share) if got else {}
    sent = spark.sparkContext.broadcast(pack_model(model) if model else b"")

    def run(batches):
        fitted = unpack_model(sent.value) if sent.value else None
        for ch in chunks(batches, "text", CHUNK):
            p = document_rates(fitted, ch.data, ch.offs) if fitted else np.full(len(ch), 0.5)
            yield pa.RecordBatch.from_arrays(
                [ch.column(c) for c in ("doc_id", "host", "path", "held_out")] + [pa.array(p)],
                ["doc_id", "host", "path", "held_out", "doc_score"])

    kind = src.schema["doc_id"].dataType.simpleString()
    scored = materialize(src.mapInArrow(run, f"doc_id {kind}, host STRING, path STRING, held_out BOOLEAN, "
                                             "doc_score DOUBLE"), "evidence")
    counted = (scored.join(marks, F.col("doc_id") == F.col("__id"), "left")
               .select("host", "path", F.when(F.col("y").isNull(), SOFT).otherwise(1.0).alias("n"),
                       F.coalesce("y", F.col("doc_score") * SOFT).alias("good")))
    rates, rate = site_rates(counted)
    rates = rates.withColumnsRenamed({"host": "__host", "path": "__path"})
    out = scored.join(rates, (F.col("host") == F.col("__host")) & F.col("path").eqNullSafe(F.col("__path")), "left")
    z = _logit(F.col("doc_score")) + _logit(F.col("path_rate")) - _logit(F.lit(rate))
    return (out.withColumns({c: F.coalesce(c, F.lit(rate)) for c in ("host_rate", "path_rate")})
            .withColumn("score", 1 / (1 + F.exp(-z)))
            .select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                    (F.col("score") >= 0.5).alias("kept"), "doc_score", "host_rate", "path_rate"))
