"""Scoring: window logit means, argmax, F1 / accuracy, cross-entropy,
validation loss, answer matching, leakage and grouped scoreboards.

Every metric is an aggregate with map-side partial aggregation; confusion
tables are (label, prediction) counts, so nothing collects a group.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .automaton import contained
from .tokens import word_tokens


def argmax(a: Column) -> Column:
    """0-based index of the first maximum (NaN counts as the maximum)."""
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def window_logit_mean(df: DataFrame, n_classes: int, idx: str = "idx", logits: str = "logits",
                      label: str = "label", order: str = "window_no") -> DataFrame:
    """Mean logit vector per id over its windows; label = last window's label.

    One group-by with partial aggregation: a class count fixed by the model
    means one ``avg`` per class, no per-id list is ever built.
    """
    aggs = [F.avg(F.col(logits)[c]).alias(f"_m{c}") for c in range(n_classes)]
    g = df.groupBy(idx).agg(*aggs, F.max_by(label, order).alias(label),
                            F.count(F.lit(1)).alias("n_windows"))
    return g.select(idx, label, "n_windows",
                    F.array(*[F.col(f"_m{c}") for c in range(n_classes)]).alias("mean_logits"))


def with_prediction(df: DataFrame, logits: str = "mean_logits", out: str = "pred") -> DataFrame:
    return df.withColumn(out, argmax(F.col(logits)))


def confusion(df: DataFrame, label: str = "label", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, label, pred).agg(F.count(F.lit(1)).alias("n"))


def f1_scores(df: DataFrame, label: str = "label", pred: str = "pred",
              by: Sequence[str] = ()) -> DataFrame:
    """Binary F1 (positive = 1), macro F1 over labels in truth or prediction,
    and accuracy, per ``by`` group.  F1 of a class without support is 0."""
    by = list(by)
    cm = confusion(df, label, pred, by)
    # per class: tp, predicted, actual
    cls = (cm.select(*by, F.col(label).alias("c"), F.col("n").alias("actual"),
                     F.lit(0).cast("long").alias("predicted"),
                     F.when(F.col(label) == F.col(pred), F.col("n")).otherwise(0).alias("tp"))
           .unionByName(cm.select(*by, F.col(pred).alias("c"), F.lit(0).cast("long").alias("actual"),
                                  F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp"))))
    per = cls.groupBy(*by, "c").agg(F.sum("tp").alias("tp"), F.sum("actual").alias("actual"),
                                    F.sum("predicted").alias("predicted"))
    f1 = F.when(F.col("actual") + F.col("predicted") == 0, 0.0) \
        .otherwise(2.0 * F.col("tp") / (F.col("actual") + F.col("predicted")))
    per = per.withColumn("f1", f1)
    return per.groupBy(*by).agg(
        F.coalesce(F.max(F.when(F.col("c") == 1, F.col("f1"))), F.lit(0.0)).alias("f1_binary"),
        F.avg("f1").alias("f1_macro"),
        (F.sum("tp") / F.sum("actual")).alias("accuracy"),
        F.sum("actual").alias("n"),
    )


def token_cross_entropy(logits: Column, label: Column, row_max: Column | None = None) -> Column:
    """``logsumexp(logits) - logits[label]`` (numerically stable).

    Pass ``row_max`` as a materialised column: the lambda would otherwise
    recompute ``array_max`` for every element.
    """
    m = F.array_max(logits) if row_max is None else row_max
    lse = m + F.log(F.aggregate(logits, F.lit(0.0), lambda acc, x: acc + F.exp(x - m)))
    return lse - F.element_at(logits, (label + 1).cast("int"))


def cross_entropy(df: DataFrame, logits: str = "logits", label: str = "label",
                  ignore_index: int = -100, by: Sequence[str] = ()) -> DataFrame:
    """Flat mean token cross-entropy; label ``-100`` is ignored as in torch."""
    d = df.where(F.col(label) != ignore_index).withColumn("_mx", F.array_max(logits))
    return d.groupBy(*by).agg(F.avg(token_cross_entropy(F.col(logits), F.col(label), F.col("_mx"))).alias("loss"),
                              F.count(F.lit(1)).alias("n_tokens"))


def validation_loss(df: DataFrame, batch: str = "batch", loss: str = "loss",
                    by: Sequence[str] = ()) -> DataFrame:
    """Both formulas in use: mean of batch means, and the last batch's mean."""
    bm = df.groupBy(*by, batch).agg(F.avg(loss).alias("_bm"))
    return bm.groupBy(*by).agg(F.avg("_bm").alias("mean_of_batch_means"),
                               F.max_by("_bm", batch).alias("last_batch_loss"),
                               F.count(F.lit(1)).alias("n_batches"))


def normalise(c: Column) -> Column:
    """lower, punctuation to spaces (letters, marks and digits of any script stay),
    collapse whitespace, trim."""
    x = F.lower(c)
    x = F.regexp_replace(x, r"[^\p{L}\p{M}\p{N}\s]", " ")
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def score_answers(df: DataFrame, pred: str = "prediction", gold: str = "answer") -> DataFrame:
    """Exact and contains match after normalisation, any of the gold answers.

    ``gold`` is a text or an array of texts.  A gold answer that normalises to
    nothing matches nothing; a null prediction or gold matches nothing."""
    golds = F.col(gold) if df.schema[gold].dataType.simpleString().startswith("array") else F.array(F.col(gold))
    d = df.withColumn("_p", normalise(F.col(pred))).withColumn(
        "_g", F.filter(F.transform(golds, normalise), lambda g: g.isNotNull() & (g != "")))
    return (d.withColumn("exact", F.coalesce(F.exists("_g", lambda g: g == F.col("_p")), F.lit(False)))
             .withColumn("contains", F.coalesce(F.exists("_g", lambda g: F.instr(F.col("_p"), g) > 0), F.lit(False)))
             .drop("_p", "_g"))


def answer_in_prompt(df: DataFrame, prompt: str = "prompt", answer: str = "answer") -> DataFrame:
    """Row-level leak: the (case-folded) answer text occurs in the prompt."""
    return df.withColumn("leaked", F.lower(F.col(prompt)).contains(F.lower(F.col(answer))))


def shingles(words: Column, n: int) -> Column:
    """Distinct word n-grams of a word array (all of them, whole text).

    ``words`` must be a column reference (materialise ``word_tokens`` first):
    a lambda re-evaluates any expression it closes over once per element.
    """
    k = F.greatest(F.size(words) - n + 1, F.lit(0))
    grams = F.transform(F.sequence(F.lit(1), k), lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.array_distinct(F.when(k > 0, grams).otherwise(F.array().cast("array<string>")))


#: words of the two probe n-grams; items of fewer words than LEAST_PROBED are searched as they are
LONG_GRAM, SHORT_GRAM, LEAST_PROBED = 8, 3, 5


def benchmark_leak(items: DataFrame, docs: DataFrame, item_key: str = "item_id",
                   doc_key: str = "doc_id", text: str = "text") -> DataFrame:
    """(item, doc) pairs where the document contains the item text verbatim.

    Items of five words or more probe with one *interior* n-gram: interior
    words are whitespace-delimited inside the item, so wherever it occurs they
    are whole words of the document too.  The n-gram has eight words, or three
    for items of five to nine words (the documents emit three-word grams only
    if such items exist); documents contribute every n-gram of their whole text
    in one scan, and candidates are verified by substring.  Shorter items, blank
    ones included, may begin and end inside words: an automaton over all of them
    reads each document once (``automaton.contained``).  No cross product, no cap.
    Rows with a null text match nothing.
    """
    it = items.where(F.col(text).isNotNull()).select(item_key, F.col(text).alias("_itext"),
                                                     word_tokens(F.col(text)).alias("_w"))
    it = it.withColumn("_words", F.size("_w"))
    dd = docs.where(F.col(text).isNotNull()).select(doc_key, F.col(text).alias("_dtext"))
    g = F.when(F.col("_words") >= LONG_GRAM + 2, F.lit(LONG_GRAM)).otherwise(F.lit(SHORT_GRAM))
    ig = it.where(F.col("_words") >= LEAST_PROBED).select(
        item_key, g.alias("g"), F.xxhash64(F.array_join(F.slice("_w", F.lit(2), g), " ")).alias("h"))
    # one row: which sizes are in use
    use = ig.agg(F.coalesce(F.max((F.col("g") == SHORT_GRAM).cast("int")), F.lit(0)).alias("_short"),
                 F.coalesce(F.max((F.col("g") == LONG_GRAM).cast("int")), F.lit(0)).alias("_long"),
                 F.lit(0).alias("_k"))

    def grams(n):
        return F.transform(shingles(F.col("_dw"), n), lambda s: F.struct(F.lit(n).alias("g"), F.xxhash64(s).alias("h")))

    none = F.array().cast("array<struct<g:int,h:bigint>>")
    both = F.concat(F.when(F.col("_short") == 1, grams(SHORT_GRAM)).otherwise(none),
                    F.when(F.col("_long") == 1, grams(LONG_GRAM)).otherwise(none))
    words = dd.select(doc_key, word_tokens(F.col("_dtext")).alias("_dw"), F.lit(0).alias("_k"))
    dgs = words.join(F.broadcast(use), "_k").select(doc_key, F.explode(both).alias("_e")) \
        .select(doc_key, "_e.g", "_e.h")
    cand = dgs.join(ig, ["g", "h"]).select(doc_key, item_key).distinct()
    out = (cand.join(it.select(item_key, "_itext"), item_key).join(dd, doc_key)
           .where(F.instr(F.col("_dtext"), F.col("_itext")) > 0).select(item_key, doc_key))
    short = it.where(F.col("_words") < LEAST_PROBED).select(item_key, "_itext")
    return out.unionByName(contained(dd, short, doc_key, "_dtext", item_key, "_itext"))


def scoreboard(df: DataFrame, dims: Sequence[str], label: str = "label", pred: str = "pred") -> DataFrame:
    """Accuracy and counts for every combination of ``dims`` (a cube)."""
    g = df.cube(*dims).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col(label) == F.col(pred)).cast("int")).alias("correct"),
        F.grouping_id().alias("gid"),
    )
    return g.withColumn("accuracy", F.col("correct") / F.col("n"))
