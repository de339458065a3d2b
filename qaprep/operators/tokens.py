"""Tokens, vocabulary, padding, packing and batching (all DataFrame-native).

Word tokens are whitespace-separated non-empty strings.  Default token ids are
hashed (``3 + md5(tok) mod (V-3)``): no vocabulary join and no shuffle.  An
exact frequency-ranked vocabulary is available (``build_vocab`` +
``tokenize_with_vocab``), and a caller may plug a real subword tokenizer in
through ``tokenize_with`` (an Arrow-batched iterator UDF that loads the
tokenizer once per Python worker).

Packing never explodes tokens into rows: each example becomes one interval
``[start, start + len)`` on a global token axis (start = weighted prefix sum
over order buckets), and only the pieces that overlap each fixed-stride chunk
are regrouped — every group is bounded by the chunk width.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import ACCUM_TARGET, EOS_ID, FIRST_WORD_ID, PACK_LEN, PAD_ID, VOCAB_SIZE
from ..functions.keys import hash60, hash_bucket
from ..session import bucket_bits


def word_tokens(text: Column) -> Column:
    """Non-empty whitespace-separated words (``str.split()`` semantics)."""
    return F.filter(F.split(text, r"\s+"), lambda t: t != "")


def hashed_id(token: Column, vocab_size: int = VOCAB_SIZE) -> Column:
    """Word -> id in [3, V) by md5; ids 0..2 are PAD, BOS, EOS."""
    return (F.lit(FIRST_WORD_ID) + F.pmod(hash60(token), F.lit(vocab_size - FIRST_WORD_ID))).cast("int")


def hashed_ids(tokens: Column, vocab_size: int = VOCAB_SIZE) -> Column:
    return F.transform(tokens, lambda t: hashed_id(t, vocab_size))


def tokenize(df: DataFrame, col: str, out: str = "input_ids", vocab_size: int = VOCAB_SIZE) -> DataFrame:
    return df.withColumn(out, hashed_ids(word_tokens(F.col(col)), vocab_size))


def tokenize_with(df: DataFrame, col: str, factory: Callable[[], Callable[[list[str]], list[list[int]]]],
                  out: str = "input_ids") -> DataFrame:
    """Plug-in tokenizer hook.

    ``factory()`` is called once per Python worker and returns a function that
    maps a list of texts to a list of id lists (the shape a batched HF
    tokenizer call returns).  Rows travel to Python in Arrow batches.
    """
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def _tok(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fn = factory()
        for s in batches:
            yield pd.Series(fn(s.fillna("").tolist()))

    return df.withColumn(out, _tok(F.col(col)))


# ---------------------------------------------------------------- vocabulary

def build_vocab(df: DataFrame, col: str, n_buckets: int | None = None) -> DataFrame:
    """(token, n, id): BIGINT ids by descending frequency then token, from 3 upwards.

    The counted vocabulary is range-partitioned on the real ``(-n, token)``
    pair by sampled bounds, so the many tokens of one count spread over the
    ranges in token order whatever their alphabet or common prefix.
    """
    from .ordering import range_index

    counts = (df.select(F.explode(word_tokens(F.col(col))).alias("token"))
              .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    ranked = range_index(counts, [F.col("n").desc(), F.col("token")], pos="_rank", partitions=n_buckets)
    return ranked.select("token", "n", (F.col("_rank") + FIRST_WORD_ID).cast("long").alias("id"))


def tokenize_with_vocab(df: DataFrame, key: str, col: str, vocab: DataFrame,
                        out: str = "input_ids", unk_id: int = PAD_ID) -> DataFrame:
    """Exact vocabulary lookup.

    Tokens are exploded with their position, joined to the vocabulary (AQE
    broadcasts it when small and splits skewed hot tokens otherwise) and
    regrouped per row in position order; a group is one row's tokens.
    """
    toks = df.select(key, F.posexplode(word_tokens(F.col(col))).alias("p", "token"))
    j = toks.join(vocab.select("token", "id"), "token", "left")
    ids = (j.groupBy(key)
           .agg(F.array_sort(F.collect_list(F.struct("p", F.coalesce("id", F.lit(unk_id).cast("long")).alias("id"))))
                .alias("_pairs"))
           .select(key, F.transform("_pairs", lambda x: x["id"]).alias(out)))
    return df.join(ids, key, "left").withColumn(out, F.coalesce(F.col(out), F.array().cast("array<bigint>")))


# ------------------------------------------------------------ windows / pads

def window_count(n: Column, size: int, stride: int) -> Column:
    """Windows of ``size`` every ``stride`` tokens; the last covers the tail."""
    return F.when(n <= size, F.lit(1)).otherwise(
        ((n - size + stride - 1) / stride).cast("long") + 1).cast("int")


def sliding_windows(df: DataFrame, key: str, col: str, size: int, stride: int) -> DataFrame:
    """One row per (key, window_no) with the window's words joined by spaces.

    Windows are cut inside the row, so a window row carries its own words only."""
    d = df.select(key, word_tokens(F.col(col)).alias("_t"))
    numbers = F.sequence(F.lit(0), window_count(F.size("_t"), size, stride) - 1)
    cut = F.transform(numbers, lambda i: F.array_join(F.slice("_t", i * stride + 1, F.lit(size)), " "))
    return d.select(key, F.posexplode(cut).alias("window_no", "text"))


def pad_truncate(ids: Column, width, pad_id: int = PAD_ID) -> tuple[Column, Column]:
    """Right-pad / truncate to ``width``; returns (ids, attention_mask)."""
    w = F.lit(width) if isinstance(width, int) else width
    cut = F.slice(ids, 1, w)
    fill = F.greatest(w - F.size(cut), F.lit(0))
    padded = F.concat(cut, F.array_repeat(F.lit(pad_id), fill))
    mask = F.concat(F.array_repeat(F.lit(1), F.size(cut)), F.array_repeat(F.lit(0), fill))
    return padded, mask


def pad_batch(df: DataFrame, batch_col: str, ids_col: str, pad_id: int = PAD_ID) -> DataFrame:
    """Pad each row to the longest row of its batch (a batch is a few rows)."""
    width = F.max(F.size(ids_col)).over(Window.partitionBy(batch_col))
    d = df.withColumn("_w", width)
    ids, mask = pad_truncate(F.col(ids_col), F.col("_w"), pad_id)
    return d.withColumn(ids_col, ids).withColumn("attention_mask", mask).drop("_w")


# ------------------------------------------------------------------ packing

def token_offsets(df: DataFrame, order_key: str, length: Column, by: Sequence[str] = (),
                  bits: int | None = None, tie: Sequence[str] = ()) -> DataFrame:
    """Start of each row on a global token axis ordered by a 60-bit hash key.

    ``tie``: columns (the row key) that order rows whose hash keys are equal.

    Weighted version of ``global_index``: bucket sums -> prefix offsets
    (broadcast when ungrouped) -> running sum inside the bucket.
    """
    spark = df.sparkSession
    bits = bits or bucket_bits(spark)
    by = list(by)
    d = df.withColumn("_len", length.cast("long")).withColumn("_b", hash_bucket(F.col(order_key), bits))
    w = (Window.partitionBy(*by, "_b").orderBy(order_key, *tie)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # bucket sums: a key-and-length-only pass with map-side partial sums
    wd = d.withColumn("_run", F.sum("_len").over(w))
    sums = d.groupBy(*by, "_b").agg(F.sum("_len").alias("_s"))
    wg = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offs = sums.select(*by, "_b", (F.sum("_s").over(wg) - F.col("_s")).alias("_off"))
    offs = F.broadcast(offs) if not by else offs      # see ordering.global_index
    return (wd.join(offs, [*by, "_b"], "left")
            .withColumn("start", F.col("_off") + F.col("_run") - F.col("_len"))
            .drop("_b", "_off", "_run"))


def pack_sequences(df: DataFrame, ids_col: str, order_key: str, seq_len: int = PACK_LEN,
                   by: Sequence[str] = (), eos_id: int = EOS_ID, bits: int | None = None,
                   id_fn=None, tie: Sequence[str] = ()) -> DataFrame:
    """Concatenate every row's ids (+EOS) in order, cut at stride L+1.

    Keeps only full cuts; ``input_ids = cut[:-1]``, ``labels = cut[1:]``.
    Output: (*by, chunk_id, input_ids, labels).

    With ``id_fn`` the column holds tokens (strings) and ids are computed on
    the cut pieces, so each token is mapped once and the offset pass only
    needs token counts.
    """
    width = seq_len + 1
    by = list(by)
    # a row without tokens (null) is an empty document: its end token stays
    if id_fn is None:
        seq = F.concat(F.coalesce(F.col(ids_col), F.array().cast(df.schema[ids_col].dataType)),
                       F.array(F.lit(eos_id)))
    else:
        seq = F.concat(F.coalesce(F.col(ids_col), F.array().cast("array<string>")),
                       F.array(F.lit(None).cast("string")))
    d = df.select(*by, order_key, *tie, seq.alias("_ids"))
    d = token_offsets(d, order_key, F.size("_ids"), by, bits, tie)
    d = d.withColumn("_end", F.col("start") + F.col("_len"))
    # slices are cut inside the row, so a chunk row carries its own piece only
    cuts = F.sequence(F.expr(f"start div {width}"), F.expr(f"(_end - 1) div {width}"))

    def piece(c):
        lo = F.greatest(c * width, F.col("start"))
        hi = F.least((c + 1) * width, F.col("_end"))
        return F.struct(c.alias("chunk_id"), F.struct(lo.alias("at"), F.slice(
            "_ids", (lo - F.col("start") + 1).cast("int"), (hi - lo).cast("int")).alias("ids")).alias("piece"))

    pieces = d.select(*by, F.explode(F.transform(cuts, piece)).alias("_p")) \
        .select(*by, F.col("_p.chunk_id").alias("chunk_id"), F.col("_p.piece").alias("piece"))
    if id_fn is not None:
        p = F.col("piece")
        pieces = pieces.select(*by, "chunk_id", F.struct(p["at"].alias("at"), F.transform(
            p["ids"], lambda t: F.when(t.isNull(), F.lit(eos_id)).otherwise(id_fn(t))).alias("ids")).alias("piece"))
    chunks = (pieces.groupBy(*by, "chunk_id")
              .agg(F.flatten(F.transform(F.array_sort(F.collect_list("piece")), lambda p: p["ids"])).alias("_seq"))
              .where(F.size("_seq") == width))
    return chunks.select(*by, "chunk_id",
                         F.slice("_seq", 1, seq_len).alias("input_ids"),
                         F.slice("_seq", 2, seq_len).alias("labels"))


# ------------------------------------------------------------------ batching

def batches(packed: DataFrame, size: int, chunk_col: str = "chunk_id") -> DataFrame:
    """Fixed-size batches of packed chunks with stacked token columns.

    Chunk ids are dense (only the last cut can be short), so the batch of a
    chunk is a division; the last partial batch is kept."""
    row = F.struct(F.col(chunk_col).alias("chunk_id"), F.col("input_ids").alias("input_ids"),
                   F.col("labels").alias("labels"))
    return (packed.groupBy(F.expr(f"{chunk_col} div {size}").alias("batch"))
            .agg(F.array_sort(F.collect_list(row)).alias("_rows"), F.count(F.lit(1)).alias("n_rows"))
            .select("batch", "n_rows", F.col("_rows.chunk_id").alias("members"),
                    F.col("_rows.input_ids").alias("input_ids"), F.col("_rows.labels").alias("labels")))


def batch_ids(offsets: DataFrame, size: int, seq_len: int = PACK_LEN) -> DataFrame:
    """(batch): ids of the batches that packing will give, from ``token_offsets``
    alone (columns start, _len): no token array is read or shuffled."""
    width = seq_len + 1
    total = offsets.agg(F.expr(f"sum(_len) div {width}").alias("_chunks")).withColumn("_k", F.lit(0))
    span = F.expr(f"sequence(start div {width * size}, (start + _len - 1) div {width * size})")
    ids = offsets.select(F.explode(span).alias("batch")).distinct().withColumn("_k", F.lit(0))
    return ids.join(F.broadcast(total), "_k").where(F.col("batch") * size < F.col("_chunks")).select("batch")


def step_plan(plan: DataFrame, batch_size: int, epochs: int) -> DataFrame:
    """(epoch, batch, accum, is_update, update_step, total_steps, warmup_steps)."""
    accum = max(ACCUM_TARGET // batch_size, 1)
    # one-row aggregate attached by a broadcast equi-join on a constant key
    n = plan.agg(F.count(F.lit(1)).alias("n_batches")).withColumn("_k", F.lit(0))
    rows = plan.select("batch", F.lit(0).alias("_k")).join(F.broadcast(n), "_k")
    ep = F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch")
    rows = rows.select(ep, "batch", "n_batches")
    updates_before = F.floor((F.col("batch") + accum - 1) / accum)   # updates in earlier batches of this epoch
    per_epoch = F.floor((F.col("n_batches") + accum - 1) / accum)
    total = F.floor(F.col("n_batches") * epochs / accum)
    return rows.select(
        F.col("epoch").cast("int").alias("epoch"), F.col("batch").cast("long").alias("batch"),
        F.lit(accum).alias("accum"),
        (F.pmod(F.col("batch"), F.lit(accum)) == 0).alias("is_update"),
        (F.col("epoch") * per_epoch + updates_before).cast("long").alias("update_step"),
        total.cast("long").alias("total_steps"),
        F.floor(total / 10).cast("long").alias("warmup_steps"),
    )
