"""Seeded shuffles, exact-ratio splits, holdouts and limits.

Python's and numpy's permutations are not reproduced; sizes, determinism
(md5 of ``seed:key``) and disjointness are.  Exact sizes need no position of every row,
only the keys at which the parts begin: ``split_exact`` finds these by distributed
selection (``cut_keys``) and then compares, so no row moves.  ``holdout_last`` also gives
positions and uses the bucketed ``global_index``; ``split_hash`` is the approximate
variant without any count.
"""

from __future__ import annotations

from decimal import Decimal
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import HELD_FRACTION, HOLDOUT_LAST, SPLIT_SEED, TEST_OF_HELD
from ..functions.keys import HASH_BITS
from ..session import materialise
from .ordering import global_index, seeded_key


def split_sizes(n: Column, held: float = HELD_FRACTION, test_of_held: float = TEST_OF_HELD):
    """(train, dev, test) sizes as two sklearn-style cuts: held = ceil(f*n)."""
    # exact decimal products: ceil(0.3 * 10) is 3, not the float 4
    n_held = F.ceil(F.lit(Decimal(str(held))) * n).cast("long")
    n_test = F.ceil(F.lit(Decimal(str(test_of_held))) * n_held).cast("long")
    return n - n_held, n_held - n_test, n_test


def shuffle(df: DataFrame, key: Sequence[str], seed=SPLIT_SEED, by: Sequence[str] = (),
            pos: str = "pos", key_col: str = "shuffle_key", count: str | None = None) -> DataFrame:
    """Seeded order: ``shuffle_key`` = md5 60-bit of ``seed:key`` and its position."""
    d = df.withColumn(key_col, seeded_key(list(key), seed))
    return global_index(d, [F.col(key_col), *[F.col(k) for k in key]], by=by, pos=pos, count=count)


#: bits of the hash key that are counted: of n rows about n / 2**BITS meet in a task for each cut
SELECT_BITS = 18


def cut_keys(df: DataFrame, order_key: str, key: Sequence[str], ranks, by: Sequence[str] = ()) -> DataFrame:
    """(*by, _c0, _c1, ...): for each group the (order_key, *key) of the rows at some ranks.

    ``ranks(n)`` gives Columns of 0-based ranks from the group size ``n``; a rank that no
    row has gives null.  ``order_key`` is a 60-bit hash.  Selection on narrow rows: counts
    by the top ``SELECT_BITS`` bits (with map-side partial sums) tell in which bucket a
    rank lies, and only the rows of that bucket are numbered."""
    by = list(by)
    narrow = df.select(*by, F.shiftright(order_key, HASH_BITS - SELECT_BITS).cast("int").alias("_b"),
                       F.struct(F.col(order_key).alias("_k"), *key).alias("_x"))
    narrow = materialise(narrow, "split-keys")
    counts = narrow.groupBy(*by, "_b").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*by)
    run = (counts.withColumn("_all", F.sum("_n").over(w))
           .withColumn("_to", F.sum("_n").over(w.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    asked = F.array(*[F.struct(F.lit(i).alias("no"), r.cast("long").alias("r")) for i, r in enumerate(ranks(F.col("_all")))])
    cut = (run.select("*", F.explode(asked).alias("_r"))
           .where((F.col("_r.r") < F.col("_to")) & (F.col("_r.r") >= F.col("_to") - F.col("_n")))
           .select(*[F.col(c).alias(f"_g_{c}") for c in by], F.col("_b").alias("_cb"), F.col("_r.no").alias("_no"),
                   (F.col("_r.r") - F.col("_to") + F.col("_n")).alias("_rank")))
    on = narrow["_b"] == cut["_cb"]
    for c in by:
        on = on & narrow[c].eqNullSafe(cut[f"_g_{c}"])
    near = narrow.join(cut, on).select(*by, "_no", "_rank", "_x")
    at = near.withColumn("_p", F.row_number().over(Window.partitionBy(*by, "_no").orderBy("_x")) - 1).where("_p = _rank")
    count = len(ranks(F.lit(0)))
    return at.groupBy(*by).agg(*[F.max(F.when(F.col("_no") == i, F.col("_x"))).alias(f"_c{i}") for i in range(count)])


def _with_parts(df: DataFrame, order_key: str, key: Sequence[str], ranks, names: Sequence[str], by: Sequence[str],
                out: str) -> DataFrame:
    """``df`` with the name of its part: the parts begin at the given ranks.

    The cuts, a row per group, are a stored table, so Spark knows its size and
    broadcasts it where it is small."""
    cuts = materialise(cut_keys(df, order_key, key, ranks, by), "split-cuts")
    if not by:  # one row, or none
        joined = df.withColumn("_one", F.lit(0)).join(F.broadcast(cuts.withColumn("_one", F.lit(0))), "_one", "left").drop("_one")
    else:
        right = cuts.withColumnsRenamed({c: f"_g_{c}" for c in by})
        on = F.lit(True)
        for c in by:
            on = on & df[c].eqNullSafe(right[f"_g_{c}"])
        joined = df.join(right, on, "left").drop(*[f"_g_{c}" for c in by])
    me = F.struct(F.col(order_key).alias("_k"), *key)
    part = None
    for i, name in enumerate(names[:-1]):
        mine = F.col(f"_c{i}").isNull() | (me < F.col(f"_c{i}"))
        part = F.when(mine, name) if part is None else part.when(mine, name)
    return joined.withColumn(out, part.otherwise(names[-1])).drop(*[f"_c{i}" for i in range(len(names) - 1)])


def split_exact(df: DataFrame, key: Sequence[str], seed=SPLIT_SEED, by: Sequence[str] = (),
                out: str = "type", held: float = HELD_FRACTION,
                test_of_held: float = TEST_OF_HELD, order_key: str | None = None) -> DataFrame:
    """70/15/15 (default) with exact sizes per ``by`` group: train, dev, test.

    ``key`` is unique within a group.  ``order_key`` lets a caller pass a precomputed
    seeded key."""
    def ranks(n):
        train, dev, _ = split_sizes(n, held, test_of_held)
        return [train, train + dev]

    d, k = df, order_key
    if k is None:
        d, k = df.withColumn("_k0", seeded_key(list(key), seed)), "_k0"
    out_rows = _with_parts(d, k, list(key), ranks, ["train", "dev", "test"], list(by), out)
    return out_rows if order_key else out_rows.drop("_k0")


def split_hash(df: DataFrame, key: Sequence[str], seed=SPLIT_SEED, out: str = "type",
               fractions: Sequence[float] = (0.7, 0.15, 0.15),
               names: Sequence[str] = ("train", "dev", "test")) -> DataFrame:
    """Approximate split by hash range: no shuffle, no count, same seed rule."""
    u = seeded_key(list(key), seed).cast("double") / float(2 ** HASH_BITS)
    expr = None
    acc = 0.0
    for frac, name in zip(fractions[:-1], names[:-1]):
        acc = round(acc + frac, 12)        # 0.7 + 0.15 must be the literal 0.85
        expr = (F.when(u < acc, name) if expr is None else expr.when(u < acc, name))
    expr = expr.otherwise(names[-1]) if expr is not None else F.lit(names[-1])
    return df.withColumn(out, expr)


def holdout_last(df: DataFrame, key: Sequence[str], seed=SPLIT_SEED, n_eval: int = HOLDOUT_LAST,
                 by: Sequence[str] = (), out: str = "part") -> DataFrame:
    """After a seeded shuffle the last ``n_eval`` rows are ``eval``, the rest ``train``."""
    d = shuffle(df, key, seed, by, pos="pos", key_col="_k", count="_n")
    return (d.withColumn(out, F.when(F.col("pos") >= F.col("_n") - n_eval, "eval").otherwise("train"))
            .drop("_k", "_n"))


def first_n(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """First ``n`` rows by ``order`` (a top-k: each task keeps only n rows)."""
    return df.orderBy(*order).limit(n)
