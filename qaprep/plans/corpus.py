"""The corpus build: stack three sources, split, random and wrong-date contexts.

    stacked  = union by name of the conformed sources
    split    = exact 70/15/15 per source in seeded hash order
    random   = ring shift -1 of relevant_context within each split
    wrong    = ordered date falsification of relevant_context

The split and falsified rows are written once as parquet below the shared
checkpoint folder; the ring shift reads pruned scans of that table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import DEFAULT_SEED, SPLIT_SEED
from ..operators.assemble import conform, stack, with_label
from ..operators.dates import falsify_dates
from ..operators.ordering import neighbours, ring_shift, ring_shift_legacy, seeded_key
from ..functions.keys import hash_bucket
from ..operators.splits import split_exact
from ..session import bucket_bits, materialise
from . import fixtures as fx

SOURCES = {"tq": "TQ_explicit", "easy": "TSQA_easy", "hard": "TSQA_hard"}
QA_COLUMNS = ["idx", "question", "answer", "relevant_context", "source"]


def stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    tq = with_label(conform(fx.qa_tq(spark, sf_dir), {"Question": "question", "Answer": "answer"},
                            drop=["pos"]), "source", SOURCES["tq"])
    easy = with_label(conform(fx.qa_easy(spark, sf_dir), {"context": "relevant_context", "targets": "answer"},
                              drop=["from", "end", "paragraphs"]), "source", SOURCES["easy"])
    hard = with_label(conform(fx.qa_hard(spark, sf_dir), {"context": "relevant_context", "targets": "answer"},
                              drop=["from", "end", "paragraphs"]), "source", SOURCES["hard"])
    return stack(tq, easy, hard).select(*QA_COLUMNS)


def with_order(df: DataFrame, seed=SPLIT_SEED) -> DataFrame:
    """Seeded order key and its bucket, shared by the split and the ring shift.

    The two windows are deliberately *not* co-partitioned: the ring's own
    exchange (by type, bucket) sits after the date falsification, so both
    ring branches (inner rows, bucket edges) reuse that one shuffle output
    instead of recomputing the split window and the falsification.
    """
    spark = df.sparkSession
    d = df.withColumn("order_key", seeded_key(["idx"], seed))
    return d.withColumn("order_bucket", hash_bucket(F.col("order_key"), bucket_bits(spark, minimum=8)))


def split(spark: SparkSession, sf_dir: str, seed=SPLIT_SEED, keep_order: bool = False) -> DataFrame:
    d = with_order(stacked(spark, sf_dir), seed)
    d = split_exact(d, ["idx"], seed, by=["source"], order_key="order_key")
    return d if keep_order else d.drop("order_key", "order_bucket")


def prepared(spark: SparkSession, sf_dir: str, seed=SPLIT_SEED, date_seed=DEFAULT_SEED,
             falsify: bool = True, types: Sequence[str] | None = None) -> DataFrame:
    """Split (+ wrong-date contexts) with order columns, as a parquet table in
    the shared checkpoint folder.

    The ring shift that follows reads its input several times (rows, bucket
    edges, bucket ring); each read is a pruned scan instead of a replay of
    stacking, splitting and date falsification, and a lost executor restarts
    from here.  ``types`` keeps only these splits: the ring runs per split.
    """
    d = split(spark, sf_dir, seed, keep_order=True)
    if types is not None:
        d = d.where(F.col("type").isin(*types))
    if falsify:
        d = falsify_dates(d, "relevant_context", "idx", date_seed, out="wrong_date_context")
    return materialise(d, "corpus")


def with_random_context(df: DataFrame, seed=SPLIT_SEED, legacy: bool = False) -> DataFrame:
    d = df if "order_bucket" in df.columns else with_order(df, seed)
    order = [F.col("order_key"), F.col("idx")]
    if legacy:
        d = ring_shift_legacy(d, "relevant_context", order, by=["type"], out="random_context",
                              bucket=F.col("order_bucket"))
    else:
        d = ring_shift(d, "relevant_context", -1, order, by=["type"], out="random_context",
                       bucket=F.col("order_bucket"))
    return d.drop("order_key", "order_bucket")


def corpus(spark: SparkSession, sf_dir: str, seed=SPLIT_SEED, date_seed=DEFAULT_SEED,
           irrelevant: bool = False, types: Sequence[str] | None = None) -> DataFrame:
    """idx, question, answer, relevant_context, source, type, random_context,
    wrong_date_context (+ ``ic``, ``wd_ic`` with ``irrelevant=True``).

    Dates are falsified before the neighbour pass, so one window over the
    bucketed rows yields the random context (next row's relevant context)
    and the irrelevant variants (previous row's relevant and wrong-date
    contexts) together.
    """
    d = prepared(spark, sf_dir, seed, date_seed, types=types)
    order = [F.col("order_key"), F.col("idx")]
    if irrelevant:
        n = neighbours(d, ["relevant_context", "wrong_date_context"], order, by=["type"],
                       bucket=F.col("order_bucket"), prefix_next="_nx_", prefix_prev="_pv_")
        d = n.select(*d.columns, F.col("_nx_relevant_context").alias("random_context"),
                     F.col("_pv_relevant_context").alias("ic"),
                     F.col("_pv_wrong_date_context").alias("wd_ic"))
    else:
        d = ring_shift(d, "relevant_context", -1, order, by=["type"], out="random_context",
                       bucket=F.col("order_bucket"))
    return d.drop("order_key", "order_bucket")
