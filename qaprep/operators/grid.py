"""Model x context experiment grid and its file manifest."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K


def grid_paths(models: Sequence[str] = tuple(K.GRID_MODELS), contexts: Sequence[str] = tuple(K.GRID_CONTEXTS),
               train_dir: str = "train/", eval_dir: str = "dev/packed/",
               model_paths: Mapping[str, str] = K.MODEL_PATHS):
    """Column expressions for a model x context grid built by ``explode``.

    Returns (model, context, train_path, eval_path, model_id) columns over a
    one-row frame; callers explode the two literal arrays (no cross join).
    """
    m = F.col("model")
    c = F.col("context")
    lookup = F.create_map(*[x for k, v in model_paths.items() for x in (F.lit(k), F.lit(v))])
    return {
        "train_path": F.concat(F.lit(train_dir), F.lit("train_"), m, F.lit("_"), c, F.lit("_packed.jsonl")),
        "eval_path": F.concat(F.lit(eval_dir), F.lit("dev_"), m, F.lit("_"), c, F.lit("_packed.jsonl")),
        "output_file": F.concat(m, F.lit("_"), c, F.lit("_training.out")),
        "model_id": F.element_at(lookup, m),
        "dataset_name": F.concat(m, F.lit("_"), c),
    }


def runnable_grid(anchor: DataFrame, files: DataFrame, models: Sequence[str] = tuple(K.GRID_MODELS),
                  contexts: Sequence[str] = tuple(K.GRID_CONTEXTS), train_dir: str = "train/",
                  eval_dir: str = "dev/packed/") -> DataFrame:
    """Every (model, context) with its files; ``ready`` only if both exist.

    ``anchor`` is any one-row frame; ``files`` is a manifest with a ``path``
    column (e.g. the written packed datasets).  Two left joins on the path.
    """
    g = anchor.select(F.explode(F.array(*[F.lit(x) for x in models])).alias("model")) \
        .select("model", F.explode(F.array(*[F.lit(x) for x in contexts])).alias("context"))
    cols = grid_paths(models, contexts, train_dir, eval_dir)
    g = g.select("model", "context", *[v.alias(k) for k, v in cols.items()])
    f = files.select("path").distinct()
    t = f.select(F.col("path").alias("train_path"), F.lit(True).alias("_has_train"))
    e = f.select(F.col("path").alias("eval_path"), F.lit(True).alias("_has_eval"))
    g = g.join(t, "train_path", "left").join(e, "eval_path", "left")
    status = F.when(F.col("_has_train").isNotNull() & F.col("_has_eval").isNotNull(), "ready") \
        .otherwise("missing")
    return g.withColumn("status", status).drop("_has_train", "_has_eval")
