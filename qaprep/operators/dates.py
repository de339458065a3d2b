"""Date mention operators on DataFrames (extract, falsify, mark, validate)."""

from __future__ import annotations

from typing import Iterator

import pandas as pd

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import DEFAULT_SEED
from ..functions import dates as D


def extract_dates(df: DataFrame, col: str, out: str = "dates", pattern: str = D.DATE_RX) -> DataFrame:
    return df.withColumn(out, D.extract_mentions(F.col(col), pattern))


def extract_dates_with(df: DataFrame, col: str, factory: Callable[[], Callable[[list[str]], list[list[str]]]],
                       out: str = "dates") -> DataFrame:
    """Hook for a named-entity model: ``factory()`` runs once per Python worker
    and returns a function from texts to their DATE mention lists."""
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def _ner(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fn = factory()
        for s in batches:
            yield pd.Series(fn(s.fillna("").tolist()))

    return df.withColumn(out, _ner(F.col(col)))


def falsify_dates(df: DataFrame, col: str, key: str, seed=DEFAULT_SEED, out: str = "wrong_date_context",
                  pattern: str = D.DATE_RX, mentions_col: str | None = None) -> DataFrame:
    """Replace months and years of every mention by false ones (ordered fold).

    With ``mentions_col`` the mentions come from a column (e.g. a NER hook)
    instead of the regex.
    """
    text = F.col(col)
    if mentions_col:
        swaps = F.transform(F.col(mentions_col), lambda m, i: F.struct(
            m.alias("orig"), D.fake_mention(m, F.col(key), seed, i).alias("fake")))
    else:
        swaps = D.date_swaps(text, F.col(key), seed, pattern)
    return df.withColumn(out, D.apply_swaps(text, swaps))


def mark_dates(df: DataFrame, col: str, out: str = "marked", pattern: str = D.DATE_RX) -> DataFrame:
    return df.withColumn(out, D.mark(F.col(col), pattern))


def validate_marked(df: DataFrame, marked_col: str, context_col: str) -> DataFrame:
    """Parse ``####...####`` spans and check the reply repeats the context."""
    return (df.withColumn("marked_dates", D.parse_marked(F.col(marked_col)))
              .withColumn("valid", (D.unmark(F.col(marked_col)) == F.col(context_col))
                          & ((F.size("marked_dates") > 0)
                             | (F.size(D.extract_mentions(F.col(context_col))) == 0))))
