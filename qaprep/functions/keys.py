"""Deterministic hash keys.

Every "random" choice in the engine is a 60-bit integer taken from the md5
of a text key.  It is identical on every retry and in DuckDB:

    Spark : cast(conv(substr(md5(s), 1, 15), 16, 10) as bigint)
    DuckDB: ('0x' || substr(md5(s), 1, 15))::BIGINT
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.lit(c)


def hash_text(*parts) -> Column:
    """The text that is hashed: parts joined by ':' (nulls skipped)."""
    if len(parts) == 1:  # nothing to join: words are hashed by the million
        return F.coalesce(_col(parts[0]).cast("string"), F.lit(""))
    return F.concat_ws(":", *[_col(p).cast("string") for p in parts])


def hash60(*parts) -> Column:
    """Non-negative 60-bit integer from md5(parts joined by ':')."""
    return F.conv(F.substring(F.md5(hash_text(*parts)), 1, 15), 16, 10).cast("bigint")


def hash_bucket(key60: Column, bits: int) -> Column:
    """Top ``bits`` bits of a 60-bit key: equal-width, order-preserving buckets."""
    return F.shiftright(key60, HASH_BITS - bits).cast("int")
