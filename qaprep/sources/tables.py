"""Reading the driver tables.

A scan of a large table yields one task per file split, so it is already
parallel.  A small table stored as a single row group yields one task no
matter how many cores there are; every CPU-heavy projection after it (regex,
md5, folds) would then run on one core.  ``read_table(..., least_splits=n)``
spreads a scan of fewer splits by hashing its unique key, which changes the plan
but no result; by default the least is the number of cores, and 0 turns it off.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# unique key of each driver table (never a single skewable column)
TABLE_KEYS = {
    "orders": ["o_orderkey"],
    "documents": ["doc_id"],
    "conversations": ["conv_id", "turn"],
    "labels": ["doc_id"],
    "benchmark": ["item_id"],
    "events": ["event_id"],
    "embeddings": ["vec_id"],
    "pages": ["page_id"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "customer": ["c_custkey"],
    "part": ["p_partkey"],
    "supplier": ["s_suppkey"],
}


# explicit schemas: no footer-reading job per read, no inference drift
TABLE_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                 "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                 "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def spread(df: DataFrame, keys: list[str] | None, least_splits: int) -> DataFrame:
    if not keys or least_splits <= 1 or df.rdd.getNumPartitions() >= least_splits:
        return df
    return df.repartition(least_splits, *[F.col(k) for k in keys])


def read_table(spark: SparkSession, sf_dir: str, name: str, least_splits: int | None = None) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    df = reader.parquet(f"{sf_dir}/{name}.parquet")
    least = spark.sparkContext.defaultParallelism if least_splits is None else least_splits
    return spread(df, TABLE_KEYS.get(name), least)
