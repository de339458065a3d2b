"""Answers of a response-log stream, one per (run_id, i), kept up to date as they arrive.

Two parts:

* a stateful operator (``applyInPandasWithState``, state in RocksDB on the executors'
  disks, its change log in the checkpoint) that knows the answer of every (run_id, i) and lets
  an arrival pass only if it is the first or a better one (the greater text, the winner of
  the batch).  Re-sent, late and reordered lines end here.  A key's state expires
  ``expiry_ms`` after its last arrival; a line that comes later still passes, and the
  table decides;
* a table of answers, in buckets of neighbouring ``i`` of one run.  A micro-batch merges
  its few changes into the buckets that they touch and writes those anew as a version of
  their own; the version counts once its line in the commit table is written (one file,
  in one move).  A batch that is run again after a failure starts from the versions before
  it, so it ends with the same rows.

Reading needs no aggregation of answers: the last version of every bucket holds one row
per key.
"""

from __future__ import annotations

from contextlib import contextmanager
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..session import ship_package
from .responses import RESPONSE_SCHEMA

#: neighbouring ``i`` of one run in a bucket
BUCKET_ROWS = 1 << 20
#: 2**STATE_BITS neighbouring ``i`` of one run share a state row: a call of Python and a row of
#: state each cost far more than the answers in it
STATE_BITS = 5
EXPIRY_MS = 30 * 24 * 3600 * 1000

_COMMITS = "batch BIGINT, bucket BIGINT"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _best_answers(expiry_ms: int):
    """Pass an answer of a key on if there was none, or a lesser one; forget the key in time.

    The state holds neighbouring keys: (i, text, last arrival) each."""
    def keep(key, parts, state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        known = {i: (text, seen) for i, text, seen in zip(*state.get) if now - seen < expiry_ms} if state.exists else {}
        better = {}
        if not state.hasTimedOut:
            for part in parts:
                for i, text in zip(part["i"].tolist(), part["output"].tolist()):
                    text = text if text is not None and text == text else None
                    old = known[i][0] if i in known else None
                    if i not in known or text is not None and (old is None or text > old):
                        better[i] = old = text
                    known[i] = (old, now)
        if known:
            state.update((list(known), [text for text, _ in known.values()], [seen for _, seen in known.values()]))
            state.setTimeoutDuration(max(1, min(seen for _, seen in known.values()) + expiry_ms - now))
        elif state.exists:
            state.remove()
        if better:
            yield pd.DataFrame({"run_id": [key[0]] * len(better), "i": list(better), "output": list(better.values())})
    return keep


@contextmanager
def _conf(spark: SparkSession, key: str, value: str):
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def better_answers(arrivals: DataFrame, expiry_ms: int = EXPIRY_MS) -> DataFrame:
    """The stream of first and better answers of each (run_id, i); lines without ``i`` are left out."""
    keyed = arrivals.where("i IS NOT NULL").select("run_id", "i", "output", F.shiftright("i", STATE_BITS).alias("_some"))
    return keyed.groupBy("run_id", "_some").applyInPandasWithState(
        _best_answers(expiry_ms), RESPONSE_SCHEMA, "i ARRAY<BIGINT>, output ARRAY<STRING>, seen ARRAY<BIGINT>", "update",
        GroupStateTimeout.ProcessingTimeTimeout)


def _versions(spark: SparkSession, path: str, before: int | None = None) -> dict[int, int]:
    """Last committed batch of every bucket."""
    try:
        commits = spark.read.schema(_COMMITS).parquet(f"{path}/commits")
    except Exception as e:  # no commit yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return {}
    if before is not None:
        commits = commits.where(F.col("batch") < before)
    return {r.bucket: r.batch for r in commits.groupBy("bucket").agg(F.max("batch").alias("batch")).collect()}


def _read(spark: SparkSession, path: str, versions: dict[int, int]) -> DataFrame:
    files = [f"{path}/versions/batch={v}/bucket={b}" for b, v in versions.items()]
    return spark.read.schema(RESPONSE_SCHEMA).parquet(*files) if files else spark.createDataFrame([], RESPONSE_SCHEMA)


def upsert(changes: DataFrame, batch: int, path: str, bucket_rows: int = BUCKET_ROWS) -> None:
    """Merge a micro-batch of answers into the table at ``path`` (the same when repeated)."""
    spark = changes.sparkSession
    bucket = F.xxhash64("run_id", F.floor(F.col("i") / bucket_rows)).alias("bucket")
    changes = changes.select(*changes.columns, bucket).persist()
    try:
        touched = [r.bucket for r in changes.select("bucket").distinct().collect()]
        if not touched:
            return
        had = {b: v for b, v in _versions(spark, path, before=batch).items() if b in set(touched)}
        old = _read(spark, path, had).select("run_id", "i", "output", bucket)
        merged = old.unionByName(changes).groupBy("bucket", "run_id", "i").agg(F.max("output").alias("output"))
        (merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/versions/batch={batch}"))
    finally:
        changes.unpersist()
    (spark.createDataFrame([(batch, b) for b in touched], _COMMITS).coalesce(1)
     .write.mode("append").parquet(f"{path}/commits"))


def run_upserts(arrivals: DataFrame, path: str, checkpoint_dir: str, expiry_ms: int = EXPIRY_MS,
                bucket_rows: int = BUCKET_ROWS) -> None:
    """Process every line available now into the table of answers, then stop."""
    spark = arrivals.sparkSession
    ship_package(spark)
    # with a timeout by the clock, batches without data would never end
    with (_conf(spark, "spark.sql.streaming.stateStore.providerClass", _ROCKSDB),
          _conf(spark, "spark.sql.streaming.noDataMicroBatches.enabled", "false")):
        q = (better_answers(arrivals, expiry_ms).writeStream.outputMode("update")
             .foreachBatch(lambda df, batch: upsert(df, batch, path, bucket_rows))
             .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
        q.awaitTermination()


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """The table of answers: one row per (run_id, i)."""
    return _read(spark, path, _versions(spark, path))


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the bucket versions that a later commit replaced; how many."""
    commits = spark.read.schema(_COMMITS).parquet(f"{path}/commits").distinct().collect()
    last = _versions(spark, path)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    for r in commits:
        if last[r.bucket] != r.batch:
            p = jvm.org.apache.hadoop.fs.Path(f"{path}/versions/batch={r.batch}/bucket={r.bucket}")
            gone += p.getFileSystem(conf).delete(p, True)
    return gone
