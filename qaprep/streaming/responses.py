"""Structured Streaming ingestion of LLM response logs (L1).

Producers append finished JSON-lines parts (``{"run_id": r, "i": n, "output":
text}``) into a directory.  The stream:

    readStream.json(dir) -> file sink with a checkpoint (exactly-once, resumable)

keeps every arrival; the table of answers is the upsert of these rows by
``(run_id, i)`` when it is read (``latest``): the same winner as in batch, the
greatest text, whatever the order or time of arrival, and no state to bound.
``trigger(availableNow=True)`` processes what is there and stops, so a re-run
after a crash resumes from the checkpoint.  Folders are given by the caller, on
storage that the cluster shares.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path

RESPONSE_SCHEMA = "run_id STRING, i BIGINT, output STRING"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return shared_path(spark, name)


def response_stream(spark: SparkSession, log_dir: str, max_files_per_trigger: int = 64) -> DataFrame:
    return (spark.readStream.schema(RESPONSE_SCHEMA)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .json(log_dir))


def latest(arrived: DataFrame) -> DataFrame:
    """One answer per (run_id, i): the greatest text of all arrivals, as in batch."""
    return arrived.where(F.col("i").isNotNull()).groupBy("run_id", "i").agg(F.max("output").alias("output"))


def attach_arrived(arrived: DataFrame, requests: DataFrame, pos_col: str = "pos") -> DataFrame:
    """The answers of the request table's rows, per run."""
    return latest(arrived).join(requests, F.col("i") == F.col(pos_col), "inner").drop(pos_col)


def run_available(df: DataFrame, out_dir: str, checkpoint_dir: str, fmt: str = "parquet") -> None:
    """Process everything available now into a file sink, then stop."""
    q = (df.writeStream.format(fmt).option("path", out_dir)
         .option("checkpointLocation", checkpoint_dir)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
