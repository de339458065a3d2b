"""Resumable model calls: a ledger keeps every finished answer.

A paid call must not be repeated because a later one failed.  ``call_with_ledger``
asks only for requests that the ledger (a table of answers in shared storage) lacks,
deals them into micro-batches by hash, and commits the answers of each batch before the
next begins.  A job that stops, wherever, goes on from the last commit when it is
started again: a request of a committed batch is never asked twice, and at most one
batch of calls is lost.

A request is known by its key and by the MD5 of its text, so one whose text has
changed is asked anew, and the ledger keeps both answers.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from .requests import call_model


def _ledger_schema(key: str, key_type: str) -> str:
    return f"`{key}` {key_type}, request_md5 STRING, output STRING"


def read_ledger(spark: SparkSession, path: str, key: str, key_type: str = "STRING") -> DataFrame:
    """Answers so far: (key, request_md5, output); empty before the first commit."""
    schema = _ledger_schema(key, key_type)
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


#: characters of request text that a task sorts at once
TASK_TEXT = 64 << 20


def _text(requests: DataFrame, request_col: str) -> Column:
    text = F.col(request_col)
    return text if requests.schema[request_col].dataType.typeName() == "string" else F.to_json(text)


def missing(requests: DataFrame, ledger: DataFrame, key: str, request_col: str = "request") -> DataFrame:
    """(key, request_md5, request as JSON text) of the requests without an answer, each once.

    Rows without a key have no place in a ledger and are left out.  The texts are dealt to
    as many tasks as they need, ``TASK_TEXT`` each: request texts repeat long instructions,
    so their size in a compressed shuffle says little about the memory that sorting takes."""
    spark = requests.sparkSession
    asked = requests.where(F.col(key).isNotNull()).select(key, _text(requests, request_col).alias("request"))
    size = asked.agg(F.sum(F.length("request") + 100)).first()[0] or 0
    asked = asked.select(key, F.md5(F.coalesce("request", F.lit("")).cast("binary")).alias("request_md5"), "request")
    if size > TASK_TEXT * int(spark.conf.get("spark.sql.shuffle.partitions")):
        asked = asked.repartition(-(-size // TASK_TEXT), key, "request_md5")
    asked = asked.dropDuplicates([key, "request_md5"])
    return asked.join(ledger.select(key, "request_md5"), [key, "request_md5"], "left_anti")


def call_with_ledger(requests: DataFrame, key: str, client_factory: Callable[[], Callable[[list[str]], list[str]]],
                     path: str, batch_rows: int = 10_000, request_col: str = "request",
                     most_batches: int | None = None) -> DataFrame:
    """Ask for all requests that the ledger at ``path`` lacks, a micro-batch at a time;
    returns the answers of all of ``requests`` (key, output), those still missing as null.

    ``client_factory`` is as in ``call_model``: one client per partition.  The batches'
    requests are written once, by batch, so a batch reads its own rows only.
    ``most_batches`` ends a run early (a budget); the next run goes on from there."""
    spark = requests.sparkSession
    key_type = requests.schema[key].dataType.simpleString()
    todo = missing(requests, read_ledger(spark, path, key, key_type), key, request_col)
    todo_path = shared_path(spark, "requests-to-ask")
    count = todo.count()
    batches = -(-count // batch_rows)
    if count:
        number = F.pmod(F.xxhash64(key, "request_md5"), F.lit(batches)).alias("batch")
        todo.select("*", number).write.partitionBy("batch").parquet(todo_path)
    asked = 0
    for b in range(batches):
        if most_batches is not None and asked >= most_batches:
            break
        try:
            part = spark.read.schema(f"`{key}` {key_type}, request_md5 STRING, request STRING") \
                .parquet(f"{todo_path}/batch={b}")
        except Exception as e:  # no request fell into it
            if "PATH_NOT_FOUND" not in str(e):
                raise
            continue
        both = part.select(F.struct(key, "request_md5").alias("k"), "request")
        answers = call_model(both, "k", client_factory, encode=False)
        answers.select(f"k.{key}", "k.request_md5", "output").write.mode("append").parquet(path)
        asked += 1
    text = _text(requests, request_col)
    wanted = requests.select(key, F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("request_md5"))
    return wanted.join(read_ledger(spark, path, key, key_type), [key, "request_md5"], "left").select(key, "output")
