"""LLM request / response tables and the model-call hook.

Requests are plain structs (``model``, ``messages`` array of
``{role, content}``, sampling parameters) that serialise with ``to_json`` to
one batch-file line each.  No network client is shipped: ``call_model``
runs a caller-supplied client factory once per partition inside
``mapInPandas``; ``ledger.call_with_ledger`` makes a run of it resumable.
"""

from __future__ import annotations

import json
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from .prompts import render

JUDGE_REPLY_SCHEMA = "choice INT, argument STRING"


def _messages(system: str, user: Column) -> Column:
    return F.array(
        F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")),
    )


def _request(model: str, system: str, user: Column) -> Column:
    return F.struct(
        F.lit(model).alias("model"),
        _messages(system, user).alias("messages"),
        F.lit(K.SAMPLING["temperature"]).alias("temperature"),
        F.lit(K.SAMPLING["max_tokens"]).alias("max_tokens"),
        F.lit(K.SAMPLING["top_p"]).alias("top_p"),
    )


def context_request_head(question: Column, answer: Column) -> Column:
    return render(K.CONTEXT_REQUEST_HEAD, {"question": question, "answer": answer})


def date_mark_head(context: Column) -> Column:
    return render(K.DATE_MARK_HEAD, {"context": context})


def context_requests(df: DataFrame, key: str, question: str = "question", answer: str = "answer") -> DataFrame:
    """One context-generation request per question (system prompt inserted)."""
    head = context_request_head(F.col(question), F.col(answer))
    return df.select(key, _request(K.CHAT_MODEL, "\n" + K.CONTEXT_SYSTEM_PROMPT + "\n", head).alias("request"))


def date_mark_requests(df: DataFrame, key: str, context: str = "relevant_context") -> DataFrame:
    head = date_mark_head(F.col(context))
    return df.select(key, _request(K.CHAT_MODEL, "\n" + K.DATE_MARK_SYSTEM_PROMPT + "\n", head).alias("request"))


def judge_message(instruction: Column, gen1: Column, gen2: Column) -> Column:
    return render(K.JUDGE_MESSAGE, {"instruction": instruction, "gen1": gen1, "gen2": gen2})


def judge_requests(df: DataFrame, key: str, instruction: str, gen1: str, gen2: str) -> DataFrame:
    """Pairwise judge requests forcing the ``make_choice`` function call."""
    msg = judge_message(F.col(instruction), F.col(gen1), F.col(gen2))
    req = F.struct(
        F.lit(K.JUDGE_MODEL).alias("model"),
        _messages(K.JUDGE_SYSTEM_PROMPT, msg).alias("messages"),
        F.lit(json.dumps({"name": K.JUDGE_FUNCTION["name"]})).alias("function_call"),
        F.lit(json.dumps([K.JUDGE_FUNCTION])).alias("functions"),
    )
    return df.select(key, req.alias("request"))


def request_lines(requests: DataFrame, key: str) -> DataFrame:
    """Batch-file lines: ``{"custom_id": key, "body": request}``."""
    return requests.select(F.to_json(F.struct(F.col(key).cast("string").alias("custom_id"),
                                              F.col("request").alias("body"))).alias("value"))


def judge_tally(replies: DataFrame, reply_col: str = "reply", by: tuple[str, ...] = ()) -> DataFrame:
    """Parse judge replies and count wins of 1, 2 and ties (0); bad JSON -> null."""
    parsed = replies.withColumn("_r", F.from_json(F.col(reply_col), JUDGE_REPLY_SCHEMA))
    return parsed.groupBy(*by).agg(
        F.count(F.when(F.col("_r.choice") == 1, 1)).alias("wins_1"),
        F.count(F.when(F.col("_r.choice") == 2, 1)).alias("wins_2"),
        F.count(F.when(F.col("_r.choice") == 0, 1)).alias("ties"),
        F.count(F.when(F.col("_r.choice").isNull(), 1)).alias("unparsed"),
        F.count(F.lit(1)).alias("n"),
    )


def generation_table(df: DataFrame, prompt: str, generation: str, max_new_tokens: int = 100,
                     temperature: float = K.SAMPLING["temperature"], top_p: float = K.SAMPLING["top_p"],
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """prompt, generation, concat, max_new_tokens, temperature, top_p."""
    return df.select(
        *keep, F.col(prompt).alias("prompt"), F.col(generation).alias("generation"),
        F.concat(F.col(prompt), F.coalesce(F.col(generation), F.lit(""))).alias("concat"),
        F.lit(max_new_tokens).alias("max_new_tokens"),
        F.lit(float(temperature)).alias("temperature"), F.lit(float(top_p)).alias("top_p"),
    )


def call_model(requests: DataFrame, key: str, client_factory: Callable[[], Callable[[list[str]], list[str]]],
               request_col: str = "request", encode: bool = True) -> DataFrame:
    """One model call per row, one client per partition (``mapInPandas``).

    ``client_factory()`` returns ``fn(list of request JSON) -> list of reply
    text``.  Output ``(key, output)``; keyed, so order never matters.  ``encode`` off:
    the request is JSON text already.  A task that is lost repeats its calls;
    ``ledger.call_with_ledger`` bounds what is lost.
    """
    import pandas as pd

    request = F.to_json(F.col(request_col)) if encode else F.col(request_col)
    nested = requests.schema[key].dataType.typeName() == "struct"
    keys = [f"{key}.{f.name}" for f in requests.schema[key].dataType.fields] if nested else [key]
    types = [f.dataType for f in requests.schema[key].dataType.fields] if nested else [requests.schema[key].dataType]
    d = requests.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], request.alias("_req"))
    names = [f"_key{i}" for i in range(len(keys))]

    def run(batches):
        fn = client_factory()
        for pdf in batches:
            yield pd.DataFrame({**{n: pdf[n] for n in names}, "output": fn(pdf["_req"].tolist())})

    out = d.mapInPandas(run, ", ".join(f"{n} {t.simpleString()}" for n, t in zip(names, types)) + ", output string")
    if not nested:
        return out.withColumnRenamed("_key0", key)
    return out.select(F.struct(*[F.col(n).alias(f.name) for n, f in zip(names, requests.schema[key].dataType.fields)])
                      .alias(key), "output")
