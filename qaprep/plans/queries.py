"""Registered queries: one Spark plan and one DuckDB oracle per operator.

Each entry reads the driver tables (or views Spark derives from them) in
full.  Arrays are emitted as delimited strings and floats rounded to 6
places so that the order-insensitive value hash compares like with like.
"""

from __future__ import annotations

import json
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import dates as D
from ..functions.keys import hash60
from ..operators import assemble, evaluate, grid, prompts, requests, splits, tokens
from ..operators import dates as dops
from ..operators.ordering import global_index, range_index, seeded_key
from ..session import discard, shared_path, ship_package
from ..sources import csv_split, readers, writers
from . import corpus as C
from . import fixtures as fx
from . import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _ids(c):
    return F.array_join(c.cast("array<string>"), ",")  # a cast is compiled, a lambda is not


def _r6(c):
    return F.round(c, 6)


# ------------------------------------------------------------------ assembly

@query("stack_sources", O.with_(O.base_ctes("stacked"), "SELECT * FROM stacked"))
def q_stack_sources(spark, d):
    return C.stacked(spark, d)


@query("prefixed_ids", """
SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS pos,
       'conv_' || (row_number() OVER (ORDER BY conv_id, turn) - 1) AS idx
FROM conversations""")
def q_prefixed_ids(spark, d):
    u = fx.table(spark, d, "conversations").select("conv_id", "turn")
    return assemble.with_prefixed_id(range_index(u, ["conv_id", "turn"]), "conv_").select(
        "conv_id", "turn", "pos", "idx")


@query("attach_responses", O.with_([("qa_tq", O.QA_TQ), ("responses", O.RESPONSES)], """
SELECT t.idx, r.output AS generated_context, r.i IS NOT NULL AS has_response
FROM qa_tq t LEFT JOIN responses r ON r.i = t.pos"""))
def q_attach_responses(spark, d):
    t = fx.qa_tq(spark, d).select("pos", "idx")
    a = assemble.attach_responses(t, fx.responses(spark, d), out_col="generated_context")
    return a.select("idx", "generated_context", "has_response")


@query("response_coverage", O.with_([("qa_tq", O.QA_TQ), ("responses", O.RESPONSES)], """
SELECT count(*) FILTER (WHERE r.i IS NULL) AS rows_without_response,
       count(*) FILTER (WHERE t.pos IS NULL) AS responses_without_row
FROM (SELECT DISTINCT pos FROM qa_tq) t FULL OUTER JOIN (SELECT DISTINCT i FROM responses) r ON r.i = t.pos"""))
def q_response_coverage(spark, d):
    return assemble.coverage_report(fx.qa_tq(spark, d), fx.responses(spark, d))


@query("split_profile", O.with_(O.base_ctes("split"), """
SELECT coalesce(type, 'ALL') AS type, coalesce(source, 'ALL') AS source, count(*) AS n
FROM split GROUP BY ROLLUP (type, source)"""))
def q_split_profile(spark, d):
    s = C.split(spark, d)
    return (s.rollup("type", "source").agg(F.count(F.lit(1)).alias("n"))
            .select(F.coalesce("type", F.lit("ALL")).alias("type"),
                    F.coalesce("source", F.lit("ALL")).alias("source"), "n"))


@query("first_n", O.with_([("qa_tq", O.QA_TQ)], """
SELECT pos, idx, Question FROM qa_tq ORDER BY pos LIMIT 20"""))
def q_first_n(spark, d):
    return splits.first_n(fx.qa_tq(spark, d).select("pos", "idx", "Question"), ["pos"], 20)


@query("json_payload_parse", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def q_json_payload_parse(spark, d):
    e = fx.table(spark, d, "events")
    return e.select("event_id", F.from_json("props", "k INT")["k"].alias("k"))


@query("response_log_json", O.with_([("responses", O.RESPONSES)], """
SELECT i, json_extract_string(line, '$.output') = output AS round_trip, length(line) > length(output) AS framed
FROM (SELECT i, output, to_json({'i': i, 'output': output})::VARCHAR AS line FROM responses)"""))
def q_response_log_json(spark, d):
    r = fx.responses(spark, d)
    line = F.to_json(F.struct("i", "output"))
    back = F.from_json(line, "i INT, output STRING")
    return r.select("i", (back["output"] == F.col("output")).alias("round_trip"),
                    (F.length(line) > F.length("output")).alias("framed"))


@query("dataset_manifest", O.with_(O.base_ctes("corpus"), """
SELECT type AS split, count(*) AS n_rows, min(length(relevant_context)) AS min_context_chars,
       max(length(relevant_context)) AS max_context_chars,
       CAST(sum(length(relevant_context)) AS BIGINT) AS context_chars,
       count(DISTINCT source) AS n_sources
FROM corpus GROUP BY type"""))
def q_dataset_manifest(spark, d):
    # the corpus has exactly the split's rows (the ring shift and the date
    # falsification add columns only), so its profile is taken from the split
    from ..sources.writers import dataset_stats
    return dataset_stats(C.split(spark, d))


# -------------------------------------------------------------- order/split

@query("global_index", f"""
SELECT doc_id, lang,
       row_number() OVER (ORDER BY {O.h60("'42:' || doc_id")}, doc_id) - 1 AS pos,
       row_number() OVER (PARTITION BY lang ORDER BY {O.h60("'42:' || doc_id")}, doc_id) - 1 AS pos_in_lang
FROM documents""")
def q_global_index(spark, d):
    docs = fx.table(spark, d, "documents").select("doc_id", "lang")
    docs = docs.withColumn("_k", seeded_key(["doc_id"], 42))
    g = global_index(docs, ["_k", "doc_id"], pos="pos")
    g = global_index(g, ["_k", "doc_id"], by=["lang"], pos="pos_in_lang")
    return g.select("doc_id", "lang", "pos", "pos_in_lang")


@query("seeded_order", O.with_(O.base_ctes("stacked"), f"""
SELECT idx, {O.h60("'27:' || idx")} AS shuffle_key,
       row_number() OVER (ORDER BY {O.h60("'27:' || idx")}, idx) - 1 AS pos
FROM stacked"""))
def q_seeded_order(spark, d):
    s = splits.shuffle(C.stacked(spark, d).select("idx"), ["idx"], K.SPLIT_SEED)
    return s.select("idx", "shuffle_key", "pos")


@query("split_exact", O.with_(O.base_ctes("split"), "SELECT idx, source, type FROM split"))
def q_split_exact(spark, d):
    return C.split(spark, d).select("idx", "source", "type")


@query("split_hash", O.with_(O.base_ctes("stacked"), f"""
SELECT idx, source,
       CASE WHEN u < 0.7 THEN 'train' WHEN u < 0.85 THEN 'dev' ELSE 'test' END AS type
FROM (SELECT idx, source, CAST({O.h60("'27:' || idx")} AS DOUBLE) / CAST(1152921504606846976 AS DOUBLE) AS u
      FROM stacked)"""))
def q_split_hash(spark, d):
    """Approximate 70/15/15 by hash range: no shuffle, no count."""
    return splits.split_hash(C.stacked(spark, d), ["idx"], K.SPLIT_SEED).select("idx", "source", "type")


@query("holdout_last", O.with_([("qa_tq", O.QA_TQ)], f"""
SELECT idx, pos, CASE WHEN pos >= n - 100 THEN 'eval' ELSE 'train' END AS part FROM (
  SELECT idx, row_number() OVER (ORDER BY {O.h60("'27:' || idx")}, idx) - 1 AS pos,
         count(*) OVER () AS n FROM qa_tq)"""))
def q_holdout_last(spark, d):
    t = fx.qa_tq(spark, d).select("idx")
    return splits.holdout_last(t, ["idx"], K.SPLIT_SEED, K.HOLDOUT_LAST).select("idx", "pos", "part")


@query("random_context", O.with_(O.base_ctes("corpus"), "SELECT idx, type, random_context FROM corpus"))
def q_random_context(spark, d):
    return C.with_random_context(C.prepared(spark, d, falsify=False)).select("idx", "type", "random_context")


@query("random_context_legacy", O.with_(O.base_ctes("split_k"),
       f"SELECT idx, type, random_context FROM ({O.ring_sql('split_k', 'relevant_context', -1, 'random_context', legacy=True)})"))
def q_random_context_legacy(spark, d):
    return C.with_random_context(C.prepared(spark, d, falsify=False), legacy=True).select(
        "idx", "type", "random_context")


@query("irrelevant_context", O.with_(
    O.base_ctes("corpus") + [("ck", f"SELECT *, {O.h60(chr(39) + '27:' + chr(39) + ' || idx')} AS k FROM corpus"),
                             ("r1", O.ring_sql("ck", "relevant_context", 1, "irrelevant_context")),
                             ("r2", O.ring_sql("r1", "wrong_date_context", 1, "wd_irrelevant_context"))],
    "SELECT idx, type, irrelevant_context, wd_irrelevant_context FROM r2"))
def q_irrelevant_context(spark, d):
    c = C.corpus(spark, d, irrelevant=True)
    return c.select("idx", "type", F.col("ic").alias("irrelevant_context"),
                    F.col("wd_ic").alias("wd_irrelevant_context"))


@query("counterfactual_report", O.with_(O.base_ctes("corpus"), """
SELECT type, source, count(*) AS n,
       count(*) FILTER (WHERE random_context = relevant_context) AS random_equals_relevant,
       count(*) FILTER (WHERE random_context IS NULL) AS random_missing,
       count(*) FILTER (WHERE wrong_date_context = relevant_context) AS wrong_date_unchanged
FROM corpus GROUP BY type, source"""))
def q_counterfactual_report(spark, d):
    """Per split and source: how often a counterfactual context is no
    counterfactual (same passage as the neighbour's, or no date changed)."""
    c = C.corpus(spark, d)
    return c.groupBy("type", "source").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("random_context") == F.col("relevant_context"), 1)).alias("random_equals_relevant"),
        F.count(F.when(F.col("random_context").isNull(), 1)).alias("random_missing"),
        F.count(F.when(F.col("wrong_date_context") == F.col("relevant_context"), 1)).alias("wrong_date_unchanged"))


# -------------------------------------------------------------------- dates

@query("extract_dates", O.with_(O.base_ctes("stacked"), f"""
SELECT idx, len(m) AS n_dates, array_to_string(m, '|') AS dates
FROM (SELECT idx, {O.mentions_sql('relevant_context')} AS m FROM stacked)"""))
def q_extract_dates(spark, d):
    s = dops.extract_dates(C.stacked(spark, d), "relevant_context", out="m")
    return s.select("idx", F.size("m").cast("long").alias("n_dates"), F.array_join("m", "|").alias("dates"))


FALSIFY_SQL = O.with_(O.base_ctes("stacked"), f"""
SELECT idx, {O.falsify_sql('relevant_context', 'idx')} AS wrong_date_context FROM stacked""")


@query("falsify_dates", FALSIFY_SQL)
def q_falsify_dates(spark, d):
    s = dops.falsify_dates(C.stacked(spark, d), "relevant_context", "idx", K.DEFAULT_SEED)
    return s.select("idx", "wrong_date_context")


@query("safe_year_parse", O.with_(O.base_ctes("stacked"), f"""
SELECT part, count(*) AS n, TRY_CAST(part AS INTEGER) AS year_value
FROM (SELECT unnest(string_split_regex(m, '\\s+')) AS part
      FROM (SELECT unnest({O.mentions_sql('relevant_context')}) AS m FROM stacked))
GROUP BY part"""))
def q_safe_year_parse(spark, d):
    s = C.stacked(spark, d)
    m = s.select(F.explode(D.extract_mentions(F.col("relevant_context"))).alias("m"))
    p = m.select(F.explode(F.split("m", r"\s+")).alias("part"))
    return p.groupBy("part").agg(F.count(F.lit(1)).alias("n")).withColumn("year_value", D.safe_int(F.col("part")))


@query("mark_dates", O.with_(O.base_ctes("stacked"), f"""
SELECT idx, regexp_replace(relevant_context, '{O.RX}', '####\\0####', 'g') AS marked FROM stacked"""))
def q_mark_dates(spark, d):
    return dops.mark_dates(C.stacked(spark, d), "relevant_context").select("idx", "marked")


@query("validate_marked", O.with_(O.base_ctes("stacked"), f"""
SELECT idx, len(regexp_extract_all(reply, '####(.+?)####', 1)) AS n_marked,
       replace(reply, '####', '') = relevant_context
         AND (len(regexp_extract_all(reply, '####(.+?)####', 1)) > 0
              OR len({O.mentions_sql('relevant_context')}) = 0) AS valid
FROM (SELECT idx, relevant_context,
             CASE WHEN source = 'TSQA_hard' THEN relevant_context
                  ELSE regexp_replace(relevant_context, '{O.RX}', '####\\0####', 'g') END AS reply
      FROM stacked)"""))
def q_validate_marked(spark, d):
    s = C.stacked(spark, d)
    s = s.withColumn("reply", F.when(F.col("source") == "TSQA_hard", F.col("relevant_context"))
                     .otherwise(D.mark(F.col("relevant_context"))))
    v = dops.validate_marked(s, "reply", "relevant_context")
    return v.select("idx", F.size("marked_dates").cast("long").alias("n_marked"), "valid")


# ------------------------------------------------------------------ prompts

_PLAIN_HEAD_SQL = K.PLAIN_HEAD.replace("'", "''").replace("\n", "' || chr(10) || '")
NL = "chr(10)"


@query("plain_prompts", O.with_([("qa_tq", O.QA_TQ)], f"""
SELECT idx, '{_PLAIN_HEAD_SQL}' || {NL} || '### Question:' || {NL} || Question || {NL} || {NL}
       || '### Response:' || {NL} AS prompt FROM qa_tq"""))
def q_plain_prompts(spark, d):
    t = fx.qa_tq(spark, d)
    return t.select("idx", prompts.plain_prompt(F.col("Question")).alias("prompt"))


def _plain_ctx_sql(c: str, q: str) -> str:
    return (f"'{_PLAIN_HEAD_SQL}' || {NL} || '### Question:' || {NL} || {c} || {NL} || {NL} || {q} "
            f"|| {NL} || {NL} || '### Response:' || {NL}")


@query("plain_prompt_variants", O.with_(O.base_ctes("stacked") + [("wd", f"""
SELECT idx, Question AS question, relevant_context,
       {O.falsify_sql('relevant_context', 'idx')} AS wrong_date_context
FROM (SELECT idx, question AS Question, relevant_context FROM stacked)""")], f"""
SELECT idx, 'no_context' AS variant, '{_PLAIN_HEAD_SQL}' || {NL} || '### Question:' || {NL} || question || {NL} || {NL}
       || '### Response:' || {NL} AS prompt FROM wd
UNION ALL SELECT idx, 'relevant_context', {_plain_ctx_sql('relevant_context', 'question')} FROM wd
UNION ALL SELECT idx, 'wrong_date_context', {_plain_ctx_sql('wrong_date_context', 'question')} FROM wd"""))
def q_plain_prompt_variants(spark, d):
    s = dops.falsify_dates(C.stacked(spark, d), "relevant_context", "idx", K.DEFAULT_SEED)
    q = F.col("question")
    arr = F.array(
        F.struct(F.lit("no_context").alias("variant"), prompts.plain_prompt(q).alias("prompt")),
        F.struct(F.lit("relevant_context").alias("variant"),
                 prompts.plain_prompt_with_context(q, F.col("relevant_context")).alias("prompt")),
        F.struct(F.lit("wrong_date_context").alias("variant"),
                 prompts.plain_prompt_with_context(q, F.col("wrong_date_context")).alias("prompt")))
    return s.select("idx", F.explode(arr).alias("_v")).select("idx", "_v.variant", "_v.prompt")


def _sql_lit(s: str) -> str:
    parts = s.replace("'", "''").split("\n")
    return " || chr(10) || ".join(f"'{p}'" for p in parts)


def _gemma_sql(q: str, c: str | None) -> str:
    body = f"{q}" if c is None else f"{c} || chr(10) || chr(10) || {q}"
    return f"{_sql_lit(K.GEMMA_USER + chr(10))} || {body} || {_sql_lit(K.GEMMA_EOT + chr(10) + K.GEMMA_MODEL)}"


def _llama_sql(q: str, c: str | None) -> str:
    body = f"{q}" if c is None else f"{c} || chr(10) || chr(10) || {q}"
    return f"{_sql_lit(K.LLAMA_USER + ' ' + K.LLAMA_SYSTEM + chr(10))} || {body} || {_sql_lit(K.LLAMA_EOT)}"


def _matrix_sql() -> str:
    rows = []
    for fam, fn in (("gemma", _gemma_sql), ("llama", _llama_sql)):
        for kind in K.CONTEXT_KINDS:
            c = None if kind == "no_context" else kind
            rows.append(f"SELECT idx, type, source, answer, '{fam}' AS family, '{kind}' AS context_kind, "
                        f"{fn('question', c)} AS prompt FROM corpus")
    return "SELECT * FROM (" + "\nUNION ALL ".join(rows) + ") WHERE prompt IS NOT NULL"


MATRIX_SQL = _matrix_sql()


@query("prompt_matrix", O.with_(O.base_ctes("corpus") + [("matrix", MATRIX_SQL)],
                                "SELECT idx, family, context_kind, prompt FROM matrix"))
def q_prompt_matrix(spark, d):
    return prompts.prompt_matrix(C.corpus(spark, d)).select("idx", "family", "context_kind", "prompt")


def _cq_sql(c: str, q: str) -> str:
    return f"'Context: ' || {c} || chr(10) || chr(10) || 'Question: ' || {q} || chr(10) || chr(10)"


@query("context_question_long", O.with_(
    O.base_ctes("corpus") + [("ck", f"SELECT *, {O.h60(chr(39) + '27:' + chr(39) + ' || idx')} AS k FROM corpus"),
                             ("r1", O.ring_sql("ck", "relevant_context", 1, "ic")),
                             ("r2", O.ring_sql("r1", "wrong_date_context", 1, "wd_ic"))], f"""
SELECT * FROM (
  SELECT idx, 'RCQ' AS variant, {_cq_sql('relevant_context', 'question')} AS cq, answer FROM r2
  UNION ALL SELECT idx, 'WD_RCQ', {_cq_sql('wrong_date_context', 'question')}, answer FROM r2
  UNION ALL SELECT idx, 'ICQ', {_cq_sql('ic', 'question')}, answer FROM r2
  UNION ALL SELECT idx, 'WD_ICQ', {_cq_sql('wd_ic', 'question')}, answer FROM r2)
WHERE cq IS NOT NULL"""))
def q_context_question_long(spark, d):
    return prompts.context_question_long(C.corpus(spark, d, irrelevant=True))


_INSTR_NO = K.INSTRUCTION_NO_INPUT.split("{instruction}")
_INSTR_IN = K.INSTRUCTION_WITH_INPUT.replace("{instruction}", "\0").replace("{input}", "\0").split("\0")


@query("instruction_prompts", O.with_([("instructions", O.INSTRUCTIONS)], f"""
SELECT conv_id, turn,
       CASE WHEN input = '' THEN {_sql_lit(_INSTR_NO[0])} || instruction || {_sql_lit(_INSTR_NO[1])}
            ELSE {_sql_lit(_INSTR_IN[0])} || instruction || {_sql_lit(_INSTR_IN[1])} || input
                 || {_sql_lit(_INSTR_IN[2])} END AS prompt,
       output || '</s>' AS output
FROM instructions"""))
def q_instruction_prompts(spark, d):
    i = fx.instructions(spark, d)
    return i.select("conv_id", "turn", prompts.instruction_prompt(F.col("instruction"), F.col("input")).alias("prompt"),
                    F.concat(F.col("output"), F.lit(K.EOS)).alias("output"))


@query("examples", O.with_(O.base_ctes("corpus") + [("matrix", MATRIX_SQL)], """
SELECT idx, family, context_kind,
       CASE WHEN ends_with(answer, '</s>') THEN answer ELSE answer || '</s>' END AS output,
       prompt || CASE WHEN ends_with(answer, '</s>') THEN answer ELSE answer || '</s>' END AS example
FROM matrix"""))
def q_examples(spark, d):
    m = prompts.prompt_matrix(C.corpus(spark, d))
    return prompts.examples(m).select("idx", "family", "context_kind", "output", "example")


@query("ensure_eos", O.with_(O.base_ctes("stacked"), """
SELECT idx, CASE WHEN ends_with(answer, '</s>') THEN answer ELSE answer || '</s>' END AS output FROM stacked"""))
def q_ensure_eos(spark, d):
    s = C.stacked(spark, d)
    return s.select("idx", prompts.ensure_suffix(F.col("answer")).alias("output"))


@query("answer_in_prompt", O.with_(O.base_ctes("corpus") + [("matrix", MATRIX_SQL)], """
SELECT family, context_kind, count(*) AS n,
       count(*) FILTER (WHERE instr(lower(prompt), lower(answer)) > 0) AS leaked
FROM matrix GROUP BY family, context_kind"""))
def q_answer_in_prompt(spark, d):
    m = evaluate.answer_in_prompt(prompts.prompt_matrix(C.corpus(spark, d)))
    return m.groupBy("family", "context_kind").agg(F.count(F.lit(1)).alias("n"),
                                                   F.count(F.when(F.col("leaked"), 1)).alias("leaked"))


# ----------------------------------------------------------------- requests

def _req_cols(system: str, user):
    return [F.lit(K.CHAT_MODEL).alias("model"), F.lit(system).alias("system_content"), user.alias("user_content"),
            F.lit(K.SAMPLING["temperature"]).alias("temperature"), F.lit(K.SAMPLING["max_tokens"]).alias("max_tokens"),
            F.lit(K.SAMPLING["top_p"]).alias("top_p")]


def _req_sql(system: str, user: str) -> str:
    return (f"'{K.CHAT_MODEL}' AS model, {_sql_lit(system)} AS system_content, {user} AS user_content, "
            f"0.7::DOUBLE AS temperature, 1024 AS max_tokens, 1.0::DOUBLE AS top_p")


_CTX_HEAD = K.CONTEXT_REQUEST_HEAD.replace("{question}", "\0").replace("{answer}", "\0").split("\0")


@query("context_requests", O.with_([("qa_tq", O.QA_TQ)], f"""
SELECT idx, {_req_sql(chr(10) + K.CONTEXT_SYSTEM_PROMPT + chr(10),
                      f"{_sql_lit(_CTX_HEAD[0])} || Question || {_sql_lit(_CTX_HEAD[1])} || Answer || {_sql_lit(_CTX_HEAD[2])}")}
FROM qa_tq"""))
def q_context_requests(spark, d):
    r = requests.context_requests(fx.qa_tq(spark, d), "idx", "Question", "Answer")
    return r.select("idx", F.col("request.model").alias("model"),
                    F.col("request.messages")[0]["content"].alias("system_content"),
                    F.col("request.messages")[1]["content"].alias("user_content"),
                    F.col("request.temperature").alias("temperature"),
                    F.col("request.max_tokens").alias("max_tokens"), F.col("request.top_p").alias("top_p"))


def _echo_client():
    """Stands in for a model: answers with the MD5 of the user's message."""
    import hashlib
    import json

    def ask(batch):
        return [hashlib.md5(json.loads(r)["messages"][1]["content"].encode()).hexdigest() for r in batch]
    return ask


@query("call_ledger", O.with_([("qa_tq", O.QA_TQ)], f"""
SELECT idx, md5({_sql_lit(_CTX_HEAD[0])} || Question || {_sql_lit(_CTX_HEAD[1])} || Answer || {_sql_lit(_CTX_HEAD[2])}) AS output,
       1::BIGINT AS n_calls FROM qa_tq"""))
def q_call_ledger(spark, d):
    """Every context request asked once, by a run that stops halfway and one that goes on."""
    from ..operators.ledger import call_with_ledger, read_ledger
    ship_package(spark)
    asked = requests.context_requests(fx.qa_tq(spark, d), "idx", "Question", "Answer")
    path, size = shared_path(spark, "ledger"), -(-asked.count() // 4)
    call_with_ledger(asked, "idx", _echo_client, path, batch_rows=size, most_batches=2)
    call_with_ledger(asked, "idx", _echo_client, path, batch_rows=size)
    return read_ledger(spark, path, "idx").groupBy("idx").agg(F.max("output").alias("output"),
                                                              F.count("*").alias("n_calls"))


_MARK_HEAD = K.DATE_MARK_HEAD.split("{context}")


@query("date_mark_requests", O.with_(O.base_ctes("stacked"), f"""
SELECT idx, {_req_sql(chr(10) + K.DATE_MARK_SYSTEM_PROMPT + chr(10),
                      f"{_sql_lit(_MARK_HEAD[0])} || relevant_context || {_sql_lit(_MARK_HEAD[1])}")}
FROM stacked"""))
def q_date_mark_requests(spark, d):
    r = requests.date_mark_requests(C.stacked(spark, d), "idx")
    return r.select("idx", F.col("request.model").alias("model"),
                    F.col("request.messages")[0]["content"].alias("system_content"),
                    F.col("request.messages")[1]["content"].alias("user_content"),
                    F.col("request.temperature").alias("temperature"),
                    F.col("request.max_tokens").alias("max_tokens"), F.col("request.top_p").alias("top_p"))


_JUDGE = K.JUDGE_MESSAGE.replace("{instruction}", "\0").replace("{gen1}", "\0").replace("{gen2}", "\0").split("\0")


@query("judge_requests", O.with_([("instructions", O.INSTRUCTIONS), ("qa_easy", O.QA_EASY)], f"""
SELECT i.conv_id, i.turn, '{K.JUDGE_MODEL}' AS model, {_sql_lit(K.JUDGE_SYSTEM_PROMPT)} AS system_content,
       {_sql_lit(_JUDGE[0])} || i.instruction || {_sql_lit(_JUDGE[1])} || i.output || {_sql_lit(_JUDGE[2])}
         || e.context || {_sql_lit(_JUDGE[3])} AS user_content,
       {_sql_lit(json.dumps({"name": K.JUDGE_FUNCTION["name"]}))} AS function_call,
       {_sql_lit(json.dumps([K.JUDGE_FUNCTION]))} AS functions
FROM instructions i JOIN qa_easy e ON e.idx = 'easy_' || i.conv_id || '_' || i.turn"""))
def q_judge_requests(spark, d):
    i = fx.instructions(spark, d)
    e = fx.qa_easy(spark, d).select("idx", F.col("context").alias("gen2"))
    j = i.withColumn("idx", F.concat(F.lit("easy_"), F.col("conv_id"), F.lit("_"), F.col("turn"))).join(e, "idx")
    r = requests.judge_requests(j.withColumn("key", F.struct("conv_id", "turn")), "key", "instruction", "output", "gen2")
    return r.select(F.col("key.conv_id").alias("conv_id"), F.col("key.turn").alias("turn"),
                    F.col("request.model").alias("model"),
                    F.col("request.messages")[0]["content"].alias("system_content"),
                    F.col("request.messages")[1]["content"].alias("user_content"),
                    F.col("request.function_call").alias("function_call"),
                    F.col("request.functions").alias("functions"))


_REPLY_SQL = """CASE WHEN user_id % 17 = 0 THEN '{"choice": ' || event_id
                 ELSE '{"choice": ' || (CAST(floor(value) AS BIGINT) % 3) || ', "argument": "' || event_type || '"}' END"""


@query("judge_tally", f"""
SELECT event_type, count(*) FILTER (WHERE c = 1) AS wins_1, count(*) FILTER (WHERE c = 2) AS wins_2,
       count(*) FILTER (WHERE c = 0) AS ties, count(*) FILTER (WHERE c IS NULL) AS unparsed, count(*) AS n
FROM (SELECT event_type, TRY_CAST(json_extract(TRY_CAST({_REPLY_SQL} AS JSON), '$.choice') AS INTEGER) AS c FROM events)
GROUP BY event_type""")
def q_judge_tally(spark, d):
    e = fx.table(spark, d, "events")
    reply = F.when(F.pmod("user_id", F.lit(17)) == 0, F.concat(F.lit('{"choice": '), F.col("event_id"))) \
        .otherwise(F.concat(F.lit('{"choice": '), F.pmod(F.floor("value"), F.lit(3)), F.lit(', "argument": "'),
                            F.col("event_type"), F.lit('"}')))
    return requests.judge_tally(e.withColumn("reply", reply), by=("event_type",))


@query("generation_table", O.with_([("qa_tq", O.QA_TQ), ("responses", O.RESPONSES)], f"""
SELECT t.idx, p.prompt, r.output AS generation, p.prompt || coalesce(r.output, '') AS concat,
       100 AS max_new_tokens, 0.7::DOUBLE AS temperature, 1.0::DOUBLE AS top_p
FROM qa_tq t
JOIN (SELECT idx, '{_PLAIN_HEAD_SQL}' || {NL} || '### Question:' || {NL} || Question || {NL} || {NL}
             || '### Response:' || {NL} AS prompt FROM qa_tq) p ON p.idx = t.idx
LEFT JOIN responses r ON r.i = t.pos"""))
def q_generation_table(spark, d):
    t = fx.qa_tq(spark, d).withColumn("prompt", prompts.plain_prompt(F.col("Question")))
    a = assemble.attach_responses(t.select("idx", "pos", "prompt"), fx.responses(spark, d), out_col="generation")
    return requests.generation_table(a, "prompt", "generation", keep=("idx",))


# ------------------------------------------------------------------- tokens

_TOK_SQL = O.word_tokens_sql("text")


def _hid_sql(t: str) -> str:
    return f"CAST({K.FIRST_WORD_ID} + ({O.h60(t)} % {K.VOCAB_SIZE - K.FIRST_WORD_ID}) AS INTEGER)"


_IDS_SQL = f"list_transform({_TOK_SQL}, lambda t: {_hid_sql('t')})"


@query("tokenize_words", f"""
SELECT doc_id, len(ids) AS n_tokens, array_to_string(ids, ',') AS ids
FROM (SELECT doc_id, {_IDS_SQL} AS ids FROM documents)""")
def q_tokenize_words(spark, d):
    t = tokens.tokenize(fx.table(spark, d, "documents"), "text", "ids")
    return t.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), _ids(F.col("ids")).alias("ids"))


@query("build_vocab", f"""
SELECT token, n, CAST(row_number() OVER (ORDER BY n DESC, token) - 1 + {K.FIRST_WORD_ID} AS BIGINT) AS id
FROM (SELECT token, count(*) AS n FROM (SELECT unnest({_TOK_SQL}) AS token FROM documents) GROUP BY token)""")
def q_build_vocab(spark, d):
    return tokens.build_vocab(fx.table(spark, d, "documents"), "text")


@query("tokenize_vocab", f"""
WITH v AS (SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) - 1 + {K.FIRST_WORD_ID} AS BIGINT) AS id
           FROM (SELECT token, count(*) AS n FROM (SELECT unnest({_TOK_SQL}) AS token FROM documents) GROUP BY token)),
     t AS (SELECT doc_id, unnest({_TOK_SQL}) AS token, generate_subscripts({_TOK_SQL}, 1) AS p FROM documents)
SELECT d.doc_id, coalesce(x.n_tokens, 0) AS n_tokens, coalesce(x.ids, '') AS ids
FROM documents d LEFT JOIN (
  SELECT t.doc_id, count(*) AS n_tokens, string_agg(CAST(v.id AS VARCHAR), ',' ORDER BY t.p) AS ids
  FROM t JOIN v ON v.token = t.token GROUP BY t.doc_id) x ON x.doc_id = d.doc_id""")
def q_tokenize_vocab(spark, d):
    docs = fx.table(spark, d, "documents")
    v = tokens.build_vocab(docs, "text")
    t = tokens.tokenize_with_vocab(docs.select("doc_id", "text"), "doc_id", "text", v, out="ids")
    return t.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), _ids(F.col("ids")).alias("ids"))


@query("sliding_windows", f"""
SELECT doc_id, CAST(w AS INTEGER) AS window_no, array_to_string(toks[w * 64 + 1 : w * 64 + 128], ' ') AS text
FROM (SELECT doc_id, {_TOK_SQL} AS toks FROM documents),
     unnest(range(0, {O.window_count_sql('len(toks)', 128, 64)})) AS r(w)""")
def q_sliding_windows(spark, d):
    return tokens.sliding_windows(fx.table(spark, d, "documents"), "doc_id", "text", 128, 64)


@query("pad_truncate", f"""
SELECT doc_id,
       array_to_string(list_concat(ids[1:{K.PAD_LEN}], list_transform(range(greatest({K.PAD_LEN} - len(ids[1:{K.PAD_LEN}]), 0)), lambda x: {K.PAD_ID})), ',') AS ids,
       len(ids[1:{K.PAD_LEN}]) AS mask_sum
FROM (SELECT doc_id, {_IDS_SQL} AS ids FROM documents)""")
def q_pad_truncate(spark, d):
    t = tokens.tokenize(fx.table(spark, d, "documents"), "text", "ids")
    ids, mask = tokens.pad_truncate(F.col("ids"), K.PAD_LEN)
    return t.select("doc_id", _ids(ids).alias("ids"),
                    F.aggregate(mask, F.lit(0), lambda a, x: a + x).cast("long").alias("mask_sum"))


_TQ_IDS = f"list_transform({O.word_tokens_sql('Question')}, lambda t: {_hid_sql('t')})"


@query("pad_batch", O.with_([("qa_tq", O.QA_TQ)], f"""
SELECT idx, batch, width, array_to_string(list_concat(ids, list_transform(range(width - len(ids)), lambda x: {K.PAD_ID})), ',') AS ids
FROM (SELECT idx, pos // 8 AS batch, ids, max(len(ids)) OVER (PARTITION BY pos // 8) AS width
      FROM (SELECT idx, pos, {_TQ_IDS} AS ids FROM qa_tq))"""))
def q_pad_batch(spark, d):
    t = tokens.tokenize(fx.qa_tq(spark, d), "Question", "ids").withColumn("batch", (F.col("pos") / 8).cast("long"))
    p = tokens.pad_batch(t, "batch", "ids")
    return p.select("idx", "batch", F.size("ids").cast("long").alias("width"), _ids(F.col("ids")).alias("ids"))


W_PACK = K.PACK_LEN + 1

PACK_CTES = [
    ("docs", f"""
  SELECT doc_id, {O.h60("'42:' || doc_id")} AS k, list_append({_IDS_SQL}, {K.EOS_ID}) AS ids FROM documents"""),
    ("off", """
  SELECT *, CAST(sum(len(ids)) OVER (ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                 - len(ids) AS BIGINT) AS st
  FROM docs"""),
    ("pieces", f"""
  SELECT c AS chunk_id, greatest(c * {W_PACK}, st) AS pstart,
         ids[greatest(c * {W_PACK}, st) - st + 1 : least((c + 1) * {W_PACK}, st + len(ids)) - st] AS piece
  FROM off, unnest(range(st // {W_PACK}, (st + len(ids) - 1) // {W_PACK} + 1)) AS r(c)"""),
    ("chunks", """
  SELECT chunk_id, flatten(list(piece ORDER BY pstart)) AS seq FROM pieces GROUP BY chunk_id"""),
    ("pk", f"SELECT chunk_id, seq FROM chunks WHERE len(seq) = {W_PACK}"),
]

PACK_SQL = O.with_(PACK_CTES, f"""
SELECT chunk_id, array_to_string(seq[1:{K.PACK_LEN}], ',') AS input_ids,
       array_to_string(seq[2:{W_PACK}], ',') AS labels
FROM pk""")


def _packed(spark, d):
    docs = fx.table(spark, d, "documents")
    t = docs.select("doc_id", tokens.word_tokens(F.col("text")).alias("toks"), seeded_key(["doc_id"], 42).alias("k"))
    return tokens.pack_sequences(t, "toks", "k", id_fn=tokens.hashed_id, tie=["doc_id"])


@query("token_offsets", O.with_(PACK_CTES[:2], "SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_tokens, st AS start FROM off"))
def q_token_offsets(spark, d):
    """Start of every document (its words + EOS) on the global token axis in
    seeded order: the running offset packing cuts."""
    return _offsets(spark, d).select("doc_id", F.col("_len").alias("n_tokens"), "start")


def _offsets(spark, d):
    t = fx.table(spark, d, "documents").select("doc_id", F.size(tokens.word_tokens(F.col("text"))).alias("n"),
                                               seeded_key(["doc_id"], 42).alias("k"))
    return tokens.token_offsets(t, "k", F.col("n") + 1, tie=["doc_id"])


@query("pack_sequences", PACK_SQL)
def q_pack_sequences(spark, d):
    p = _packed(spark, d)
    return p.select("chunk_id", _ids(F.col("input_ids")).alias("input_ids"), _ids(F.col("labels")).alias("labels"))


def _batch_sql(size: int) -> str:
    return O.with_(PACK_CTES, f"""
SELECT chunk_id // {size} AS batch, string_agg(CAST(chunk_id AS VARCHAR), ',' ORDER BY chunk_id) AS members,
       count(*) AS n_rows,
       string_agg(array_to_string(seq[1:{K.PACK_LEN}], ','), '|' ORDER BY chunk_id) AS input_ids,
       string_agg(array_to_string(seq[2:{W_PACK}], ','), '|' ORDER BY chunk_id) AS labels
FROM pk GROUP BY chunk_id // {size}""")


def _batches(spark, d, size):
    def rows(c):
        return F.array_join(F.transform(c, lambda x: F.array_join(x.cast("array<string>"), ",")), "|")
    b = tokens.batches(_packed(spark, d), size)
    return b.select("batch", F.array_join(F.col("members").cast("array<string>"), ",").alias("members"), "n_rows",
                    rows(F.col("input_ids")).alias("input_ids"), rows(F.col("labels")).alias("labels"))


@query("batch_plan", _batch_sql(K.BATCH_SIZE))
def q_batch_plan(spark, d):
    """Batches of 8 chunks with stacked ids and labels."""
    return _batches(spark, d, K.BATCH_SIZE)


@query("batch_plan_grid", _batch_sql(4))
def q_batch_plan_grid(spark, d):
    """Batches of 4 chunks, as the grid runner uses them."""
    return _batches(spark, d, 4)


@query("step_plan", O.with_(PACK_CTES + [("b", """SELECT DISTINCT chunk_id // 8 AS batch FROM pk"""), ("n", "SELECT count(*) AS nb FROM b")], """
SELECT CAST(e AS INTEGER) AS epoch, batch, 4 AS accum, batch % 4 = 0 AS is_update,
       CAST(e * ((nb + 3) // 4) + (batch + 3) // 4 AS BIGINT) AS update_step,
       CAST(nb * 3 // 4 AS BIGINT) AS total_steps, CAST(nb * 3 // 4 // 10 AS BIGINT) AS warmup_steps
FROM b, n, unnest(range(0, 3)) AS r(e)"""))
def q_step_plan(spark, d):
    return tokens.step_plan(tokens.batch_ids(_offsets(spark, d), K.BATCH_SIZE), K.BATCH_SIZE, K.EPOCHS)


_EXAMPLE_SQL = "prompt || CASE WHEN ends_with(answer, '</s>') THEN answer ELSE answer || '</s>' END"
_MODEL_SQL = "CASE family WHEN 'gemma' THEN 'GEMMA' ELSE 'Llama' END"
_CONTEXT_SQL = ("CASE context_kind WHEN 'relevant_context' THEN 'rel_context' WHEN 'wrong_date_context' "
                "THEN 'WD_context' ELSE context_kind END")


@query("pack_variants", O.with_(O.base_ctes("corpus") + [("matrix", MATRIX_SQL), ("ex", f"""
  SELECT type, {_MODEL_SQL} AS model, {_CONTEXT_SQL} AS context, idx, {O.h60(f"'{K.SPLIT_SEED}:' || idx")} AS k,
         list_append(list_transform({O.word_tokens_sql(_EXAMPLE_SQL)}, lambda t: {_hid_sql('t')}), {K.EOS_ID}) AS ids
  FROM matrix WHERE type IN ('train', 'dev')"""), ("voff", """
  SELECT *, CAST(sum(len(ids)) OVER (PARTITION BY type, model, context ORDER BY k, idx
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - len(ids) AS BIGINT) AS st FROM ex"""),
    ("vpieces", f"""
  SELECT type, model, context, c AS chunk_id, greatest(c * {W_PACK}, st) AS pstart,
         ids[greatest(c * {W_PACK}, st) - st + 1 : least((c + 1) * {W_PACK}, st + len(ids)) - st] AS piece
  FROM voff, unnest(range(st // {W_PACK}, (st + len(ids) - 1) // {W_PACK} + 1)) AS r(c)"""),
    ("vchunks", """
  SELECT type, model, context, chunk_id, flatten(list(piece ORDER BY pstart)) AS seq
  FROM vpieces GROUP BY type, model, context, chunk_id""")], f"""
SELECT type, model, context, chunk_id, md5(array_to_string(seq[1:{K.PACK_LEN}], ',')) AS input_md5,
       md5(array_to_string(seq[2:{W_PACK}], ',')) AS labels_md5
FROM vchunks WHERE len(seq) = {W_PACK}"""))
def q_pack_variants(spark, d):
    """Every packed sequence of every (split, model, context) variant, by the md5 of its ids."""
    p = _variants(spark, d)
    return p.select("type", "model", "context", "chunk_id", F.md5(_ids(F.col("input_ids"))).alias("input_md5"),
                    F.md5(_ids(F.col("labels"))).alias("labels_md5"))


def _named(m):
    """(model, context) columns of the prompt matrix in the grid's naming."""
    from .jobs import FAMILY_NAME, KIND_NAME
    names = [F.element_at(F.create_map(*[x for k, v in n.items() for x in (F.lit(k), F.lit(v))]), F.col(c))
             for n, c in ((FAMILY_NAME, "family"), (KIND_NAME, "context_kind"))]
    return m.withColumns({"model": names[0], "context": names[1]})


def _variants(spark, d):
    from .jobs import pack_corpus
    stored = C.prepared(spark, d, types=("train", "dev"))
    packed = pack_corpus(stored)  # from tables of its own
    discard(stored)
    return packed


# ------------------------------------------------------------------- scores

PRED_CTE = [("pred_windows", O.PRED_WINDOWS)]
MEANS_SQL = """
SELECT idx, arg_max(label, window_no) AS label, count(*) AS n_windows,
       avg(logits[1]) AS m0, avg(logits[2]) AS m1
FROM pred_windows GROUP BY idx"""


@query("window_logit_mean", O.with_(PRED_CTE + [("means", MEANS_SQL)], """
SELECT idx, label, n_windows, m0 AS mean0, m1 AS mean1 FROM means"""))
def q_window_logit_mean(spark, d):
    m = evaluate.window_logit_mean(fx.pred_windows(spark, d), 2)
    return m.select("idx", "label", "n_windows", F.col("mean_logits")[0].alias("mean0"),
                    F.col("mean_logits")[1].alias("mean1"))


@query("argmax_class", O.with_(PRED_CTE + [("means", MEANS_SQL)], """
SELECT idx, CASE WHEN m1 > m0 THEN 1 ELSE 0 END AS pred FROM means"""))
def q_argmax_class(spark, d):
    m = evaluate.with_prediction(evaluate.window_logit_mean(fx.pred_windows(spark, d), 2))
    return m.select("idx", "pred")


F1_SQL = """
WITH pr AS (SELECT label, CASE WHEN m1 > m0 THEN 1 ELSE 0 END AS pred FROM means),
cls AS (SELECT c, sum(tp) AS tp, sum(a) AS actual, sum(p) AS predicted FROM (
          SELECT label AS c, CASE WHEN label = pred THEN 1 ELSE 0 END AS tp, 1 AS a, 0 AS p FROM pr
          UNION ALL SELECT pred, 0, 0, 1 FROM pr) GROUP BY c),
f AS (SELECT c, tp, actual, CASE WHEN actual + predicted = 0 THEN 0.0 ELSE 2.0 * tp / (actual + predicted) END AS f1 FROM cls)
SELECT round(coalesce(max(f1) FILTER (WHERE c = 1), 0.0), 6) AS f1_binary, round(avg(f1), 6) AS f1_macro,
       round(sum(tp) / sum(actual), 6) AS accuracy, CAST(sum(actual) AS BIGINT) AS n FROM f"""


@query("f1_scores", O.with_(PRED_CTE + [("means", MEANS_SQL)], F1_SQL.replace("WITH pr AS", "SELECT * FROM (WITH pr AS") + ")"))
def q_f1_scores(spark, d):
    m = evaluate.with_prediction(evaluate.window_logit_mean(fx.pred_windows(spark, d), 2))
    f = evaluate.f1_scores(m)
    return f.select(_r6(F.col("f1_binary")).alias("f1_binary"), _r6(F.col("f1_macro")).alias("f1_macro"),
                    _r6(F.col("accuracy")).alias("accuracy"), F.col("n").cast("long").alias("n"))


_CE_ROW = """(list_max(e) + ln(list_sum(list_transform(e, lambda x: exp(x - list_max(e))))) - e[label + 1])"""


@query("cross_entropy", f"""
SELECT round(avg({_CE_ROW}), 6) AS loss, count(*) AS n_tokens
FROM (SELECT CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings WHERE label <> -100)""")
def q_cross_entropy(spark, d):
    e = fx.table(spark, d, "embeddings").select(F.col("embedding").cast("array<double>").alias("logits"), "label")
    c = evaluate.cross_entropy(e)
    return c.select(_r6(F.col("loss")).alias("loss"), "n_tokens")


@query("validation_loss", f"""
SELECT round(avg(bm), 6) AS mean_of_batch_means, round(arg_max(bm, batch), 6) AS last_batch_loss, count(*) AS n_batches
FROM (SELECT vec_id // 8 AS batch, avg({_CE_ROW}) AS bm
      FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings) GROUP BY vec_id // 8)""")
def q_validation_loss(spark, d):
    e = fx.table(spark, d, "embeddings")
    e = e.select((F.col("vec_id") / 8).cast("long").alias("batch"),
                 F.col("embedding").cast("array<double>").alias("lg"), "label")
    e = e.withColumn("_mx", F.array_max("lg")).select(
        "batch", evaluate.token_cross_entropy(F.col("lg"), F.col("label"), F.col("_mx")).alias("loss"))
    v = evaluate.validation_loss(e)
    return v.select(_r6(F.col("mean_of_batch_means")).alias("mean_of_batch_means"),
                    _r6(F.col("last_batch_loss")).alias("last_batch_loss"), "n_batches")


@query("answer_leak", """
SELECT b.item_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)""")
def q_answer_leak(spark, d):
    return evaluate.benchmark_leak(fx.table(spark, d, "benchmark"), fx.table(spark, d, "documents"))


_SHORT_ITEMS = """
SELECT item_id * 4 + n AS item_id, CASE n WHEN 0 THEN '' ELSE array_to_string(w[1:[1, 2, 4][n]], ' ') END AS text
FROM (SELECT item_id, {w} AS w FROM benchmark), unnest(range(0, 4)) AS r(n)"""


@query("answer_leak_short", O.with_([("items", _SHORT_ITEMS.replace("{w}", O.word_tokens_sql("text")))], """
SELECT i.item_id, d.doc_id FROM items i JOIN documents d ON contains(d.text, i.text)"""))
def q_answer_leak_short(spark, d):
    """Blank, one-, two- and four-word items (the first words of every benchmark item)."""
    w = fx.table(spark, d, "benchmark").select("item_id", tokens.word_tokens(F.col("text")).alias("w"))
    n = F.explode(F.array(*[F.struct(F.lit(i).alias("n"), F.lit(k).alias("k")) for i, k in enumerate((0, 1, 2, 4))]))
    items = w.select("item_id", "w", n.alias("c")).select(
        (F.col("item_id") * 4 + F.col("c.n")).alias("item_id"),
        F.array_join(F.slice("w", F.lit(1), F.col("c.k")), " ").alias("text"))
    return evaluate.benchmark_leak(items, fx.table(spark, d, "documents"))


def _norm_sql(x: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{M}}\\p{{N}}\\s]', ' ', 'g'), "
            f"'\\s+', ' ', 'g'))")


def _any_sql(golds: str, pred: str) -> str:
    return f"""
SELECT idx, len(list_filter(g, lambda x: x = p)) > 0 AS exact,
       len(list_filter(g, lambda x: instr(p, x) > 0)) > 0 AS contains
FROM (SELECT idx, coalesce({_norm_sql(pred)}, '') AS p,
             list_filter(list_transform({golds}, lambda a: {_norm_sql('a')}), lambda a: a <> '') AS g FROM stacked)"""


@query("score_answers", O.with_(O.base_ctes("stacked"), _any_sql("[answer]", "relevant_context")))
def q_score_answers(spark, d):
    s = evaluate.score_answers(C.stacked(spark, d), pred="relevant_context", gold="answer")
    return s.select("idx", "exact", "contains")


@query("score_answers_any", O.with_(O.base_ctes("stacked"), _any_sql(
    "[answer, split_part(answer, ' ', 1), question, '?!']", "split_part(relevant_context, '.', 1)")))
def q_score_answers_any(spark, d):
    """Any of several gold answers (one of them only punctuation) against the first sentence."""
    s = C.stacked(spark, d).withColumn("pred", F.substring_index("relevant_context", ".", 1)).withColumn(
        "answers", F.array("answer", F.split_part("answer", F.lit(" "), F.lit(1)), "question", F.lit("?!")))
    return evaluate.score_answers(s, pred="pred", gold="answers").select("idx", "exact", "contains")


@query("scoreboard", O.with_(PRED_CTE + [("means", MEANS_SQL)], """
SELECT coalesce(lang, 'ALL') AS lang, coalesce(source, 'ALL') AS source, count(*) AS n,
       CAST(sum(CASE WHEN label = CASE WHEN m1 > m0 THEN 1 ELSE 0 END THEN 1 ELSE 0 END) AS BIGINT) AS correct,
       round(sum(CASE WHEN label = CASE WHEN m1 > m0 THEN 1 ELSE 0 END THEN 1 ELSE 0 END) / count(*), 6) AS accuracy
FROM means m JOIN documents d ON d.doc_id = m.idx
GROUP BY CUBE (lang, source)"""))
def q_scoreboard(spark, d):
    m = evaluate.with_prediction(evaluate.window_logit_mean(fx.pred_windows(spark, d), 2))
    docs = fx.table(spark, d, "documents").select(F.col("doc_id").alias("idx"), "lang", "source")
    s = evaluate.scoreboard(m.join(docs, "idx"), ["lang", "source"])
    return s.select(F.coalesce("lang", F.lit("ALL")).alias("lang"), F.coalesce("source", F.lit("ALL")).alias("source"),
                    "n", F.col("correct").cast("long").alias("correct"), _r6(F.col("accuracy")).alias("accuracy"))


def _grid_pred_sql() -> str:
    return f"""
SELECT m.idx, m.label, g.model, g.context,
       CAST({O.h60("'pred:' || g.model || ':' || g.context || ':' || m.idx")} % 2 AS INTEGER) AS pred
FROM means m, ({_grid_sql()}) g"""


def _grid_sql() -> str:
    rows = []
    for m in K.GRID_MODELS:
        for c in K.GRID_CONTEXTS:
            rows.append(f"SELECT '{m}' AS model, '{c}' AS context")
    return " UNION ALL ".join(rows)


@query("scoreboard_grid", O.with_(PRED_CTE + [("means", MEANS_SQL), ("pr", _grid_pred_sql())], """
SELECT coalesce(model, 'ALL') AS model, coalesce(context, 'ALL') AS context, coalesce(source, 'ALL') AS source,
       count(*) AS n, CAST(sum(CASE WHEN label = pred THEN 1 ELSE 0 END) AS BIGINT) AS correct,
       round(sum(CASE WHEN label = pred THEN 1 ELSE 0 END) / count(*), 6) AS accuracy
FROM pr JOIN documents d ON d.doc_id = pr.idx GROUP BY CUBE (model, context, source)"""))
def q_scoreboard_grid(spark, d):
    """Accuracy by model x context x source over derived predictions of every grid cell."""
    m = evaluate.window_logit_mean(fx.pred_windows(spark, d), 2).select("idx", "label")
    cell = F.explode(F.array(*[F.struct(F.lit(a).alias("model"), F.lit(b).alias("context"))
                               for a in K.GRID_MODELS for b in K.GRID_CONTEXTS]))
    m = m.select("idx", "label", cell.alias("c")).select("idx", "label", "c.model", "c.context")
    pred = F.pmod(hash60(F.lit("pred"), F.col("model"), F.col("context"), F.col("idx")), F.lit(2)).cast("int")
    docs = fx.table(spark, d, "documents").select(F.col("doc_id").alias("idx"), "source")
    s = evaluate.scoreboard(m.withColumn("pred", pred).join(docs, "idx"), ["model", "context", "source"])
    return s.select(*[F.coalesce(c, F.lit("ALL")).alias(c) for c in ("model", "context", "source")], "n",
                    F.col("correct").cast("long").alias("correct"), _r6(F.col("accuracy")).alias("accuracy"))


# --------------------------------------------------------------------- grid

@query("experiment_grid", O.with_(O.base_ctes("corpus") + [("matrix", MATRIX_SQL)], f"""
, files AS (
  SELECT CASE WHEN type = 'train' THEN 'train/train_' ELSE 'dev/packed/dev_' END
           || CASE family WHEN 'gemma' THEN 'GEMMA' ELSE 'Llama' END || '_'
           || CASE context_kind WHEN 'relevant_context' THEN 'rel_context' WHEN 'wrong_date_context' THEN 'WD_context'
                                ELSE context_kind END || '_packed.jsonl' AS path
  FROM matrix WHERE type IN ('train', 'dev')
  GROUP BY type, family, context_kind
  HAVING sum(len({O.word_tokens_sql(_EXAMPLE_SQL)}) + 1) >= {W_PACK}),
g AS ({_grid_sql()})
SELECT g.model, g.context,
       'train/train_' || g.model || '_' || g.context || '_packed.jsonl' AS train_path,
       'dev/packed/dev_' || g.model || '_' || g.context || '_packed.jsonl' AS eval_path,
       CASE g.model WHEN 'GEMMA' THEN '{K.MODEL_PATHS["GEMMA"]}' ELSE '{K.MODEL_PATHS["Llama"]}' END AS model_id,
       CASE WHEN t.path IS NOT NULL AND e.path IS NOT NULL THEN 'ready' ELSE 'missing' END AS status
FROM g LEFT JOIN files t ON t.path = 'train/train_' || g.model || '_' || g.context || '_packed.jsonl'
       LEFT JOIN files e ON e.path = 'dev/packed/dev_' || g.model || '_' || g.context || '_packed.jsonl'
""".replace("\n, files AS", "SELECT * FROM (WITH files AS", 1) + ")"))
def q_experiment_grid(spark, d):
    m = _named(prompts.examples(prompts.prompt_matrix(C.corpus(spark, d, types=("train", "dev")))))
    path = F.concat(F.when(F.col("type") == "train", "train/train_").otherwise("dev/packed/dev_"),
                    F.col("model"), F.lit("_"), F.col("context"), F.lit("_packed.jsonl"))
    ntok = F.size(tokens.word_tokens(F.col("example"))) + 1
    files = (m.groupBy(path.alias("path")).agg(F.sum(ntok).alias("_t")).where(F.col("_t") >= W_PACK).select("path"))
    g = grid.runnable_grid(spark.range(1), files)
    return g.select("model", "context", "train_path", "eval_path", "model_id", "status")


# ------------------------------------------------- written and read back again

@query("dataset_written", O.with_(O.base_ctes("split"), """
SELECT type AS split, count(*) AS n_rows, CAST(sum(length(relevant_context)) AS BIGINT) AS context_chars,
       count(DISTINCT source) AS n_sources, true AS files_hold_all, 5::BIGINT AS n_preview
FROM split GROUP BY type"""))
def q_dataset_written(spark, d):
    """The split as a dataset directory, seen through its written manifest."""
    path = shared_path(spark, "dataset")
    writers.write_dataset(C.split(spark, d), path, "temporal_qa", metadata={"seed": str(K.SPLIT_SEED)})
    m = spark.read.schema("manifest STRING").json(f"{path}/_manifest").select(F.from_json(
        "manifest", "splits ARRAY<STRUCT<split: STRING, n_rows: BIGINT, context_chars: BIGINT, n_sources: BIGINT>>, "
                    "files ARRAY<STRUCT<file: STRING, n_rows: BIGINT>>, preview ARRAY<STRUCT<idx: STRING>>").alias("m"))
    in_files = F.aggregate("m.files", F.lit(0).cast("bigint"), lambda a, f: a + f["n_rows"])
    in_splits = F.aggregate("m.splits", F.lit(0).cast("bigint"), lambda a, f: a + f["n_rows"])
    return m.select(F.explode("m.splits").alias("s"), (in_files == in_splits).alias("files_hold_all"),
                    F.size(F.filter("m.preview", lambda r: r["idx"].isNotNull())).cast("bigint").alias("n_preview")) \
        .select("s.split", "s.n_rows", "s.context_chars", "s.n_sources", "files_hold_all", "n_preview")


@query("qa_csv_roundtrip", O.with_([("qa_hard", O.QA_HARD)], """
SELECT question AS Question, context AS Answer FROM qa_hard"""))
def q_qa_csv_roundtrip(spark, d):
    """Questions and multi-line texts as CSV, read by many tasks a file."""
    path = shared_path(spark, "qa-csv")
    q = fx.qa_hard(spark, d).select(F.col("question").alias("Question"), F.col("context").alias("Answer"))
    q.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return csv_split.read_csv(spark, path, readers.QA_CSV_SCHEMA)


@query("split_files_roundtrip", O.with_(O.base_ctes("split"), f"""
SELECT pos, idx, question, answer, nullif(relevant_context, '') AS relevant_context, source, type FROM (
  SELECT *, row_number() OVER (PARTITION BY type ORDER BY {O.h60(f"'{K.SPLIT_SEED}:' || idx")}, idx) - 1 AS pos
  FROM split)"""))
def q_split_files_roundtrip(spark, d):
    """CSV split files with a leading position, read back with all splits (an
    empty text is a missing value in CSV)."""
    path = shared_path(spark, "splits")
    c = C.split(spark, d, keep_order=True)
    c = global_index(c, ["order_key", "idx"], by=["type"], bucket=F.col("order_bucket"), pos="pos")
    writers.write_splits(c.select("idx", "question", "answer", "relevant_context", "source", "type", "pos"), path,
                         fmt="csv", index_col="pos")
    schema = "_c0 BIGINT, idx STRING, question STRING, answer STRING, relevant_context STRING, source STRING, type STRING"
    return readers.read_indexed_csv(spark, path, schema, many_tasks=True)


@query("tsqa_jsonl_roundtrip", O.with_([("qa_easy", O.QA_EASY)], """
SELECT idx, question, context, targets AS answer, 2::INTEGER AS n_targets FROM qa_easy"""))
def q_tsqa_jsonl_roundtrip(spark, d):
    path = shared_path(spark, "tsqa")
    q = fx.qa_easy(spark, d).withColumn("targets", F.array("targets", F.lit("another answer")))
    writers.write_jsonl(q, path)
    t = readers.read_tsqa(spark, path)
    return t.select("idx", "question", "context", "answer", F.size("targets").alias("n_targets"))


@query("packed_jsonl_roundtrip", O.with_(PACK_CTES, f"""
SELECT md5(array_to_string(seq[1:{K.PACK_LEN}], ',')) AS input_md5, md5(array_to_string(seq[2:{W_PACK}], ',')) AS labels_md5
FROM pk"""))
def q_packed_jsonl_roundtrip(spark, d):
    path = shared_path(spark, "packed")
    writers.write_jsonl(_packed(spark, d).select("input_ids", "labels"), path)
    p = readers.read_packed(spark, path)
    return p.select(F.md5(_ids(F.col("input_ids"))).alias("input_md5"), F.md5(_ids(F.col("labels"))).alias("labels_md5"))


# ------------------------------------------------- dates that have no year

_DAY_SQL = """
SELECT o_orderkey AS k, 'Ready ' || strftime(o_orderdate, '%B %-d') || ', sent ' || strftime(o_orderdate, '%-d %B')
  || ' to ' || strftime(o_orderdate + INTERVAL 40 DAY, '%-d %B %Y') || '; open ' || strftime(o_orderdate, '%B %-d')
  || ' to 28, ' || year(o_orderdate) || ' and in ' || strftime(o_orderdate, '%B') || ' again.' AS t FROM orders"""


def _day_texts(spark, d):
    at, later = F.col("o_orderdate"), F.col("o_orderdate") + F.expr("INTERVAL 40 DAYS")
    return fx.table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.concat(
        F.lit("Ready "), F.date_format(at, "MMMM d"), F.lit(", sent "), F.date_format(at, "d MMMM"), F.lit(" to "),
        F.date_format(later, "d MMMM yyyy"), F.lit("; open "), F.date_format(at, "MMMM d"), F.lit(" to 28, "),
        F.year(at), F.lit(" and in "), F.date_format(at, "MMMM"), F.lit(" again.")).alias("t"))


@query("extract_day_dates", O.with_([("x", _DAY_SQL)], f"""
SELECT k, array_to_string({O.mentions_sql('t')}, '|') AS dates,
       array_to_string(regexp_extract_all(t, '{D.DATE_RX_WITH_BARE_MONTH.replace("'", "''")}', 0), '|') AS with_months
FROM x"""))
def q_extract_day_dates(spark, d):
    """Days without a year, day ranges, and bare months with the wider pattern."""
    x = _day_texts(spark, d)
    return x.select("k", F.array_join(D.extract_mentions(F.col("t")), "|").alias("dates"),
                    F.array_join(D.extract_mentions(F.col("t"), D.DATE_RX_WITH_BARE_MONTH), "|").alias("with_months"))


@query("falsify_day_dates", O.with_([("x", _DAY_SQL)], f"""
SELECT k, {O.falsify_sql('t', 'CAST(k AS VARCHAR)')} AS wrong FROM x"""))
def q_falsify_day_dates(spark, d):
    x = dops.falsify_dates(_day_texts(spark, d).withColumn("key", F.col("k").cast("string")), "t", "key", out="wrong")
    return x.select("k", "wrong")
