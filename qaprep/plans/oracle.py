"""DuckDB definitions of the derived views and shared SQL expressions.

These mirror ``plans.fixtures`` / ``plans.corpus`` statement by statement
so that every registered Spark query has an independent SQL oracle over
the same parquet tables (pre-registered as views by the checker).
"""

from __future__ import annotations

from ..constants import (DEFAULT_SEED, FALSE_YEAR_MAX, FALSE_YEAR_MIN, MONTHS, SPLIT_SEED)
from ..functions.dates import DATE_RX

MONTHS_SQL = "[" + ", ".join(f"'{m}'" for m in MONTHS) + "]"
RX = DATE_RX.replace("'", "''")


def h60(text_sql: str) -> str:
    """60-bit md5 integer of a SQL text expression."""
    return f"('0x' || substr(md5({text_sql}), 1, 15))::BIGINT"


def with_(ctes: list[tuple[str, str]], select: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS (\n{s}\n)" for n, s in ctes) + "\n" + select


QA_TQ = """
SELECT o_orderkey AS pos,
       'TQ_exp_' || o_orderkey AS idx,
       'When was order ' || o_orderkey || ' placed?' AS Question,
       strftime(o_orderdate, '%B %Y') AS Answer,
       'Order ' || o_orderkey || ' was placed on ' || strftime(o_orderdate, '%B %-d, %Y')
         || ' by customer ' || o_custkey || '. In ' || year(o_orderdate) || ' it had priority '
         || o_orderpriority || ', a scheme in use since the ' || (year(o_orderdate) // 10 * 10) || 's.'
         AS relevant_context
FROM orders"""

QA_EASY = """
SELECT 'easy_' || u.conv_id || '_' || u.turn AS idx, u.text AS question,
       coalesce(p.text, '') AS context, a.text AS targets,
       CAST(u.turn AS VARCHAR) AS "from", CAST(u.turn + 1 AS VARCHAR) AS "end"
FROM conversations u
JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
LEFT JOIN conversations p ON p.conv_id = u.conv_id AND p.turn = u.turn - 1
WHERE u.role = 'user'"""

QA_HARD = """
SELECT 'hard_' || doc_id AS idx, split_part(text, '.', 1) || '?' AS question,
       text AS context, source AS targets,
       CAST(len(string_split(text, chr(10))) AS VARCHAR) AS paragraphs
FROM documents"""

STACKED = """
SELECT idx, Question AS question, Answer AS answer, relevant_context, 'TQ_explicit' AS source FROM qa_tq
UNION ALL SELECT idx, question, targets, context, 'TSQA_easy' FROM qa_easy
UNION ALL SELECT idx, question, targets, context, 'TSQA_hard' FROM qa_hard"""

SPLIT = f"""
SELECT * EXCLUDE (p, n, held, tst),
       CASE WHEN p < n - held THEN 'train' WHEN p < n - tst THEN 'dev' ELSE 'test' END AS type
FROM (
  SELECT *, CAST(ceil(0.5 * held) AS BIGINT) AS tst FROM (
    SELECT *, CAST(ceil(0.3 * n) AS BIGINT) AS held FROM (
      SELECT *, row_number() OVER (PARTITION BY source ORDER BY k, idx) - 1 AS p,
             count(*) OVER (PARTITION BY source) AS n
      FROM (SELECT *, {h60(f"'{SPLIT_SEED}:' || idx")} AS k FROM stacked))))"""


def ring_sql(src: str, col: str, step: int, out: str, by: str = "type", legacy: bool = False) -> str:
    """Cyclic shift in (k, idx) order per group; groups of one row get null."""
    w = f"PARTITION BY {by} ORDER BY k, idx"
    if legacy:
        val = (f"CASE WHEN rn = 1 AND tn = rn THEN {col} WHEN rn = tn THEN NULL "
               f"WHEN rn = 1 THEN lst ELSE nx END")
    elif step == -1:
        val = "CASE WHEN tn = 1 THEN NULL WHEN rn = tn THEN fst ELSE nx END"
    else:
        val = "CASE WHEN tn = 1 THEN NULL WHEN rn = 1 THEN lst ELSE pv END"
    return f"""
SELECT * EXCLUDE (rn, tn, nx, pv, fst, lst), {val} AS {out} FROM (
  SELECT *, row_number() OVER ({w}) AS rn, count(*) OVER (PARTITION BY {by}) AS tn,
         lead({col}) OVER ({w}) AS nx, lag({col}) OVER ({w}) AS pv,
         first_value({col}) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS fst,
         last_value({col}) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS lst
  FROM {src})"""


def fake_mention_sql(m: str, key: str, i0: str, seed=DEFAULT_SEED) -> str:
    h = h60(f"'{seed}:' || {key} || ':' || ({i0}) || ':' || (j - 1)")
    y = "TRY_CAST(p AS INTEGER)"
    fy = (f"CASE WHEN {y} BETWEEN {FALSE_YEAR_MIN} AND {FALSE_YEAR_MAX} "
          f"THEN {FALSE_YEAR_MIN} + ({h} % {FALSE_YEAR_MAX - FALSE_YEAR_MIN}) + "
          f"CASE WHEN {FALSE_YEAR_MIN} + ({h} % {FALSE_YEAR_MAX - FALSE_YEAR_MIN}) >= {y} THEN 1 ELSE 0 END "
          f"ELSE {FALSE_YEAR_MIN} + ({h} % {FALSE_YEAR_MAX - FALSE_YEAR_MIN + 1}) END")
    fm = f"{MONTHS_SQL}[((list_position({MONTHS_SQL}, p) - 1 + 1 + ({h} % 11)) % 12) + 1]"
    part = (f"CASE WHEN list_contains({MONTHS_SQL}, p) THEN {fm} "
            f"WHEN regexp_full_match(p, '[0-9]{{4}}') AND {y} <> 0 THEN CAST({fy} AS VARCHAR) "
            f"ELSE p END")
    return f"array_to_string(list_transform(string_split_regex(trim({m}), '\\s+'), lambda p, j: {part}), ' ')"


def mentions_sql(text: str) -> str:
    return f"regexp_extract_all({text}, '{RX}', 0)"


def falsify_sql(text: str, key: str, seed=DEFAULT_SEED) -> str:
    swaps = (f"list_transform({mentions_sql(text)}, lambda m, i: "
             f"{{'orig': m, 'fake': {fake_mention_sql('m', key, 'i - 1', seed)}}})")
    return f"list_reduce({swaps}, lambda acc, s: replace(acc, s.orig, s.fake), {text})"


CORPUS = f"""
SELECT idx, question, answer, relevant_context, source, type, random_context,
       {falsify_sql('relevant_context', 'idx')} AS wrong_date_context
FROM ({ring_sql('split_k', 'relevant_context', -1, 'random_context')})"""


def base_ctes(upto: str = "corpus") -> list[tuple[str, str]]:
    """CTE chain up to (and including) ``upto``."""
    chain = [("qa_tq", QA_TQ), ("qa_easy", QA_EASY), ("qa_hard", QA_HARD), ("stacked", STACKED),
             ("split", SPLIT),
             ("split_k", f"SELECT *, {h60(f"'{SPLIT_SEED}:' || idx")} AS k FROM split"),
             ("corpus", CORPUS)]
    names = [n for n, _ in chain]
    return chain[: names.index(upto) + 1]


def word_tokens_sql(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '\\s+'), lambda t: t <> '')"


def window_count_sql(n: str, size: int, stride: int) -> str:
    return f"CAST(CASE WHEN {n} <= {size} THEN 1 ELSE ({n} - {size} + {stride} - 1) // {stride} + 1 END AS INTEGER)"


PRED_WINDOWS = f"""
SELECT d.doc_id AS idx, CAST(w.window_no AS INTEGER) AS window_no, l.quality AS label,
       [CAST(({h60("'logit:' || d.doc_id || ':' || w.window_no || ':0'")} % 2001) - 1000 AS DOUBLE),
        CAST(({h60("'logit:' || d.doc_id || ':' || w.window_no || ':1'")} % 2001) - 1000 AS DOUBLE)] AS logits
FROM documents d JOIN labels l ON l.doc_id = d.doc_id,
     unnest(range(0, {window_count_sql(f"len({word_tokens_sql('d.text')})", 128, 64)})) AS w(window_no)"""

INSTRUCTIONS = """
SELECT u.conv_id, u.turn, u.text AS instruction, coalesce(s.system, '') AS input, a.text AS output
FROM conversations u
JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
LEFT JOIN (SELECT conv_id, arg_min(text, turn) AS system FROM conversations WHERE role = 'system'
           GROUP BY conv_id) s ON s.conv_id = u.conv_id
WHERE u.role = 'user'"""

RESPONSES = "SELECT CAST(doc_id AS BIGINT) AS i, text AS output FROM documents"
