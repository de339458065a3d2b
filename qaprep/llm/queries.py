"""Registered queries of the training-data operators and their DuckDB oracles.

``opN_<name>`` applies operator N with production parameters to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (decontaminate, html_text, language, packing, prefix_trie, quality_rules, quality_sites, repeats,
               secret_scan, simhash, spelling, toxicity, warc)
from .shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


@query("op1_toxicity")
def op1_toxicity(spark, d):
    """Toxicity score of every document."""
    return toxicity.score_documents(table(spark, d, "documents"), table(spark, d, "labels"))


_LINES = "list_filter(string_split(t, chr(10)), lambda s: regexp_matches(s, '[^\\x20\\x09-\\x0D]'))"


@query("op2_quality_rules", f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, {_LINES} AS lines FROM d),
g AS (SELECT rid, s, array_to_string(w[s:s + 4], ' ') AS g
      FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS s FROM w WHERE len(w) >= 5)),
dup AS (SELECT rid, s FROM (SELECT rid, s, count(*) OVER (PARTITION BY rid, g) AS n FROM g) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(s, s + 5)) AS p FROM dup) GROUP BY rid),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
  len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
  len(list_filter(lines, lambda s: regexp_matches(s, '^[\\x20\\x09]*[-*\\x{{2022}}]'))) AS n_bullet_lines,
  len(list_filter(lines, lambda s: regexp_matches(s, '(\\.\\.\\.|\\x{{2026}})[\\x20\\x09\\x0D]*$'))) AS n_ellipsis_lines,
  CASE WHEN 2 * length(regexp_replace(array_to_string(w, ''), '{quality_rules.LISTED}', '', 'g')) > length(array_to_string(w, ''))
  THEN len(w) ELSE len(list_filter(w, lambda x: x IN ({', '.join(repr(s) for s in quality_rules.STOP_FORMS)}))) END AS n_stop_words,
  coalesce(rep.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN rep USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND {quality_rules.rules_sql()} AS kept
FROM m""")
def op2_quality_rules(spark, d):
    """Quality rules of every document."""
    return quality_rules.apply_rules(table(spark, d, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op3_html_text")
def op3_html_text(spark, d):
    """Main text of every page."""
    return html_text.extract(table(spark, d, "pages")).select("page_id", "url", "text", "n_chars")


@query("op4_simhash")
def op4_simhash(spark, d):
    """SimHash components of all documents."""
    return simhash.simhash_groups(table(spark, d, "documents"))


@query("op5_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT html, min(page_id) AS first FROM p WHERE octet_length(encode(html)) >= 100 GROUP BY html)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (html)""")
def op5_warc(spark, d):
    """All pages written as WARC archives and read back."""
    return warc.round_trip(spark, table(spark, d, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op6_language")
def op6_language(spark, d):
    """Language of every document."""
    return language.language_of_documents(table(spark, d, "documents"))


@query("op7_suffix_dedup")
def op7_suffix_dedup(spark, d):
    """Bytes of all documents that repeated 200-byte strings cover."""
    return repeats.deduplicate(table(spark, d, "documents")).drop("spans", "kept_text")


@query("op8_packing")
def op8_packing(spark, d):
    """Pieces of all documents in windows of 2048 tokens."""
    return packing.pack_documents(table(spark, d, "documents"))


@query("op10_quality_sites")
def op10_quality_sites(spark, d):
    """Quality of every document by its text, source and language section."""
    return quality_sites.score_documents(table(spark, d, "documents"), table(spark, d, "labels"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', " \
         r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op9_decontaminate", f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item_id, array_to_string(w[s:s + 12], ' ') AS win, least(len(w), 13) AS n
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
spots AS (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n),
hits AS (SELECT rid, s, win.n, item_id FROM spots JOIN win
         ON win.n = spots.n AND win.win = array_to_string(w[s:s + spots.n - 1], ' ')),
per AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM hits) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hits) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN per USING (rid) LEFT JOIN its USING (rid)""")
def op9_decontaminate(spark, d):
    """Benchmark windows found in all documents."""
    return decontaminate.contamination(table(spark, d, "documents"), table(spark, d, "benchmark")) \
        .drop("spans", "items")


def crc32_sql(bytes_list: str) -> str:
    """crc32 of a list of byte values, bit by bit."""
    step = "lambda s, i: xor(s >> 1, 3988292384 * (s & 1))"
    byte = f"lambda s, b: list_reduce(range(1, 9), {step}, xor(s, b))"
    return f"xor(list_reduce({bytes_list}, {byte}, 4294967295), 4294967295)"


@query("op11_prefix_trie", f"""
WITH c AS (SELECT conv_id, list(coalesce(role, '') || chr(1) || coalesce(text, '') ORDER BY turn NULLS FIRST) AS own
           FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hd AS (SELECT *, {crc32_sql("list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)")} % 4 AS h FROM c),
b AS (SELECT hd.conv_id, list_concat(coalesce(base.own, [])[1:h], hd.own[h + 1:]) AS turns
      FROM hd LEFT JOIN c base ON base.conv_id = hd.conv_id - hd.conv_id % 20),
k AS (SELECT conv_id, len(turns) AS len, turns, list_transform(turns, lambda x: md5(x)) AS m FROM b),
pre AS (SELECT conv_id, len, d, array_to_string(m[1:d], '') AS node, array_to_string(m[1:d - 1], '') AS above,
               CASE WHEN d > 0 THEN len(regexp_extract_all(split_part(turns[d], chr(1), 2), '[^\\x20\\x09-\\x0D]+')) END AS w
        FROM (SELECT *, unnest(range(0, len + 1)) AS d FROM k)),
n AS (SELECT d, node, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(any_value(w), 0) AS w,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len = d), '')) AS ends_sha256
      FROM pre GROUP BY d, node),
kids AS (SELECT d - 1 AS d, above AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
below AS (SELECT p.node, p.d, count(*) FILTER (kids.node IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.w) AS saved
          FROM n JOIN pre q ON q.node = n.node AND q.d = n.d AND q.conv_id = n.conv_id
          JOIN pre p ON p.conv_id = q.conv_id AND p.d <= q.d LEFT JOIN kids ON kids.node = n.node AND kids.d = n.d
          GROUP BY p.node, p.d)
SELECT n.conv_id, n.d::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, saved::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN below USING (d, node) LEFT JOIN kids USING (d, node) LEFT JOIN n up ON up.d = n.d - 1 AND up.node = n.above""")
def op11_prefix_trie(spark, d):
    """Trie of the turns of all rebuilt conversations."""
    return prefix_trie.prefix_trie(table(spark, d, "conversations"))


@query("op12_secrets")
def op12_secrets(spark, d):
    """Secrets of every document, weak ones where they complete each other."""
    return secret_scan.report(table(spark, d, "documents"))


@query("op13_spelling", f"""
WITH RECURSIVE runs AS (SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
occ AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL),
byt AS (SELECT *, coalesce(doc_id::VARCHAR, '') || ':' || run AS s FROM occ),
hsh AS (SELECT run, n, {crc32_sql("flatten(list_transform(string_split(s, ''), lambda x: CASE WHEN ord(x) < 128 "
        "THEN [ord(x)::BIGINT] ELSE [192 + ord(x)::BIGINT // 64, 128 + ord(x)::BIGINT % 64] END))")} AS h FROM byt),
cut AS (SELECT CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hsh),
w AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
del AS (SELECT DISTINCT word, n, i, word[:i] || word[i + 2:] AS rest FROM (SELECT *, unnest(range(0, length(word))) AS i FROM w)),
near AS (SELECT a.word, b.word AS near, b.n AS near_n FROM del a JOIN del b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
         UNION SELECT a.word, w.word, w.n FROM del a JOIN w ON w.word = a.rest
         UNION SELECT w.word, a.word, a.n FROM del a JOIN w ON w.word = a.rest),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(m := -near_n, near := near)) AS b FROM near GROUP BY word),
forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.m >= 2 * w.n THEN b.near END AS form,
                 CASE WHEN -b.m >= 2 * w.n THEN -b.m END AS form_n FROM w LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS root FROM forms WHERE form IS NULL
         UNION ALL SELECT f.word, walk.root FROM forms f JOIN walk ON f.form = walk.word)
SELECT word, form, root, n, n_near, form_n::BIGINT AS form_n FROM forms JOIN walk USING (word)""")
def op13_spelling(spark, d):
    """Words of all documents with the words one edit away."""
    return spelling.variants(table(spark, d, "documents"))
