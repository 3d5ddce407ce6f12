"""The registered queries of the corpus operators, one per operator, each over
its whole table, and the DuckDB form where SQL can express the operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontam,
    forest_join,
    html_blocks,
    hyperminhash,
    licenses,
    line_dedup,
    mixing,
    outliers,
    pii_crf,
    prefix_trie,
    quotes,
    substring_dedup,
    token_align,
)
from .common import read_table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


@query
def op1_outliers(spark, sf_dir):
    rows = outliers.judge(read_table(spark, sf_dir, "documents"), F.col("doc_id"))
    return rows.select(F.col("__d").alias("doc_id"), "s.n_words", "s.word_chars", "s.n_symbols",
                       "s.n_dup_lines", "s.n_repeat_words", "base_failed", "kept", "distance")


@query
def op2_substring_dedup(spark, sf_dir):
    rows = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed",
                       F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op3_quotation_linking(spark, sf_dir):
    return quotes.conversations(read_table(spark, sf_dir, "conversations"))


@query
def op4_license_scan(spark, sf_dir):
    rows = licenses.labelled(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("__d.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query
def op5_html_blocks(spark, sf_dir):
    rows = html_blocks.extract(read_table(spark, sf_dir, "pages"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))


@query
def op6_pii_crf(spark, sf_dir):
    rows = pii_crf.find(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    line = lambda a: F.array_join(F.transform(
        a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select("doc_id", *[count(k) for k in pii_crf.KINDS],
                       F.sha2(line(base).cast("binary"), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))


@query
def op7_forest_join(spark, sf_dir):
    rows = forest_join.near_duplicates(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "class_id", "n_links")


@query
def op8_mix_sources(spark, sf_dir):
    plan = mixing.mixing_plan(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return plan.select("__d.doc_id", "size", "source_size", "target",
                       (F.col("copies") * F.col("size")).alias("taken"))


@query
def op9_line_dedup(spark, sf_dir):
    rows = line_dedup.clean_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return rows.select("__d.doc_id", "__d.source", "n_lines", "n_dropped", F.col("clean").alias("text"))


@query
def op10_decontamination(spark, sf_dir):
    return decontam.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op11_token_align(spark, sf_dir):
    return token_align.align_documents(read_table(spark, sf_dir, "documents"))


@query
def op12_hyperminhash(spark, sf_dir):
    return hyperminhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@query
def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_nodes(read_table(spark, sf_dir, "conversations"))


ORACLE_SQL["op8_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rk FROM per),
weighed AS (SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
                   2 * source_size AS cap FROM ranked),
filled AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER w, 0)::DOUBLE)
            / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER w, 0.0::DOUBLE)) AS lvl
  FROM weighed
  WINDOW w AS (ORDER BY cap::DOUBLE / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, least(cap::DOUBLE, (max(lvl) OVER ()) * weight) AS target FROM filled),
rated AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('7:' || coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM rated
"""

ORACLE_SQL["op9_line_dedup"] = r"""
WITH lines AS (
  SELECT source AS host, md5(text) AS page,
         unnest(list_distinct(list_transform(string_split(text, chr(10)),
                lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))))) AS line
  FROM documents WHERE text IS NOT NULL),
totals AS (SELECT host, count(DISTINCT page) AS n_pages FROM lines GROUP BY host),
counts AS (SELECT host, line, count(DISTINCT page) AS n FROM lines WHERE line <> '' GROUP BY host, line),
bad AS (
  SELECT c.host, list(c.line) AS bad FROM counts c JOIN totals t ON c.host IS NOT DISTINCT FROM t.host
  WHERE c.n >= 5 AND c.n > 0.1::DOUBLE * t.n_pages GROUP BY c.host),
split AS (
  SELECT d.doc_id, d.source, d.text, string_split(d.text, chr(10)) AS l, coalesce(b.bad, []::VARCHAR[]) AS bad
  FROM documents d LEFT JOIN bad b ON d.source IS NOT DISTINCT FROM b.host),
kept AS (
  SELECT *, list_filter(l, lambda x: NOT list_contains(bad,
            trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)))) AS k FROM split)
SELECT doc_id, source, coalesce(len(l), 0)::BIGINT AS n_lines,
       (coalesce(len(l), 0) - coalesce(len(k), 0))::BIGINT AS n_dropped,
       array_to_string(k, chr(10)) AS text
FROM kept
"""

ORACLE_SQL["op3_quotation_linking"] = r"""
WITH RECURSIVE
msgs AS (SELECT *, ('0x' || substr(md5(md5(coalesce('s' || role, 'n')) || text), 1, 15))::BIGINT AS mark
         FROM (SELECT DISTINCT conv_id, turn, role, coalesce(text, '') AS text FROM conversations)),
numbered AS (SELECT *, string_split(text, chr(10)) AS ls FROM msgs),
lines AS (SELECT conv_id, turn, role, mark, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS k FROM numbered),
parsed AS (SELECT *, regexp_extract(line, '^[ \t>]*', 0) AS lead FROM lines),
leveled AS (
  SELECT *, length(lead) - length(replace(lead, '>', '')) AS lvl, substr(line, length(lead) + 1) AS body FROM parsed),
beside AS (
  SELECT *, lag(lvl) OVER m IS DISTINCT FROM lvl AS other, lag(lower(trim(regexp_replace(body, '[\x20\x09-\x0D]+', ' ', 'g'))) = '') OVER m AS after_blank
  FROM leveled WHERE conv_id IS NOT NULL AND turn IS NOT NULL WINDOW m AS (PARTITION BY conv_id, turn, mark ORDER BY k)),
cut AS (
  SELECT *, count(*) FILTER (other) OVER m AS run, count(*) FILTER (other OR after_blank) OVER m AS par
  FROM beside WINDOW m AS (PARTITION BY conv_id, turn, mark ORDER BY k)),
passages AS (
  SELECT conv_id, turn, mark, lvl, lower(trim(regexp_replace(body, '[\x20\x09-\x0D]+', ' ', 'g'))) AS s, [k] AS places FROM cut
  UNION ALL SELECT conv_id, turn, mark, lvl, lower(trim(regexp_replace(string_agg(body, ' ' ORDER BY k), '[\x20\x09-\x0D]+', ' ', 'g'))), list(k) FROM cut GROUP BY conv_id, turn, mark, lvl, run
  UNION ALL SELECT conv_id, turn, mark, lvl, lower(trim(regexp_replace(string_agg(body, ' ' ORDER BY k), '[\x20\x09-\x0D]+', ' ', 'g'))), list(k) FROM cut GROUP BY conv_id, turn, mark, lvl, par
  UNION ALL SELECT conv_id, turn, mark, lvl, lower(trim(regexp_replace(string_agg(body, ' ' ORDER BY k), '[\x20\x09-\x0D]+', ' ', 'g'))), list(k) FROM cut GROUP BY conv_id, turn, mark, lvl),
originals AS (SELECT conv_id, s, min(turn) AS wrote FROM passages WHERE lvl = 0 AND s <> '' GROUP BY conv_id, s),
met AS (
  SELECT q.*, o.wrote FROM passages q JOIN originals o ON q.conv_id = o.conv_id AND q.s = o.s
  WHERE q.lvl > 0 AND o.wrote < q.turn),
gone AS (SELECT DISTINCT conv_id, turn, mark, unnest(places) AS k FROM met),
built AS (
  SELECT l.conv_id, l.turn, l.role, l.mark, count(g.k) AS n_quoted,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.k) FILTER (g.k IS NULL), '') AS own
  FROM leveled l LEFT JOIN gone g ON l.conv_id = g.conv_id AND l.turn = g.turn AND l.mark = g.mark AND l.k = g.k
  GROUP BY l.conv_id, l.turn, l.role, l.mark),
found AS (
  SELECT conv_id, turn, lvl, wrote, count(*) AS n FROM (SELECT DISTINCT conv_id, turn, lvl, s, wrote FROM met)
  GROUP BY conv_id, turn, lvl, wrote),
links AS (
  SELECT conv_id, turn, wrote AS reply_to FROM found
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY lvl, n DESC, wrote DESC) = 1),
climb AS (
  SELECT conv_id, turn, reply_to AS top FROM links
  UNION ALL
  SELECT c.conv_id, c.turn, l.reply_to FROM climb c JOIN links l ON c.conv_id = l.conv_id AND c.top = l.turn),
tops AS (SELECT conv_id, turn, min(top) AS thread FROM climb GROUP BY conv_id, turn),
placed AS (
  SELECT b.conv_id, b.turn, b.role, b.own, b.mark, b.n_quoted, l.reply_to, coalesce(t.thread, b.turn) AS thread,
         floor(coalesce(t.thread, b.turn) / 512)::BIGINT AS thread_part, floor(b.turn / 512)::BIGINT AS turn_part,
         CASE WHEN b.conv_id IS NULL THEN b.mark || ':' || coalesce(b.turn, -1) END AS alone
  FROM built b LEFT JOIN links l ON b.conv_id = l.conv_id AND b.turn = l.turn
  LEFT JOIN tops t ON b.conv_id = t.conv_id AND b.turn = t.turn),
turns AS (
  SELECT *, CASE WHEN n > 4096 THEN ceil(n * 2 / 4096)::BIGINT ELSE 0 END AS deal,
         sum(n) OVER (PARTITION BY conv_id, thread_part, turn_part) AS n_part
  FROM (SELECT conv_id, thread_part, turn_part, thread, turn, count(*) AS n FROM placed WHERE conv_id IS NOT NULL
        GROUP BY conv_id, thread_part, turn_part, thread, turn)),
dealt AS (
  SELECT *, floor(coalesce(sum(CASE WHEN deal > 0 THEN (deal + 2) * 4096 ELSE n END) OVER (
           PARTITION BY conv_id, thread_part, turn_part ORDER BY thread NULLS LAST, turn NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 4096)::BIGINT AS first
  FROM turns WHERE n_part > 4096),
parts AS (
  SELECT p.*, coalesce(d.first + CASE WHEN d.deal > 0 THEN 1 + p.mark % d.deal ELSE 0 END, 0)::BIGINT AS sub_part
  FROM placed p LEFT JOIN dealt d ON p.conv_id = d.conv_id AND p.thread_part IS NOT DISTINCT FROM d.thread_part
  AND p.turn_part IS NOT DISTINCT FROM d.turn_part AND p.thread IS NOT DISTINCT FROM d.thread AND p.turn IS NOT DISTINCT FROM d.turn)
SELECT conv_id, thread_part, turn_part, sub_part,
       count(*) AS n_messages, count(reply_to) AS n_replies, sum(n_quoted)::BIGINT AS n_quoted,
       string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || own, chr(10)
                  ORDER BY thread NULLS LAST, turn NULLS LAST, coalesce(role, ''), own) AS chat
FROM parts GROUP BY conv_id, alone, thread_part, turn_part, sub_part
"""

ORACLE_SQL["op13_prefix_trie"] = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT conv_id, xor(list_reduce(
           [4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
           lambda crc, b: list_reduce([xor(crc, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
             lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)),
           4294967295::BIGINT) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
heads AS (
  SELECT i.conv_id, t.p AS d, t.role, t.text
  FROM ids i JOIN turns t ON t.conv_id = i.conv_id - i.conv_id % 20 AND t.p <= i.h),
copied AS (SELECT conv_id, count(*) AS n FROM heads GROUP BY conv_id),
rebuilt AS (
  SELECT * FROM heads
  UNION ALL
  SELECT t.conv_id, t.p - i.h + coalesce(c.n, 0), t.role, t.text
  FROM turns t JOIN ids i USING (conv_id) LEFT JOIN copied c USING (conv_id) WHERE t.p > i.h),
listed AS (
  SELECT conv_id, d, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS w,
         list(md5(role || chr(1) || text)) OVER (PARTITION BY conv_id ORDER BY d) AS path
  FROM rebuilt),
prefixes AS (
  SELECT conv_id, d::BIGINT AS d, w::BIGINT AS w, array_to_string(path, ',') AS k, array_to_string(path[:-2], ',') AS up FROM listed
  UNION ALL
  SELECT conv_id, 0, 0, '', NULL FROM ids),
nodes AS (
  SELECT k, d, any_value(up) AS up, max(w) AS w, min(conv_id) AS conv_id, count(*) AS n FROM prefixes GROUP BY k, d),
children AS (SELECT up AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY up),
pairs AS (
  SELECT DISTINCT a.k AS top, b.k AS k FROM prefixes a JOIN prefixes b ON a.conv_id = b.conv_id AND a.d <= b.d),
below AS (
  SELECT p.top, count(*) FILTER (c.k IS NULL) AS n_leaves, sum((n.n - 1) * n.w)::BIGINT AS saved_tokens
  FROM pairs p JOIN nodes n ON n.k = p.k LEFT JOIN children c ON c.k = p.k GROUP BY p.top),
lengths AS (SELECT conv_id, arg_max(k, d) AS k FROM prefixes GROUP BY conv_id),
ends AS (SELECT k, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM lengths GROUP BY k)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(c.n_children, 0) AS n_children,
       b.n_leaves, b.saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n JOIN below b ON b.top = n.k LEFT JOIN nodes u ON u.k = n.up AND n.d > 0
LEFT JOIN children c ON c.k = n.k LEFT JOIN ends e ON e.k = n.k
"""
