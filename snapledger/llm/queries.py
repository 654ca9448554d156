"""The registered queries of this folder and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontam, jaccard, licenses, pii, quality, radix, substrings, tokenfiles, urlgraph
from ._util import fresh_path, table

RANKS, PATTERN = "byte_bpe_multi_50k.tiktoken", public_tokenizers.PATTERN
WORDS = "word_bpe_49k.json"


#: Not a secret: a corpus of one's own wants a key of one's own.
KEY = "public example key"


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlgraph.judge(table(spark, sf_dir, "pages"), tolerance=1e-6).drop("trust", "distrust")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "tokens")
    tokenfiles.write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORDS))
    return tokenfiles.digest(spark, path)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), PATTERN)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.digest(decontam.contamination(docs, table(spark, sf_dir, "benchmark")))


def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(table(spark, sf_dir, "documents").select("doc_id", "text"), KEY)


QUERIES = {f.__name__: f for f in (op1_url_filter, op2_substring_dedup, op3_suffix_array_dedup, op4_token_files, op5_quality_rules, op6_byte_bpe, op7_jaccard_join, op8_license_scan, op9_decontamination, op10_pii_surrogates)}

_NORMAL_WORDS = r"regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

def _op1_sql(rounds: int = 250) -> str:
    """Ranks far beyond the operator's tolerance, by a recursive table: each round passes 85 per cent of all ranks on and adds the seeds anew.

    A row of the host ``*`` stands for the seeds in every round. Parents are worked out label by label.
    """
    az = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    rules = " UNION ALL ".join(f"SELECT '{r.rule}' AS rule, '{r.host}' AS rhost, '{r.path}' AS rpath, {str(r.allow).lower()} AS allow" for r in urlgraph.RULES)
    suffixes = ", ".join(map(_quoted, urlgraph.SUFFIXES))
    return f"""
WITH RECURSIVE p AS (SELECT page_id, row_number() OVER () AS k, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), {az}), '') AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path, html FROM pages),
rules AS ({rules}),
hits AS (SELECT k, rule, allow, row_number() OVER (PARTITION BY k ORDER BY length(rule) DESC) AS n FROM p JOIN rules ON (host = rhost OR host LIKE '%.' || rhost) AND starts_with(path, rpath)),
ruled AS (SELECT p.*, rule, allow FROM p LEFT JOIN hits ON p.k = hits.k AND n = 1),
links AS (SELECT host AS src, translate(unnest(regexp_extract_all(html, {_quoted(urlgraph.LINK)}, 1)), {az}) AS dst FROM p),
named AS (SELECT string_split(src, '.') AS x FROM (SELECT host AS src FROM p UNION SELECT dst FROM links) WHERE NOT regexp_matches(src, '^[0-9.]+(:[0-9]*)?$')),
steps AS (SELECT x, unnest(range(1, len(x) - 1)) AS i FROM named WHERE len(x) >= 3),
up AS (SELECT DISTINCT array_to_string(x[i:], '.') AS src, array_to_string(x[i + 1:], '.') AS dst FROM steps WHERE NOT list_contains(x[i + 1:], '') AND array_to_string(x[i + 1:], '.') NOT IN ({suffixes})),
fwd AS (SELECT src, dst, count(*) AS weight FROM (SELECT src, dst FROM links UNION ALL SELECT src, dst FROM up UNION ALL SELECT dst, src FROM up) WHERE src <> dst AND src <> '' AND dst <> '' GROUP BY src, dst),
edges AS (SELECT true AS allow, src, dst, weight FROM fwd UNION ALL SELECT false, dst, src, weight FROM fwd),
seeds AS (SELECT allow, host, count(*) / sum(count(*)) OVER (PARTITION BY allow) AS seed FROM ruled WHERE allow IS NOT NULL AND host <> '' GROUP BY allow, host),
moves AS (SELECT allow, src, dst, 0.85 * weight / sum(weight) OVER (PARTITION BY allow, src) AS share FROM edges UNION ALL SELECT allow, '*', host, 0.15 * seed FROM seeds UNION ALL SELECT DISTINCT allow, '*', '*', 1.0 FROM seeds),
ranks(n, allow, host, rank) AS (
  SELECT DISTINCT 0, allow, '*', CAST(1.0 AS DOUBLE) FROM seeds
  UNION ALL SELECT n + 1, moves.allow, dst, sum(rank * share) FROM ranks JOIN moves ON ranks.allow = moves.allow AND ranks.host = moves.src WHERE n < {rounds} GROUP BY n + 1, moves.allow, dst),
last AS (SELECT host, coalesce(max(rank) FILTER (WHERE allow), 0) AS trust, coalesce(max(rank) FILTER (WHERE NOT allow), 0) AS distrust FROM ranks WHERE n = {rounds} GROUP BY host)
SELECT page_id, ruled.host, path, rule, CASE WHEN coalesce(allow, coalesce(distrust, 0) <= coalesce(trust, 0)) THEN 'allow' ELSE 'block' END AS verdict
FROM ruled LEFT JOIN last ON ruled.host = last.host"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


SQL = {
    "op1_url_filter": _op1_sql(),
    "op2_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, unnest(list_transform(range(1, len(w) - 33), lambda i: md5(array_to_string(w[i:i + 34], ' ')))) AS g FROM d WHERE len(w) >= 35),
twice AS (SELECT g FROM win GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM win SEMI JOIN twice ON win.g = twice.g),
per AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d),
kept AS (SELECT words.doc_id, string_agg(x, ' ' ORDER BY words.p) AS t FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p GROUP BY words.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN per ON d.doc_id = per.doc_id LEFT JOIN kept ON d.doc_id = kept.doc_id""",
    "op3_suffix_array_dedup": r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
win AS (SELECT doc_id, i, md5(piece) AS g FROM (SELECT doc_id, i, substr(x, 2 * i + 1, 200) AS piece FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 99)) AS i FROM d WHERE length(x) >= 200))),
seen AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS n FROM win),
marks AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER w + 100 THEN 0 ELSE 1 END AS new FROM seen WHERE n > 1 WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
runs AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marks) GROUP BY doc_id, run),
edges AS (SELECT doc_id, b AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS b FROM runs UNION ALL SELECT doc_id, 0, min(a) FROM runs GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(x, 2 * a + 1, CASE WHEN b IS NULL THEN length(x) ELSE 2 * (b - a) END), '' ORDER BY a) AS t FROM edges JOIN d USING (doc_id) GROUP BY doc_id),
per AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans FROM runs GROUP BY doc_id)
SELECT d.doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN removed IS NULL THEN x ELSE coalesce(t, '') END)) AS kept_sha256
FROM d LEFT JOIN per ON d.doc_id = per.doc_id LEFT JOIN kept ON d.doc_id = kept.doc_id""",
    "op5_quality_rules": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM w WHERE len(w) >= 5),
twice AS (SELECT doc_id, g FROM win GROUP BY doc_id, g HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT win.doc_id, unnest(range(i, i + 5)) AS p FROM win JOIN twice ON win.doc_id = twice.doc_id AND win.g = twice.g) GROUP BY doc_id),
s AS (
  SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, length(t) - length(translate(t, '!', '')) AS n_shouts, len(lines) AS n_lines
  FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (100 * n_symbols > 25 * n_words OR 100 * n_shouts > 50 * n_words OR word_chars < 2 * n_words OR word_chars > 14 * n_words OR 100 * n_dup_lines > 30 * n_lines) AS kept
FROM b""",
    "op7_jaccard_join": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) AS g FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT x, y FROM common JOIN n p ON x = p.doc_id JOIN n q ON y = q.doc_id WHERE 100 * k >= 85 * (p.n + q.n - k)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, y FROM reach JOIN both_ways ON r = x)
SELECT d.doc_id, CAST(coalesce(max(n.n), 0) AS BIGINT) AS n_shingles, min(r) AS component_id
FROM d JOIN reach ON d.doc_id = reach.doc_id LEFT JOIN n ON d.doc_id = n.doc_id GROUP BY d.doc_id""",
    "op9_decontamination": f"""
WITH d AS (SELECT doc_id, {_NORMAL_WORDS.format('text')} AS w FROM documents),
b AS (SELECT item_id, {_NORMAL_WORDS.format('text')} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, g FROM (
    SELECT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS g
    FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g
  FROM d, sizes WHERE len(w) >= n),
m AS (SELECT doc_id, item_id, i, bw.n FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id""",
}
