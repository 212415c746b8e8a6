"""Registered queries of this subpackage: one thin query per operator, with production parameters, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from pulsekit.llm.common import table
from pulsekit.llm.decontaminate import benchmark_hits
from pulsekit.llm.fim import fill_in_middle, restored
from pulsekit.llm.html_extract import extract_main_text
from pulsekit.llm.license_scan import MIN_PERCENT, NOTICES, phrase_templates, scan_licences, template_words
from pulsekit.llm.lm_scoring import score_documents
from pulsekit.llm.near_dup import near_duplicates
from pulsekit.llm.packing import pack_documents
from pulsekit.llm.pii import KINDS, find_pii, joined_spans
from pulsekit.llm.prefix_trie import prefix_trie
from pulsekit.llm.quality import quality_measures
from pulsekit.llm.sharding import shard_documents
from pulsekit.llm.token_counts import count_tokens
from pulsekit.llm.url_rules import MIN_CONFIDENCE, MIN_SUPPORT, filter_urls

#: Byte limit of a shard: buckets split from the smallest tables on.
SHARD_BYTES = 256 << 10

#: The URL rules of the query (verdict, host, path).
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

#: The licence phrases of the query and their labels.
LICENCE_PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op2_best_two_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048,
                            ranks=(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "n_words", "n_hit", "n_items",
                       F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"size(filter(base, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined_spans(F.col("base")), 256).alias("base_sha256"),
                        joined_spans(F.concat("base", "added")).alias("spans"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), folds=7, held_fold=2)


def op8_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), max_bytes=SHARD_BYTES)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_measures(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & F.col("rejected_by").isNull()).alias("kept"))


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = filter_urls(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licences(table(spark, sf_dir, "documents"), LICENCE_PHRASES)
    joined = [F.concat_ws(",", c).alias(c) for c in ("base_labels", "labels")]
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", *joined, "score")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle(table(spark, sf_dir, "documents"), seed=42, percent=50, spm_percent=80)
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"), family=5, most_shared=8)


QUERIES = {
    "op1_main_text": op1_main_text,
    "op2_best_two_fit_packing": op2_best_two_fit_packing,
    "op4_decontamination": op4_decontamination,
    "op5_token_counts": op5_token_counts,
    "op3_near_duplicates": op3_near_duplicates,
    "op6_personal_data": op6_personal_data,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_extendible_sharding": op8_extendible_sharding,
    "op9_quality_rules": op9_quality_rules,
    "op10_url_rules": op10_url_rules,
    "op11_license_scan": op11_license_scan,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_prefix_trie": op13_prefix_trie,
}

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TEMPLATES = [*phrase_templates(LICENCE_PHRASES), *NOTICES]
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_WORD = r"'[^\x20\x09-\x0D]+'"

ORACLES = {
    "op3_near_duplicates": rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format('text')}, {_WORD}) AS ws FROM documents),
shingled AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s
  FROM worded, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS t(i) WHERE len(ws) > 0),
sized AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
  FROM shingled a JOIN shingled b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
linked AS (
  SELECT a, b FROM shared JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
  WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN linked l ON l.a = r.other),
found AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN found USING (doc_id) LEFT JOIN sized USING (doc_id)
""",
    "op4_decontamination": rf"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER.format('text')}, {_ALNUM}) AS ws FROM documents),
asked AS (SELECT item_id, regexp_extract_all({_LOWER.format('text')}, {_ALNUM}) AS ws FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS n, array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS w
  FROM asked, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS t(i) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT rid, i, n, array_to_string(ws[i:i + n - 1], ' ') AS w
  FROM texts, sizes, unnest(range(1, len(ws) - n + 2)) AS t(i) WHERE len(ws) >= n),
matches AS (SELECT rid, i, n, item_id FROM doc_windows JOIN item_windows USING (n, w)),
hit AS (SELECT rid, count(DISTINCT i + o) AS n_hit FROM matches, unnest(range(0, n)) AS t(o) GROUP BY rid),
named AS (
  SELECT rid, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM matches GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM texts LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)
""",
    "op9_quality_rules": rf"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws FROM documents),
windows AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i], ws[i + 1], ws[i + 2]) AS k
  FROM base, unnest(range(1, len(ws) - 1)) AS t(i)),
covered AS (
  SELECT rid, count(DISTINCT i + o) AS n FROM windows, (VALUES (0), (1), (2)) AS v(o) WHERE k > 1 GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM base),
dups AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
uses AS (SELECT rid, w, count(*) AS k FROM (SELECT rid, unnest(ws) AS w FROM base) GROUP BY rid, w),
tops AS (SELECT rid, max(k) AS n_top FROM uses GROUP BY rid),
measured AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_top, 0) AS n_top,
    len(regexp_extract_all(text, '!')) AS n_shouts, len(regexp_extract_all(text, '[A-Z]')) AS n_upper
  FROM base LEFT JOIN covered USING (rid) LEFT JOIN dups USING (rid) LEFT JOIN tops USING (rid)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_shouts > n_words OR 10 * n_upper > 4 * word_chars
    OR 10 * n_top > 4 * n_words OR 10 * n_dup_lines > 5 * n_lines OR word_chars < 2 * n_words
    OR word_chars > 15 * n_words) AS kept
FROM judged
""",
    "op8_extendible_sharding": rf"""
WITH hashed AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes, coalesce(text, '') AS text,
    md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key, count(*) OVER (PARTITION BY doc_id) AS uses FROM documents),
bits AS (
  SELECT doc_id, n_bytes, array_to_string([['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100',
          '1101', '1110', '1111'][strpos('0123456789abcdef', x)]
          FOR x IN string_split(key, '')], '') AS bits
  FROM hashed),
levels AS (SELECT doc_id, n_bytes, d AS depth, substr(bits, 1, d) AS bucket FROM bits, unnest(range(0, 61)) AS t(d)),
sums AS (SELECT depth, bucket, sum(n_bytes) AS bytes, count(*) AS n FROM levels GROUP BY depth, bucket),
chosen AS (
  SELECT doc_id, l.n_bytes, l.bucket, l.depth, s.bytes,
    row_number() OVER (PARTITION BY doc_id ORDER BY l.depth) AS k
  FROM levels l JOIN sums s USING (depth, bucket) WHERE s.bytes <= {SHARD_BYTES} OR s.n = 1)
SELECT doc_id, n_bytes, bucket AS shard, depth, CAST(bytes AS BIGINT) AS shard_bytes, bytes > {SHARD_BYTES} AS over_limit
FROM chosen WHERE k = 1
""",
    "op10_url_rules": rf"""
WITH RECURSIVE rules(verdict, rhost, rpath) AS (VALUES {', '.join(map(str, URL_RULES))}),
rests AS (
  SELECT row_number() OVER () AS rid, page_id, coalesce(url, '') AS url,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT rid, page_id, url, {_LOWER.format("regexp_extract(rest, '^[^/?#]*', 0)")} AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
fits AS (
  SELECT rid, rhost || rpath AS rule, verdict,
    row_number() OVER (PARTITION BY rid ORDER BY length(rhost || rpath) DESC, rhost || rpath DESC) AS k
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)),
judged AS (SELECT p.*, f.rule, f.verdict AS given FROM parts p LEFT JOIN fits f ON f.rid = p.rid AND f.k = 1),
tokens AS (
  SELECT DISTINCT rid, given, token FROM (
    SELECT rid, given, unnest(list_concat(
      ['s:' || {_LOWER.format("regexp_extract(url, '^([^/?#:]*)://', 1)")}],
      ['h:' || x FOR x IN string_split(host, '.')], ['p:' || x FOR x IN string_split(path, '/')],
      ['e:' || regexp_extract(path, '\.([A-Za-z0-9]{{1,8}})$', 1)],
      ['q:' || string_split(x, '=')[1] FOR x IN string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&')],
      ['f:' || regexp_extract(url, '(#)', 1)])) AS token FROM judged) WHERE length(token) > 2),
total AS (SELECT count(*) AS n FROM judged WHERE given IS NOT NULL),
sets AS (
  SELECT rid, given, [token] AS x FROM tokens
  UNION ALL SELECT s.rid, s.given, list_append(s.x, t.token) FROM sets s JOIN tokens t ON t.rid = s.rid AND t.token > s.x[-1]),
counts AS (
  SELECT x, count(*) AS n, count(*) FILTER (given = 'allow') AS n_allow, count(*) FILTER (given = 'block') AS n_block
  FROM sets WHERE given IS NOT NULL GROUP BY x),
mined AS (
  SELECT x, v AS learned, k / c.n AS confidence, k / total.n AS support
  FROM (SELECT x, n, 'allow' AS v, n_allow AS k FROM counts UNION ALL SELECT x, n, 'block', n_block FROM counts) c, total
  WHERE k >= ceil({MIN_SUPPORT} * total.n) AND k > 0 AND k / c.n >= {MIN_CONFIDENCE}),
best AS (
  SELECT rid, learned, row_number() OVER (PARTITION BY rid ORDER BY confidence DESC, support DESC, learned DESC) AS k
  FROM sets JOIN mined USING (x) WHERE given IS NULL)
SELECT page_id, host, path, rule, coalesce(given, learned, 'allow') AS verdict
FROM judged j LEFT JOIN best b ON b.rid = j.rid AND b.k = 1
""",
    "op11_license_scan": rf"""
WITH template_words(t, k, w, is_key) AS (
  VALUES {', '.join(str((t, k, w, is_key)) for t, x in enumerate(_TEMPLATES) for k, (w, is_key) in enumerate(template_words(x)))}),
named(t, label) AS (VALUES {', '.join(str((t, x.label)) for t, x in enumerate(_TEMPLATES))}),
worded AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER.format('text')}, {_ALNUM}) AS ws FROM documents),
places AS (
  SELECT rid, i - 1 AS i, ws[i] AS w FROM worded, unnest(range(1, len(ws) + 1)) AS u(i)
  WHERE ws[i] IN (SELECT w FROM template_words)),
uses AS (SELECT w, count(DISTINCT rid) AS n FROM places GROUP BY w),
weighted AS (
  SELECT t, k, x.w, is_key, 1 + CAST(round(1000 * ln((d.n + 1) / (coalesce(u.n, 0) + 1))) AS BIGINT) AS weight
  FROM template_words x LEFT JOIN uses u USING (w), (SELECT count(*) AS n FROM documents) d),
sizes AS (SELECT t, sum(weight) AS total, count(*) FILTER (is_key) AS n_keys FROM weighted GROUP BY t),
ranked AS (SELECT *, rank() OVER (PARTITION BY t ORDER BY weight DESC, w) AS r FROM weighted WHERE is_key),
starts AS (SELECT DISTINCT p.rid, a.t, p.i - a.k AS s FROM ranked a JOIN places p USING (w) WHERE r = 1),
found AS (
  SELECT s.rid, s.t, s.s, sum(x.weight) AS weight, count(*) FILTER (x.is_key) AS n_keys
  FROM starts s JOIN weighted x USING (t) JOIN places p ON p.rid = s.rid AND p.i = s.s + x.k AND p.w = x.w GROUP BY ALL),
judged AS (
  SELECT rid, f.t, s, label, f.weight / total AS share, f.n_keys = z.n_keys AS whole, f.t < {len(LICENCE_PHRASES)} AS is_base,
    100 * f.weight >= {MIN_PERCENT} * total AS enough
  FROM found f JOIN sizes z USING (t) JOIN named USING (t)),
summed AS (
  SELECT rid, count(*) FILTER (whole AND is_base) AS n_base, min(s) FILTER (whole AND is_base) AS first_word,
    max(s) FILTER (whole AND is_base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (whole AND is_base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (whole AND (is_base OR enough)) AS labels, max(share) AS score
  FROM judged GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM worded LEFT JOIN summed USING (rid)
""",
    "op12_fill_in_middle": rf"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex,
    regexp_extract_all(coalesce(text, ''), '[ 	-
]*[^ 	-
]+|[ 	-
]+') AS u FROM documents),
hashed AS (
  SELECT doc_id, text, u, len(u) AS n, CAST(concat('0x', substr(hex, 1, 8)) AS BIGINT) AS h1,
    CAST(concat('0x', substr(hex, 9, 8)) AS BIGINT) AS h2, CAST(concat('0x', substr(hex, 17, 8)) AS BIGINT) AS h3,
    CAST(concat('0x', substr(hex, 25, 8)) AS BIGINT) AS h4 FROM cut),
formed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM hashed),
parts AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
    array_to_string(u[b + 1:], '') AS suffix FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
""",
    "op13_prefix_trie": """
WITH RECURSIVE tagged AS (
  SELECT conv_id AS c, turn, strlen(coalesce(text, '')) AS b,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS tid
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, tid, b, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, substr(tid, 1, 32)) - 1 AS pos FROM tagged),
bits(c, s, k, v) AS (
  SELECT c, CAST(c AS VARCHAR), 0, 4294967295::BIGINT FROM (SELECT DISTINCT c FROM own)
  UNION ALL
  SELECT c, s, k + 1, CASE WHEN w % 2 = 1 THEN xor(w >> 1, 3988292384::BIGINT) ELSE w >> 1 END
  FROM (SELECT c, s, k, CASE WHEN k % 8 = 0 THEN xor(v, ascii(substr(s, k // 8 + 1, 1))::BIGINT) ELSE v END AS w
        FROM bits WHERE k < 8 * length(s))),
convs AS (SELECT c, c - c % 5 AS base, xor(v, 4294967295::BIGINT) % 9 AS h FROM bits WHERE k = 8 * length(s)),
lent AS (SELECT v.c, o.tid, o.b, o.pos FROM convs v JOIN own o ON o.c = v.base AND o.pos < v.h),
rebuilt AS (
  SELECT c, tid, b, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d FROM (
    SELECT c, tid, b, 0 AS part, pos FROM lent
    UNION ALL SELECT o.c, o.tid, o.b, 1, o.pos FROM own o JOIN convs v ON v.c = o.c AND o.pos >= v.h)),
paths AS (
  SELECT c, d, b, string_agg(tid, ',') OVER (PARTITION BY c ORDER BY d) AS path FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM convs),
ways AS (
  SELECT *, lag(path) OVER (PARTITION BY c ORDER BY d) AS above, lead(d) OVER (PARTITION BY c ORDER BY d) IS NULL AS is_end FROM paths),
nodes AS (
  SELECT path, d, min(c) AS c, any_value(above) AS above, count(*) AS n, any_value(b) AS b, bool_and(is_end) AS is_leaf,
    string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (is_end) AS ends FROM ways GROUP BY path, d),
subtree AS (
  SELECT w.path, sum((n.n - 1) * n.b) AS saved, count(*) FILTER (n.is_leaf) AS n_leaves
  FROM nodes n JOIN ways w ON w.c = n.c AND w.d <= n.d GROUP BY w.path),
children AS (SELECT above AS path, count(*) AS k FROM nodes WHERE above IS NOT NULL GROUP BY above)
SELECT n.c AS conv_id, CAST(n.d AS BIGINT) AS depth, p.c AS parent_conv_id, n.n AS n_convs, coalesce(k, 0) AS n_children,
  n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN subtree USING (path) LEFT JOIN children USING (path) LEFT JOIN nodes p ON p.path = n.above
""",
}
