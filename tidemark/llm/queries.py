"""Queries of the corpus operators: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch

from . import bpe_codec, conversation_repair, exact_dedup, ngram_join, packing, quality_classifier, quality_rules, source_divergence, substring_dedup, token_counts, token_store, url_filter, warc


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    parts = token_store.write_store(documents(spark, sf_dir), path)
    return token_store.read_store(spark, path, parts).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(documents(spark, sf_dir))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir)).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "loss_tokens")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir)).drop("text", "rejected_by")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.classify(documents(spark, sf_dir), labels)


def op7_warc_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    files = warc.write_archive(pages(spark, sf_dir), path)
    return warc.read_archive(spark, path, files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The host and path rules that the query is asked to apply.
DOMAIN_RULES = [
    url_filter.DomainRule("allow", "com/"),
    url_filter.DomainRule("block", "example.com/en/"),
    url_filter.DomainRule("allow", "www.example.com/en/"),
    url_filter.DomainRule("block", "net/es/"),
    url_filter.DomainRule("block", "net/fr/"),
]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(pages(spark, sf_dir), "page_id", DOMAIN_RULES).select("page_id", "host", "path", "rule", "verdict", "pattern")


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe_codec.encode_decode(documents(spark, sf_dir))
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir)).withColumn("over_limit", F.col("n_tokens") > 1024)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence(documents(spark, sf_dir))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversation_repair.repair(conversation_repair.damage(rows), rows)


QUERIES = {
    "op1_token_store": op1_token_store,
    "op2_ngram_join": op2_ngram_join,
    "op3_packing": op3_packing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_warc_writer": op7_warc_writer,
    "op8_url_filter": op8_url_filter,
    "op9_bpe_codec": op9_bpe_codec,
    "op10_token_counts": op10_token_counts,
    "op11_source_divergence": op11_source_divergence,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_conversation_repair": op13_conversation_repair,
}

OP4_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id) = 1 AS kept, sha256(norm) AS text_sha256
FROM t WINDOW g AS (PARTITION BY norm)
"""

OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
tri AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM d)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS k FROM dup) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, t, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines, coalesce(cov.n, 0) AS n_repeat_words
  FROM d LEFT JOIN cov ON d.doc_id = cov.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words OR word_chars > 20 * n_words OR 2 * n_words > word_chars
            OR (n_dup_lines > 0 AND 2 * n_dup_lines > n_lines)
            OR 2 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > word_chars
            OR 2 * length(regexp_replace(t, '\P{L}+', '', 'g')) < word_chars) AS kept
FROM b
"""

_PATTERN_SQL = " UNION ALL ".join("SELECT '{}' AS name, '{}' AS re".format(p.name, p.pattern.replace(r"\Z", "$")) for p in url_filter.PATTERNS)
_RULE_SQL = " UNION ALL ".join("SELECT '{}' AS action, '{}' AS rule".format(r.action, r.rule) for r in DOMAIN_RULES)

OP8_SQL = rf"""
WITH p AS ({_PATTERN_SQL}), r AS (SELECT action, rule, split_part(rule, '/', 1) AS rh, substr(rule, strpos(rule, '/')) AS rp FROM ({_RULE_SQL})),
a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^([^?#]*)', 1) ELSE '' END AS rest,
             translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM pages),
u AS (SELECT page_id, low, translate(regexp_extract(coalesce(rest, ''), '^([^/]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path FROM a),
f AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
      FROM u JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id),
x AS (SELECT page_id, min(name) AS pattern FROM u JOIN p ON regexp_matches(low, re) GROUP BY page_id)
SELECT u.page_id, host, path, f.rule AS rule, CASE WHEN f.rule IS NOT NULL THEN f.action WHEN x.pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, x.pattern AS pattern
FROM u LEFT JOIN f ON u.page_id = f.page_id LEFT JOIN x ON u.page_id = x.page_id
"""

OP7_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
g AS (SELECT page_id, body, max(page_id) OVER (PARTITION BY body) AS top FROM p),
h AS (SELECT page_id, top, octet_length(encode(body)) AS payload_bytes, sha1(body) AS hex FROM g),
b AS (SELECT *, list_transform(range(0, 20), lambda i: ('0x' || substr(hex, 2 * i + 1, 2))::BIGINT) AS y FROM h)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((y[(5 * k) // 8 + 1] * 256 + coalesce(y[(5 * k) // 8 + 2], 0)) // (2 ** (11 - (5 * k) % 8))::BIGINT) % 32 + 1)::BIGINT, 1)), '') AS payload_digest,
       CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id < top THEN top END AS refers_to
FROM b
"""

OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
c AS (SELECT o.lang, o.source, o.term, count(*) AS n FROM o JOIN k ON o.lang = k.lang AND o.term = k.term GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
l AS (SELECT g.lang, coalesce((SELECT sum(n) FROM c WHERE c.lang = g.lang), 0)::HUGEINT AS total, (SELECT count(*) FROM k WHERE k.lang = g.lang)::HUGEINT AS v FROM (SELECT DISTINCT lang FROM g) g),
t AS (SELECT g.lang, g.source, coalesce((SELECT sum(n) FROM c WHERE c.lang = g.lang AND c.source = g.source), 0)::HUGEINT AS total FROM g),
p AS (SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (t.total + 5 * l.v))::BIGINT AS p
      FROM t JOIN k ON t.lang = k.lang JOIN l ON t.lang = l.lang LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
q AS (SELECT k.lang, k.term, (1 + (1000000000::HUGEINT * (s.n + 5)) // (l.total + 5 * l.v))::BIGINT AS q
      FROM k JOIN l ON k.lang = l.lang JOIN (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL) s ON s.lang = k.lang AND s.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT p.lang, p.source, 'term', p.term, p.p - q.q FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q),
w AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)))::INT AS rank FROM u)
SELECT * FROM w WHERE part = 'pair' OR rank <= 50
"""

OP12_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
m AS (SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY g) AS low FROM x) WHERE low < doc_id),
c AS (SELECT DISTINCT r, i + k AS i FROM (SELECT r, i, unnest(range(0, 13)) AS k FROM m)),
k AS (SELECT r, list(i) AS gone, count(*) AS n FROM c GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(CASE WHEN n IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(list_filter(w, lambda x, i: NOT list_contains(gone, i)), ' ') END) AS kept_sha256
FROM d LEFT JOIN k ON d.r = k.r
"""

OP13_SQL = r"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END)) AS t),
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
crc AS (SELECT src.*, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) % 20 AS kind FROM src, tab),
conv AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
dam AS (SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM crc JOIN conv ON crc.conv_id IS NOT DISTINCT FROM conv.conv_id),
num AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text)) AS i, role[1] AS ini FROM dam),
bad AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'd'
                       WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault, lag(ini) OVER (PARTITION BY c ORDER BY i) || ini AS pair FROM num),
ins(st, st2, letters, turns) AS (VALUES (0, 0, '', ''), (1, 1, '', ''), (2, 2, '', ''), (3, 3, '', ''), (0, 2, 'I', chr(10) || 'user:'), (1, 2, 'I', chr(10) || 'user:'), (3, 2, 'I', chr(10) || 'user:'),
  (2, 3, 'I', chr(10) || 'assistant:'), (0, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
keep(st, ini, st2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
fill(st, name, st2) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
edit AS (
  SELECT c, i, st, st AS st2, 2 AS price, 'D' AS letter, '' AS turns FROM bad, fill
  UNION ALL SELECT c, i, st, st2, CASE fault WHEN 't' THEN 5 ELSE 0 END, 'K', chr(10) || role || ':' || text FROM bad JOIN keep ON bad.ini = keep.ini WHERE fault IN ('', 't')
  UNION ALL SELECT c, i, st, st2, CASE fault WHEN 't' THEN 6 ELSE 1 END, 'R', chr(10) || name || ':' || text FROM bad, fill WHERE fault IN ('', 't')),
dp AS (
  SELECT c, 0::BIGINT AS i, 0 AS st, 0 AS cost, '' AS audit, '' AS turns FROM conv
  UNION ALL
  SELECT c, i, st, cost, audit, turns FROM (
    SELECT dp.c, e.i, e.st2 AS st, dp.cost + 5 * length(ins.letters) + e.price AS cost, dp.audit || ins.letters || e.letter AS audit, dp.turns || ins.turns || e.turns AS turns
    FROM dp JOIN ins ON ins.st = dp.st JOIN edit e ON e.c = dp.c AND e.i = dp.i + 1 AND e.st = ins.st2)
  QUALIFY row_number() OVER (PARTITION BY c, st ORDER BY cost, audit) = 1),
num_rows AS (SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
                    count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM bad GROUP BY c),
best AS (
  SELECT conv.conv_id, coalesce(r.gaps, 0) AS gaps, coalesce(r.blank, 0) AS blank, coalesce(r.duplicate, 0) AS duplicate, coalesce(r.truncated, 0) AS truncated, coalesce(r.illegal, 0) AS illegal,
         (dp.cost + 5 * length(ins.letters))::BIGINT AS cost, dp.audit || ins.letters AS audit, sha256(substr(dp.turns || ins.turns, 2)) AS repaired_sha256
  FROM conv LEFT JOIN num_rows r ON r.c = conv.c JOIN dp ON dp.c = conv.c AND dp.i = coalesce(r.n, 0) JOIN ins ON ins.st = dp.st AND ins.st2 IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY conv.c ORDER BY dp.cost + 5 * length(ins.letters), dp.audit || ins.letters) = 1)
SELECT * FROM best
"""

ORACLES: dict[str, str] = {
    "op4_exact_dedup": OP4_SQL,
    "op5_quality_rules": OP5_SQL,
    "op7_warc_writer": OP7_SQL,
    "op8_url_filter": OP8_SQL,
    "op11_source_divergence": OP11_SQL,
    "op12_substring_dedup": OP12_SQL,
    "op13_conversation_repair": OP13_SQL,
}
