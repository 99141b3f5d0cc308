"""Queries of title functions and entity resolution over part names, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import matching, text
from tidemark.operators.ranges import numbered
from tidemark.sources.tables import table

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


_TEXTS = """x AS (SELECT p_partkey AS id, CASE p_partkey % 8 WHEN 0 THEN 'The ' || p_name || '''s ' || p_brand WHEN 1 THEN p_name || '-' || p_type || ' (' || p_brand || ')'
  WHEN 2 THEN upper(p_name) || p_type || p_name WHEN 3 THEN '  ' || p_name || ' : ' || p_type || '!' WHEN 4 THEN '日本' || p_brand WHEN 5 THEN '日本語' WHEN 6 THEN p_type || lower(p_brand) || 'And' || p_name ELSE p_name || ' season ' || p_size END AS t FROM part)"""


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 8
    t = F.when(k == 0, F.concat(F.lit("The "), "p_name", F.lit("'s "), "p_brand")).when(k == 1, F.concat("p_name", F.lit("-"), "p_type", F.lit(" ("), "p_brand", F.lit(")")))
    t = t.when(k == 2, F.concat(F.upper("p_name"), "p_type", "p_name")).when(k == 3, F.concat(F.lit("  "), "p_name", F.lit(" : "), "p_type", F.lit("!"))).when(k == 4, F.concat(F.lit("日本"), "p_brand"))
    t = t.when(k == 5, F.lit("日本語")).when(k == 6, F.concat("p_type", F.lower("p_brand"), F.lit("And"), "p_name")).otherwise(F.concat("p_name", F.lit(" season "), F.col("p_size").cast("string")))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), t.alias("t"))


def _spaced(t: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower({t}), '[^\w\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def _stripped(t: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower({t}), '[^\w\s]', '', 'g'), '\s+', ' ', 'g'))"


def _inside(t: str) -> str:
    return rf"regexp_replace(regexp_replace(trim(lower({t})), '[^\w\s]', '', 'g'), '\s+', ' ', 'g')"


def _cleaned(t: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({t}), '[''`]\w*', '', 'g'), '[-_]', ' ', 'g'), '^the\s+', ''), '[^\w\s]', '', 'g'), '\s+', ' ', 'g'))"


_COMMON = "[" + ", ".join(f"'{w}'" for w in text.COMMON_WORDS) + "]"
_STOP = "[" + ", ".join(f"'{w}'" for w in text.STOP_WORDS) + "]"


def _significant(t: str) -> str:
    return f"list_filter(string_split({_cleaned(t)}, ' '), lambda w: length(w) > 2 AND NOT list_contains({_COMMON}, w))"


@query(f"WITH {_TEXTS} SELECT id, {_spaced('t')} AS spaced, {_stripped('t')} AS stripped, {_inside('t')} AS inside, {_cleaned('t')} AS cleaned FROM x")
def norm_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("t")
    return _texts(spark, sf_dir).select("id", text.spaced(t).alias("spaced"), text.stripped(t).alias("stripped"), text.stripped_inside(t).alias("inside"), text.cleaned(t).alias("cleaned"))


@query(rf"""WITH {_TEXTS}, y AS (SELECT id, t, list_filter(list_transform(string_split(regexp_replace(regexp_replace(lower(t), '[^\w\s'']', ' ', 'g'), '\s+', ' ', 'g'), ' '),
    lambda w: CASE WHEN strpos(w, '''') > 1 THEN split_part(w, '''', 1) ELSE w END), lambda w: length(w) > 3 AND NOT list_contains({_STOP}, w)) AS k,
  list_filter(string_split(regexp_replace(regexp_replace(lower(t), '[^\w\s]', ' ', 'g'), '\s+', ' ', 'g'), ' '), lambda w: length(w) > 4) AS l FROM x)
SELECT id, array_to_string({_significant('t')}, ' ') AS significant,
  CASE WHEN len(k) = 0 THEN trim(t) ELSE array_to_string(list_transform(list_sort(list_transform(range(1, len(k) + 1), lambda i: {{'n': -length(k[i]), 'i': i, 'w': k[i]}}))[1:3], lambda s: s.w), ' ') END AS longest,
  CASE WHEN len(l) > 0 THEN list_sort(list_transform(range(1, len(l) + 1), lambda i: {{'n': -length(l[i]), 'i': i, 'w': l[i]}}))[1].w END AS single,
  array_to_string(string_split(regexp_replace(trim(t), '\s+', ' ', 'g'), ' ')[1:3], ' ') AS head,
  CASE WHEN length(trim(regexp_extract(t, '^([\w\s]+)', 1))) >= 5 THEN trim(regexp_extract(t, '^([\w\s]+)', 1)) ELSE t END AS truncated,
  array_to_string(list_filter(list_transform(string_split(regexp_replace(t, '([a-z])([A-Z])', '\1|\2', 'g'), '|'), lambda s: trim(s)), lambda s: s <> ''), '|') AS parts FROM y""")
def word_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("t")
    return _texts(spark, sf_dir).select(
        "id", F.array_join(text.significant(text.cleaned(t)), " ").alias("significant"), text.longest_words(t).alias("longest"), text.longest_word(t).alias("single"),
        text.first_words(t).alias("head"), text.truncated(t).alias("truncated"), F.array_join(text.split_joined(t), "|").alias("parts"),
    )


@query(r"""SELECT page_id, CASE WHEN split_part(url, '/', -1) = '' THEN url ELSE split_part(url, '/', -1) END AS slug, CASE WHEN starts_with(url, 'http') THEN url END AS absolute,
  'https://h.example/' || 'p' || page_id AS built, replace(replace(replace(replace(replace(replace(replace(url, '%', '%25'), ':', '%3A'), '/', '%2F'), '?', '%3F'), '=', '%3D'), '#', '%23'), '&', '%26') AS encoded FROM pages""")
def url_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    made = text.absolute(F.concat(F.lit("p"), F.col("page_id").cast("string")), F.lit("https://h.example"))
    return table(spark, sf_dir, "pages").select("page_id", text.slug(u).alias("slug"), text.absolute(u, F.lit("https://h.example")).alias("absolute"), made.alias("built"), text.url_component(u).alias("encoded"))


# pairs: distinct part names against names with a type, that share a word; a few literal titles cover single words and other scripts
_EXTRA_Q = ["ring", "solo", "日本語", "blue's bolt", "Re:Gear", "red-widget"]
_EXTRA_C = ["ring", "ring SMALL", "solo leveling", "漫画", "blue bolt", "reGear", "Red Widget Academy"]
_PAIRS = f"""q AS (SELECT DISTINCT p_name AS title FROM part UNION SELECT unnest({_EXTRA_Q!r}) ),
c0 AS (SELECT DISTINCT p_name || ' ' || p_type AS cand_title FROM part UNION SELECT unnest({_EXTRA_C!r})),
c AS (SELECT cand_title, row_number() OVER (ORDER BY cand_title) AS pos, lower(replace(cand_title, ' ', '-')) AS slug FROM c0),
pairs AS (SELECT title AS query, title, cand_title, pos, slug FROM q, c WHERE list_has_any(list_filter(string_split({_spaced('title')}, ' '), lambda w: w <> ''), list_filter(string_split({_spaced('cand_title')}, ' '), lambda w: w <> '')))""".replace('"', "'").replace("'blue's bolt'", "'blue''s bolt'")  # fmt: skip


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.search_hits(*_sides(spark, sf_dir))


def _dice(a: str, b: str) -> str:
    def grams(t: str) -> str:
        return f"list_distinct(list_transform(range(1, length({t})), lambda i: substr({t}, i, 2)))"

    return f"CASE WHEN length({a}) > 1 AND length({b}) > 1 THEN 2.0 * len(list_intersect({grams(a)}, {grams(b)})) / (len({grams(a)}) + len({grams(b)})) ELSE CASE WHEN {a} = {b} THEN 1.0 ELSE 0.0 END END"


def _jaccard(a: str, b: str) -> str:
    x, y = (f"list_distinct(string_split({t}, ' '))" for t in (a, b))
    return f"CASE WHEN {a} = {b} THEN 1.0 ELSE len(list_intersect({x}, {y})) / CAST(len(list_distinct(list_concat({x}, {y}))) AS DOUBLE) END"


_BEST = "SELECT query, cand_title, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, pos) AS rn FROM s WHERE score > 0) WHERE rn = 1 AND score >= least"


@query(f"""WITH {_PAIRS}, n AS (SELECT *, {_spaced('title')} AS a, {_spaced('cand_title')} AS b, {_spaced("replace(slug, '-', ' ')")} AS z FROM pairs),
s AS (SELECT query, cand_title, pos, 0.4 AS least, CASE WHEN len(string_split(a, ' ')) = 1 THEN CASE WHEN a = b OR a = z THEN 1.0 ELSE 0.0 END ELSE {_dice('a', 'b')} END AS score FROM n WHERE a <> '') {_BEST}""")
def dice_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.dice_match(_pairs(spark, sf_dir))


_SPLIT = "list_filter(list_transform(string_split(regexp_replace(cand_title, '([a-z])([A-Z])', '\\1|\\2', 'g'), '|'), lambda s: trim(s)), lambda s: s <> '')"


@query(f"""WITH {_PAIRS}, n AS (SELECT *, {_stripped('title')} AS a, unnest(list_append({_SPLIT}, replace(slug, '-', ' '))) AS f FROM pairs), m AS (SELECT *, {_stripped('f')} AS b FROM n WHERE a <> ''),
t AS (SELECT query, cand_title, pos, CASE WHEN len(string_split(a, ' ')) = 1 THEN CASE WHEN a = b THEN 1.0 ELSE 0.0 END ELSE {_jaccard('a', 'b')} END AS score FROM m),
s AS (SELECT query, cand_title, pos, 0.4 AS least, max(score) AS score FROM t GROUP BY ALL) {_BEST}""")
def jaccard_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.jaccard_match(_pairs(spark, sf_dir))


@query(rf"""WITH {_PAIRS}, n AS (SELECT *, {_inside('title')} AS a, {_inside('cand_title')} AS b FROM pairs), m AS (SELECT *, list_filter(string_split_regex(a, '\s+'), lambda w: w <> '') AS w, string_split_regex(b, '\s+') AS u FROM n WHERE trim(a) <> ''),
s AS (SELECT query, cand_title, pos, CASE WHEN len(w) = 1 THEN 0.5 ELSE 0.6 END AS least, CASE WHEN a = b THEN 1.0 WHEN contains(b, a) THEN 0.95
  ELSE len(list_filter(w, lambda x: len(list_filter(u, lambda y: contains(y, x))) > 0)) / CAST(len(w) AS DOUBLE) * 0.7 + (1 - levenshtein(a, b) / CAST(greatest(length(a), length(b)) AS DOUBLE)) * 0.3 END AS score FROM m) {_BEST}""")
def levenshtein_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.edit_match(_pairs(spark, sf_dir))


@query(f"""WITH {_PAIRS}, n AS (SELECT query, cand_title, pos, unnest([title, title || ' small']) AS v, slug FROM pairs), m AS (SELECT query, cand_title, pos, v, unnest([cand_title, replace(slug, '-', ' ')]) AS f FROM n),
k AS (SELECT query, cand_title, pos, {_spaced('v')} AS a, {_spaced('f')} AS b FROM m), e AS (SELECT query, min(pos) AS pos FROM k WHERE a = b AND b <> '' GROUP BY 1),
s AS (SELECT query, cand_title, pos, 0.7 AS least, max(CASE WHEN a = '' OR b = '' THEN 0.0 ELSE {_jaccard('a', 'b')} END) AS score FROM k WHERE query NOT IN (SELECT query FROM e) GROUP BY ALL)
SELECT e.query, c.cand_title, 1.0 AS score FROM e JOIN c ON c.pos = e.pos UNION ALL ({_BEST})""")
def exact_then_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.exact_or_jaccard_match(_pairs(spark, sf_dir).withColumn("variants", F.array("title", F.concat("title", F.lit(" small")))))


@query(f"""WITH {_PAIRS}, n AS (SELECT query, cand_title, pos, slug, unnest([{{'step': 1, 't': title}}, {{'step': 2, 't': title || ' small'}}]) AS z FROM pairs),
k AS (SELECT query, cand_title, pos, z.step AS step, {_spaced('z.t')} AS a, {_spaced('cand_title')} AS b, {_spaced("replace(slug, '-', ' ')")} AS sl FROM n),
s AS (SELECT query, cand_title, pos, step, CASE WHEN len(string_split(a, ' ')) = 1 THEN CASE WHEN a = b OR a = sl THEN 1.0 ELSE 0.0 END ELSE {_dice('a', 'b')} END AS score FROM k WHERE a <> ''),
f AS (SELECT s.* FROM s LEFT JOIN (SELECT query, min(step) AS last FROM s WHERE score >= 0.7 GROUP BY 1) e ON s.query = e.query WHERE last IS NULL OR step <= last)
SELECT query, cand_title, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, step, pos) AS rn FROM f WHERE score > 0) WHERE rn = 1 AND score >= 0.4""")
def title_ladder_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _pairs(spark, sf_dir)
    steps = F.explode(F.array(F.struct(F.lit(1).alias("step"), F.col("title").alias("t")), F.struct(F.lit(2).alias("step"), F.concat("title", F.lit(" small")).alias("t"))))
    return matching.titles_match(p.withColumn("z", steps).withColumn("title", F.col("z.t")).withColumn("step", F.col("z.step")))


_OPEN = _PAIRS[: _PAIRS.rindex(" WHERE list_has_any")] + ")"


def _sides(spark: SparkSession, sf_dir: str) -> tuple:
    p = table(spark, sf_dir, "part")
    q = p.select(F.col("p_name").alias("title")).union(spark.createDataFrame([(x,) for x in _EXTRA_Q], "title string")).distinct().withColumn("query", F.col("title"))
    c = p.select(F.concat("p_name", F.lit(" "), "p_type").alias("cand_title")).union(spark.createDataFrame([(x,) for x in _EXTRA_C], "cand_title string")).distinct()
    c = numbered(c, ["cand_title"]).withColumn("pos", F.col("_at") + 1).drop("_at")
    return q, c.withColumn("slug", F.lower(F.replace(F.col("cand_title"), F.lit(" "), F.lit("-"))))


@query(f"""WITH {_OPEN}, n AS (SELECT *, {_spaced('title')} AS a, {_spaced('cand_title')} AS b, {_spaced("replace(slug, '-', ' ')")} AS z FROM pairs),
s AS (SELECT query, cand_title, pos, 0.55 AS least, CASE WHEN len(string_split(a, ' ')) = 1 THEN CASE WHEN a = b OR a = z THEN 1.0 ELSE 0.0 END ELSE {_dice('a', 'b')} END AS score FROM n WHERE a <> '') {_BEST}""")
def open_dice_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All names against all candidates, whether they share a word or not."""
    return matching.open_dice_match(*_sides(spark, sf_dir), 0.55)


@query(f"""WITH {_OPEN}, n AS (SELECT *, {_stripped('title')} AS a, unnest(list_append({_SPLIT}, replace(slug, '-', ' '))) AS f FROM pairs), m AS (SELECT *, {_stripped('f')} AS b FROM n WHERE a <> ''),
t AS (SELECT query, cand_title, pos, CASE WHEN len(string_split(a, ' ')) = 1 THEN CASE WHEN a = b THEN 1.0 ELSE 0.0 END ELSE {_jaccard('a', 'b')} END AS score FROM m),
s AS (SELECT query, cand_title, pos, 0.4 AS least, max(score) AS score FROM t GROUP BY ALL) {_BEST}""")
def open_jaccard_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.open_jaccard_match(*_sides(spark, sf_dir), 0.4)


@query("""WITH x AS (SELECT p_partkey AS mal_id, p_name AS query, p_size AS pos, p_brand AS cand_title, CAST((p_partkey // 2) * 2 AS VARCHAR) AS cand_mal FROM part),
r AS (SELECT query, cand_title, row_number() OVER (PARTITION BY query ORDER BY pos, cand_title) AS rn FROM x WHERE mal_id <> 0 AND CAST(mal_id AS VARCHAR) = cand_mal) SELECT query, cand_title, CAST(1 AS DOUBLE) AS score FROM r WHERE rn = 1""")
def external_id_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("mal_id"), F.col("p_name").alias("query"), F.col("p_size").alias("pos"), F.col("p_brand").alias("cand_title"), (F.floor(F.col("p_partkey") / 2) * 2).cast("string").alias("cand_mal"))
    return matching.id_match(x)


@query(f"""WITH {_PAIRS}, n AS (SELECT query, pos, unnest([title, title || ' small']) AS v, [cand_title, replace(slug, '-', ' '), '日本'] AS l FROM pairs), m AS (SELECT query, pos, v, unnest(CASE pos % 5 WHEN 0 THEN ['日本'] WHEN 1 THEN l[1:1] ELSE l END) AS alt FROM n),
k AS (SELECT query, pos, {_spaced('v')} AS a, {_spaced('alt')} AS b FROM m) SELECT query, pos, bool_or(a = b OR {_dice('a', 'b')} >= 0.7) AS verified FROM k WHERE pos % 7 > 0 GROUP BY ALL
UNION ALL SELECT query, pos, true FROM pairs WHERE pos % 7 = 0""")
def redirect_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with one, several or no alternative titles against two variants each."""
    p, k = _pairs(spark, sf_dir), F.col("pos")
    listed = F.array("cand_title", F.replace(F.col("slug"), F.lit("-"), F.lit(" ")), F.lit("日本"))
    alternatives = F.when(k % 7 == 0, F.array().cast("array<string>")).when(k % 5 == 0, F.array(F.lit("日本"))).when(k % 5 == 1, F.slice(listed, 1, 1)).otherwise(listed)
    return p.select("query", "pos", matching.verified(alternatives, F.array("title", F.concat("title", F.lit(" small")))).alias("verified"))


def _cp(a: str, b: str) -> str:
    return f"len(list_filter(range(1, least(length({a}), length({b})) + 1), lambda i: substr({a}, 1, i) = substr({b}, 1, i)))"


_IN = "(contains(b, a) OR contains(a, b))"
_PART = "((contains(b, a) AND length(a) > 3) OR (contains(a, b) AND length(b) > 3))"
_SHORT = "least(length(a), length(b))"
_SIM = f"len(list_filter(r, lambda b: {_PART} OR ({_SHORT} >= 4 AND {_cp('a', 'b')} >= 4))) > 0"
_NEAR = f"a = b OR {_IN} OR {_cp('a', 'b')} >= 4"
_N, _M = "CAST(greatest(len(s), 1) AS DOUBLE)", "CAST(greatest(len(r), 1) AS DOUBLE)"
_FIRSTS = f"list_transform(s, lambda a: coalesce(list_min(list_filter(range(1, len(r) + 1), lambda i: contains(r[i], a) OR contains(a, r[i]))), 0))"


@query(f"""WITH {_PAIRS}, k AS (SELECT query, cand_title, pos, {_cleaned('title')} AS t, {_significant('title')} AS s, {_significant('cand_title')} AS r FROM pairs),
one AS (SELECT query, cand_title, row_number() OVER (PARTITION BY query ORDER BY pos) AS rn FROM k WHERE len(s) = 1 AND len(r) = 1 AND s[1] = r[1]),
o AS (SELECT *, {_FIRSTS} AS f FROM k WHERE len(s) <> 1),
p AS (SELECT *, 0.30 * (len(list_filter(s, lambda a: list_contains(r, a))) / {_N}) + 0.25 * (len(list_distinct(list_filter(s, lambda a: list_contains(r, a) OR {_SIM}))) / {_N})
  + 0.15 * coalesce(len(list_filter(s, lambda a: length(a) > 5 AND len(list_filter(r, lambda b: {_IN} OR {_cp('a', 'b')} >= least(5, {_SHORT} - 1))) > 0)) / CAST(nullif(len(list_filter(s, lambda a: length(a) > 5)), 0) AS DOUBLE), 0)
  + 0.10 * (len(list_filter(s, lambda a: {_SIM})) / {_N})
  + 0.10 * coalesce(len(list_filter(s, lambda a: length(a) > 7 AND len(list_filter(r, lambda b: {_IN})) > 0)) / CAST(nullif(len(list_filter(s, lambda a: length(a) > 7)), 0) AS DOUBLE), 0)
  + 0.10 * (CASE WHEN len(s) > 1 THEN len(list_filter(range(1, len(f) + 1), lambda i: f[i] > 0 AND f[i] > coalesce(list_max(f[1:i - 1]), 0))) / {_N} ELSE 0 END)
  - 0.15 * (len(list_filter(r, lambda b: len(list_filter(s, lambda a: {_NEAR})) = 0)) / {_M})
  - 0.60 * (0.8 * len(list_filter(s, lambda a: len(list_filter(r, lambda b: a = b OR {_PART} OR {_cp('a', 'b')} >= least(4, 0.7 * {_SHORT}))) = 0)) / {_N})
  - 0.50 * (1.2 * len(list_filter(r, lambda b: length(b) > 6 AND len(list_filter(s, lambda a: {_NEAR})) = 0)) / {_M}) AS score,
  len(list_filter(r, lambda b: length(b) > 6 AND len(list_filter(s, lambda a: {_NEAR})) = 0)) > 0 AND len(list_filter(string_split(t, ' '), lambda w: w <> '')) <= 2 AS no FROM o),
b AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, pos) AS rn FROM p)
SELECT query, cand_title, 1.0 AS score FROM one WHERE rn = 1 UNION ALL SELECT query, cand_title, round(score, 6) AS score FROM b WHERE rn = 1 AND score >= 0.3 AND NOT no""")
def composite_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.composite_match(_pairs(spark, sf_dir))


@query(f"""WITH {_TEXTS}, l AS (SELECT id, [t, lower(t), t || ' 2', '日本語', t || ' 3', t || ' 4'] AS v FROM x), u AS (SELECT id, unnest(v) AS t, unnest(range(1, 7)) AS i FROM l),
k AS (SELECT *, {_spaced('t')} AS f FROM u), g AS (SELECT *, row_number() OVER (PARTITION BY id, f ORDER BY i) AS first FROM k WHERE regexp_matches(f, '[a-z]')),
n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY i) AS n FROM g WHERE first = 1)
SELECT x.id, coalesce(string_agg(n.t, '|' ORDER BY n.i), '') AS variants FROM x LEFT JOIN n ON x.id = n.id AND n.n <= 3 GROUP BY x.id""")
def title_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("t")
    listed = F.array(t, F.lower(t), F.concat(t, F.lit(" 2")), F.lit("日本語"), F.concat(t, F.lit(" 3")), F.concat(t, F.lit(" 4")))
    return _texts(spark, sf_dir).select("id", F.array_join(text.variants(listed), "|").alias("variants"))
