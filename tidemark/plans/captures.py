"""Queries of every kind of captured page and answer: literal payloads made from row numbers, so that SQL knows their rows without parsing."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import selection, telemetry
from tidemark.session import partitions, scratch
from tidemark.sources import captures, extract, plugin, searches
from tidemark.sources import html as h
from tidemark.sources import tables as t

QUERIES: dict = {}
ORACLES: dict = {}
BASE = "https://r.example"
NOW = "2024-03-31 10:20:30"
#: Of each part: a page, and the first chapter number on it.
KEYS = "k AS (SELECT CAST(p_partkey AS BIGINT) AS page_id, CAST(p_partkey % 50 + 1 AS BIGINT) AS n FROM part)"


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey").cast("long")
    return t.table(spark, sf_dir, "part").select(k.alias("page_id"), (k % 50 + 1).alias("n"))


def _write(*parts: str | Column) -> Column:
    """The parts as one string; {n}, {n+1} and {n+2} stand for numbers, {k} for the page."""
    out = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    for mark, value in (("{k}", F.col("page_id")), ("{n}", F.col("n")), ("{n+1}", F.col("n") + 1), ("{n+2}", F.col("n") + 2)):
        out = F.replace(out, F.lit(mark), value.cast("string"))
    return out


#: What stands around the payload of each page: a comment with a link, tags in capitals, elements that nothing closes.
BEFORE = '<!-- <a href="/chapter/9">9</a> --><DIV CLASS=top><P>one<p>two<UL><LI>x<li>y</UL>'
AFTER = "<p>end<b><i>of<P>page"


def _pages(spark: SparkSession, sf_dir: str, *parts: str | Column) -> DataFrame:
    """The pages; their keys are few bytes in few files, so they are dealt out before they become pages."""
    keys = _keys(spark, sf_dir).repartition(max(partitions(spark), spark.sparkContext.defaultParallelism), "page_id")
    return keys.select("page_id", "n", F.lit(f"{BASE}/page").alias("url"), _write(BEFORE, *parts, AFTER).alias("html"))


def _now() -> Column:
    return F.lit(NOW).cast("timestamp_ntz")


def _of(rest: int, of: int, yes: str, no: str = "") -> Column:
    return F.when(F.col("page_id") % of == rest, yes).otherwise(no)


@query(f"""WITH {KEYS}, r AS (SELECT page_id, CAST(n AS DOUBLE) AS chapter_number, '{BASE}/series/x/chapter/' || n AS link, TIMESTAMP '2024-09-04' AS release_date FROM k
UNION ALL SELECT page_id, n + 1.5, '{BASE}/series/x/chapter/' || (n + 1) || '.5', NULL FROM k WHERE page_id % 7 = 0 OR page_id % 3 = 2)
SELECT *, page_id % 7 <> 0 AS locks_known FROM r""")
def divided_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    until = F.when(F.col("page_id") % 3 == 1, "2030").otherwise("2020")
    island = ('{"chapters":[1,[[0,{"number":[0,{n+1}.5],"is_premium":[0,', _of(0, 3, "true", "false"), '],"early_access_until":[0,"', until, '-01-01T00:00:00Z"]}]]]}')
    props = F.when(F.col("page_id") % 7 == 0, "not JSON").otherwise(F.replace(_write(*island), F.lit('"'), F.lit("&quot;")))
    link = '<a href="/series/x/chapter/{n}">'
    listed = f'<div class="divide-y">{link}Chapter <span>September 4th 2024</span></a>{link}again</a><a href="/series/x/chapter/{{n+1}}.5">Extra</a></div>'
    pages = _pages(spark, sf_dir, '<astro-island props="', props, f'"></astro-island>{listed}<a href="/series/x/chapter/999">outside</a>')
    return extract.divided_list(pages, BASE, _now())


@query(f"""WITH {KEYS} SELECT page_id, CAST(n AS DOUBLE) AS chapter_number, '{BASE}/title/1/chapter/' || n AS link,
CASE WHEN page_id % 4 = 0 THEN NULL WHEN page_id % 5 = 0 THEN NULL WHEN page_id % 5 = 1 THEN TIMESTAMP '2024-03-29 10:20:30' ELSE TIMESTAMP '2024-05-06 07:08:09' END AS release_date FROM k""")
def boxed_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    when = F.when(F.col("page_id") % 5 == 0, '<time datetime="bad">1 day ago</time>').when(F.col("page_id") % 5 == 1, "<time>2 days ago</time>").otherwise('<time datetime="2024-05-06T07:08:09Z">1 day ago</time>')
    link = '<a href="/title/1/chapter/{n}">Chapter {n}</a>'
    boxes = F.concat(F.lit(f'<div class="row x">{link}'), when, F.lit(f'</div><div class="row">{link}</div><div class="row"><a href="/title/2/chapter/{{n}}">Chapter {{n}}</a></div><p><a href="/title/3/chapter/77">Chapter 77</a></p>'))
    pages = _pages(spark, sf_dir, F.when(F.col("page_id") % 4 == 0, F.lit(f"<p>{link}</p>")).otherwise(boxes))
    return extract.boxed_list(pages, BASE, "park", ".row", "/chapter/", _now(), fallback=True)


@query(f"""WITH {KEYS} SELECT page_id, CAST(n AS DOUBLE) AS chapter_number, '{BASE}/chapters/ID' || page_id AS link, TIMESTAMP '2024-01-02 03:04:05' AS release_date FROM k
UNION ALL SELECT page_id, n + 1, '{BASE}/chapters/' || (n + 1) || 'abc', NULL FROM k UNION ALL SELECT page_id, n + 1, '{BASE}/chapters/' || (n + 1) || 'abc', NULL FROM k""")
def fragment_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = '<a href="/chapters/ID{k}"><span class="grow flex"><span>Chapter {n}</span></span><time datetime="2024-01-02T03:04:05Z"></time></a>'
    bare = '<a href="/chapters/{n+1}abc"></a>'
    return extract.fragment_list(_pages(spark, sf_dir, one + bare + bare + '<a href="/other/5">x</a>'), BASE)


@query(f"""WITH {KEYS} SELECT page_id, CAST(n AS DOUBLE) AS chapter_number, '{BASE}/s-chapter-' || n || '/' AS link, CASE WHEN page_id % 5 = 0 THEN TIMESTAMP '2026-08-24' ELSE TIMESTAMP '2024-02-03' END AS release_date FROM k
UNION ALL SELECT page_id, n + 1, '{BASE}/s-chapter-' || (n + 1) || '/', TIMESTAMP '2026-08-24' FROM k WHERE page_id % 3 <> 0
UNION ALL SELECT page_id, n + 2, '{BASE}/s-chapter-' || (n + 2) || '/', NULL FROM k""")
def theme_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    script = '<script type="application/ld+json">{"@graph":[{"@type":"Chapter","url":"https://r.example/s-chapter-{n}/","position":{n},"datePublished":"2024-02-03"}]'

    def item(n: str, price: str | Column):
        start = f'<li data-num="{n}"><div class="chbox"><div class="eph-num"><a href="{BASE}/s-chapter-{n}/"><span class="chapternum">Chapter {n}</span><span class="chapterdate">August 24, 2026</span></a></div>'
        return start, price, "</div>"  # the next item ends this one

    price = _of(0, 3, '<span class="text-gold">10</span>')
    parts = (script, _of(0, 5, "", "}"), '</script><div id="chapterlist"><ul>', *item("{n+1}", price), *item("{n}", ""), '</ul></div><a href="/s-chapter-{n+2}/">x</a><a href="/s-chapter-{n+1}/">y</a>')
    return extract.theme_pages(_pages(spark, sf_dir, *parts), BASE, _now())


@query(f"""WITH {KEYS} SELECT page_id, CASE page_id % 3 WHEN 0 THEN CAST(n AS DOUBLE) WHEN 1 THEN n + 0.5 ELSE 0 END AS chapter_number,
'{BASE}/chapters/' || CASE WHEN page_id % 3 = 1 THEN 'x-chapter-' || n || '-5' ELSE 'x' END AS link, TIMESTAMP '{NOW}' AS release_date, page_id % 3 = 2 AS defaulted FROM k""")
def api_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id") % 3
    rows = _keys(spark, sf_dir).select("page_id", F.when(k == 1, _write("x-chapter-{n}-5")).otherwise("x").alias("id"), F.when(k == 0, _write("Chapter: {n}")).otherwise("Special").alias("title"), _now().alias("release_date"))
    return extract.api_chapters(rows, BASE)


@query(f"""WITH {KEYS} SELECT page_id, 'found' AS kind, 's' || page_id AS id, 'Title ' || n AS title, CAST(NULL AS DOUBLE) AS chapter_number, CAST(NULL AS TIMESTAMP) AS release_date FROM k WHERE page_id % 6 > 0
UNION ALL SELECT page_id, 'chapter', '{BASE}/chapters/c' || n, NULL, CAST(n AS DOUBLE), CASE WHEN page_id % 2 = 0 THEN TIMESTAMP '2024-05-01 10:00:00' END FROM k""")
def api_search_and_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An API's search answers (one in six has no results) and series answers."""
    keys = _keys(spark, sf_dir)
    search = F.when(F.col("page_id") % 6 == 0, "{}").otherwise(_write('{"results":[{"id":"s{k}","title":"Title {n}"}]}'))
    found = extract.results_search(keys.select("page_id", search.alias("body")))
    info = _write('{"id":"s","chapters":[{"id":"c{n}","title":"Chapter {n}","releasedDate":"', _of(0, 2, "2024-05-01T10:00:00Z", "soon"), '"}]}')
    rows = extract.info_chapters(keys.select("page_id", info.alias("body")), BASE)
    none = F.lit(None)
    return found.select("page_id", F.lit("found").alias("kind"), "id", "title", none.cast("double").alias("chapter_number"), none.cast("timestamp_ntz").alias("release_date")).unionByName(
        rows.select("page_id", F.lit("chapter").alias("kind"), F.col("link").alias("id"), none.cast("string").alias("title"), "chapter_number", "release_date")
    )


@query(f"""WITH {t.ATTEMPTS}, s AS (SELECT CAST(c_custkey AS BIGINT) AS series, c_custkey % 3 AS k FROM customer),
x AS (SELECT series, 0 AS step, 'Main ' || series AS query, false AS keywords FROM s UNION ALL SELECT series, 1, 'English', false FROM s WHERE k = 1 UNION ALL SELECT series, 2, 'One', false FROM s WHERE k > 0 UNION ALL SELECT series, 3, 'Main ' || series, true FROM s)
SELECT series, CAST(step AS INTEGER) AS step, query, keywords FROM x""")
def ladder_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey").cast("long")
    main = F.concat(F.lit("Main "), k.cast("string"))
    english = F.when(k % 3 == 1, "English").when(k % 3 == 2, main)
    synonyms = F.when(k % 3 > 0, F.array(F.lit("One"), F.lit("Two"))).otherwise(F.array().cast("array<string>"))
    return selection.ladder_steps(t.table(spark, sf_dir, "customer").select(k.alias("series"), main.alias("title"), english.alias("english"), synonyms.alias("synonyms")))


_LADDER = """s AS (SELECT CAST(c_custkey AS BIGINT) AS series, 'Main ' || c_custkey AS title, CASE c_custkey % 4 WHEN 1 THEN 'English' WHEN 2 THEN 'Main ' || c_custkey END AS english,
CASE c_custkey % 3 WHEN 1 THEN ['One', '漫画', 'one!', 'Two'] WHEN 2 THEN ['Main ' || c_custkey] ELSE CAST([] AS VARCHAR[]) END AS synonyms FROM customer)"""


def _ladder_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey").cast("long")
    main = F.concat(F.lit("Main "), k.cast("string"))
    synonyms = F.when(k % 3 == 1, F.array(*map(F.lit, ("One", "漫画", "one!", "Two")))).when(k % 3 == 2, F.array(main)).otherwise(F.array().cast("array<string>"))
    return t.table(spark, sf_dir, "customer").select(k.alias("series"), main.alias("title"), F.when(k % 4 == 1, "English").when(k % 4 == 2, main).alias("english"), synonyms.alias("synonyms"))


@query(f"""WITH {_LADDER} SELECT series, 0 AS step, title AS query FROM s UNION ALL SELECT series, 1, CASE WHEN english <> title THEN english ELSE synonyms[1] END FROM s WHERE english <> title OR synonyms[1] <> title""")
def fallback_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.fallback_steps(_ladder_series(spark, sf_dir))


@query(f"""WITH {_LADDER} SELECT series, CAST(i - 1 AS INTEGER) AS step, v[i] AS query, array_to_string(v, '|') AS variants FROM (SELECT series, v, unnest(range(1, 4)) AS i FROM
(SELECT series, list_concat([title], CASE WHEN english <> title THEN [english] ELSE CAST([] AS VARCHAR[]) END, CASE WHEN len(synonyms) > 1 THEN ['One', 'Two'] ELSE CAST([] AS VARCHAR[]) END) AS v FROM s)) WHERE i <= len(v)""")
def variant_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.variant_steps(_ladder_series(spark, sf_dir)).withColumn("variants", F.array_join("variants", "|"))


@query(f"""WITH {t.ATTEMPTS}, f AS (SELECT series, provider, seq % 2 AS step, chapters % 3 AS results, seq % 5 = 0 AS blank, CASE WHEN chapters % 3 > 0 AND ms < 20 THEN 'r' || seq END AS match, CASE WHEN outcome = 'error' THEN 'HTTP 500' END AS error, seq,
row_number() OVER (PARTITION BY series, provider, seq % 2 ORDER BY seq) AS rn FROM attempts), a AS (SELECT * FROM f WHERE rn = 1 AND step = 0), b AS (SELECT * FROM f WHERE rn = 1 AND step = 1),
m AS (SELECT a.series, a.provider, b.series IS NOT NULL AND a.error IS NULL AND a.results = 0 AS second, a, b FROM a LEFT JOIN b ON a.series = b.series AND a.provider = b.provider),
x AS (SELECT series || ':' || provider AS series, CASE WHEN second THEN 1 ELSE 0 END AS step, CASE WHEN second THEN b.error ELSE a.error END AS error, CASE WHEN second THEN b.match ELSE a.match END AS match, second AND a.blank AS waits FROM m)
SELECT series, step, CASE WHEN error IS NOT NULL THEN 'error' WHEN match IS NOT NULL THEN 'match' ELSE 'empty' END AS outcome, CASE WHEN error IS NULL THEN match END AS match, waits FROM x""")
def fallback_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first attempts of even and odd number of each series and source, as its two tries; those without a first one are left out."""
    a = t.attempts(spark, sf_dir).withColumns({"step": (F.col("seq") % 2).cast("int"), "results": F.col("chapters") % 3, "blank": F.col("seq") % 5 == 0})
    first = a.groupBy("series", "provider", "step").agg(F.min(F.struct("seq", "results", "blank", "ms", "outcome")).alias("f")).select("series", "provider", "step", "f.*")
    tries = first.select(
        F.concat(F.col("series").cast("string"), F.lit(":"), "provider").alias("series"), "step", "results", "blank",
        F.when((F.col("results") > 0) & (F.col("ms") < 20), F.concat(F.lit("r"), F.col("seq").cast("string"))).alias("match"), F.when(F.col("outcome") == "error", "HTTP 500").alias("error"),
    )
    began = tries.filter("step = 0").select("series")
    return selection.fallback_outcome(tries.join(began, "series", "left_semi"))


@query(f"""WITH {t.ATTEMPTS}, f AS (SELECT series, provider, CAST(seq % 4 AS INTEGER) AS step, CASE WHEN ms > 20 AND ms < 22 THEN 'r' || (seq % 9) END AS match, outcome = 'error' AS bad FROM attempts),
m AS (SELECT series, min(step * 1000 + CAST(substr(match, 2) AS INTEGER)) AS b, bool_or(bad) AS bad FROM f GROUP BY series)
SELECT series, CASE WHEN b IS NOT NULL THEN 'match' WHEN bad THEN 'error' ELSE 'empty' END AS outcome, CAST(b // 1000 AS INTEGER) AS step, 'r' || (b % 1000) AS match FROM m""")
def ladder_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = t.attempts(spark, sf_dir)
    match = F.when((F.col("ms") > 20) & (F.col("ms") < 22), F.concat(F.lit("r"), (F.col("seq") % 9).cast("string")))
    error = F.when(F.col("outcome") == "error", "HTTP 500")
    return selection.ladder_outcome(a.select("series", (F.col("seq") % 4).cast("int").alias("step"), match.alias("match"), error.alias("error")))


@query(f"""WITH {KEYS} SELECT page_id, 'Site' AS provider, CASE WHEN page_id % 4 = 0 THEN 'error' WHEN page_id % 4 = 1 THEN 'empty' ELSE 'chapters' END AS outcome, CAST(CASE WHEN page_id % 4 > 1 THEN 2 ELSE 0 END AS BIGINT) AS chapters FROM k""")
def source_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A configured site over all captures: every page has an outcome, and rows of a failed one don't count."""
    links = '<a href="/s-chapter-{n}/">x</a><a href="/s-chapter-{n+1}/">y</a>'
    pages = _pages(spark, sf_dir, F.when(F.col("page_id") % 4 == 1, "<p></p>").otherwise(links)).withColumn("status", F.when(F.col("page_id") % 4 == 0, 500).otherwise(200))
    attempts, _ = plugin.scrape(plugin.theme_site("Site", BASE), pages, _now())
    return attempts.select("page_id", "provider", "outcome", "chapters")


def _read(html: str, url: str):
    """Chapters by a function of a page; what it can't stand raises."""
    for n in re.findall('<a href="/c/([^"]*)">', html):
        yield float(n), f"{BASE}/c/{n}", None


@query(f"""WITH {KEYS}, p AS (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'error' WHEN page_id % 5 = 1 THEN 'empty' WHEN page_id % 7 = 0 THEN 'error' ELSE 'chapters' END AS outcome FROM k WHERE page_id BETWEEN 20 AND 900 AND page_id % 2 = 0)
SELECT page_id, 'Even' AS provider, outcome, CAST(CASE WHEN outcome = 'chapters' THEN 2 ELSE 0 END AS BIGINT) AS chapters FROM p""")
def captured_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of two sources written as capture files in two turns, and one source's range of them read by a function that raises on some."""
    captures.register(spark)
    broken = F.when(F.col("page_id") % 7 == 0, '<a href="/c/none">').otherwise("")
    pages = _pages(spark, sf_dir, F.when(F.col("page_id") % 5 == 1, "").otherwise(F.lit('<a href="/c/{n}">x</a><a href="/c/{n+1}">')), F.when(F.col("page_id") % 5 != 1, broken).otherwise(""))
    pages = pages.select(F.when(F.col("page_id") % 2 == 0, "Even").otherwise("Odd: 1/2").alias("source"), "page_id", "url", F.when(F.col("page_id") % 5 == 0, 503).otherwise(200).alias("status"), "html")
    folder = scratch(spark, "captures")
    for turn in (0, 1):
        captures.write(pages.filter(F.col("page_id") % 3 == 0 if turn == 0 else F.col("page_id") % 3 > 0), folder, turn)
    held = spark.read.format("captures").load(folder).filter("source = 'Even' AND page_id >= 20 AND page_id <= 900")
    attempts, _ = plugin.scrape(plugin.page_site("Even", _read), held, _now())
    return attempts.select("page_id", "provider", "outcome", "chapters")


@query(f"""WITH {KEYS} SELECT page_id, CAST(NULL AS DOUBLE) AS chapter_number, CASE page_id % 4 WHEN 3 THEN 'chapters' WHEN 2 THEN 'empty' ELSE 'error' END AS link, CAST(NULL AS TIMESTAMP) AS release_date FROM k
UNION ALL SELECT page_id, n, '{BASE}/chapter/b', TIMESTAMP '2024-01-01' FROM k WHERE page_id % 4 = 3 UNION ALL SELECT page_id, n + 1, '{BASE}/chapter/c', TIMESTAMP '2024-01-01' FROM k WHERE page_id % 4 = 3""")
def chapter_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    def chapter(ident: str, number: str, outside: str | Column) -> tuple:
        return f'{{"id":"{ident}","attributes":{{"chapter":"{number}","publishAt":"2024-01-01T00:00:00Z","externalUrl":"', outside, '"}}'

    else_ = _of(2, 4, "https://e")
    first = _write('{"data":[', *chapter("a", "{n}", "https://e"), ",", *chapter("b", "{n}", else_), ",", *chapter("c", "{n+1}x", else_), "]}")
    last = F.when(F.col("page_id") % 4 == 2, '{"data":[]}').otherwise(_write('{"data":[', *chapter("d", "{n+1}", ""), "]}"))
    keys = _keys(spark, sf_dir)
    one = keys.select("page_id", F.lit(0).alias("part"), F.lit(200).alias("status"), first.alias("body"))
    two = keys.filter("page_id % 4 <> 1").select("page_id", F.lit(1).alias("part"), F.when(F.col("page_id") % 4 == 0, 500).otherwise(200).alias("status"), last.alias("body"))
    return extract.feed(one.unionByName(two), BASE, page_size=3)


@query(f"""WITH {KEYS} SELECT page_id, 'm' || page_id AS id, CASE page_id % 4 WHEN 0 THEN 'English ' || n WHEN 1 THEN 'Romaji' WHEN 2 THEN 'Other' ELSE 'Unknown' END AS title, 'F,J' AS alternatives, CASE WHEN page_id % 5 > 0 THEN CAST(page_id AS VARCHAR) END AS mal_id FROM k""")
def json_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id") % 4
    title = F.when(k == 0, '"ja":"J","en":"English {n}"').when(k == 1, '"ja":"J","ja-ro":"Romaji"').when(k == 2, '"xx":"Other"').otherwise("")
    body = _write('{"data":[{"id":"m{k}","attributes":{"title":{', title, '},"altTitles":[{"fr":"F"},{"ja":"J"}],"links":{', F.when(F.col("page_id") % 5 > 0, '"mal":"{k}"').otherwise(""), "}}}]}")
    found = extract.search_titles(_keys(spark, sf_dir).select("page_id", body.alias("body")))
    return found.select("page_id", "id", "title", F.array_join("alt_titles", ",").alias("alternatives"), "mal_id")


@query(f"""WITH {KEYS} SELECT page_id, '{BASE}/s' || page_id AS link, 's' || page_id AS slug, 'It’s – "' || n || '" <&>' AS title FROM k""")
def rest_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = _write('[{"link":null,"slug":"x","title":{"rendered":"A"}},{"link":"https://r.example/s{k}","slug":"s{k}","title":{"rendered":"It&#8217;s &#8211; &quot;{n}&quot; &lt;&amp;&gt;"}},{"link":"y"}]')
    return extract.rest_search(_keys(spark, sf_dir).select("page_id", body.alias("body"))).select("page_id", "link", "slug", "title")


@query(f"""WITH {KEYS} SELECT page_id, '/series/s' || i || '-' || page_id AS link, CASE WHEN i = 3 THEN 'From image' ELSE 'Title ' || i END AS title, CAST(i + 1 AS BIGINT) AS rank FROM k, range(0, 10) r(i)""")
def link_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    def link(i: int) -> str:
        inner = '<img alt="From image">' if i == 3 else f"Title {i}"
        return f'<a href="/series/s{i}-{{k}}"> {inner} </a>'

    noise = '<a href="/series/s0-{k}/">Again</a><a href="/series/s0-{k}/chapter-1">Chapter</a><a href="/series/long">' + "x" * 200 + '</a><a href="/other">O</a><a href="/series/none"></a>'
    found = extract.search_links(_pages(spark, sf_dir, link(0) + noise + "".join(map(link, range(1, 13)))), "/series/")
    return found.select("page_id", "link", "title", F.col("rank").cast("long").alias("rank"))


@query(f"""WITH {KEYS} SELECT page_id, CASE WHEN page_id % 6 IN (0, 1, 2) THEN 'error' WHEN page_id % 6 = 3 THEN 'chapters' ELSE 'empty' END AS outcome, page_id % 6 IN (0, 1, 4) AS blank FROM k""")
def payload_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id") % 6
    link = '<a href="/chapter/{n}">x</a>'
    html = F.when(k == 0, "<html><title> Just a moment...</title></html>").when(k == 1, "<div id=cf-browser-verification></div>").when(k.isin(2, 3), link).when(k == 4, "<p>nothing</p>").otherwise("<p>" + "x" * 5000 + "</p>")
    pages = _pages(spark, sf_dir, html).withColumn("status", F.when(k == 2, 503).otherwise(200))
    links = h.elements(pages, ("a",))
    return h.outcomes(pages, links).select("page_id", "outcome", "blank")


@query(f"""WITH {KEYS}, p(provider) AS (VALUES ('MangaPark'), ('Weeb Central'), ('Other'))
SELECT page_id, provider, CASE WHEN provider <> 'Other' AND page_id % 3 = 0 THEN 'English ' || n ELSE 'Main ' || n END AS title, 'Main ' || n || '|One|Two' AS alternatives FROM k, p""")
def search_titles_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id") % 3
    english = F.when(k == 0, _write("English {n}")).when(k == 1, "")
    out = _keys(spark, sf_dir).withColumn("provider", F.explode(F.array(*map(F.lit, ("MangaPark", "Weeb Central", "Other")))))
    return out.select("page_id", "provider", selection.title_for(F.col("provider"), _write("Main {n}"), english).alias("title"), F.array_join(text.alternatives(_write("Main {n}"), F.lit(" One ;; Two; ")), "|").alias("alternatives"))


@query(f"""WITH {t.ATTEMPTS}, f AS (SELECT series, CAST(seq % 4 AS BIGINT) AS step, CASE WHEN outcome = 'chapters' THEN 'r' || (seq % 9) END AS match FROM attempts),
m AS (SELECT series, step, match, row_number() OVER (PARTITION BY series ORDER BY step, match) AS rn FROM f WHERE match IS NOT NULL) SELECT series, step, match FROM m WHERE rn = 1""")
def retry_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    match = F.when(F.col("outcome") == "chapters", F.concat(F.lit("r"), (F.col("seq") % 9).cast("string")))
    return selection.ladder(t.attempts(spark, sf_dir).select("series", (F.col("seq") % 4).cast("long").alias("step"), match.alias("match")))


@query(f"""WITH {t.ATTEMPTS}, i AS (SELECT *, sum(CASE WHEN outcome = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY provider ORDER BY seq) AS island FROM attempts),
r AS (SELECT *, sum(CASE WHEN outcome = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY provider, island ORDER BY seq) AS run FROM i),
x AS (SELECT provider, min(seq) FILTER (run >= 4) AS tripped_at FROM r GROUP BY provider)
SELECT seq, a.provider, outcome FROM attempts a JOIN x ON a.provider = x.provider WHERE tripped_at IS NULL OR seq <= tripped_at""")
def breaker_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = t.attempts(spark, sf_dir)
    return telemetry.after_breaker(a, telemetry.breaker(a, 4)).select("seq", "provider", "outcome")


@query(f"""WITH {KEYS} SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'Given' WHEN 1 THEN 'Picture' WHEN 2 THEN 'Text ' || n ELSE 'a ' || page_id END AS title, 'a-' || page_id AS slug, '{BASE}/manga/a-' || page_id || '/' AS link FROM k
UNION ALL SELECT page_id, 'b', 'b', '{BASE}/series/b/' FROM k""")
def theme_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id") % 4
    given = F.when(k == 0, ' title=" Given "').otherwise("")
    inner = F.when(k == 1, '<i><img src="x" alt="Picture "></i>').when(k == 2, " Text  {n} ").otherwise("")
    link = F.concat(F.lit('<a href="/manga/a-{k}/"'), given, F.lit(">"), inner, F.lit("</a>"))
    rest = f'<a href="/manga/a-{{k}}/chapter-1">Later</a><a href="/manga/">Index</a><a href="https://o.example/manga/c/">Other</a><a href="/about"><img alt="No"></a><a href="{BASE}/series/"></a><a href="{BASE}/series/b/"></a>'
    found = searches.theme_search(_pages(spark, sf_dir, link, rest), BASE, ("/manga/", "/series/"))
    return found.select("page_id", "title", "slug", "link")


@query(f"""WITH {KEYS}, r AS (SELECT page_id, 'Bold ' || n AS title, '{BASE}/comics/s' || page_id AS link FROM k UNION ALL SELECT page_id, 'Picture', '{BASE}/comics/p' FROM k
UNION ALL SELECT page_id, 'Outside', '{BASE}/comics/o' FROM k WHERE page_id % 4 > 1) SELECT * FROM r
UNION ALL SELECT page_id, 'Title ' || i, '{BASE}/comics/n' || i FROM k, range(0, 20) t(i) WHERE i < CASE WHEN page_id % 4 > 1 THEN 7 ELSE 8 END""")
def grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id") % 4
    kind = F.when(k == 0, "x grid grid-cols-2").when(k == 1, "grid").when(k == 2, "plain").otherwise("none")
    inner = '<a href="/comics/s{k}"><span class="block font-bold"> Bold  {n} </span><span>more</span></a><a href="/comics/s{k}/chapter/1">Chapter</a><a href="comics/p"><img alt="Picture"></a><a href="/comics/s{k}" title="Again"></a><a href="/comics/e"> </a>'
    outside = F.concat(F.when(k == 0, F.lit('<div class="grid">')).otherwise(F.lit("<div>")), F.lit('<a href="/comics/o">Outside</a></div>'))
    tail = "".join(f'<a href="/comics/n{i}" title="Title {i}"><img alt="x"></a>' for i in range(12))
    pages = _pages(spark, sf_dir, outside, '<div class="', kind, f'"><p>{inner}{tail}</p></div>')
    return searches.grid_search(pages, BASE).select("page_id", "title", "link")


@query(f"""WITH {KEYS} SELECT page_id, CASE WHEN page_id % 3 = 2 THEN 'Text' WHEN page_id % 3 = 1 THEN 'Heading ' || n ELSE 'Linked ' || n END AS title, '{BASE}/title/a' || page_id AS link FROM k
UNION ALL SELECT page_id, 'Given', '{BASE}/title/b' FROM k""")
def row_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id") % 3
    row = '<div class="flex border-b border-b-base-200 pb-5 x">'
    first = F.when(k == 0, F.lit(f'{row}<a href="/title/a{{k}}"> Linked {{n}} </a><h3>No</h3></div>')).when(k == 1, F.lit(f'{row}<a href="/title/a{{k}}"><img></a><b class="name">Heading {{n}}</b><h3>No</h3></div>')).otherwise(F.lit('<a href="/title/a{k}">Text</a>'))
    second = F.when(k == 2, F.lit('<a href="title/b" title="Lost"></a><a href="/title/b" title="Given"></a>')).otherwise(F.lit(f'{row}<a href="/title/b" title="Given"></a></div>{row}<a href="/title/b">Repeat</a></div>{row}<p>none</p></div>'))
    bare = F.when(k == 2, F.lit('<a href="/title/c"></a><a href="/title/c">Too late</a>')).otherwise(F.lit('<a href="/title/c">Outside</a>'))
    found = searches.row_search(_pages(spark, sf_dir, first, second, bare), BASE)
    return found.select("page_id", "title", "link")


@query(f"""WITH {KEYS} SELECT page_id, 'Title ' || n AS title, '{BASE}/manga/a.' || page_id AS link FROM k UNION ALL SELECT page_id, 'Far', 'https://o.example/manga/b' FROM k WHERE page_id % 2 = 0""")
def list_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    def item(link: str) -> str:
        return f'<div class="item"><a href="/manga/cover">Cover</a><h3 class="title">{link}</h3></div>'

    far = F.when(F.col("page_id") % 2 == 0, F.lit(item('<a href="https://o.example/manga/b">Far</a>'))).otherwise(F.lit(item("<a>No link</a>")))
    listed = item('<a href="/manga/a.{k}"> Title {n} </a><a href="/manga/z">Second</a>') + item('<a href="manga/a.{k}">Repeat</a>') + item('<a href="/manga/e"></a>') + item('<a href="/manga/e">Late</a>')
    found = searches.list_search(_pages(spark, sf_dir, '<div id="book_list">', listed, far, "</div>", item('<a href="/manga/o">Outside</a>')), BASE)
    return found.select("page_id", "title", "link")


@query(f"""WITH {KEYS} SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'Wide ' || n ELSE 'Short' END AS title, page_id || '/slug' AS id FROM k UNION ALL SELECT page_id, 'Short', 'two' FROM k UNION ALL SELECT page_id, 'Short', 'two' FROM k""")
def card_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    def card(ident: str, wide: str | Column = "") -> tuple:
        return f'<article class="x bg-base-300"><section><a href="{BASE}/series/{ident}"><div class="text-ellipsis"> Short </div></a></section>', wide, "</article>"

    wide = F.when(F.col("page_id") % 2 == 0, F.lit('<section class="hidden lg:block"><span class="tooltip"><a href="x"> Wide {n}</a></span></section>')).otherwise(F.lit('<section class="hidden"><span class="tooltip"><a href="x">Narrow</a></span></section>'))
    found = searches.card_search(_pages(spark, sf_dir, *card("{k}/slug", wide), *card("two"), *card("two"), *card(""), '<article><section><a href="/series/o"><b class="text-ellipsis">Outside</b></a></section></article>'))
    return found.select("page_id", "title", "id")


@query(f"""WITH {KEYS} SELECT page_id, CASE WHEN page_id % 4 = 1 THEN 'Query' WHEN page_id % 4 = 2 THEN 'é a+' || n ELSE 'one two' END AS title, CASE WHEN page_id % 4 = 1 THEN '{BASE}/x' WHEN page_id % 4 = 2 THEN '{BASE}/manga/%C3%A9-a+' || n || '.' || page_id || '/c1' ELSE 'https://o.example/manga/one-two.5' END AS link,
CASE WHEN page_id % 4 = 2 THEN 'é a+' || n WHEN page_id % 4 = 3 THEN 'one two' END AS slug FROM k WHERE page_id % 4 > 0""")
def redirected_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id") % 4
    location = F.when(k == 1, F.lit("x")).when(k == 2, _write("/manga/%C3%A9-a+{n}.{k}/c1")).otherwise("https://o.example/manga/one-two.5")
    answers = _keys(spark, sf_dir).select("page_id", F.lit(" Query ").alias("query"), F.when(k == 0, 200).otherwise(302).alias("status"), location.alias("location"))
    return searches.redirected(answers, BASE).withColumn("slug", text.url_slug(F.col("link"), "manga", "/?#."))


@query(f"""WITH {KEYS} SELECT page_id, 'Site' AS provider, CASE WHEN page_id % 4 = 0 THEN 'error' WHEN page_id % 4 = 1 THEN 'empty' ELSE 'found' END AS outcome, CAST(CASE WHEN page_id % 4 > 1 THEN 2 ELSE 0 END AS BIGINT) AS found, page_id % 4 = 1 AS blank,
CASE WHEN page_id % 4 > 1 THEN 'One,s ' || n END AS titles FROM k""")
def source_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A configured site over all its search pages: every page has an outcome, and candidates of a failed one don't count."""
    links = '<a href="/manga/one/" title="One">x</a><a href="/manga/s-{n}/"></a><a href="/manga/one/">again</a>'
    pages = _pages(spark, sf_dir, F.when(F.col("page_id") % 4 == 1, "<p></p>").otherwise(links)).withColumn("status", F.when(F.col("page_id") % 4 == 0, 500).otherwise(200))
    answers, met = plugin.find(plugin.theme_site("Site", BASE), pages)
    titles = met.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "title"))), lambda x: x["title"]), ",").alias("titles"))
    return answers.join(titles, "page_id", "left").select("page_id", "provider", "outcome", "found", "blank", "titles")
