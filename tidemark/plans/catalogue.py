"""Queries of the catalogue over the test tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import cadence, delta, notify, reads, selection, telemetry
from tidemark.operators.versions import Table
from tidemark.session import materialize, scratch
from tidemark.sources import tables as t

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _now():
    return F.lit(t.NOW).cast("timestamp_ntz")


def _ms(column: str):
    return F.unix_micros(F.col(column).cast("timestamp"))


@query(f"""WITH {t.CHAPTERS}, {t.PROVIDERS}, {t.SERIES},
top AS (SELECT manga_id, max(chapter_number) AS n FROM chapters GROUP BY 1),
ranked AS (SELECT c.manga_id, n, min(created_at) AS seen FROM chapters c JOIN top ON c.manga_id = top.manga_id AND chapter_number = n GROUP BY 1, 2 ORDER BY seen DESC, 1 LIMIT 18),
r AS (SELECT c.manga_id, c.chapter_number, name, link, created_at, row_number() OVER (PARTITION BY c.manga_id, name ORDER BY created_at, link) AS rn
      FROM ranked JOIN chapters c ON c.manga_id = ranked.manga_id AND c.chapter_number = n JOIN providers ON id = provider_id WHERE enabled)
SELECT r.manga_id AS mal_id, any_value(title) AS title, any_value(chapter_number) AS chapter_number, min(created_at) AS created_at,
  string_agg(name || '=' || link, ', ' ORDER BY lower(name)) FILTER (rn = 1) AS providers
FROM r JOIN mangas ON mal_id = manga_id GROUP BY r.manga_id""")
def latest_across_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.latest_across_series(t.chapters(spark, sf_dir), t.providers(spark, sf_dir), t.series(spark, sf_dir))


@query(f"""WITH {t.CHAPTERS}, {t.PROVIDERS}
SELECT manga_id, name AS provider_name, chapter_number, link, created_at FROM chapters JOIN providers ON id = provider_id
WHERE enabled AND manga_id = 7 ORDER BY chapter_number DESC, provider_id LIMIT 20 OFFSET 20""")
def chapters_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.page(t.chapters(spark, sf_dir), t.providers(spark, sf_dir), 7, number=2, size=20)


@query(f"""WITH {t.CHAPTERS}, {t.PROVIDERS}, r AS (SELECT manga_id, name AS provider_name, chapter_number, link, created_at, row_number() OVER (PARTITION BY manga_id ORDER BY chapter_number DESC, provider_id) - 1 AS rank
FROM chapters JOIN providers ON id = provider_id WHERE enabled) SELECT * FROM r WHERE rank >= 10 AND rank < 20""")
def second_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page of ten of every series, from the table that is laid out by rank."""
    path = scratch(spark, "ranked")
    reads.write_ranked(t.chapters(spark, sf_dir), t.providers(spark, sf_dir), path)
    rows = spark.read.parquet(path).filter("rank >= 10 AND rank < 20")
    return rows.select("manga_id", "provider_name", "chapter_number", "link", "created_at", "rank")


@query(f"WITH {t.CHAPTERS}, {t.PROVIDERS} SELECT manga_id, count(*) AS total FROM chapters JOIN providers ON id = provider_id WHERE enabled GROUP BY 1")
def chapters_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.totals(t.chapters(spark, sf_dir), t.providers(spark, sf_dir))


@query(f"""WITH {t.CHAPTERS}, {t.PROVIDERS}, c AS (SELECT chapters.*, name FROM chapters JOIN providers ON id = provider_id WHERE enabled),
e AS (SELECT manga_id, min(chapter_number) AS lo, max(chapter_number) AS hi FROM c GROUP BY 1)
SELECT c.manga_id, side, chapter_number, name AS provider_name, link FROM c JOIN e ON c.manga_id = e.manga_id, (VALUES ('first'), ('last')) s(side)
WHERE (side = 'first' AND chapter_number = lo) OR (side = 'last' AND chapter_number = hi)""")
def first_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.boundaries(t.chapters(spark, sf_dir), t.providers(spark, sf_dir))


@query(f"""WITH {t.CHAPTERS}, {t.PROVIDERS},
r AS (SELECT *, row_number() OVER (PARTITION BY manga_id ORDER BY chapter_number DESC, provider_id DESC, link DESC) AS rn FROM chapters)
SELECT manga_id, chapter_number, name AS provider_name, link FROM r LEFT JOIN providers ON id = provider_id WHERE rn = 1""")
def latest_chapter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.latest_chapter(t.chapters(spark, sf_dir), t.providers(spark, sf_dir))


@query(f"WITH {t.CHAPTERS}, {t.SERIES} SELECT mal_id, mal_id IN (SELECT manga_id FROM chapters) AS has_chapters FROM mangas")
def has_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.has_chapters(t.chapters(spark, sf_dir), t.series(spark, sf_dir))


@query(f"WITH {t.PROVIDERS} SELECT * FROM providers ORDER BY name")
def providers_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.providers_by_name(t.providers(spark, sf_dir))


@query(f"WITH {t.PROVIDERS} SELECT * FROM providers WHERE name = 'Click'")
def provider_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.provider(t.providers(spark, sf_dir), "Click")


@query(f"""WITH {t.PROVIDERS}, cfg AS (SELECT name, upper(name) || ' ' AS shown, true AS enabled FROM providers UNION ALL SELECT 'Un Known', 'Un Known', true)
SELECT shown AS name, lower(regexp_replace(shown, '\\s+', '', 'g')) AS key, coalesce(p.enabled, cfg.enabled) AS enabled FROM cfg LEFT JOIN providers p ON lower(p.name) = lower(regexp_replace(shown, '\\s+', '', 'g'))""")
def provider_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = t.providers(spark, sf_dir)
    config = stored.select(F.concat(F.upper("name"), F.lit(" ")).alias("name")).union(spark.createDataFrame([("Un Known",)], "name string")).withColumn("enabled", F.lit(True))
    return reads.provider_state(config, stored).select("name", "key", "enabled")


@query(f"WITH {t.CHAPTERS} SELECT chapter_number, link FROM chapters WHERE manga_id = 7 AND provider_id = 'click'")
def existing_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.existing_links(t.chapters(spark, sf_dir), 7, "click")


@query(f"WITH {t.CHAPTERS} SELECT DISTINCT manga_id FROM chapters")
def ids_with_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.chapters(spark, sf_dir).select("manga_id").distinct()


@query("SELECT o_custkey AS manga_id, max(o_orderdate) AS last_chapter_at FROM orders GROUP BY 1")
def series_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cadence.activity(t.activity_rows(spark, sf_dir))


@query("SELECT o_custkey AS manga_id, max(o_orderdate) AS last_chapter_at, count(*) AS chapters FROM orders GROUP BY 1")
def kept_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity added up batch by batch; the last batch comes twice."""
    table, rows = Table(spark, scratch(spark, "activity"), ["manga_id"], 8), t.table(spark, sf_dir, "orders")
    for k in (0, 1, 2, 2):
        cadence.keep_activity(table, rows.filter(F.col("o_orderkey") % 3 == k).select(F.col("o_custkey").alias("manga_id"), F.col("o_orderdate").alias("created_at")), ("orders", k))
    return table.read()


@query("SELECT DISTINCT o_custkey AS manga_id, CAST(NULL AS TIMESTAMP) AS last_chapter_at FROM orders")
def series_activity_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cadence.activity(t.activity_rows(spark, sf_dir), complete=False)


@query(f"WITH {t.SERIES} SELECT mal_id, title, status, last_chapters_update FROM mangas WHERE mal_id IN (SELECT user_id FROM events)")
def series_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.cards(t.series(spark, sf_dir), t.table(spark, sf_dir, "events").select(F.col("user_id").alias("mal_id")))


_TIER = f"""a AS (SELECT o_custkey AS id, max(o_orderdate) AS d FROM orders GROUP BY 1),
g AS (SELECT id, CASE WHEN d > TIMESTAMP '{t.NOW}' OR epoch_us(TIMESTAMP '{t.NOW}') - epoch_us(d) <= 9 * 86400000000 THEN 'active' WHEN epoch_us(TIMESTAMP '{t.NOW}') - epoch_us(d) <= 30 * 86400000000 THEN 'slow' ELSE 'dormant' END AS tier FROM a)"""


@query(f"WITH {_TIER} SELECT tier, count(*) AS candidates, CASE tier WHEN 'active' THEN 1 WHEN 'slow' THEN 2 ELSE 3 END AS position FROM g GROUP BY tier")
def tier_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cadence.tier_histogram(cadence.activity(t.activity_rows(spark, sf_dir)), _now()).select("tier", "candidates", "position")


_STALE = f"""{t.SERIES}, {_TIER}, due AS (SELECT mal_id, title, tier, last_chapters_update FROM mangas JOIN g ON id = mal_id
WHERE status NOT IN ('Finished', 'Discontinued') AND (last_chapters_update IS NULL
  OR epoch_us(TIMESTAMP '{t.NOW}') - epoch_us(last_chapters_update) > CASE tier WHEN 'active' THEN 2 WHEN 'slow' THEN 6 ELSE 24 END * 3600000000))"""


def _due(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cadence.stale(cadence.activity(t.activity_rows(spark, sf_dir)), t.series(spark, sf_dir), _now())


@query(f"WITH {_STALE} SELECT * FROM due")
def stale_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _due(spark, sf_dir)


@query(f"""WITH {_STALE}, r AS (SELECT *, coalesce(sum(mal_id % 7 + 1) OVER (ORDER BY last_chapters_update NULLS FIRST, mal_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM due)
SELECT mal_id, tier, spent < 500 AS admitted FROM r""")
def admitted_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.asc_nulls_first("last_chapters_update"), F.col("mal_id")]
    return cadence.admitted(_due(spark, sf_dir), F.col("mal_id") % 7 + 1, 500, order).select("mal_id", "tier", "admitted")


@query(f"WITH {t.SERIES} SELECT mal_id, title, status, CASE WHEN mal_id % 3 = 0 THEN TIMESTAMP '{t.NOW}' ELSE last_chapters_update END AS last_chapters_update FROM mangas")
def mark_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = t.series(spark, sf_dir)
    return cadence.mark_updated(s, s.filter("mal_id % 3 = 0"), _now()).select("mal_id", "title", "status", "last_chapters_update")


_FLAGS = f"""{t.DELTA}, f AS (SELECT s.manga_id, s.provider_id, s.chapter_number, s.link, s.release_date, o.chapter_number IS NOT NULL AS found, o.link AS stored_link,
  rank() OVER (PARTITION BY s.manga_id, s.provider_id ORDER BY s.chapter_number DESC) <= 5 AS in_window
  FROM scraped s LEFT JOIN stored o ON s.manga_id = o.manga_id AND s.provider_id = o.provider_id AND s.chapter_number = o.chapter_number),
flags AS (SELECT *, NOT found AS inserted, found AND link IS DISTINCT FROM stored_link AS changed, found AND link IS DISTINCT FROM stored_link AND NOT in_window AS relinked,
  NOT found OR link IS DISTINCT FROM stored_link OR in_window AS upsert FROM f)"""


def _flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.flags(t.scraped(spark, sf_dir), t.stored(spark, sf_dir))


@query(f"WITH {_FLAGS} SELECT manga_id, provider_id, chapter_number, link, found, changed, in_window, inserted, relinked, upsert FROM flags")
def delta_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(spark, sf_dir).select(*delta.KEY, "link", "found", "changed", "in_window", "inserted", "relinked", "upsert")


@query(f"""WITH {_FLAGS} SELECT manga_id, provider_id, count(*) FILTER (inserted) AS inserted, count(*) FILTER (relinked) AS relinked,
count(*) FILTER (NOT upsert) AS skipped, count(*) FILTER (upsert) AS upserted FROM flags GROUP BY 1, 2""")
def delta_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.counters(_flags(spark, sf_dir))


@query(f"""WITH {_FLAGS}, u AS (SELECT * FROM flags WHERE upsert)
SELECT coalesce(o.manga_id, u.manga_id) AS manga_id, coalesce(o.provider_id, u.provider_id) AS provider_id, coalesce(o.chapter_number, u.chapter_number) AS chapter_number,
  CASE WHEN u.manga_id IS NOT NULL THEN u.link ELSE o.link END AS link, CASE WHEN u.manga_id IS NOT NULL THEN u.release_date ELSE o.release_date END AS release_date, o.id AS id, coalesce(o.created_at, TIMESTAMP '2024-02-01') AS created_at,
  CASE WHEN u.manga_id IS NOT NULL THEN TIMESTAMP '2024-02-01' ELSE o.created_at END AS updated_at
FROM stored o FULL JOIN u ON o.manga_id = u.manga_id AND o.provider_id = u.provider_id AND o.chapter_number = u.chapter_number""")
def upsert_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming = delta.first_by_key(_flags(spark, sf_dir).filter("upsert"), delta.KEY, ["link"])
    return delta.upsert(t.stored(spark, sf_dir).withColumn("updated_at", F.col("created_at")), incoming, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))


@query(f"WITH {t.PROVIDERS} SELECT DISTINCT p_brand AS name FROM part WHERE p_brand NOT IN (SELECT name FROM providers)")
def new_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.missing_names(t.table(spark, sf_dir, "part").select(F.col("p_brand").alias("name")), t.providers(spark, sf_dir))


@query(f"""WITH {_FLAGS}, u AS (SELECT * FROM flags WHERE upsert)
SELECT coalesce(o.manga_id, u.manga_id) AS manga_id, coalesce(o.provider_id, u.provider_id) AS provider_id, coalesce(o.chapter_number, u.chapter_number) AS chapter_number,
  CASE WHEN u.manga_id IS NOT NULL THEN u.link ELSE o.link END AS link, coalesce(o.created_at, TIMESTAMP '2024-02-02') AS created_at
FROM stored o FULL JOIN u ON o.manga_id = u.manga_id AND o.provider_id = u.provider_id AND o.chapter_number = u.chapter_number""")
def versioned_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored rows as the first version of a table, and the scraped ones as the batch that makes the second."""
    table = Table(spark, scratch(spark, "table"), ["manga_id"])
    table.update(t.stored(spark, sf_dir).select(*delta.KEY, "link", "created_at").withColumn("updated_at", F.col("created_at")), lambda old, new: new)

    def merge(stored: DataFrame | None, new: DataFrame) -> DataFrame:
        due = delta.flags(new, stored).filter("upsert").select(*new.columns)
        return delta.upsert(stored, due, F.lit("2024-02-02 00:00:00").cast("timestamp_ntz"))

    new = materialize(t.scraped(spark, sf_dir).select(*delta.KEY, "link"), "batch")
    for _ in range(2):  # the second time, the batch is known
        table.update(new, merge, ("refresh", 0))
    return table.read().select(*delta.KEY, "link", "created_at")


@query("""WITH n AS (SELECT DISTINCT p_brand AS name FROM part UNION SELECT DISTINCT upper(replace(p_brand, '#', ' # ')) FROM part), k AS (SELECT name, lower(replace(name, ' ', '')) AS key FROM n),
o AS (SELECT key, row_number() OVER (ORDER BY key) AS id FROM k WHERE key LIKE '%1' GROUP BY key),
r AS (SELECT key, (SELECT count(*) FROM o) + row_number() OVER (ORDER BY key) AS id FROM (SELECT DISTINCT key FROM k WHERE key NOT IN (SELECT key FROM o)))
SELECT name, k.key, coalesce(o.id, r.id) AS id FROM k LEFT JOIN o ON o.key = k.key LEFT JOIN r ON r.key = k.key""")
def provider_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of brands spelt in two ways; some had theirs before."""
    brand = F.col("p_brand")
    names = t.table(spark, sf_dir, "part").select(F.explode(F.array(brand, F.upper(F.replace(brand, F.lit("#"), F.lit(" # "))))).alias("name")).distinct()
    names = names.withColumn("base_url", F.concat(F.lit("https://"), F.lower("name")))
    table = Table(spark, scratch(spark, "providers"), ["key"], 4)
    delta.get_or_create(table, names.filter("lower(name) LIKE '%1'"))
    return delta.get_or_create(table, names)


_RANK = "coalesce(list_sort(list(ms) FILTER (ms IS NOT NULL))[CAST(floor({p} * (count(ms) - 1) + 0.5) AS BIGINT) + 1], 0)"
_BY_PROVIDER = f"""stats AS (SELECT provider, count(*) AS attempts, count(*) FILTER (outcome = 'chapters') AS with_chapters, count(*) FILTER (outcome = 'empty') AS empty,
count(*) FILTER (outcome = 'error') AS errors, CAST(sum(chapters) AS BIGINT) AS chapters, coalesce(max(ms), 0) AS max_ms, {_RANK.format(p=0.5)} AS median_ms, {_RANK.format(p=0.95)} AS p95_ms FROM attempts WHERE outcome <> 'skipped' GROUP BY provider)"""
_STATS = f"{t.ATTEMPTS}, {_BY_PROVIDER}"
_GAPPED = f"{t.GAPPED}, {_BY_PROVIDER}"


@query(f"WITH {_GAPPED} SELECT * FROM stats")
def provider_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.provider_stats(t.gapped(spark, sf_dir))


@query(f"""WITH {_GAPPED} SELECT provider, CASE WHEN errors / attempts > 0.3 THEN 'errors' ELSE 'empty' END AS kind,
CASE WHEN errors / attempts > 0.3 THEN provider || ': ' || CAST(floor(100 * (errors / attempts) + 0.5) AS BIGINT) || '% errors over ' || attempts || ' attempts'
ELSE provider || ': ' || CAST(floor(100 * (empty / attempts) + 0.5) AS BIGINT) || '% empty over ' || attempts || ' attempts — likely a silent breakage' END AS alert
FROM stats WHERE attempts >= 50 AND (errors / attempts > 0.3 OR empty / attempts > 0.1)""")
def provider_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.provider_alerts(telemetry.provider_stats(t.gapped(spark, sf_dir)), error_rate=0.3, empty_rate=0.1)


@query(f"""WITH {t.GAPPED}, i AS (SELECT *, sum(CASE WHEN outcome = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY provider ORDER BY seq) AS island FROM attempts WHERE outcome <> 'skipped'),
r AS (SELECT *, sum(CASE WHEN outcome = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY provider, island ORDER BY seq) AS run FROM i)
SELECT provider, min(seq) FILTER (run >= 8) AS tripped_at, CAST(max(run) AS BIGINT) AS longest FROM r GROUP BY provider""")
def breaker_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.breaker(t.gapped(spark, sf_dir), 8)


_OUTCOME = f"""{t.ATTEMPTS}, o AS (SELECT series, count(*) FILTER (outcome <> 'skipped') AS attempted, count(*) FILTER (outcome = 'error') AS errors, count(*) FILTER (outcome = 'skipped') AS skipped,
count(*) FILTER (outcome = 'chapters') AS results, CAST(sum(chapters) AS BIGINT) AS found, max(ms) AS busy_ms, max(waited_ms) AS waited_ms FROM attempts GROUP BY series)"""


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.series_outcome(t.attempts(spark, sf_dir))


@query(f"WITH {_OUTCOME} SELECT *, attempted > errors OR (attempted = 0 AND skipped = 0) AS success FROM o")
def series_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcomes(spark, sf_dir)


#: The same events as the attempts: what each series' sources brought is what the delta counts.
_ROWS = f"""{_FLAGS}, rows_of AS (SELECT manga_id AS series, count(*) FILTER (upsert) AS written, count(*) FILTER (inserted) AS new FROM flags GROUP BY 1)"""


def _counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.counters(_flags(spark, sf_dir))


@query(f"""WITH {_ROWS}, {t.ATTEMPTS} SELECT a.series, CAST(sum(chapters) AS BIGINT) AS found, count(DISTINCT provider) FILTER (outcome = 'chapters') AS sources, count(*) FILTER (outcome = 'error') AS errors, any_value(written) AS written, any_value(new) AS new
FROM attempts a LEFT JOIN rows_of r ON r.series = a.series GROUP BY a.series""")
def series_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all sources of a series brought together, and what of it was written."""
    return telemetry.series_totals(t.attempts(spark, sf_dir), _counters(spark, sf_dir))


@query(f"""WITH {_ROWS}, {_OUTCOME}, s AS (SELECT *, attempted > errors AS success FROM o)
SELECT count(*) AS processed, count(*) FILTER (success) AS updated, CAST(sum(found) AS BIGINT) AS found, CAST(coalesce(sum(written), 0) AS BIGINT) AS written, CAST(coalesce(sum(new), 0) AS BIGINT) AS new, round(100 * sum(busy_ms) / 4800000, 6) AS busy_pct,
round(100 * sum(waited_ms) / 4800000, 6) AS queued_pct, count(*) > 0 AND count(*) FILTER (success) = 0 AS failed FROM s LEFT JOIN rows_of r ON r.series = s.series""")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.run_totals(telemetry.with_rows(_outcomes(spark, sf_dir), _counters(spark, sf_dir)), 600_000, 8)


@query(f"""WITH {_ROWS}, {_OUTCOME}, n AS (SELECT o.series AS id FROM o JOIN rows_of r ON r.series = o.series WHERE attempted > errors AND new > 0),
r AS (SELECT id, (row_number() OVER (ORDER BY id) - 1) // 40 AS batch_id FROM n)
SELECT batch_id, count(*) AS size, min(id) AS first_id, max(id) AS last_id, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids FROM r GROUP BY batch_id""")
def notifiable_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series whose delta has new rows; what a series without any delta has isn't known."""
    rows = telemetry.rows_by_series(_counters(spark, sf_dir))
    results = _outcomes(spark, sf_dir).join(rows, "series", "left").select(F.col("series").alias("manga_id"), "success", F.col("new").alias("chapters_new"))
    out = notify.batches(notify.notifiable(results), size=40)
    return out.select("batch_id", F.size("manga_ids").cast("long").alias("size"), F.array_min("manga_ids").alias("first_id"), F.array_max("manga_ids").alias("last_id"), F.array_join(F.col("manga_ids").cast("array<string>"), ",").alias("ids"))


_RUNS = {"all": "true", "good": "outcome <> 'error'", "bad": "outcome = 'error'", "none": "false"}


@query(f"""WITH {t.ATTEMPTS}, b AS (SELECT seq AS batch_id, outcome, chapters + 1 AS size, CASE WHEN outcome = 'error' THEN 'HTTP ' || CAST(500 + seq % 3 AS VARCHAR) END AS error FROM attempts),
k AS ({" UNION ALL ".join(f"SELECT '{name}' AS run, * FROM b WHERE {which}" for name, which in _RUNS.items())}), n AS (SELECT unnest({list(_RUNS)!r}) AS run),
e AS (SELECT run, string_agg(error, ', ' ORDER BY seen) AS reason FROM (SELECT run, error, min(batch_id) AS seen FROM k WHERE error IS NOT NULL GROUP BY ALL) GROUP BY run),
c AS (SELECT n.run, CAST(coalesce(sum(size), 0) AS BIGINT) AS ids, CAST(coalesce(sum(size) FILTER (error IS NULL), 0) AS BIGINT) AS sent_ids, count(size) AS batches, count(size) FILTER (error IS NULL) AS sent_batches FROM n LEFT JOIN k ON k.run = n.run GROUP BY n.run),
s AS (SELECT *, CASE WHEN batches = 0 THEN 'skipped' WHEN sent_batches = batches THEN 'sent' WHEN sent_batches > 0 THEN 'partial' ELSE 'failed' END AS status FROM c)
SELECT s.*, CASE WHEN status = 'skipped' THEN 'no chapter written this run' WHEN status <> 'sent' THEN reason END AS reason FROM s LEFT JOIN e ON e.run = s.run""")
def webhook_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All batches, those that went well, those that didn't, and none."""
    a = t.attempts(spark, sf_dir)
    error = F.when(F.col("outcome") == "error", F.concat(F.lit("HTTP "), (500 + F.col("seq") % 3).cast("string")))
    out = None
    for name, which in _RUNS.items():
        one = notify.outcome(a.filter(which).select(F.col("seq").alias("batch_id"), (F.col("chapters") + 1).alias("size"), error.alias("error"))).withColumn("run", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


_SOURCES = "src AS (SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{k}', {i})" for i, (n, k) in enumerate(selection.REGISTERED)) + ") s(name, type, idx))"
_KINDS = """kinds AS (SELECT c_custkey AS mal_id, CASE c_mktsegment WHEN 'BUILDING' THEN 'manga' WHEN 'MACHINERY' THEN ' Manhua' WHEN 'FURNITURE' THEN NULL WHEN 'HOUSEHOLD' THEN 'MANHWA' ELSE '' END AS type FROM customer)"""


@query(f"""WITH {_SOURCES}, {_KINDS}, k AS (SELECT mal_id, CASE WHEN coalesce(type, '') = '' THEN 'manga' WHEN lower(trim(type)) = 'manhua' THEN 'manhwa' ELSE lower(trim(type)) END AS kind FROM kinds)
SELECT mal_id, name, row_number() OVER (PARTITION BY mal_id ORDER BY type = 'multiple' DESC, CASE WHEN type = 'multiple' THEN -idx ELSE idx END) AS rank FROM k JOIN src ON type = 'multiple' OR type = kind""")
def source_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    kind = F.create_map(*[F.lit(x) for x in ("BUILDING", "manga", "MACHINERY", " Manhua", "HOUSEHOLD", "MANHWA", "AUTOMOBILE", "")])
    series = t.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("mal_id"), kind[F.col("c_mktsegment")].alias("type"))
    sources = spark.createDataFrame([(n, k, True, i) for i, (n, k) in enumerate(selection.REGISTERED)], "name string, type string, enabled boolean, idx int")
    out = selection.compatible(series, sources)
    return out.select("mal_id", "name", F.row_number().over(Window.partitionBy("mal_id").orderBy("position")).cast("long").alias("rank"))


@query(f"""WITH {t.ATTEMPTS}, o AS (SELECT event_type AS provider, row_number() OVER (ORDER BY event_type) AS position FROM (SELECT DISTINCT event_type FROM events)),
r AS (SELECT series, a.provider, chapters, row_number() OVER (PARTITION BY series ORDER BY position, seq) AS rn FROM attempts a JOIN o ON a.provider = o.provider WHERE outcome = 'chapters')
SELECT series, provider, chapters FROM r WHERE rn = 1""")
def first_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = sorted(r.id for r in t.providers(spark, sf_dir).collect())  # configuration: one row a source
    order = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "provider string, position int")
    return selection.first_hit(t.attempts(spark, sf_dir), order)


@query("""WITH x AS (SELECT event_id AS seq, CAST((event_id * 37) % 200000 AS DOUBLE) AS ms FROM events), y AS (SELECT *, CAST(floor(ms / 1000 + 0.5) AS BIGINT) AS s FROM x)
SELECT seq, CASE WHEN ms < 1000 THEN CAST(CAST(ms AS BIGINT) AS VARCHAR) || 'ms'
  WHEN ms < 60000 THEN printf('%.1f', CASE WHEN (ms / 1000 * 4) % 2 = 1 THEN floor(ms / 100 + 0.5) / 10 ELSE ms / 1000 END) || 's'
  ELSE (s // 60) || 'm' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || 's' END AS text FROM y""")
def durations_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.attempts(spark, sf_dir).select("seq", telemetry.format_ms((F.col("seq") * 37 % 200000).cast("double")).alias("text"))


def _ms_sql(x: str) -> str:
    tenths = f"printf('%.1f', CASE WHEN ({x} / 1000 * 4) % 2 = 1 THEN floor({x} / 100 + 0.5) / 10 ELSE {x} / 1000 END) || 's'"
    seconds = f"CAST(floor({x} / 1000 + 0.5) AS BIGINT)"
    return f"CASE WHEN {x} < 1000 THEN CAST(floor({x} + 0.5) AS BIGINT) || 'ms' WHEN {x} < 60000 THEN {tenths} ELSE ({seconds} // 60) || 'm' || lpad(CAST({seconds} % 60 AS VARCHAR), 2, '0') || 's' END"


def _rank_sql(x: str, p: float) -> str:
    return _ms_sql(f"list_sort(list({x}))[CAST(floor({p} * (count(*) - 1) + 0.5) AS BIGINT) + 1]")


#: Milliseconds after which no other series is begun.
_BUDGET = 20_000
_ALERT = "provider || ': ' || CAST(floor(100 * (errors / attempts) + 0.5) AS BIGINT) || '% errors over ' || attempts || ' attempts'"
_TRIPPED = """i AS (SELECT *, sum(CASE WHEN outcome = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY provider ORDER BY seq) AS island FROM attempts),
u AS (SELECT provider, sum(CASE WHEN outcome = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY provider, island ORDER BY seq) AS run FROM i), b AS (SELECT provider FROM u GROUP BY provider HAVING max(run) >= 8)"""


@query(f"""WITH {_ROWS}, {_STATS}, {_OUTCOME.removeprefix(t.ATTEMPTS + ", ")}, {_TIER}, {_TRIPPED},
s AS (SELECT o.*, attempted > errors AS success, coalesce(written, 0) AS written, coalesce(new, 0) AS new, coalesce(sum(floor(busy_ms)) OVER (ORDER BY o.series ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) >= {_BUDGET} AS late FROM o LEFT JOIN rows_of r ON r.series = o.series),
y AS (SELECT count(*) AS n, count(*) FILTER (late) AS late, count(*) FILTER (success) AS ok, CAST(sum(found) AS BIGINT) AS found, CAST(sum(written) AS BIGINT) AS written, CAST(sum(new) AS BIGINT) AS new, 100 * sum(busy_ms) / 4800000 AS busy, 100 * sum(waited_ms) / 4800000 AS queued FROM s),
al AS (SELECT provider, {_ALERT} AS alert FROM stats WHERE attempts >= 50 AND errors / attempts > 0.3),
tier AS (SELECT tier, count(*) AS n, CASE tier WHEN 'active' THEN 1 WHEN 'slow' THEN 2 ELSE 3 END AS p FROM g GROUP BY tier),
l(sec, sub, text) AS (
  SELECT 0, 0, '## Catalogue refresh' UNION ALL SELECT 0, 1, ''
  UNION ALL SELECT 1, 0, '> **Alerts**' WHERE (SELECT count(*) FROM al) > 0 UNION ALL SELECT 1, row_number() OVER (ORDER BY provider), '> - ' || alert FROM al UNION ALL SELECT 1, 999, '' WHERE (SELECT count(*) FROM al) > 0
  UNION ALL SELECT 2, 0, '> **Circuit breaker opened** for: ' || string_agg(provider, ', ' ORDER BY provider) FROM b HAVING count(*) > 0 UNION ALL SELECT 2, 1, '' WHERE (SELECT count(*) FROM b) > 0
  UNION ALL SELECT 3, 0, '| Metric | Value |' UNION ALL SELECT 3, 1, '|---|---|' UNION ALL SELECT 3, 2, '| Series with chapters | ' || count(DISTINCT o_custkey) || ' |' FROM orders
  UNION ALL SELECT 3, 3, '| Due (cadence by tier) | ' || n || ' |' FROM y UNION ALL SELECT 3, 4, '| Processed | ' || n || CASE WHEN late > 0 THEN ' (' || late || ' left for the next run: deadline)' ELSE '' END || ' |' FROM y
  UNION ALL SELECT 3, 5, '| Updated | ' || ok || ' / ' || n || ' |' FROM y UNION ALL SELECT 3, 6, '| Rows found | ' || found || ' |' FROM y UNION ALL SELECT 3, 7, '| Rows written | ' || written || ' (' || new || ' new) |' FROM y
  UNION ALL SELECT 3, 8, '| Duration | 10m00s |' UNION ALL SELECT 3, 9, '| Concurrency | 8 series, 4 a source, 300ms apart |'
  UNION ALL SELECT 3, 10, '| Pool time scraping | ' || CAST(floor(busy + 0.5) AS BIGINT) || '% |' FROM y UNION ALL SELECT 3, 11, '| Pool time queued | ' || CAST(floor(queued + 0.5) AS BIGINT) || '% |' FROM y UNION ALL SELECT 3, 12, ''
  UNION ALL SELECT 4, 0, '| Tier | Interval | Candidates |' UNION ALL SELECT 4, 1, '|---|---:|---:|' UNION ALL SELECT 4, 1 + p, '| ' || tier || ' | ' || CASE p WHEN 1 THEN 2 WHEN 2 THEN 6 ELSE 24 END || 'h | ' || n || ' |' FROM tier UNION ALL SELECT 4, 9, ''
  UNION ALL SELECT 5, 0, 'Series: median ' || {_rank_sql("busy_ms", 0.5)} || ', p95 ' || {_rank_sql("busy_ms", 0.95)} || ', max ' || {_ms_sql("max(busy_ms)")} FROM o UNION ALL SELECT 5, 1, ''
  UNION ALL SELECT 5, 2, 'Queued: median ' || {_rank_sql("waited_ms", 0.5)} || ', p95 ' || {_rank_sql("waited_ms", 0.95)} FROM o UNION ALL SELECT 5, 3, ''
  UNION ALL SELECT 6, 0, '| Provider | Attempts | With chapters | Empty | Errors | Median | p95 | Max |' UNION ALL SELECT 6, 1, '|---|---:|---:|---:|---:|---:|---:|---:|'
  UNION ALL SELECT 6, 1 + row_number() OVER (ORDER BY median_ms * attempts DESC, provider), '| ' || provider || ' | ' || attempts || ' | ' || with_chapters || ' | ' || empty || ' | ' || errors || ' | ' || {_ms_sql("median_ms")} || ' | ' || {_ms_sql("p95_ms")} || ' | ' || {_ms_sql("max_ms")} || ' |' FROM stats)
SELECT CAST(row_number() OVER (ORDER BY sec, sub) - 1 AS INTEGER) AS line, text FROM l""")
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's lines with their numbers."""
    a = t.attempts(spark, sf_dir)
    stats = telemetry.provider_stats(a)
    rows = stats.collect()  # one row a provider
    outcomes = telemetry.with_rows(telemetry.series_outcome(a), _counters(spark, sf_dir))
    late = cadence.admitted(outcomes, F.floor("busy_ms"), _BUDGET, [F.col("series")]).filter("NOT admitted").count()
    totals = telemetry.run_totals(outcomes, 600_000, 8).first()
    alerts = telemetry.provider_alerts(stats, error_rate=0.3).orderBy("provider").collect()
    active = cadence.activity(t.activity_rows(spark, sf_dir))
    tiers = cadence.tier_histogram(active, _now()).collect()
    tripped = [r.provider for r in telemetry.breaker(a, 8).filter("tripped_at IS NOT NULL").orderBy("provider").collect()]
    run = telemetry.Run(600_000, 8, with_chapters=active.count(), due=totals.processed, left=late, source_concurrency=4, delay_ms=300)
    lines = telemetry.report(totals, rows, alerts, tiers, tripped, run, telemetry.series_times(outcomes))
    return spark.createDataFrame(list(enumerate(lines)), "line int, text string")
