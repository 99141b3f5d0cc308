"""The catalogue's relations, shaped from the test tables. Each has the same rows as the SQL beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: `now` of the cadence over orders, and the cut between stored and scraped rows over events.
NOW = "2001-08-02 00:00:00"
STORED_BEFORE = "2024-01-25 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chapters(manga_id, provider_id, chapter_number, link, created_at, event_id) from events."""
    e = table(spark, sf_dir, "events")
    order = Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    return e.select(
        F.col("user_id").alias("manga_id"), F.col("event_type").alias("provider_id"), F.row_number().over(order).cast("double").alias("chapter_number"),
        F.concat(F.lit("/c/"), F.col("event_id").cast("string")).alias("link"), F.col("ts").alias("created_at"), "event_id",
    )


CHAPTERS = """chapters AS (SELECT user_id AS manga_id, event_type AS provider_id,
  CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS DOUBLE) AS chapter_number,
  concat('/c/', CAST(event_id AS VARCHAR)) AS link, ts AS created_at, event_id FROM events)"""


def providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """providers(id, name, type, enabled) from the event types; one of them is disabled."""
    kinds = table(spark, sf_dir, "events").select(F.col("event_type").alias("id")).distinct()
    return kinds.select("id", F.initcap("id").alias("name"), F.when(F.col("id").isin("click", "view"), "multiple").otherwise("manga").alias("type"), (F.col("id") != "signup").alias("enabled"))


PROVIDERS = """providers AS (SELECT DISTINCT event_type AS id, upper(substr(event_type, 1, 1)) || substr(event_type, 2) AS name,
  CASE WHEN event_type IN ('click', 'view') THEN 'multiple' ELSE 'manga' END AS type, event_type <> 'signup' AS enabled FROM events)"""


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mangas(mal_id, title, status, last_chapters_update) from customers; the update is the last high-priority order."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    status = F.when(F.col("c_mktsegment") == "BUILDING", "Finished").when(F.col("c_mktsegment") == "MACHINERY", "Discontinued").when(F.col("c_mktsegment") == "FURNITURE", None).otherwise("Publishing")
    updated = o.filter("o_orderpriority = '1-URGENT'").groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_chapters_update"))
    return c.join(updated, c.c_custkey == updated.o_custkey, "left").select(F.col("c_custkey").alias("mal_id"), F.col("c_name").alias("title"), status.alias("status"), "last_chapters_update")


SERIES = """mangas AS (SELECT c_custkey AS mal_id, c_name AS title,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Finished' WHEN 'MACHINERY' THEN 'Discontinued' WHEN 'FURNITURE' THEN NULL ELSE 'Publishing' END AS status, u AS last_chapters_update
  FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS u FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) x ON c_custkey = o_custkey)"""


def activity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(manga_id, created_at) of every row that counts as activity of a series, from orders."""
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("manga_id"), F.col("o_orderdate").alias("created_at"))


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of chapters before the cut, with id and release_date."""
    old = chapters(spark, sf_dir).filter(F.col("created_at") < F.lit(STORED_BEFORE).cast("timestamp_ntz"))
    return old.withColumns({"id": F.col("event_id"), "release_date": F.col("created_at")}).drop("event_id")


def scraped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole of chapters; every 17th link has changed, and each release_date is an hour later."""
    return chapters(spark, sf_dir).withColumn("release_date", F.col("created_at") + F.expr("INTERVAL 1 HOUR")).withColumn("link", F.when(F.col("event_id") % 17 == 0, F.concat("link", F.lit("?v=2"))).otherwise(F.col("link")))


DELTA = f"""{CHAPTERS},
stored AS (SELECT *, event_id AS id, created_at AS release_date FROM chapters WHERE created_at < TIMESTAMP '{STORED_BEFORE}'),
scraped AS (SELECT manga_id, provider_id, chapter_number, CASE WHEN event_id % 17 = 0 THEN link || '?v=2' ELSE link END AS link, created_at, created_at + INTERVAL 1 HOUR AS release_date FROM chapters)"""


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """attempts(seq, series, provider, outcome, ms, waited_ms, chapters, message), one row a source tried, from events."""
    e = table(spark, sf_dir, "events")
    outcome = F.when(F.col("value") > 30, "error").when(F.col("value") < 5, "empty").otherwise("chapters")
    return e.select(
        F.col("event_id").alias("seq"), F.col("user_id").alias("series"), F.col("event_type").alias("provider"), outcome.alias("outcome"), F.col("value").alias("ms"),
        (F.col("event_id") % 50).cast("double").alias("waited_ms"), F.when(outcome == "chapters", F.col("event_id") % 9 + 1).otherwise(0).alias("chapters"), "ts",
    )


ATTEMPTS = """attempts AS (SELECT event_id AS seq, user_id AS series, event_type AS provider,
  CASE WHEN value > 30 THEN 'error' WHEN value < 5 THEN 'empty' ELSE 'chapters' END AS outcome, value AS ms, CAST(event_id % 50 AS DOUBLE) AS waited_ms,
  CASE WHEN value > 30 OR value < 5 THEN 0 ELSE event_id % 9 + 1 END AS chapters, ts FROM events)"""


def gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """attempts in which each seventh source was skipped, and one provider's have no time."""
    out = F.col("seq") % 7 == 3
    rows = attempts(spark, sf_dir).withColumn("outcome", F.when(out, "skipped").otherwise(F.col("outcome")))
    return rows.withColumns({"chapters": F.when(out, 0).otherwise(F.col("chapters")), "ms": F.when(~out & (F.col("provider") != "signup"), F.col("ms"))})


GAPPED = f"""{ATTEMPTS.replace("attempts AS", "base AS", 1)}, attempts AS (SELECT * REPLACE (CASE WHEN seq % 7 = 3 THEN 'skipped' ELSE outcome END AS outcome,
  CASE WHEN seq % 7 = 3 THEN 0 ELSE chapters END AS chapters, CASE WHEN seq % 7 <> 3 AND provider <> 'signup' THEN ms END AS ms) FROM base)"""
