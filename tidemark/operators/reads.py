"""Reads of the catalogue: latest across series, pages, boundaries, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranges import numbered
from .skew import left_join_by_key


def enabled_chapters(chapters: DataFrame, providers: DataFrame) -> DataFrame:
    """Chapters of enabled providers with the provider's name. Providers are a dimension: Spark broadcasts them while they are small."""
    p = providers.filter("enabled").select(F.col("id").alias("provider_id"), F.col("name").alias("provider_name"))
    return chapters.join(p, "provider_id")


def latest_across_series(chapters: DataFrame, providers: DataFrame, series: DataFrame, limit: int = 18) -> DataFrame:
    """The series whose top chapter appeared last: mal_id, title, chapter_number, created_at (first appearance), providers.

    The ranking uses all chapters, and one row a series is kept before any
    limit, so a series with many rows hides no other. Dates and providers come
    from enabled ones; a card without them or without metadata is dropped, so
    there can be fewer than `limit`. One aggregation with map-side combine, a
    top-N of `limit` rows, then broadcasts of those rows only.
    """
    top = chapters.groupBy("manga_id").agg(F.max(F.struct("chapter_number", (-F.unix_micros(F.col("created_at").cast("timestamp"))).alias("age"))).alias("t"))
    top = top.select("manga_id", F.col("t.chapter_number").alias("chapter_number"), F.col("t.age").alias("age")).orderBy("age", "manga_id").limit(limit)
    rows = enabled_chapters(chapters, providers).join(F.broadcast(top.drop("age")), ["manga_id", "chapter_number"])
    first = F.row_number().over(Window.partitionBy("manga_id", "provider_name").orderBy("created_at", "link"))
    rows = rows.withColumns({"first": F.min("created_at").over(Window.partitionBy("manga_id")), "rn": first}).filter("rn = 1")
    cards = rows.groupBy("manga_id", "chapter_number").agg(F.min("first").alias("created_at"), F.array_sort(F.collect_list(F.struct(F.lower("provider_name").alias("k"), "provider_name", "link"))).alias("p"))
    cards = cards.withColumn("providers", F.expr("array_join(transform(p, x -> concat(x.provider_name, '=', x.link)), ', ')"))
    meta = series.select(F.col("mal_id").alias("manga_id"), "title")
    out = meta.join(F.broadcast(cards), "manga_id").select(F.col("manga_id").alias("mal_id"), "title", "chapter_number", "created_at", "providers")
    return out.orderBy(F.desc("created_at"), "mal_id")


def page(chapters: DataFrame, providers: DataFrame, manga_id: int, number: int = 1, size: int = 50) -> DataFrame:
    """One page of a series' chapters, highest first; ties by provider."""
    rows = enabled_chapters(chapters.filter(F.col("manga_id") == manga_id), providers)
    return rows.orderBy(F.desc("chapter_number"), "provider_id").offset((number - 1) * size).limit(size).select("manga_id", "provider_name", "chapter_number", "link", "created_at")


def ranked(chapters: DataFrame, providers: DataFrame) -> DataFrame:
    """What page() shows, with rank: a row's place in its series, from 0. Places come from one numbering of all rows by ranges, shifted by each series' first one, so no task sorts a series."""
    rows = enabled_chapters(chapters, providers).select("manga_id", "provider_id", "provider_name", "chapter_number", "link", "created_at")
    order = ["manga_id", F.desc("chapter_number"), "provider_id"]
    at = numbered(rows, order)
    first = at.groupBy("manga_id").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    met = left_join_by_key(at, first, ["manga_id"], "_n", at.count())
    return met.withColumn("rank", F.col("_at") - F.col("_first")).drop("_at", "_first", "_n")


def write_ranked(chapters: DataFrame, providers: DataFrame, path: str, rows_a_file: int = 1_000_000) -> None:
    """ranked() as Parquet sorted by series and rank: a page is then a slice that file and row group statistics find."""
    rows = ranked(chapters, providers)
    rows.repartitionByRange("manga_id", "rank").sortWithinPartitions("manga_id", "rank").write.option("maxRecordsPerFile", rows_a_file).option("parquet.block.size", 8 << 20).option("compression", "zstd").parquet(path)


def ranked_page(index: DataFrame, manga_id: int, number: int = 1, size: int = 50) -> DataFrame:
    """page() from a table of write_ranked(): page n reads its own slice, however deep it is."""
    low = (number - 1) * size
    rows = index.filter((F.col("manga_id") == manga_id) & (F.col("rank") >= low) & (F.col("rank") < low + size))
    return rows.orderBy("rank").select("manga_id", "provider_name", "chapter_number", "link", "created_at")


def totals(chapters: DataFrame, providers: DataFrame) -> DataFrame:
    """The exact number of chapters that pages show, by series."""
    return enabled_chapters(chapters, providers).groupBy("manga_id").agg(F.count(F.lit(1)).alias("total"))


def boundaries(chapters: DataFrame, providers: DataFrame) -> DataFrame:
    """First and last chapter of every series with all rows at each, by an aggregate over the series joined back."""
    rows = enabled_chapters(chapters, providers)
    ends = rows.groupBy("manga_id").agg(F.min("chapter_number").alias("lo"), F.max("chapter_number").alias("hi"))
    met = rows.join(ends, "manga_id").filter("chapter_number = lo OR chapter_number = hi")
    side = F.explode(F.expr("filter(array(if(chapter_number = lo, 'first', null), if(chapter_number = hi, 'last', null)), x -> x IS NOT NULL)"))
    return met.select("manga_id", side.alias("side"), "chapter_number", "provider_name", "link")


def latest_chapter(chapters: DataFrame, providers: DataFrame) -> DataFrame:
    """The newest chapter of every series, of any provider, disabled ones too; its provider may be unknown."""
    best = chapters.groupBy("manga_id").agg(F.max(F.struct("chapter_number", "provider_id", "link")).alias("b")).select("manga_id", "b.*")
    return best.join(providers.select(F.col("id").alias("provider_id"), F.col("name").alias("provider_name")), "provider_id", "left").select("manga_id", "chapter_number", "provider_name", "link")


def has_chapters(chapters: DataFrame, series: DataFrame) -> DataFrame:
    """For every series whether it has any chapter, of enabled providers or not."""
    ids = chapters.select(F.col("manga_id").alias("mal_id"), F.lit(True).alias("found")).distinct()
    return series.select("mal_id").join(ids, "mal_id", "left").select("mal_id", F.coalesce("found", F.lit(False)).alias("has_chapters"))


def providers_by_name(providers: DataFrame) -> DataFrame:
    return providers.orderBy("name")


def provider(providers: DataFrame, name: str) -> DataFrame:
    return providers.filter(F.col("name") == name).limit(1)


def key_of(name: Column) -> Column:
    """A provider's key: lower case, no white space."""
    return F.regexp_replace(F.lower(name), r"\s+", "")


def provider_state(config: DataFrame, stored: DataFrame) -> DataFrame:
    """config (name, enabled, ...) with `enabled` as stored under the same key, where there is one."""
    db = stored.select(key_of(F.col("name")).alias("key"), F.col("enabled").alias("db_enabled")).groupBy("key").agg(F.max("db_enabled").alias("db_enabled"))
    return config.withColumn("key", key_of(F.col("name"))).join(db, "key", "left").withColumn("enabled", F.coalesce("db_enabled", "enabled")).drop("db_enabled")


def existing_links(chapters: DataFrame, manga_id: int, provider_id: str) -> DataFrame:
    return chapters.filter((F.col("manga_id") == manga_id) & (F.col("provider_id") == provider_id)).select("chapter_number", "link")


def cards(series: DataFrame, ids: DataFrame) -> DataFrame:
    """Metadata of the listed ids (mal_id)."""
    return series.join(ids.select("mal_id").distinct(), "mal_id", "left_semi")
