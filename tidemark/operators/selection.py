"""Which sources serve a series, in which order, and the first that answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text

#: The sources in order of registration and their types.
REGISTERED = (
    ("Asura", "manhwa"), ("MangaDex", "multiple"), ("MangaPark", "multiple"), ("Mangapill", "multiple"),
    ("Weeb Central", "multiple"), ("MangaKatana", "multiple"), ("Rokari Comics", "manhwa"),
)


def series_type(kind: Column) -> Column:
    """Lower case, trimmed; manhua counts as manhwa; null or empty as manga."""
    low = F.lower(F.trim(kind))
    return F.when(F.coalesce(kind, F.lit("")) == "", "manga").when(low == "manhua", "manhwa").otherwise(low)


def compatible(series: DataFrame, sources: DataFrame) -> DataFrame:
    """series x the enabled sources of its type, with position: sources of type `multiple` first, the last registered first; then those of the exact type in order.

    sources (name, type, enabled, idx) is a list of configured plugins: it is
    bounded by the configuration, not by data, and is broadcast.
    """
    kind = series_type(F.col("type"))
    s = series.withColumn("_kind", kind)
    p = sources.filter("enabled").select("name", F.col("type").alias("_type"), "idx")
    met = s.join(F.broadcast(p), (F.col("_type") == "multiple") | (F.col("_type") == F.col("_kind")))
    return met.withColumn("position", F.when(F.col("_type") == "multiple", -1000 - F.col("idx")).otherwise(F.col("idx"))).drop("_kind", "_type")


def first_hit(attempts: DataFrame, order: DataFrame) -> DataFrame:
    """(series, provider, chapters): the first source in order (provider, position) that found chapters; errors and empties pass on."""
    met = attempts.filter("outcome = 'chapters'").join(F.broadcast(order), "provider")
    best = met.groupBy("series").agg(F.min(F.struct("position", "provider", "seq", "chapters")).alias("b"))
    return best.select("series", "b.provider", "b.chapters")


def title_for(provider: Column, title: Column, english: Column, overridden: tuple[str, ...] = ("MangaPark", "Weeb Central")) -> Column:
    """The title to search with: the English one for sources that ask for it, if there is one."""
    return F.when(provider.isin(*overridden), F.coalesce(F.nullif(english, F.lit("")), title)).otherwise(title)


def ladder_steps(series: DataFrame) -> DataFrame:
    """(series, step, query, keywords): what to search for in turn, from (series, title, english, synonyms).

    0 the title; 1 the English title if it is another; 2 the first synonym;
    3 the title again, by its key words. Steps without a title are left out.
    """
    first = F.get("synonyms", F.lit(0))
    steps = F.array(
        F.struct(F.lit(0).alias("step"), F.col("title").alias("query"), F.lit(False).alias("keywords")),
        F.struct(F.lit(1).alias("step"), F.when(F.col("english") != F.col("title"), F.col("english")).alias("query"), F.lit(False).alias("keywords")),
        F.struct(F.lit(2).alias("step"), first.alias("query"), F.lit(False).alias("keywords")),
        F.struct(F.lit(3).alias("step"), F.col("title").alias("query"), F.lit(True).alias("keywords")),
    )
    return series.select("series", F.explode(steps).alias("s")).select("series", "s.step", "s.query", "s.keywords").filter("coalesce(query, '') <> ''")


def fallback_steps(series: DataFrame) -> DataFrame:
    """(series, step, query) of sites that get one more try, from (series, title, english, synonyms): 0 the title; 1 the English title if it is another, else the first synonym if that is. Step 1 is taken only if step 0 found no results at all; see fallback_outcome()."""
    first = F.get("synonyms", F.lit(0))
    other = lambda c: F.when((F.coalesce(c, F.lit("")) != "") & (c != F.col("title")), c)
    steps = F.array(F.struct(F.lit(0).alias("step"), F.col("title").alias("query")), F.struct(F.lit(1).alias("step"), F.coalesce(other(F.col("english")), other(first)).alias("query")))
    return series.select("series", F.explode(steps).alias("s")).select("series", "s.step", "s.query").filter("query IS NOT NULL")


def fallback_outcome(tries: DataFrame) -> DataFrame:
    """(series, step, outcome, match, waits) from tries (series, step, results, blank, match or null, error or null).

    The first step decides unless it answered without results; then the second
    does, if there is one. An error ends the search there. waits: the first
    answer was blank, so the second try comes after a pause.
    """
    by = tries.groupBy("series").agg(*[F.max_by(F.struct("results", "blank", "match", "error"), F.when(F.col("step") == k, 1)).alias(f"s{k}") for k in (0, 1)])
    second = F.col("s0.error").isNull() & (F.col("s0.results") == 0) & F.col("s1").isNotNull()
    last = by.select("series", F.when(second, 1).otherwise(0).alias("step"), F.when(second, F.col("s1")).otherwise(F.col("s0")).alias("s"), (second & F.coalesce("s0.blank", F.lit(False))).alias("waits"))
    outcome = F.when(F.col("s.error").isNotNull(), "error").when(F.col("s.match").isNotNull(), "match").otherwise("empty")
    return last.select("series", "step", outcome.alias("outcome"), F.when(outcome == "match", F.col("s.match")).alias("match"), "waits")


def variant_steps(series: DataFrame, most: int = 3) -> DataFrame:
    """(series, step, query, variants) of sites that are asked for up to `most` variants in turn, from (series, title, english, synonyms): each answer is matched against all variants, however many there are."""
    titles = F.concat(F.array("title", "english"), F.coalesce("synonyms", F.array().cast("array<string>")))
    named = series.select("series", text.variants(F.filter(titles, lambda t: F.coalesce(t, F.lit("")) != ""), None).alias("variants"))
    return named.select("series", "variants", F.posexplode(F.slice("variants", 1, most)).alias("step", "query")).select("series", "step", "query", "variants")


def ladder_outcome(tries: DataFrame) -> DataFrame:
    """(series, outcome, step, match) from tries (series, step, match or null, error or null): the first step that matched; without one `error` if any try failed, else `empty`."""
    hit = F.col("match").isNotNull()
    out = tries.groupBy("series").agg(F.min(F.when(hit, F.struct("step", "match"))).alias("b"), F.count_if(F.col("error").isNotNull()).alias("n"))
    return out.select("series", F.when(F.col("b").isNotNull(), "match").when(F.col("n") > 0, "error").otherwise("empty").alias("outcome"), "b.step", "b.match")


def ladder(found: DataFrame) -> DataFrame:
    """(series, step, match) of the first step with a match, from rows (series, step, match or null)."""
    return found.filter("match IS NOT NULL").groupBy("series").agg(F.min(F.struct("step", "match")).alias("b")).select("series", "b.step", "b.match")
