"""Age-tiered cadence: which series are due for a refresh."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize, tidy

from .ranges import numbered
from .versions import Table


@dataclass(frozen=True)
class Tier:
    """Series whose newest chapter is at most max_age_days old (None: any) are refreshed every interval_hours."""

    label: str
    max_age_days: float | None
    interval_hours: float


#: The default cadence.
DEFAULT_TIERS = (Tier("active", 9, 2), Tier("slow", 30, 6), Tier("dormant", None, 24))


def parse_tiers(spec: str) -> tuple[Tier, ...] | None:
    """`9:2,30:6,*:24` as tiers; None unless every part is valid and only the last is the catch-all."""
    out: list[Tier] = []
    parts = [p.strip() for p in spec.split(",")]
    for i, part in enumerate(parts):
        age, _, rest = part.partition(":")
        age, hours = age.strip(), rest.split(":")[0].strip()
        try:
            interval = float(hours)
            limit = None if age == "*" else float(age)
        except ValueError:
            return None
        if not 0 < interval < float("inf") or (limit is not None and not 0 < limit < float("inf")) or (limit is None) != (i == len(parts) - 1):
            return None
        out.append(Tier("catch-all" if limit is None else f"<{limit:g}d", limit, interval))
    return tuple(out) or None


def tier_of(last: Column, now: Column, tiers: tuple[Tier, ...] = DEFAULT_TIERS, field: str = "label") -> Column:
    """The first tier that an age fits; a missing date, or one to come, is the first tier."""
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(last.cast("timestamp"))) / F.lit(86_400_000_000.0)
    value = [getattr(t, field) for t in tiers]
    out = F.when(last.isNull() | (age < 0), F.lit(value[0]))
    for t, v in zip(tiers, value, strict=True):
        out = out.when(F.lit(True) if t.max_age_days is None else age <= t.max_age_days, F.lit(v))
    return out.otherwise(F.lit(value[-1]))


def activity(rows: DataFrame, complete: bool = True) -> DataFrame:
    """(manga_id, last_chapter_at). If the scan wasn't complete, no date of it is used: all are null."""
    if not complete:
        return rows.select("manga_id").distinct().withColumn("last_chapter_at", F.lit(None).cast("timestamp_ntz"))
    return rows.groupBy("manga_id").agg(F.max("created_at").alias("last_chapter_at"))


def keep_activity(table: Table, rows: DataFrame, batch: tuple[str, int] | None = None) -> int | None:
    """Adds a batch of new chapter rows (manga_id, created_at) to a table (key manga_id) of manga_id, last_chapter_at and chapters.

    The table then holds what activity() gives for all batches so far, without
    reading their rows again: a batch is reduced to a row a series, and only
    the buckets of its series are read and written. A batch that was counted
    before changes nothing. Late rows change nothing but the count.
    """
    with tidy(rows.sparkSession):
        new = materialize(rows.groupBy("manga_id").agg(F.max("created_at").alias("last_chapter_at"), F.count(F.lit(1)).alias("chapters")), "batch")

        def merge(stored: DataFrame | None, new: DataFrame) -> DataFrame:
            both = new if stored is None else stored.unionByName(new)
            return both.groupBy("manga_id").agg(F.max("last_chapter_at").alias("last_chapter_at"), F.sum("chapters").alias("chapters"))

        return table.update(new, merge, batch)


def tier_histogram(active: DataFrame, now: Column, tiers: tuple[Tier, ...] = DEFAULT_TIERS) -> DataFrame:
    """Candidates by tier, before the staleness filter; empty tiers don't show. position keeps the tiers' order."""
    position = F.array_position(F.array(*[F.lit(t.label) for t in tiers]), F.col("tier")).cast("long")
    hours = F.element_at(F.array(*[F.lit(float(t.interval_hours)) for t in tiers]), F.col("position").cast("int"))
    return active.groupBy(tier_of(F.col("last_chapter_at"), now, tiers).alias("tier")).agg(F.count(F.lit(1)).alias("candidates")).withColumn("position", position).withColumn("interval_hours", hours)


def stale(active: DataFrame, series: DataFrame, now: Column, tiers: tuple[Tier, ...] = DEFAULT_TIERS) -> DataFrame:
    """Series with chapters that are neither finished nor discontinued and weren't updated within their tier's interval; a null status is none of those. Never updated first, then the oldest."""
    hours = tier_of(F.col("last_chapter_at"), now, tiers, "interval_hours").cast("double")
    due = series.join(active.withColumnRenamed("manga_id", "mal_id"), "mal_id")
    idle = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("last_chapters_update").cast("timestamp"))
    due = due.filter(~F.col("status").isin("Finished", "Discontinued") & (F.col("last_chapters_update").isNull() | (idle > hours * 3_600_000_000)))
    return due.select("mal_id", "title", tier_of(F.col("last_chapter_at"), now, tiers).alias("tier"), "last_chapters_update").orderBy(F.asc_nulls_first("last_chapters_update"), "mal_id")


def admitted(due: DataFrame, cost: Column, budget: float, order: list[Column], blocks: int = 64) -> DataFrame:
    """due with `admitted`: items are taken in order until the cost of those before reaches the budget.

    The running sum is made by ranges, so no task sees all rows. A null cost is
    none.
    """
    met = numbered(due.withColumn("_cost", cost), order, blocks, F.col("_cost"))
    return met.withColumn("admitted", F.col("_at") < budget).drop("_cost", "_at")


def mark_updated(series: DataFrame, ids: DataFrame, now: Column) -> DataFrame:
    """series with last_chapters_update set to now for the ids (mal_id) and untouched elsewhere."""
    hit = ids.select("mal_id").distinct().withColumn("_hit", F.lit(True))
    return series.join(hit, "mal_id", "left").withColumn("last_chapters_update", F.when(F.col("_hit"), now).otherwise(F.col("last_chapters_update"))).drop("_hit")
