"""Link-aware delta between scraped and stored chapters, and the upsert that follows from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize, tidy

from .ranges import numbered
from .reads import key_of
from .versions import PLACE, Conflict, Table

KEY = ["manga_id", "provider_id", "chapter_number"]
SOURCE = ["manga_id", "provider_id"]


def first_by_key(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row for each key, the first in `order`; the survivor doesn't depend on partitioning."""
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("_rn = 1").drop("_rn")


def flags(scraped: DataFrame, stored: DataFrame | None, window: int = 5) -> DataFrame:
    """scraped with found, changed, in_window, inserted, relinked and upsert.

    changed: found with another link (null-safe); a date alone changes nothing.
    in_window: at or above the window-th highest number of the source's list,
    counted with repeats. inserted: not found. relinked: changed outside the
    window. upsert: any of inserted, changed, in_window. Without stored rows
    (None: unknown) everything is inserted.
    """
    rank = F.rank().over(Window.partitionBy(*SOURCE).orderBy(F.desc("chapter_number")))
    rows = scraped.withColumn("in_window", rank <= window)
    if stored is None:
        rows = rows.withColumns({"found": F.lit(False), "stored_link": F.lit(None).cast("string")})
    else:
        rows = rows.join(stored.select(*KEY, F.col("link").alias("stored_link"), F.lit(True).alias("found")), KEY, "left").withColumn("found", F.coalesce("found", F.lit(False)))
    changed = F.col("found") & ~F.col("link").eqNullSafe(F.col("stored_link"))
    rows = rows.withColumn("changed", changed).withColumn("inserted", ~F.col("found"))
    rows = rows.withColumn("relinked", F.col("changed") & ~F.col("in_window"))
    return rows.withColumn("upsert", F.col("inserted") | F.col("changed") | F.col("in_window"))


def counters(flagged: DataFrame) -> DataFrame:
    """inserted, relinked, skipped and upserted by source."""
    counts = {"inserted": "inserted", "relinked": "relinked", "skipped": "NOT upsert", "upserted": "upsert"}
    return flagged.groupBy(*SOURCE).agg(*[F.count_if(F.expr(c)).alias(n) for n, c in counts.items()])


def upsert(stored: DataFrame | None, incoming: DataFrame, now: Column) -> DataFrame:
    """stored after an upsert of incoming, with stored's columns: found rows take the link and release_date, others begin now; nothing is deleted. Without stored rows (None) it is incoming, beginning now.

    created_at and any other column of a found row stay; a new row has
    incoming's value there, or null. One full outer join on the key. incoming
    must have one row a key: see first_by_key().
    """
    if stored is None:
        return incoming.withColumns({"created_at": now, "updated_at": now})
    rest = [c for c in stored.columns if c not in (*KEY, "created_at", "updated_at")]
    taken = [c for c in rest if c in incoming.columns]
    s = stored.select(*KEY, F.struct(*[c for c in stored.columns if c not in KEY]).alias("_s"))
    i = incoming.select(*KEY, F.struct(F.lit(True).alias("_"), *taken).alias("_i"))
    new, old = F.col("_i").isNotNull(), F.col("_s").isNotNull()

    def value(c: str) -> Column:
        if c == "created_at":
            return F.when(old, F.col("_s.created_at")).otherwise(now)
        if c == "updated_at":
            return F.when(new, now).otherwise(F.col("_s.updated_at"))
        if c not in taken:
            return F.col(f"_s.{c}")
        first = new if c in ("link", "release_date") else ~old
        return F.when(first, F.col(f"_i.{c}")).otherwise(F.col(f"_s.{c}"))

    return s.join(i, KEY, "full").select(*[c if c in KEY else value(c).alias(c) for c in stored.columns])


def missing_names(names: DataFrame, stored: DataFrame) -> DataFrame:
    """Names that have no stored row yet: the rows to create."""
    return names.select("name").distinct().join(stored.select("name"), "name", "left_anti")


def get_or_create(table: Table, names: DataFrame, tries: int = 20) -> DataFrame:
    """(name, key, id) of every row of names (name, base_url): names that agree but for case and white space are one provider.

    table (Table with key "key") holds key, id, name, base_url. A key without a
    row gets the next free id; new keys are numbered without gaps in order of
    key, by ranges, and of names with one key the smallest is stored. Rows that
    are there stay as they are. A second call finds the same ids; of two
    writers at once one is first, and the other takes its ids over. Null names
    have no key and come back with null.
    """
    spark = names.sparkSession
    named = names.select("name", "base_url", key_of(F.col("name")).alias("key"))
    with tidy(spark):
        wanted = materialize(named.filter("key IS NOT NULL").groupBy("key").agg(F.min(F.struct("name", "base_url")).alias("n")).select("key", "n.*"), "wanted")
        for _ in range(tries):
            base = table.manifest()
            stored = table.read(base["version"])
            lacking = wanted if stored is None else wanted.join(stored.select("key"), "key", "left_anti")
            top = (stored.agg(F.max("id")).first()[0] if stored is not None else None) or 0
            new = materialize(numbered(lacking, ["key"]).select("key", (F.col("_at") + 1 + top).alias("id"), "name", "base_url"), "new")
            placed = table.placed(new)
            met = [r[0] for r in placed.select(PLACE).distinct().collect()]  # at most as many numbers as there are buckets
            if not met:
                break
            old = table.read(base["version"], met)
            try:
                table.commit(placed if old is None else table.placed(old.select(*new.columns)).unionByName(placed), base, met)
                break
            except Conflict:
                continue
        else:
            raise Conflict(f"{table.path}: other writers were first {tries} times")
    stored = table.read()
    ids = stored.select("key", "id") if stored is not None else spark.createDataFrame([], "key string, id long")
    return named.select("name", "key").join(ids, "key", "left").select("name", "key", "id")
