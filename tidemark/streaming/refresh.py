"""Incremental refresh of the stored catalogue from a stream of scraped rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import cadence, delta
from tidemark.operators.ranges import numbered
from tidemark.operators.versions import Table
from tidemark.session import materialize, tidy
from tidemark.settings import Settings


def apply_batches(scraped: DataFrame, table: Table, now: Column, checkpoint: str, name: str = "refresh", window: int = 5):
    """Starts a query that upserts each micro-batch's delta into a versioned table, dealt out by manga_id; an absent table is created.

    A micro-batch is one version: readers see all of it or nothing. Its number
    is committed with it under the query's name, so one that is run again after
    a failure changes nothing. Only the buckets of its series are read and
    written. Of rows with one key the first by pos, the place in the document,
    counts (without that column, the smallest link).
    """
    order = [c for c in ("pos",) if c in scraped.columns] + ["link"]

    def merge(stored: DataFrame | None, new: DataFrame) -> DataFrame:
        due = delta.flags(new, stored, window).filter("upsert").select(*new.columns)
        return delta.upsert(stored, due.drop("pos"), now)

    def step(batch: DataFrame, number: int) -> None:
        with tidy(batch.sparkSession):
            table.update(materialize(delta.first_by_key(batch, delta.KEY, order), "batch"), merge, (name, number))

    return scraped.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def flush_marks(table: Table, done: DataFrame, now: Column, run: str, every: int = int(Settings.flush_every), most: int = 1000) -> int:
    """Sets last_chapters_update of the series in done (mal_id) to now, `every` series a version and the rest in a last one; the number of versions.

    A run that is lost keeps what it has flushed, and the same run again (the
    same name and the same series) goes on from there. With over `most` x
    `every` series, as many more go into a version.
    """
    with tidy(done.sparkSession):
        ids = numbered(done.select("mal_id").distinct(), ["mal_id"])
        n = ids.count()
        every = max(every, -(-n // most))

        def merge(stored: DataFrame | None, ids: DataFrame) -> DataFrame:
            return cadence.mark_updated(stored, ids, now)

        if table.read() is None:
            raise ValueError(f"{table.path} has no series to mark")
        return sum(table.update(ids.filter(F.floor(F.col("_at") / every) == k).select("mal_id"), merge, (run, k)) is not None for k in range(-(-n // every)))


def activity(rows: DataFrame, late: str = "1 day") -> DataFrame:
    """Newest row of each series and day in a stream, rows later than `late` left out; an extension beyond the batch operators."""
    day = F.window("created_at", "1 day")
    return rows.withWatermark("created_at", late).groupBy("manga_id", day).agg(F.max("created_at").alias("last_chapter_at"))
