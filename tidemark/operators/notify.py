"""Notification batches: ids with new rows, dealt into requests, and what became of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranges import numbered

#: Fixed value: ids in one request, at most.
BATCH = 500


def notifiable(results: DataFrame) -> DataFrame:
    """Distinct manga_ids of successful results with new chapters (null: none)."""
    return results.filter("success AND chapters_new > 0").select("manga_id").distinct()


def batches(ids: DataFrame, size: int = BATCH, ranges: int = 64) -> DataFrame:
    """(batch_id, manga_ids): the ids in order, `size` to a batch, from 0.

    Positions come from ranges, so no task sorts all ids.
    """
    at = numbered(ids.select("manga_id"), ["manga_id"], ranges)
    return at.withColumn("batch_id", F.floor(F.col("_at") / size)).groupBy("batch_id").agg(F.array_sort(F.collect_list("manga_id")).alias("manga_ids"))


def outcome(sent: DataFrame) -> DataFrame:
    """One row: status (sent, partial, failed or skipped), ids, sent_ids, batches, sent_batches, reason, from rows (batch_id, size, error or null)."""
    ok = F.col("error").isNull()
    out = sent.agg(
        F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("ids"), F.coalesce(F.sum(F.when(ok, F.col("size"))), F.lit(0)).cast("long").alias("sent_ids"),
        F.count(F.lit(1)).alias("batches"), F.count_if(ok).alias("sent_batches"),
    )
    # reasons are told apart before they are gathered: one row a reason, in order of first batch
    reasons = sent.filter(~ok).groupBy("error").agg(F.min("batch_id").alias("first")).agg(F.array_sort(F.collect_list(F.struct("first", "error"))).alias("errors"))
    out = out.crossJoin(F.broadcast(reasons))  # one row each
    status = F.when(F.col("batches") == 0, "skipped").when(F.col("sent_batches") == F.col("batches"), "sent").when(F.col("sent_batches") > 0, "partial").otherwise("failed")
    out = out.withColumn("status", status)
    reason = F.when(F.col("status") == "skipped", F.lit("no chapter written this run")).when(F.col("status") != "sent", F.expr("array_join(transform(errors, x -> x.error), ', ')"))
    return out.withColumn("reason", reason).drop("errors")


def describe_error(name: str | None, code: str | None, timeout_ms: int = 10_000) -> str:
    """A short reason without any address: the timeout, else the cause's code, else the error's name."""
    if name == "TimeoutError":
        return f"timed out after {timeout_ms}ms"
    return code or name or "request failed"


def summary(row) -> str:
    """The outcome as one line of a report."""
    if row.status == "sent":
        return f"{row.sent_ids} id{'' if row.sent_ids == 1 else 's'} in {row.batches} batch{'es' if row.batches > 1 else ''}"
    if row.status == "partial":
        return f"{row.sent_ids}/{row.ids} ids ({row.sent_batches}/{row.batches} batches) — {row.reason}"
    return f"0/{row.ids} ids — {row.reason}" if row.status == "failed" else f"skipped — {row.reason}"


def alerts(row) -> list[str]:
    """An alert if ids weren't delivered."""
    return [f"notification {row.status}: {row.ids - row.sent_ids} of {row.ids} ids not delivered — {row.reason}"] if row.status in ("partial", "failed") else []
