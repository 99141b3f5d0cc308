"""Telemetry of source attempts: statistics, alerts, circuit breaker, outcomes of series and runs, the report."""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

#: When a source raises an alert.
ALERT_MIN_ATTEMPTS, ALERT_ERROR_RATE, ALERT_EMPTY_RATE = 50, 0.8, 0.98


def nearest_rank(column: str, percent: int, key: list[str], rows: DataFrame) -> DataFrame:
    """(key, value): the value at index round(percent / 100 * (n - 1)), halves up, of the sorted values of each key.

    Whole parts are counted first, and only the values of the one that holds
    the index are ranked, by distinct value; so a key's windows hold its
    distinct whole parts and the distinct values of one of them, not its rows.
    """
    distinct = rows.filter(F.col(column).isNotNull()).groupBy(*key, column).agg(F.count(F.lit(1)).alias("_n")).withColumn("_whole", F.floor(column))
    parts = distinct.groupBy(*key, "_whole").agg(F.sum("_n").alias("_m"))
    up = Window.partitionBy(*key).orderBy("_whole")
    parts = parts.withColumns({"_to": F.sum("_m").over(up), "_all": F.sum("_m").over(Window.partitionBy(*key))})
    at = F.floor(F.lit(percent / 100.0) * (F.col("_all") - 1) + 0.5)
    parts = parts.withColumn("_at", at - (F.col("_to") - F.col("_m"))).filter("_at >= 0 AND _at < _m").select(*key, "_whole", "_at")
    inside = distinct.join(parts, [*key, "_whole"]).withColumn("_upto", F.sum("_n").over(Window.partitionBy(*key).orderBy(column)))
    return inside.filter((F.col("_upto") > F.col("_at")) & (F.col("_upto") - F.col("_n") <= F.col("_at"))).select(*key, F.col(column).alias(f"p{percent}"))


def provider_stats(attempts: DataFrame) -> DataFrame:
    """attempts, with_chapters, empty, errors, chapters, median_ms, p95_ms, max_ms by provider; the pace-setter has the largest median x attempts.

    Sources that were skipped weren't attempted. A provider none of whose
    attempts has a time has times of 0.
    """
    tried = attempts.filter("outcome <> 'skipped'")
    counts = tried.groupBy("provider").agg(
        F.count(F.lit(1)).alias("attempts"), F.count_if(F.expr("outcome = 'chapters'")).alias("with_chapters"), F.count_if(F.expr("outcome = 'empty'")).alias("empty"),
        F.count_if(F.expr("outcome = 'error'")).alias("errors"), F.coalesce(F.sum("chapters"), F.lit(0)).cast("long").alias("chapters"), F.coalesce(F.max("ms"), F.lit(0.0)).alias("max_ms"),
    )
    out = counts
    for percent, name in ((50, "median_ms"), (95, "p95_ms")):
        out = out.join(nearest_rank("ms", percent, ["provider"], tried).withColumnRenamed(f"p{percent}", name), "provider", "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("median_ms", "p95_ms")})
    return out.orderBy(F.desc(F.col("median_ms") * F.col("attempts")), "provider")


def provider_alerts(stats: DataFrame, min_attempts: int = ALERT_MIN_ATTEMPTS, error_rate: float = ALERT_ERROR_RATE, empty_rate: float = ALERT_EMPTY_RATE) -> DataFrame:
    """(provider, kind, alert): at most one a provider; too many errors before too many empties; both limits are strict."""
    errors, empty = F.col("errors") / F.col("attempts"), F.col("empty") / F.col("attempts")
    kind = F.when(errors > error_rate, "errors").when(empty > empty_rate, "empty")

    def text(rate: Column, what: str) -> Column:
        return F.concat("provider", F.lit(": "), F.floor(100 * rate + 0.5).cast("string"), F.lit(f"% {what} over "), F.col("attempts").cast("string"), F.lit(" attempts"))

    rows = stats.filter(F.col("attempts") >= min_attempts).withColumn("kind", kind).filter("kind IS NOT NULL")
    silent = F.concat(text(empty, "empty"), F.lit(" — likely a silent breakage"))
    return rows.select("provider", "kind", F.when(F.col("kind") == "errors", text(errors, "errors")).otherwise(silent).alias("alert"))


def breaker(attempts: DataFrame, threshold: int) -> DataFrame:
    """(provider, tripped_at, longest): the seq at which consecutive errors first reach the threshold (null: never) and the longest run.

    A skipped source neither adds to a run nor ends it. Runs are counted within
    ranges of each provider's log and stitched by their ends, so no task holds
    a provider's whole log.
    """
    span = Window.partitionBy("provider", "_range").orderBy("seq")
    dealt = attempts.filter("outcome <> 'skipped'").select("provider", "seq", (F.col("outcome") == "error").alias("bad")).withColumn("_range", F.floor(F.col("seq") / 4096))
    marked = dealt.withColumn("_island", F.sum(F.when(F.col("bad"), 0).otherwise(1)).over(span))
    run = F.sum(F.col("bad").cast("long")).over(Window.partitionBy("provider", "_range", "_island").orderBy("seq"))
    counted = marked.withColumn("run", run)
    ends = counted.groupBy("provider", "_range").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("bad")).alias("ok"), F.max(F.struct("seq", "run")).alias("last"))
    order = Window.partitionBy("provider").orderBy("_range")
    # errors at a range's end, carried over ranges that hold nothing else
    block = F.sum(F.when(F.col("ok") > 0, 1).otherwise(0)).over(order)
    tail = ends.withColumn("_block", block).withColumn("carry", F.sum(F.when(F.col("ok") > 0, F.col("last.run")).otherwise(F.col("n"))).over(Window.partitionBy("provider", "_block").orderBy("_range")))
    into = tail.withColumn("before", F.coalesce(F.lag("carry").over(order), F.lit(0))).select("provider", "_range", "before")
    full = counted.join(into, ["provider", "_range"]).withColumn("run", F.when(F.col("bad") & (F.col("_island") == 0), F.col("run") + F.col("before")).when(F.col("bad"), F.col("run")).otherwise(0))
    return full.groupBy("provider").agg(F.min(F.when(F.col("run") >= threshold, F.col("seq"))).alias("tripped_at"), F.max("run").alias("longest"))


def after_breaker(attempts: DataFrame, trips: DataFrame) -> DataFrame:
    """attempts that a sticky breaker lets through: those up to the one that trips it."""
    met = attempts.join(F.broadcast(trips.select("provider", "tripped_at")), "provider", "left")
    return met.filter(F.col("tripped_at").isNull() | (F.col("seq") <= F.col("tripped_at"))).drop("tripped_at")


def series_outcome(attempts: DataFrame) -> DataFrame:
    """By series: attempted, errors, skipped, results, found, busy_ms, waited_ms, success.

    outcome may also be 'skipped'. A series fails only if no source answered
    and at least one was attempted or skipped; found nowhere is a success.
    Sources run side by side, so times are the slowest one's.
    """
    tried = F.col("outcome") != "skipped"
    out = attempts.groupBy("series").agg(
        F.count_if(tried).alias("attempted"), F.count_if(F.col("outcome") == "error").alias("errors"), F.count_if(~tried).alias("skipped"),
        F.count_if(F.col("outcome") == "chapters").alias("results"), F.sum("chapters").alias("found"),
        F.max(F.coalesce("ms", F.lit(0.0))).alias("busy_ms"), F.max(F.coalesce("waited_ms", F.lit(0.0))).alias("waited_ms"),
    )
    return out.withColumn("success", (F.col("attempted") > F.col("errors")) | ((F.col("attempted") == 0) & (F.col("skipped") == 0)))


def rows_by_series(counters: DataFrame) -> DataFrame:
    """(series, written, new) from delta.counters(): rows upserted and rows inserted, over all sources of a series."""
    return counters.groupBy(F.col("manga_id").alias("series")).agg(F.sum("upserted").alias("written"), F.sum("inserted").alias("new"))


def with_rows(outcomes: DataFrame, counters: DataFrame) -> DataFrame:
    """series_outcome() with written and new; 0 where a series has no counters."""
    met = outcomes.join(rows_by_series(counters), "series", "left")
    return met.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("written", "new")})


def series_totals(attempts: DataFrame, counters: DataFrame) -> DataFrame:
    """By series: rows found over all sources, the number of sources that had some, errors, rows written, and new ones among them."""
    had = F.when(F.col("outcome") == "chapters", F.col("provider"))
    out = attempts.groupBy("series").agg(F.coalesce(F.sum("chapters"), F.lit(0)).cast("long").alias("found"), F.count_distinct(had).alias("sources"), F.count_if(F.col("outcome") == "error").alias("errors"))
    return with_rows(out, counters)


def run_totals(outcomes: DataFrame, total_ms: float, concurrency: int) -> DataFrame:
    """One row: processed, updated, found, written and new rows (0 if outcomes has no such columns), busy and queued per cent of the pool, failed (something was processed and nothing updated)."""
    capacity = total_ms * concurrency
    share = {"busy_pct": "busy_ms", "queued_pct": "waited_ms"}
    rows = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) if c in outcomes.columns else F.lit(0).cast("long").alias(c) for c in ("found", "written", "new")]
    out = outcomes.agg(
        F.count(F.lit(1)).alias("processed"), F.count_if("success").alias("updated"), *rows,
        *[(F.round(100 * F.coalesce(F.sum(c), F.lit(0.0)) / capacity, 6) if capacity else F.lit(0.0)).alias(n) for n, c in share.items()],
    )
    return out.withColumn("failed", (F.col("processed") > 0) & (F.col("updated") == 0))


def format_ms(ms: Column) -> Column:
    """840ms, 2.9s, 1m04s. Tenths are rounded on the exact binary value, ties up: 1450 is 1.4s, 8250 is 8.3s."""
    seconds, exact = F.floor(ms / 1000 + 0.5), ms.cast("double") / 1000
    tie = (exact * 4) % 2 == 1  # .25 and .75 are the only exact ties
    tenths = F.format_number(F.when(tie, F.floor(exact * 10 + 0.5) / 10).otherwise(exact), 1)
    return (
        F.when(ms < 1000, F.concat(F.floor(ms + 0.5).cast("string"), F.lit("ms")))
        .when(ms < 60_000, F.concat(tenths, F.lit("s")))
        .otherwise(F.concat(F.floor(seconds / 60).cast("string"), F.lit("m"), F.lpad((seconds % 60).cast("string"), 2, "0"), F.lit("s")))
    )


def ms_text(ms: float) -> str:
    """format_ms() of one number."""
    if ms < 1000:
        return f"{math.floor(ms + 0.5)}ms"
    if ms < 60_000:
        return f"{Decimal(ms / 1000).quantize(Decimal('0.1'), ROUND_HALF_UP)}s"
    seconds = math.floor(ms / 1000 + 0.5)
    return f"{seconds // 60}m{seconds % 60:02d}s"


def whole(x: float) -> str:
    """A number without decimals, halves up on the exact binary value."""
    return str(Decimal(x).quantize(Decimal(1), ROUND_HALF_UP))


def series_times(outcomes: DataFrame) -> Row:
    """One row over all series: median, p95 and max of busy_ms, median and p95 of waited_ms; 0 without series."""
    one = outcomes.withColumn("_run", F.lit(1))
    out = outcomes.agg(F.coalesce(F.max("busy_ms"), F.lit(0.0)).alias("max_ms"))
    for column, percent, name in (("busy_ms", 50, "median_ms"), ("busy_ms", 95, "p95_ms"), ("waited_ms", 50, "wait_median_ms"), ("waited_ms", 95, "wait_p95_ms")):
        value = nearest_rank(column, percent, ["_run"], one).agg(F.coalesce(F.max(f"p{percent}"), F.lit(0.0)).alias(name))
        out = out.crossJoin(F.broadcast(value))  # one row each
    return out.first()


@dataclass(frozen=True)
class Run:
    """What a report says of a run besides its attempts."""

    total_ms: float
    concurrency: int
    with_chapters: int = 0
    due: int = 0
    left: int = 0
    interval_hours: float = 2
    source_concurrency: int = 0
    delay_ms: int = 0


def report(totals: Row, stats: list[Row], alerts: list[Row], tiers: list[Row], tripped: list[str], run: Run | None = None, times: Row | None = None) -> list[str]:
    """The run's report in Markdown, from rows that are few whatever the input: one run, a row a provider or tier."""
    lines = ["## Catalogue refresh", ""]
    if alerts:
        lines += ["> **Alerts**", *[f"> - {a.alert}" for a in alerts], ""]
    if tripped:
        lines += [f"> **Circuit breaker opened** for: {', '.join(tripped)}", ""]
    lines += ["| Metric | Value |", "|---|---|"]
    if run:
        lines += [f"| Series with chapters | {run.with_chapters} |", f"| Due ({'cadence by tier' if tiers else f'>{run.interval_hours:g}h'}) | {run.due} |"]
    rest = f" ({run.left} left for the next run: deadline)" if run and run.left else ""
    lines += [f"| Processed | {totals.processed}{rest} |", f"| Updated | {totals.updated} / {totals.processed} |", f"| Rows found | {totals.found} |"]
    if run:
        each = f", {run.source_concurrency} a source" if run.source_concurrency else ""
        lines += [f"| Rows written | {totals.written} ({totals.new} new) |", f"| Duration | {ms_text(run.total_ms)} |", f"| Concurrency | {run.concurrency} series{each}, {run.delay_ms}ms apart |"]
    lines += [f"| Pool time scraping | {whole(totals.busy_pct)}% |"]
    if not run or run.source_concurrency:
        lines += [f"| Pool time queued | {whole(totals.queued_pct)}% |"]
    lines += [""]
    if tiers:
        lines += ["| Tier | Interval | Candidates |", "|---|---:|---:|", *[f"| {t.tier} | {t.interval_hours:g}h | {t.candidates} |" for t in sorted(tiers, key=lambda t: t.position)], ""]
    if times:
        lines += [f"Series: median {ms_text(times.median_ms)}, p95 {ms_text(times.p95_ms)}, max {ms_text(times.max_ms)}", ""]
        if not run or run.source_concurrency:
            lines += [f"Queued: median {ms_text(times.wait_median_ms)}, p95 {ms_text(times.wait_p95_ms)}", ""]
    lines += ["| Provider | Attempts | With chapters | Empty | Errors | Median | p95 | Max |", "|---|---:|---:|---:|---:|---:|---:|---:|"]
    lines += [f"| {s.provider} | {s.attempts} | {s.with_chapters} | {s.empty} | {s.errors} | {ms_text(s.median_ms)} | {ms_text(s.p95_ms)} | {ms_text(s.max_ms)} |" for s in stats]
    return lines


#: Fixed value: failures that are named; the rest are counted.
NAMED_FAILURES = 20


def failure_lines(failures: DataFrame, most: int = NAMED_FAILURES) -> list[str]:
    """The first failures by series (title, series, error), and how many more there are; nothing without failures. What reaches the driver are `most` rows and a count."""
    n = failures.count()
    if not n:
        return []
    first = failures.orderBy("series").select("title", "series", "error").limit(most).collect()
    return [f"{n} series failed:", *[f"  - {r.title} ({r.series}): {r.error}" for r in first], *([f"  and {n - most} more"] if n > most else [])]


def tripped_alerts(trips: DataFrame) -> DataFrame:
    """(provider, kind, alert) of each source that its breaker has cut off."""
    alert = F.concat("provider", F.lit(": circuit breaker opened, left out for the rest of the run"))
    return trips.filter("tripped_at IS NOT NULL").select("provider", F.lit("tripped").alias("kind"), alert.alias("alert"))


def annotations(alerts: list[str], title: str = "Catalogue refresh") -> list[str]:
    """Alerts as warning annotations of a job's log."""
    return [f"::warning title={title}::{a}" for a in alerts]


def append_report(lines: list[str], path: str | None) -> bool:
    """Prints the report and appends it to the file at path. A file that can't be written is never an error."""
    text = "\n".join(lines)
    print(f"\n{text}\n")
    if not path:
        return False
    try:
        with open(path, "a", encoding="utf-8") as f:
            f.write(f"{text}\n")
    except OSError as error:
        print(f"the report wasn't written: {error}")
        return False
    return True
