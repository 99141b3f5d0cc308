import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, matching, text
from tidemark.operators import cadence, delta, notify, selection, telemetry

KEY = "manga_id long, provider_id string, chapter_number double, link string"


def rows(spark, numbers, link="l{}"):
    return spark.createDataFrame([(1, "p", float(n), link.format(n)) for n in numbers], KEY)


def count(flagged):
    r = delta.counters(flagged).first()
    return (r.inserted, r.relinked, r.skipped, r.upserted)


@pytest.mark.parametrize(
    "scraped,stored,window,want",
    [
        (range(1, 11), {n: f"l{n}" for n in range(1, 11)}, 5, (0, 0, 5, 5)),
        (range(1, 11), {n: f"l{n}" for n in range(1, 9)}, 5, (2, 0, 5, 5)),
        (range(1, 11), {n: f"l{n}" if n != 3 else "old" for n in range(1, 11)}, 5, (0, 1, 4, 6)),
        (range(1, 11), {n: f"l{n}" if n != 3 else None for n in range(1, 11)}, 5, (0, 1, 4, 6)),
        (range(1, 102), {n: f"l{n}" for n in range(1, 101)}, 5, (1, 0, 96, 5)),
        ([3, 1, 2], {1: "l1", 2: "l2", 3: "l3"}, 1, (0, 0, 2, 1)),
        ([10.5, 10], {10.5: "l10.5", 10: "l10"}, 0, (0, 0, 2, 0)),
        (range(1, 4), {}, 5, (3, 0, 0, 3)),
        ([11, 11, 10.5, 10], {11: "l11", 10.5: "l10.5", 10: "l10"}, 2, (0, 0, 2, 2)),
        (range(1, 4), {n: f"l{n}" for n in range(1, 4)}, 50, (0, 0, 0, 3)),
    ],
)
def test_delta(spark, scraped, stored, window, want):
    s = spark.createDataFrame([(1, "p", float(n), x) for n, x in stored.items()], KEY)
    assert count(delta.flags(rows(spark, scraped), s, window)) == want


def test_delta_without_stored_rows_inserts_all(spark):
    assert count(delta.flags(rows(spark, range(1, 11)), None)) == (10, 0, 0, 10)


def test_upsert_twice_changes_nothing_more(spark):
    now = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    old = rows(spark, [1, 2]).withColumns({"created_at": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), "updated_at": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")})
    new = rows(spark, [2, 3], "n{}")
    once = delta.upsert(old, new, now)
    assert sorted((r.chapter_number, r.link, r.created_at.day, r.updated_at.day) for r in once.collect()) == [(1.0, "l1", 1, 1), (2.0, "n2", 1, 2), (3.0, "n3", 2, 2)]
    assert sorted(delta.upsert(once, new, now).collect()) == sorted(once.collect())
    assert count(delta.flags(new, once, 0)) == (0, 0, 2, 0)


@pytest.mark.parametrize("age,want", [(1, "active"), (9, "active"), (10, "slow"), (15, "slow"), (30, "slow"), (730, "dormant"), (-5, "active"), (None, "active")])
def test_tier(spark, age, want):
    now = dt.datetime(2026, 8, 30)
    last = None if age is None else now - dt.timedelta(days=age)
    df = spark.createDataFrame([(last, now)], "a timestamp_ntz, now timestamp_ntz")
    assert df.select(cadence.tier_of(F.col("a"), F.col("now"))).first()[0] == want


def test_tier_spec():
    assert [(t.label, t.interval_hours) for t in cadence.parse_tiers("3:1,10:4,*:12")] == [("<3d", 1), ("<10d", 4), ("catch-all", 12)]
    for bad in ("3:1,10:4", "*:12,3:1", "banane", "", "3:0,*:1"):
        assert cadence.parse_tiers(bad) is None


def test_alert_limits(spark):
    stats = spark.createDataFrame([("a", 49, 0, 49), ("b", 100, 0, 81), ("c", 100, 0, 80), ("d", 100, 99, 0), ("e", 500, 100, 0)], "provider string, attempts long, empty long, errors long")
    assert {r.provider: r.kind for r in telemetry.provider_alerts(stats).collect()} == {"b": "errors", "d": "empty"}


def test_pool_shares(spark):
    o = spark.range(900).select(F.lit(3000.0).alias("busy_ms"), F.lit(2000.0).alias("waited_ms"), F.lit(1).alias("found"), F.lit(True).alias("success"))
    r = telemetry.run_totals(o, 600_000, 8).first()
    assert (round(r.busy_pct), round(r.queued_pct), r.processed, r.failed) == (56, 38, 900, False)
    assert telemetry.run_totals(o.withColumn("success", F.lit(False)), 0, 8).first().failed


@pytest.mark.parametrize("values,p,want", [([1, 2], 50, 2), ([100, 200, 300], 50, 200), ([5], 95, 5), (list(range(100)), 95, 94)])
def test_nearest_rank(spark, values, p, want):
    df = spark.createDataFrame([("k", float(v)) for v in values], "k string, v double")
    assert telemetry.nearest_rank("v", p, ["k"], df).first()[f"p{p}"] == want


def test_outcomes_of_series(spark):
    kinds = {1: "ccc", 2: "eee", 3: "ee ", 4: "   ", 5: "xss", 6: "ss", 7: "eec"}
    names = {"c": "chapters", "e": "error", " ": "empty", "s": "skipped", "x": "error"}
    df = spark.createDataFrame([(k, names[c], 1.0, 0.0, 1) for k, v in kinds.items() for c in v], "series long, outcome string, ms double, waited_ms double, chapters long")
    assert {r.series: r.success for r in telemetry.series_outcome(df).collect()} == {1: True, 2: False, 3: True, 4: True, 5: False, 6: False, 7: True}


def test_breaker_across_ranges(spark):
    log = [(i, "p", "error" if 4000 <= i < 9000 else "chapters") for i in range(9100)] + [(i, "q", "error" if i % 2 else "empty") for i in range(50)]
    got = {r.provider: (r.tripped_at, r.longest) for r in telemetry.breaker(spark.createDataFrame(log, "seq long, provider string, outcome string"), 3).collect()}
    assert got == {"p": (4002, 5000), "q": (None, 1)}


def test_batches_of_ids(spark):
    got = sorted(notify.batches(spark.range(1, 1202).select(F.col("id").alias("manga_id"))).collect())
    assert [(r.batch_id, len(r.manga_ids), r.manga_ids[0]) for r in got] == [(0, 500, 1), (1, 500, 501), (2, 201, 1001)]


def test_notifiable(spark):
    df = spark.createDataFrame([(3, True, 2), (1, True, 0), (2, True, 1), (4, False, None), (3, True, 5), (5, True, None)], "manga_id long, success boolean, chapters_new long")
    assert sorted(r[0] for r in notify.notifiable(df).collect()) == [2, 3]


def test_notification_outcome(spark):
    sent = spark.createDataFrame([(0, 500, None), (1, 500, "HTTP 503"), (2, 201, None)], "batch_id long, size long, error string")
    r = notify.outcome(sent).first()
    assert (r.status, r.sent_ids, r.ids, r.reason) == ("partial", 701, 1201, "HTTP 503")
    assert notify.outcome(sent.filter("false")).first().status == "skipped"
    assert notify.summary(r).startswith("701/1201 ids (2/3 batches)") and notify.alerts(r)
    assert notify.describe_error("TimeoutError", None) == "timed out after 10000ms"


def test_source_order(spark):
    sources = spark.createDataFrame([(n, k, True, i) for i, (n, k) in enumerate(selection.REGISTERED)], "name string, type string, enabled boolean, idx int")
    series = spark.createDataFrame([(1, None)], "id long, type string")
    got = [r.name for r in selection.compatible(series, sources).orderBy("position").collect()]
    assert got == ["MangaKatana", "Weeb Central", "Mangapill", "MangaPark", "MangaDex"]
    other = [r.name for r in selection.compatible(series.withColumn("type", F.lit(" Manhua")), sources).orderBy("position").collect()]
    assert other == [*got, "Asura", "Rokari Comics"]


def test_calendar_months_run_over(spark):
    df = spark.createDataFrame([("1 month ago",), ("2 months ago",), ("1 year ago",)], "t string")
    now = F.lit("2023-03-31 12:00:00").cast("timestamp_ntz")
    assert [r[0] for r in df.select(dates.calendar_units(F.col("t"), now)).collect()] == [dt.datetime(2023, 3, 3, 12), dt.datetime(2023, 1, 31, 12), dt.datetime(2022, 3, 31, 12)]


def test_titles_without_latin_words(spark):
    p = spark.createDataFrame([("日本", "日本", "漫画", 1, "x")], "query string, title string, cand_title string, pos long, slug string")
    assert matching.edit_match(p).count() == 0 and matching.edit_match(p, strict_parity=True).count() == 1
    assert matching.jaccard_match(p).count() == 0


def test_similarities_are_symmetric_and_bounded(spark):
    df = spark.createDataFrame([("solo leveling", "leveling solo"), ("a", "b"), ("", ""), ("ab", "ab"), ("", "x")], "a string, b string")
    for f in (text.dice, text.jaccard):
        for r in df.select(f(F.col("a"), F.col("b")).alias("x"), f(F.col("b"), F.col("a")).alias("y")).collect():
            assert r.x == r.y and 0 <= r.x <= 1


@pytest.mark.parametrize("t,want", [("Aishiteru Game wo OwarasetaiI Want", ["Aishiteru Game wo Owarasetai", "I Want"]), ("plain", ["plain"])])
def test_split_joined(spark, t, want):
    assert spark.createDataFrame([(t,)], "t string").select(text.split_joined(F.col("t"))).first()[0] == want


def test_admission_of_a_million_rows_with_all_columns(spark):
    due = spark.range(1_000_000).select("id", (F.col("id") * 7919 % 1_000_003).alias("at"), F.lit(1.0).alias("cost"), F.concat(F.lit("t"), "id").alias("title"))
    got = cadence.admitted(due, F.col("cost"), 500_000, [F.col("at"), F.col("id")])
    taken = got.filter("admitted").agg(F.count(F.lit(1)).alias("n"), F.max("at").alias("last"), F.max("title").alias("t")).first()
    left = got.filter("NOT admitted").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"), F.max("title").alias("t")).first()
    assert (taken.n, left.n) == (500_000, 500_000) and taken["last"] < left["first"]


def test_batches_of_many_ids(spark):
    out = notify.batches(spark.range(200_000).select((F.col("id") * 3).alias("manga_id")), 500).select("batch_id", F.size("manga_ids").alias("n"), F.array_min("manga_ids").alias("a"), F.array_max("manga_ids").alias("b")).collect()
    assert sorted((r.batch_id, r.n, r.a, r.b) for r in out) == [(i, 500, 1500 * i, 1500 * i + 1497) for i in range(400)]


@pytest.mark.parametrize("ms,want", [(840, "840ms"), (999.6, "1000ms"), (1450, "1.4s"), (2950, "3.0s"), (2850, "2.9s"), (8250, "8.3s"), (8750, "8.8s"), (59999, "60.0s"), (60500, "1m01s"), (64000, "1m04s")])
def test_durations(spark, ms, want):
    assert spark.range(1).select(telemetry.format_ms(F.lit(float(ms))).alias("t")).first().t == want


def test_upsert_keeps_what_it_does_not_know(spark):
    now, old = dt.datetime(2024, 2, 1), dt.datetime(2024, 1, 1)
    s = spark.createDataFrame([(7, 1, "p", 1.0, "a", old, old, old, "x"), (8, 1, "p", 2.0, "b", old, old, old, "y")], "id long, manga_id long, provider_id string, chapter_number double, link string, release_date timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz, note string")
    i = spark.createDataFrame([(1, "p", 1.0, "a2", None, "z"), (1, "p", 3.0, "c", now, "w")], "manga_id long, provider_id string, chapter_number double, link string, release_date timestamp_ntz, note string")
    got = {r.chapter_number: tuple(r) for r in delta.upsert(s, i, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")).collect()}
    assert got == {
        1.0: (7, 1, "p", 1.0, "a2", None, old, now, "x"),
        2.0: (8, 1, "p", 2.0, "b", old, old, old, "y"),
        3.0: (None, 1, "p", 3.0, "c", now, now, now, "w"),
    }


def test_outcomes_of_failing_and_missing_series(spark):
    a = spark.createDataFrame([(1, "error", 0, 5.0, 1.0), (1, "error", 0, 9.0, 0.0), (2, "error", 0, 1.0, 0.0), (2, "empty", 0, 1.0, 0.0), (3, "skipped", 0, None, None), (4, "chapters", 3, 2.0, 0.0)], "series long, outcome string, chapters long, ms double, waited_ms double")
    got = {r.series: (r.attempted, r.errors, r.skipped, r.results, r.busy_ms, r.success) for r in telemetry.series_outcome(a).collect()}
    assert got == {1: (2, 2, 0, 0, 9.0, False), 2: (2, 1, 0, 0, 1.0, True), 3: (0, 0, 1, 0, 0.0, False), 4: (1, 0, 0, 1, 2.0, True)}
