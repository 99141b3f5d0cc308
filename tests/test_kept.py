"""What is kept and added to rather than worked out again: ranks, activity; and table functions."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.functions import tables
from tidemark.operators import cadence, reads
from tidemark.operators.versions import Table
from tidemark.sources import extract


def test_a_deep_page_is_a_slice(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id % 40 END AS manga_id", "concat('p', id % 3) AS provider_id", "CAST(id AS double) AS chapter_number", "concat('l', id) AS link", "timestamp_ntz'2024-01-01 00:00:00' AS created_at")
    providers = spark.createDataFrame([("p0", "Zero", True), ("p1", "One", True), ("p2", "Two", False)], "id string, name string, enabled boolean")
    path = f"file://{tmp_path}/ranked"
    reads.write_ranked(rows, providers, path, rows_a_file=500)
    index = spark.read.parquet(path)
    for manga, page, size in ((7, 1, 50), (7, 100, 50), (7, 137, 50), (1, 2, 20), (999, 1, 5), (7, 9999, 50)):
        want = [tuple(r) for r in reads.page(rows, providers, manga, page, size).collect()]
        assert [tuple(r) for r in reads.ranked_page(index, manga, page, size).collect()] == want
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = reads.ranked_page(index, 7, 100)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(rank,4950)" in plan and "LessThan(rank,5000)" in plan and "EqualTo(manga_id,7)" in plan
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert reads.ranked(rows.filter("false"), providers).count() == 0


def test_activity_added_up_is_activity_worked_out_again(spark, tmp_path):
    draw = np.random.default_rng(4)
    table = Table(spark, f"file://{tmp_path}/a", ["manga_id"], 8)
    every = []
    for k in range(20):
        batch = [(int(m), f"2024-01-{int(d):02d} 00:00:00") for m, d in zip(draw.integers(0, 30, 5), draw.integers(1, 29, 5), strict=True)] + ([(100, None)] if k == 3 else [])
        every += batch
        rows = spark.createDataFrame(batch, "manga_id long, at string").select("manga_id", F.col("at").try_cast("timestamp_ntz").alias("created_at"))
        before = table.manifest()["buckets"]
        assert cadence.keep_activity(table, rows, ("rows", k)) == k + 1
        assert cadence.keep_activity(table, rows, ("rows", k)) is None
        after = table.manifest()["buckets"]
        assert sum(before.get(b) != f for b, f in after.items()) <= len({m for m, _ in batch})
    all_rows = spark.createDataFrame(every, "manga_id long, at string").select("manga_id", F.col("at").try_cast("timestamp_ntz").alias("created_at"))
    want = {r.manga_id: r.last_chapter_at for r in cadence.activity(all_rows).collect()}
    got = table.read().collect()
    assert {r.manga_id: r.last_chapter_at for r in got} == want and sum(r.chapters for r in got) == len(every)


def test_elements_and_objects_in_sql(spark):
    tables.register(spark)
    spark.createDataFrame([(1, "<ul><li><a href=x>X</a><li><a>Y"), (2, None), (3, "")], "id long, html string").createOrReplaceTempView("t_pages")
    got = spark.sql("SELECT id, e.pos, e.tag, e.attrs['href'] AS href, e.text FROM t_pages, LATERAL html_elements(html, 'li a') e ORDER BY pos").collect()
    assert [tuple(r) for r in got] == [(1, 2, "a", "x", "X"), (1, 4, "a", None, "Y")]
    assert spark.sql("SELECT count(*) FROM t_pages, LATERAL html_elements(html, NULL) e").first()[0] == 5
    spark.createDataFrame([(1, '{"@type": "A", "x": [{"é": 1}]}'), (2, "{"), (3, None), (4, "7"), (5, "[" * 100_000)], "id long, body string").createOrReplaceTempView("t_bodies")
    got = spark.sql("SELECT id, o.at, o.type, o.value FROM t_bodies, LATERAL json_objects(body) o ORDER BY id, at").collect()
    assert [tuple(r) for r in got] == [(1, 0, "A", '{"@type": "A", "x": [{"é": 1}]}'), (1, 1, None, '{"é": 1}')]


def test_replay_of_long_pages(spark):
    """20,000 rows of one page, of which links and numbers repeat."""
    rows = [(k % 2, k, f"l{k * 7 % 9000}", float(k * 11 % 8000), None) for k in range(20_000)] + [(2, 1, None, 1.0, None), (2, 2, None, 2.0, None), (2, 3, "x", 1.0, None)]
    df = spark.createDataFrame(rows, "page_id long, pos int, link string, chapter_number double, release_date timestamp_ntz").repartition(3)
    want, seen = [], {0: set(), 1: set(), 2: set()}
    for page, pos, link, n, _ in sorted(rows, key=lambda r: r[:2]):
        mine = {link, n} - {None}
        if seen[page].isdisjoint(mine):
            seen[page] |= mine
            want.append((page, pos))
    assert sorted((r.page_id, r.pos) for r in extract.url_then_number(df).collect()) == want
