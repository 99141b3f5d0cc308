
import pytest
from pyspark.sql import functions as F

from tidemark.sources import captures, plugin

SCHEMA = "source string, page_id long, url string, status int, html string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("captures")
    captures.register(spark)
    rows = [("Weeb Central", i, f"u{i}", 200 if i % 4 else 500, f"<a href='/c/{i}'>{'é' * (i % 3)}") for i in range(60)] + [("a/b", i, None, None, None) for i in range(100, 130)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert captures.write(df.filter("page_id < 40"), f"file://{path}", 0) >= 1
    captures.write(df.filter("page_id >= 40"), f"file://{path}", 1)
    return path, rows


def read(spark, path):
    return spark.read.format("captures").load(f"file://{path}")


def test_what_was_written_is_read(spark, folder):
    path, rows = folder
    got = sorted((r.source, r.page_id, r.url, r.status, r.html) for r in read(spark, path).collect())
    assert got == sorted(rows) and {r.fault for r in read(spark, path).collect()} == {None}
    assert not list(path.rglob(".*"))


def test_filters_leave_files_out(spark, folder):
    path, _ = folder
    reader = captures._Reader(f"file://{path}")
    every = reader.partitions()
    assert {c.source for c in every} == {"Weeb Central", "a/b"} and {c.sequence for c in every} == {0, 1}
    few = read(spark, path).filter("source = 'a/b' AND page_id > 100 AND page_id <= 103")
    assert [r.page_id for r in few.orderBy("page_id").collect()] == [101, 102, 103]
    one = captures._Reader(f"file://{path}")
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThan

    asked = [EqualTo(("source",), "Weeb Central"), GreaterThan(("page_id",), 38), LessThan(("page_id",), 42), In(("status",), (1,))]
    assert list(one.pushFilters(asked)) == asked
    assert 0 < len(one.partitions()) < len(every) and all(c.source == "Weeb Central" and c.high > 38 and c.low < 42 for c in one.partitions())
    assert read(spark, path).filter("source IN ('x', 'y')").count() == 0


def test_a_line_that_cannot_be_read_costs_itself(spark, tmp_path):
    captures.register(spark)
    (tmp_path / "s").mkdir()
    lines = ["{}", "not JSON", '{"page_id": "7"}', '{"page_id": 1, "status": 200, "html": "<a>"}', "", '{"page_id": 2, "status": "x"}', '{"page_id": 99999999999999999999}', '{"page_id": 3, "status": 99999999999, "url": "\\ud800"}', '{"page_id": 4}']
    (tmp_path / "s" / "000000000000-1-9-ab.jsonl").write_bytes("\n".join(lines).encode() + b'\n{"page_id": 5, "html": "\xff"}')
    (tmp_path / "s" / "other.jsonl").write_text("ignored")
    rows = read(spark, tmp_path).collect()
    assert sorted(r.page_id for r in rows if r.fault is None) == [1, 4] and sum(r.fault is not None for r in rows) == 7
    attempts, found = plugin.scrape(plugin.page_site("s", lambda html, url: [(1, "l", None)] if html else []), read(spark, tmp_path), F.lit(None))
    assert sorted((r.page_id or 0, r.outcome) for r in attempts.collect()) == [(0, "error")] * 7 + [(1, "chapters"), (4, "error")] and found.count() == 1


def test_a_page_that_raises_is_one_error(spark):
    def shaky(html, url):
        if "boom" in html:
            raise RuntimeError("boom")
        if "late" in html:
            yield 1, "first", None
            raise ValueError("late")
        if "odd" in html:
            yield "no number", "l", None
        if "date" in html:
            yield 1, "l", "yesterday"
        if "one" in html:
            yield 2, f"{url}/2", None

    kinds = ["one", "boom", "late", "odd", "date", "", None, "one"]
    pages = spark.createDataFrame([(i, "u", 200, k) for i, k in enumerate(kinds)], "page_id long, url string, status int, html string").repartition(2)
    attempts, rows = plugin.scrape(plugin.page_site("Shaky", shaky), pages, F.lit(None))
    assert {r.page_id: (r.outcome, r.chapters) for r in attempts.collect()} == {0: ("chapters", 1), 1: ("error", 0), 2: ("error", 0), 3: ("error", 0), 4: ("error", 0), 5: ("empty", 0), 6: ("empty", 0), 7: ("chapters", 1)}
    assert sorted((r.page_id, r.chapter_number, r.link, r.provider) for r in rows.collect()) == [(0, 2.0, "u/2", "Shaky"), (7, 2.0, "u/2", "Shaky")]
    failed = plugin.read_pages(pages, shaky).filter("error IS NOT NULL").collect()
    assert {r.page_id: r.error.split(":")[0] for r in failed}.keys() == {1, 2, 3, 4} and "RuntimeError: boom" in {r.error for r in failed}


def test_a_stream_gives_the_attempts_of_a_batch(spark, folder, tmp_path):
    path, rows = folder
    source = plugin.page_site("Site", lambda html, url: [(len(url), url, None)] if "é" in html else [])
    want = sorted((r.page_id, r.outcome, r.chapters) for r in plugin.scrape(source, read(spark, path), F.lit(None))[0].collect())
    got = []

    def step(batch, number):
        got.extend((r.page_id, r.outcome, r.chapters) for r in plugin.scrape(source, batch.persist(), F.lit(None))[0].collect())

    stream = spark.readStream.format("captures").load(f"file://{path}")
    for _ in range(2):  # the second run goes on from the first one's offset: nothing is new
        stream.writeStream.foreachBatch(step).option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start().awaitTermination(180)
    assert sorted(got) == want and len(want) == len(rows)
    captures.write(spark.createDataFrame([("new", 500, "u", 200, "é")], SCHEMA), f"file://{path}", 2)
    got.clear()
    stream.writeStream.foreachBatch(step).option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start().awaitTermination(180)
    assert got == [(500, "chapters", 1)]


def test_captures_without_source_are_refused(spark, tmp_path):
    with pytest.raises(Exception, match="needs a source"):
        captures.write(spark.createDataFrame([(None, 1, "u", 200, "")], SCHEMA), f"file://{tmp_path}/x", 0)
    assert captures.listed(f"file://{tmp_path}/none") == []
