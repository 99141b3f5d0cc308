import json
import os

from pyspark.sql import functions as F

from tidemark.operators.versions import Table
from tidemark.sources.snapshot import Memo, Snapshots
from tidemark.streaming import breaker, refresh


def test_breaker_keeps_its_run_between_batches(spark, tmp_path):
    for k, outcomes in enumerate((["error", "empty", "error"], ["error", "error", "error"])):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(json.dumps({"seq": 10 * k + i, "provider": "p", "outcome": o}) for i, o in enumerate(outcomes)))
        os.utime(tmp_path / "in" / f"{k}.json", (1_700_000_000 + 60 * k,) * 2)  # files are read by age
    source = spark.readStream.schema("seq long, provider string, outcome string").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    q = breaker.trips(source, 3).writeStream.format("memory").queryName("trips").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [tuple(r) for r in spark.sql("SELECT * FROM trips").collect()] == [("p", 11)]


SCHEMA = "manga_id long, provider_id string, chapter_number double, link string, pos int"


def put(folder, k, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{k}.json").write_text("\n".join(json.dumps(dict(zip(("manga_id", "provider_id", "chapter_number", "link", "pos"), r, strict=True))) for r in rows))
    os.utime(folder / f"{k}.json", (1_700_000_000 + 60 * k,) * 2)  # files are read by age


def now(day=2):
    return F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp_ntz")


def run(spark, tmp_path, table, folder="in", checkpoint="c"):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(tmp_path / folder))
    refresh.apply_batches(stream, table, now(), str(tmp_path / checkpoint)).awaitTermination(180)


def test_refresh_creates_the_table_and_a_version_a_batch(spark, tmp_path):
    table = Table(spark, f"file://{tmp_path}/t", ["manga_id"], 4)
    put(tmp_path / "in", 0, [(1, "p", 1.0, "b", 2), (1, "p", 1.0, "a", 1), (2, "p", 1.0, "x", 1)])
    put(tmp_path / "in", 1, [(1, "p", 1.0, "c", 1), (1, "p", 2.0, "d", 2)])
    run(spark, tmp_path, table)
    assert table.versions() == [1, 2]
    assert sorted((r.manga_id, r.chapter_number, r.link) for r in table.read(1).collect()) == [(1, 1.0, "a"), (2, 1.0, "x")]
    assert sorted((r.manga_id, r.chapter_number, r.link) for r in table.read().collect()) == [(1, 1.0, "c"), (1, 2.0, "d"), (2, 1.0, "x")]
    assert "pos" not in table.read().columns


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    table = Table(spark, f"file://{tmp_path}/t", ["manga_id"], 4)
    put(tmp_path / "in", 0, [(1, "p", 1.0, "a", 1)])
    run(spark, tmp_path, table)
    run(spark, tmp_path, table, checkpoint="lost")  # the checkpoint was lost: batch 0 comes again
    assert table.versions() == [1]


def test_a_batch_reads_and_writes_only_its_buckets(spark, tmp_path):
    table = Table(spark, f"file://{tmp_path}/t", ["manga_id"], 8)
    base = spark.createDataFrame([(i, "p", 1.0, "a") for i in range(40)], "manga_id long, provider_id string, chapter_number double, link string").withColumns({"created_at": now(1), "updated_at": now(1)})
    table.update(base, lambda old, new: new)
    before = table.manifest()["buckets"]
    put(tmp_path / "in", 0, [(3, "p", float(n), f"b{n}", n) for n in (1, 2)])
    run(spark, tmp_path, table)
    after = table.manifest()["buckets"]
    assert sum(before[b] != after[b] for b in before) == 1 and len(before) > 4
    assert sorted((r.manga_id, r.chapter_number, r.link) for r in table.read().collect()) == sorted([(i, 1.0, "a") for i in range(40) if i != 3] + [(3, 1.0, "b1"), (3, 2.0, "b2")])


def test_marks_are_flushed_in_steps_and_a_lost_run_goes_on(spark, tmp_path):
    table = Table(spark, f"file://{tmp_path}/s", ["mal_id"], 4)
    table.update(spark.range(50).selectExpr("id AS mal_id", "CAST(NULL AS timestamp_ntz) AS last_chapters_update"), lambda old, new: new)
    done = spark.range(25).selectExpr("id AS mal_id")
    assert refresh.flush_marks(table, done.filter("mal_id < 20"), now(), "run", every=10) == 2  # the run was lost after 20
    assert refresh.flush_marks(table, done, now(), "run", every=10) == 1
    assert table.versions() == [1, 2, 3, 4] and table.read().filter("last_chapters_update IS NOT NULL").count() == 25
    assert refresh.flush_marks(table, done, now(3), "next", every=1, most=2) == 2


def test_snapshots_are_capped_and_old_files_go(spark, tmp_path):
    s = Snapshots(spark, f"file://{tmp_path}", ttl=1, most=2)
    for at in (0, 10, 20):
        last = s.fresh("a", lambda: spark.range(3), at)
    assert len(list(tmp_path.glob("a-*"))) == 2 and last.count() == 3
    s.fresh("b", lambda: spark.range(1), 30)
    s.fresh("c", lambda: spark.range(1), 31)
    assert set(s.made) == {"b", "c"} and not list(tmp_path.glob("a-*"))
    assert s.fresh("a", lambda: spark.range(2), 32).count() == 2


def test_memo_waits_after_a_failure():
    tries = []

    def make():
        tries.append(1)
        if len(tries) < 3:
            raise OSError("down")
        return "made"

    m = Memo(make, "default")
    assert [m.get(t) for t in (0, 30, 59.9)] == ["default"] * 3 and len(tries) == 1
    assert m.get(60) == "default" and m.get(100) == "default" and len(tries) == 2
    assert m.get(120) == "made" and m.get(121) == "made" and len(tries) == 3


def test_last_good_snapshot_serves_when_a_read_fails(spark, tmp_path):
    s = Snapshots(spark, f"file://{tmp_path}")
    assert s.fresh("x", lambda: spark.range(3), 0).count() == 3
    assert s.fresh("x", lambda: spark.range(9), 100).count() == 3

    def broken():
        raise OSError("down")

    assert s.fresh("x", broken, 1000).count() == 3
    assert s.fresh("x", lambda: spark.range(4), 1001).count() == 4
