import threading

import pytest
from pyspark.sql import functions as F

from tidemark.operators import delta
from tidemark.operators.ranges import numbered
from tidemark.operators.versions import Conflict, Table


def add(stored, new):
    return new if stored is None else stored.unionByName(new)


def test_versions_stay_readable_and_absent_tables_are_empty(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t", ["id"], 4)
    assert t.read() is None and t.versions() == [] and t.manifest()["version"] == 0
    assert t.update(spark.range(0).toDF("id"), add) is None
    t.update(spark.range(10).toDF("id"), add)
    t.update(spark.range(10, 13).toDF("id"), add)
    assert [t.read(v).count() for v in (1, 2)] == [10, 13]
    t.update(spark.range(13).toDF("id"), lambda old, new: new.filter("id = 5"))  # every other bucket is empty then
    assert [r.id for r in t.read().collect()] == [5] and len(t.manifest()["buckets"]) == 1
    other = Table(spark, f"file://{tmp_path}/t", ["id"], 99)
    assert other.placed(spark.range(50).toDF("id")).agg(F.max("_b")).first()[0] < 4  # buckets are those of the first version


def test_one_bucket_is_read_by_its_files(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t", ["id"], 8)
    t.update(spark.range(100).toDF("id"), add)
    one = t.placed(spark.createDataFrame([(7,)], "id long")).first()["_b"]
    part = t.read(buckets=[one])
    assert all(f"_b={one}/" in f for f in part.inputFiles()) and 7 in {r.id for r in part.collect()}
    assert t.read(buckets=[]).count() == 0


def test_readers_miss_nothing_while_writers_commit_and_die(spark, tmp_path):
    """50 commits, every fifth of a writer that is lost before its version; a reader in a loop sees each version whole."""
    t = Table(spark, f"file://{tmp_path}/t", ["id"], 3)
    t.update(spark.range(20).selectExpr("id", "0 AS v"), add)
    wrong, seen, stop = [], set(), threading.Event()

    def read():
        while not stop.is_set():
            rows = t.read().collect()
            seen.add(rows[0].v if rows else None)
            if len(rows) != 20 or len({r.v for r in rows}) != 1:
                wrong.append(rows)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for k in range(1, 51):
            rows = spark.range(20).selectExpr("id", f"{k} AS v")
            if k % 5 == 0:
                t.placed(rows).write.partitionBy("_b").parquet(f"{t.path}/data/lost{k}")
                (tmp_path / "t" / "versions" / f".lost{k}").write_text('{"version": ')
                continue
            t.update(rows, lambda old, new: new)
    finally:
        stop.set()
        reader.join(60)
    assert not wrong and len(seen) > 3 and t.versions() == list(range(1, 42))
    assert len(t.clean(now=2**33, grace=0)) > 40 and t.versions() == [41]
    assert {r.v for r in t.read().collect()} == {49} and not list((tmp_path / "t" / "data").glob("lost*"))


def test_data_is_kept_for_a_grace_time(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t", ["id"], 2)
    for k in range(3):
        t.update(spark.range(5).selectExpr("id", f"{k} AS v"), lambda old, new: new)
    pinned = t.read(1)
    import time

    assert t.clean(time.time(), grace=3600) == [] and {r.v for r in pinned.collect()} == {0}


def test_of_two_writers_one_is_first_and_the_other_goes_on_top(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t", ["id"], 2)
    t.update(spark.range(2).toDF("id"), add)
    base = t.manifest()
    t.update(spark.range(2, 4).toDF("id"), add)
    with pytest.raises(Conflict):
        t.commit(t.placed(spark.range(9).toDF("id")), base, [0, 1])
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2  # nothing of the one that came late

    made, failed = [], []

    def write(k):
        try:
            made.append(t.update(spark.range(100 * k, 100 * k + 5).toDF("id"), add))
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    writers = [threading.Thread(target=write, args=(k,)) for k in range(1, 5)]
    for w in writers:
        w.start()
    for w in writers:
        w.join(120)
    assert not failed and sorted(made) == [3, 4, 5, 6] and t.read().count() == 24


def test_a_batch_is_committed_once(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t", ["id"], 2)
    assert [t.update(spark.range(3).toDF("id"), add, ("q", n)) for n in (0, 0, 1, 0)] == [1, None, 2, None]
    assert t.update(spark.range(3).toDF("id"), add, ("other", 0)) == 3 and t.read().count() == 9


# ---- ids


def names(spark, *rows):
    return spark.createDataFrame(list(rows), "name string, base_url string")


def test_providers_have_stable_gapless_ids(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/p", ["key"], 3)
    first = {r.name: r.id for r in delta.get_or_create(t, names(spark, ("Weeb  Central", "https://w"), ("weebcentral", "https://x"), ("B", "b"), (None, "n"), ("B", "b"))).collect()}
    assert first == {"Weeb  Central": 2, "weebcentral": 2, "B": 1, None: None}
    again = delta.get_or_create(t, names(spark, ("WEEB CENTRAL", "https://new"), ("A", "a"), ("C", None)))
    assert {r.name: r.id for r in again.collect()} == {"WEEB CENTRAL": 2, "A": 3, "C": 4}
    assert t.versions() == [1, 2]
    assert {r.name: r.id for r in delta.get_or_create(t, names(spark, ("a", "z"), ("b", "z"))).collect()} == {"a": 3, "b": 1} and t.versions() == [1, 2]
    stored = {r.key: (r.id, r.name, r.base_url) for r in t.read().collect()}
    assert stored == {"b": (1, "B", "b"), "weebcentral": (2, "Weeb  Central", "https://w"), "a": (3, "A", "a"), "c": (4, "C", None)}
    assert delta.get_or_create(Table(spark, f"file://{tmp_path}/none", ["key"]), names(spark, (None, None))).first().id is None


def test_two_writers_give_each_key_one_id(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/p", ["key"], 3)
    failed = []

    def write(k):
        try:
            delta.get_or_create(t, names(spark, *[(f"n{i}", None) for i in range(5 * k, 5 * k + 20)]))
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    writers = [threading.Thread(target=write, args=(k,)) for k in range(3)]
    for w in writers:
        w.start()
    for w in writers:
        w.join(120)
    rows = t.read().collect()
    assert not failed and len({r.key for r in rows}) == len(rows) == 30 and sorted(r.id for r in rows) == list(range(1, 31))


def test_places_and_running_sums(spark):
    df = spark.range(1000).selectExpr("(id * 7919) % 1000 AS k", "CASE WHEN id % 10 > 0 THEN CAST(id % 3 AS double) END AS c")
    assert sorted((r.k, r._at) for r in numbered(df, ["k"], 7).collect()) == [(i, i) for i in range(1000)]
    rows = sorted((r.k, r.c or 0.0, r._at) for r in numbered(df, ["k"], 7, F.col("c")).collect())
    total = 0.0
    for _, c, at in rows:
        assert at == total
        total += c
    assert numbered(df.filter("false"), ["k"]).count() == 0
