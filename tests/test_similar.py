import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import matching, similar


def brute(left, right, like):
    out = []
    for (i, a), (j, b) in itertools.product(left, right):
        x, y = set(a or []) - {None}, set(b or []) - {None}
        both = len(x & y)
        if not both:
            continue
        score = 1.0 if like.name == "any" else both / len(x | y) if like.name == "jaccard" else 2 * both / (len(x) + len(y))
        if score >= like.least:
            out.append((i, j, round(score, 9)))
    return sorted(out)


@pytest.fixture(scope="module")
def sets():
    """Rare and common words, one word in every set, equal sets, empty and null ones, repeats."""
    draw = np.random.default_rng(11)

    def some(n):
        rows = [(k, ["all", *(f"w{int(x)}" for x in draw.zipf(1.3, int(draw.integers(1, 9))) % 60)]) for k in range(n)]
        return rows + [(n, []), (n + 1, None), (n + 2, ["all"]), (n + 3, ["all"]), (n + 4, ["x", "x", None]), (n + 4, ["x"])]

    return some(150), some(170)


@pytest.mark.parametrize("like", [similar.Likeness("any", 0.0), *(similar.Likeness(k, t) for k in ("jaccard", "dice") for t in (0.2, 0.5, 2 / 3, 0.8, 1.0))], ids=str)
@pytest.mark.parametrize("hot", [10_000, 7])
def test_pairs_are_those_of_brute_force(spark, sets, like, hot, monkeypatch):
    monkeypatch.setattr(similar, "HEAVY", 10**9)
    left, right = sets
    l = spark.createDataFrame(left, "i long, a array<string>").repartition(3)
    r = spark.createDataFrame(right, "j long, b array<string>").repartition(2)
    got = similar.pairs(l, r, F.col("a"), F.col("b"), like, hot)
    assert sorted((x.i, x.j, round(x.score, 9)) for x in got.collect()) == brute(left, right, like)
    assert got.columns == ["i", "a", "j", "b", "score"]


def test_a_word_in_all_titles_is_in_no_prefix(spark):
    rows = [(k, ["all", f"a{k}", f"b{k % 50}", f"c{k % 20}"]) for k in range(2000)]
    df = spark.createDataFrame(rows, "i long, a array<string>")
    like = similar.Likeness("jaccard", 0.6)
    counts = df.select(F.explode("a").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("f"))
    base = df.select(F.col("i").alias("uid"), F.struct("i").alias("row"), F.col("a").alias("w"))
    words = {r.w for r in similar._prefixes(base, similar._ordered(base, counts, 8000), like, "l").select("w").distinct().collect()}
    assert "all" not in words and len(words) == 2050
    plan = similar.pairs(df, df.select(F.col("i").alias("j"), F.col("a").alias("b")), F.col("a"), F.col("b"), like)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "HashAggregate" not in plan


def test_nothing_is_like_nothing(spark):
    none = spark.createDataFrame([], "i long, a array<string>")
    other = spark.createDataFrame([(1, ["x"])], "j long, b array<string>")
    for like in (similar.Likeness("any", 0.0), similar.Likeness("dice", 0.4)):
        assert similar.pairs(none, other, F.col("a"), F.col("b"), like).count() == 0


@pytest.mark.parametrize("least", [0.4, 0.7])
def test_open_matching_finds_what_all_pairs_give(spark, least):
    titles = ["Blue Bolt", "blue bolts", "The Blue Bolt Academy", "Solo", "solo!", "Lone Star", "Lone-Star Rising", "日本語", "", "a b", "Re:Gear", "Star Lone", "Bolt", "Boltz up"]
    q = spark.createDataFrame([(f"q{i}", t) for i, t in enumerate(titles)], "query string, title string")
    c = spark.createDataFrame([(f"{t}{'' if i % 3 else 'Extra Title'}", i, t.lower().replace(" ", "-")) for i, t in enumerate(titles * 2)], "cand_title string, pos long, slug string")
    every = q.crossJoin(c)
    for rule, opened in ((matching.dice_match, matching.open_dice_match), (matching.jaccard_match, matching.open_jaccard_match)):
        want = sorted(map(tuple, rule(every, least).collect()))
        assert sorted(map(tuple, opened(q, c, least).collect())) == want and want


def test_search_hits_share_a_word_once(spark):
    q = spark.createDataFrame([("q", "The blue the bolt"), ("r", "???")], "query string, title string")
    c = spark.createDataFrame([("Blue bolt the", 1), ("the", 2), ("other", 3)], "cand_title string, pos long")
    assert sorted((r.query, r.pos) for r in matching.search_hits(q, c).collect()) == [("q", 1), ("q", 2)]
