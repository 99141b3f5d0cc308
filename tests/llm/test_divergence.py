from collections import Counter, defaultdict

import pytest
import regex
from pyspark.sql import functions as F

from tidemark.llm import source_divergence

TERM = regex.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, least, top):
    docs = [(lang or "", source or "", TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))) for lang, source, text in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [(s, w) for x, s, w in docs if x == lang]
        have = Counter(t for _, w in mine for t in set(w))
        kept = sorted(t for t, n in have.items() if n >= least)
        counts = defaultdict(Counter)
        for s, w in mine:
            counts[s].update(t for t in w if t in set(kept))
        share = lambda c, t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))
        sources = {s for s, _ in mine}
        every = sum((counts[s] for s in sources), Counter())
        for s in sources:
            pairs = [(-sum(abs(share(counts[s], t) - share(counts[o], t)) for t in kept), o) for o in sources if o != s]
            terms = [(share(every, t) - share(counts[s], t), t) for t in kept if counts[s][t] and share(counts[s], t) > share(every, t)]
            for part, items in (("pair", sorted(pairs, key=lambda x: (x[0], x[1].encode()))), ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:top])):
                out |= {(lang, s, part, item, -v, k) for k, (v, item) in enumerate(items, 1)}
    return out


def got(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("least", [1, 2, 30])
def test_divergence_of_odd_rows(odd, least):
    want = brute([(r.lang, r.source, r.text) for r in odd.collect()], least, 50)
    assert got(source_divergence.divergence(odd, least)) == want
    assert {r[2] for r in want} == ({"pair", "term"} if least < 30 else {"pair"})


def test_divergence_with_a_hot_source_ties_and_lone_sources(spark, monkeypatch):
    rows = [("en", "hot" if i % 3 else f"s{i % 7}", "the THE cat " + ("dog " * (i % 4)) + ("Été 日本" if i % 5 == 0 else "a-b_c4d")) for i in range(300)]
    rows += [("de", "only", "eins zwei")] * 40 + [("fr", None, None), ("fr", "x", ""), (None, None, "\x00 12 !")]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "lang string, source string, text string, n int, term string").repartition(5)
    want = brute(rows, 30, 2)
    assert got(source_divergence.divergence(docs, 30, 2)) == want
    monkeypatch.setattr(source_divergence, "BROADCAST_SOURCES", 0)  # the salted join
    assert got(source_divergence.divergence(docs, 30, 2)) == want
    ranks = {r[5] for r in want if r[2] == "term"}
    assert ranks == {1, 2}


def test_a_groups_terms_are_limited_before_the_shuffle(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    plan = source_divergence.divergence(docs)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Cartesian" not in plan


def test_nothing_to_compare(none):
    assert source_divergence.divergence(none).count() == 0


def test_large_counts_stay_exact(spark):
    share = source_divergence._share("c", "total")
    one = spark.createDataFrame([(9_000_000_000_000, 9_000_000_000_007, 3)], "c long, total long, v long").select(F.expr(share)).first()[0]
    assert one == 1 + 10**9 * 9_000_000_000_005 // (9_000_000_000_007 + 15)
