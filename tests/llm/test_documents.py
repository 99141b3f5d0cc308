import re
from collections import Counter

import numpy as np
import pytest
from oracle import same
from pyspark.sql import functions as F

from tidemark.llm import bitmaps, exact_dedup, ngram_join, quality_classifier, quality_rules, queries
from tidemark.llm.components import components

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_its_sql(spark, small, name):
    same(spark, small, queries.QUERIES[name], queries.ORACLES[name])


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# ---- exact dedup


@pytest.mark.parametrize("bits", [32, 1, 0])
def test_exact_groups_tell_collisions_apart(odd, bits):
    weak = lambda t: F.unhex(F.rpad(F.substring(F.md5(F.encode(t, "UTF-8")), 1, bits), 32, "0"))
    texts = {}
    for d, t in rows(odd):
        texts.setdefault(re.sub("[\x20\x09-\x0d]+", " ", t or ""), []).append(d)
    want = Counter()
    for group in texts.values():
        named = sorted(d for d in group if d is not None)
        keep = named[0] if named else None
        for d in group:
            want[d, keep, len(group)] += 1
    got = exact_dedup.exact_groups(odd, weak).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == want
    assert sum(r.kept for r in got) == len(texts)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_groups_of_one_digest_are_told_apart_by_bytes(spark, odd, monkeypatch):
    """Hash and digest both collide for all texts."""
    real = F.sha2
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: F.lit("same"))
    try:
        got = exact_dedup.exact_groups(odd, lambda t: F.unhex(F.lit("00" * 16))).collect()
    finally:
        monkeypatch.setattr(exact_dedup.F, "sha2", real)
    assert sum(r.kept for r in got) == len({re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in rows(odd)}) and len(got) == odd.count()


def test_exact_groups_with_a_hot_group(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").otherwise(F.concat(F.lit("t"), (F.col("id") % 1900).cast("string"))).alias("text"))
    got = exact_dedup.exact_groups(docs)
    assert got.count() == 6000 and got.filter("kept").count() == docs.select("text").distinct().count()
    assert got.filter("keep_id = 0").count() == 2000


def test_nothing_to_dedup(none):
    assert exact_dedup.exact_groups(none).count() == 0


# ---- quality rules


def brute_metrics(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("position_bits", [24, 5])
def test_rule_metrics(odd, none, monkeypatch, position_bits):
    monkeypatch.setattr(quality_rules, "POSITION_BITS", position_bits)
    got = quality_rules.judge(odd, order=list(quality_rules.RULES)).collect()
    assert len(got) == odd.count()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_metrics(r.text)
        assert r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words) and r.kept == (r.rejected_by is None)
    assert quality_rules.judge(none).count() == 0


def test_order_of_rules_changes_no_verdict(spark, small):
    docs = queries.documents(spark, small)
    one, two = (quality_rules.judge(docs, order=o).select("doc_id", "kept").orderBy("doc_id").collect() for o in (list(quality_rules.RULES), list(quality_rules.RULES)[::-1]))
    assert one == two
    every = quality_rules.BASE + quality_rules.RULES
    order = quality_rules.order_rules(docs)
    assert {r.name for r in order} == {r.name for r in every} and order == quality_rules.order_rules(docs.repartition(7))
    kept = sorted(r.doc_id for r in one if r.kept)
    for o in (order, list(every), list(every)[::-1]):
        assert sorted(r.doc_id for r in quality_rules.passing(docs, order=o).select("doc_id").collect()) == kept


def test_rules_are_ordered_by_rejections_per_cost(spark):
    prose = " ".join(f"word{i}" for i in range(60))
    rows = [(i, t) for i, t in enumerate([prose] * 20 + ["#| " * 80] * 5 + ["few words"] * 3 + [prose.upper()] * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    names = [r.name for r in quality_rules.order_rules(docs)]
    assert names.index("symbols") < names.index("repeated_words")  # both reject the junk; one costs far less
    assert [r.name for r in quality_rules.order_rules(docs, known=quality_rules.COUNTS)][0] in ("symbols", "repeated_words", "word_length", "no_letters")
    assert quality_rules.order_rules(docs.filter("false"))


def test_rejected_documents_skip_what_later_rules_need(spark):
    """A metric that fails when it is evaluated shows that it isn't."""
    docs = spark.createDataFrame([(1, "few"), (2, "words here")], "doc_id long, text string")
    bad = quality_rules.Rule("bad", "cast(raise_error('evaluated') as int) + {n_letters} > 0", ("n_letters",))
    assert quality_rules.passing(docs, order=[quality_rules.BASE[0], bad]).count() == 0
    with pytest.raises(Exception, match="evaluated"):
        quality_rules.passing(docs, order=[bad, quality_rules.BASE[0]]).collect()


def test_rules_keep_columns_whatever_their_names(spark):
    text = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text, 1, 2, 3, True, "r"), (2, "few", 1, 2, 3, True, "r")], "doc_id long, text string, t int, n_words int, _q_t int, kept boolean, _Q_rejected string")
    assert [tuple(r) for r in quality_rules.passing(docs).collect()] == [(1, text, 1, 2, 3, True, "r")]
    assert [(r.n_words, r.kept) for r in quality_rules.judge(docs).orderBy("doc_id").collect()] == [(60, True), (1, False)]


# ---- quality classifier


def test_classifier_on_labels_it_has_not_seen(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = queries.documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    half = labels.filter("xxhash64(doc_id, 5) % 2 = 0")
    got = quality_classifier.classify(docs, half).join(labels.join(half, "doc_id", "left_anti"), "doc_id").select("kept", "quality").collect()
    good = [r.kept for r in got if r.quality == 1]
    bad = [r.kept for r in got if r.quality == 0]
    assert len(good) > 50 and all(good) and sum(bad) <= 0.2 * len(bad)


def test_site_posteriors_equal_a_plain_computation(spark):
    r = np.random.default_rng(1)
    data = [(f"h{i % 7}", f"p{i % 3}", float(np.clip(r.normal(0.5 + 0.05 * (i % 7), 0.1), 0.01, 0.99))) for i in range(400)] + [("rare", "x", 0.9)]
    got = {(x.host, x.path): (x.n, x.shift) for x in quality_classifier.site_posteriors(spark.createDataFrame(data, "host string, path string, p double")).collect()}
    paths, hosts = {}, {}
    for h, p, v in data:
        paths.setdefault((h, p), []).append(v)
        hosts.setdefault(h, []).append(v)
    prior = (sum(v for *_, v in data) + 0.5) / (len(data) + 1)

    def strength(groups):
        k = len(groups)
        within = sum(sum(v) * (1 - sum(v) / len(v)) for v, _ in groups) / max(sum(len(v) for v, _ in groups) - k, 1)
        between = sum(len(v) * (sum(v) / len(v) - m) ** 2 for v, m in groups) / k
        return min(1e4, max(1.0, within / max((between - within) / (sum(len(v) for v, _ in groups) / k), 1e-6)))

    kh = strength([(v, prior) for v in hosts.values()])
    mean = {h: (sum(v) + kh * prior) / (len(v) + kh) for h, v in hosts.items()}
    kp = strength([(v, mean[h]) for (h, _), v in paths.items()])
    for (h, p), v in paths.items():
        m = (sum(v) + kp * mean[h]) / (len(v) + kp)
        assert got[h, p] == (len(v), pytest.approx(np.log(m / (1 - m)) - np.log(prior / (1 - prior)), abs=1e-9))


def test_hashed_features_equal_a_plain_computation():
    import pyarrow as pa
    import xxhash

    texts = ["the quick  brown\tfox the", None, "", " \n ", "é日 x" * 50, "a"]
    bags = quality_classifier.Bags(pa.array(texts))
    x = bags.vectors()
    for row, t in zip(x, texts, strict=True):
        want = np.zeros(quality_classifier.WORDS + quality_classifier.TRIGRAMS)
        words = (t or "").encode().split()
        for w in words:
            want[xxhash.xxh3_64_intdigest(w) % quality_classifier.WORDS] += 1 / len(words)
            v = b" " + w + b" "
            for i in range(len(w)):
                key = int.from_bytes(v[i : i + 3], "little") * 0x9E3779B97F4A7C15 & (1 << 64) - 1
                want[quality_classifier.WORDS + (key >> 40) % quality_classifier.TRIGRAMS] += 1 / sum(map(len, words))
        assert row == pytest.approx(want, abs=1e-6)
    weights = np.random.default_rng(2).normal(size=x.shape[1])
    assert bags.scores(weights) == pytest.approx(x @ weights, abs=1e-6)


def test_whole_verdict_equals_a_plain_computation(spark, small):
    docs, labels = queries.documents(spark, small), spark.read.parquet(f"{small}/labels.parquet")
    got = {r.doc_id: r for r in quality_classifier.classify(docs, labels).collect()}
    model = quality_classifier.fit(docs, labels)
    import pyarrow as pa

    rows = quality_classifier.features(docs).select("doc_id", "text", "source", "lang", *quality_classifier.FEATURES).collect()
    own = model.own(pa.array([r.text for r in rows]), np.array([r[4:] for r in rows], float))
    sites, hosts = {}, {}
    for r, o in zip(rows, own, strict=True):
        p = 1 / (1 + np.exp(-o))
        sites.setdefault((r.source, r.lang), []).append(p)
        hosts.setdefault(r.source, []).append(p)
    prior = (sum(map(sum, hosts.values())) + 0.5) / (len(rows) + 1)

    def strength(groups):
        n = sum(len(v) for v, _ in groups)
        within = sum(sum(v) * (1 - sum(v) / len(v)) for v, _ in groups) / max(n - len(groups), 1)
        between = sum(len(v) * (sum(v) / len(v) - m) ** 2 for v, m in groups) / len(groups)
        return min(1e4, max(1.0, within / max((between - within) / (n / len(groups)), 1e-6)))

    kh = strength([(v, prior) for v in hosts.values()])
    kp = strength([(v, (sum(hosts[h]) + kh * prior) / (len(hosts[h]) + kh)) for (h, _), v in sites.items()])
    for r, o in zip(rows, own, strict=True):
        p = 1 / (1 + np.exp(-o))
        h, v = hosts[r.source], sites[r.source, r.lang]
        mean = (sum(h) - p + kh * prior) / (len(h) - 1 + kh)
        m = (sum(v) - p + kp * mean) / (len(v) - 1 + kp)
        shift = min(2.0, max(-2.0, np.log(m / (1 - m)) - np.log(prior / (1 - prior))))
        x = got[r.doc_id]
        assert (x.own, x.shift) == (pytest.approx(o, abs=1e-9), pytest.approx(shift, abs=1e-7))
        assert x.score == pytest.approx(1 / (1 + np.exp(-(o + shift))), abs=1e-7) and x.kept == (x.score >= 0.5)


def test_a_lone_document_says_nothing_about_itself(spark):
    docs = spark.createDataFrame([(i, f"words number {i} here", f"host{i}", "en") for i in range(5)], "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")
    assert all(abs(r["shift"]) < 1e-9 for r in quality_classifier.classify(docs, labels).collect())


def test_repeated_ids_count_once_in_the_fit(spark, monkeypatch):
    docs = spark.createDataFrame([(0, "good words"), (1, "#!# bad")] + [(1, f"#!# bad {i}") for i in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality_classifier.fit(docs, labels, most=4).bins.shape == (512,)


def test_classifier_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (16, 0, 0), (16, 0, 0), (None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    assert quality_classifier.classify(odd, labels).count() == odd.count()
    assert quality_classifier.classify(odd, labels.filter("false")).filter("kept IS NULL").count() == 0
    assert quality_classifier.classify(none, labels).count() == 0


# ---- n-gram join


def brute_components(docs, size=5, percent=80):
    def grams(text):
        w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in WORD.findall(text or "")]
        return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()

    sets = [grams(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and docs[i][0] is not None and docs[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return Counter((d, len(s), least.get(find(i)) if d is not None else None) for i, ((d, _), s) in enumerate(zip(docs, sets)))


def result(df, **k):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_components(df, **k).collect())


def test_components_equal_brute_force(spark, odd, none):
    assert result(odd) == brute_components(rows(odd))
    assert not result(none)


def near_copies(spark, seed, n=160):
    r = np.random.default_rng(seed)
    base = [[f"w{x}" for x in r.integers(0, 400, int(r.integers(1, 90)))] for _ in range(12)]
    passage = [f"p{x}" for x in range(40)]
    docs = []
    for i in range(n):
        w = list(base[int(r.integers(0, len(base)))])
        for _ in range(int(r.integers(0, 5))):
            w[int(r.integers(0, len(w)))] = f"e{r.integers(0, 9)}"
        if i % 5 == 0:
            w += passage
        docs.append((i, " ".join(w)))
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("seed,block,percent,size", [(1, 1024, 80, 5), (2, 4, 80, 5), (3, 2, 60, 3), (4, 1024, 95, 2), (5, 3, 80, 1)])
def test_near_copies_equal_brute_force(spark, monkeypatch, seed, block, percent, size):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "COMMON", 2)
    df = near_copies(spark, seed)
    assert result(df, percent=percent, size=size) == brute_components(rows(df), size, percent)


def brute_links(docs, size=5, percent=80):
    sets = []
    for d, t in docs:
        w = [x.lower() for x in WORD.findall(t or "")]
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w and d is not None else set())
    return Counter((d, sum(1 for j, b in enumerate(sets) if i != j and a & b and 100 * len(a & b) >= percent * len(a | b))) for i, ((d, _), a) in enumerate(zip(docs, sets)))


@pytest.mark.parametrize("block", [1024, 4])
def test_links_equal_brute_force(spark, odd, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    for df in (odd, near_copies(spark, 6)):
        got = ngram_join.ngram_components(df).collect()
        assert Counter((r.doc_id, r.n_links) for r in got) == brute_links(rows(df))


@pytest.mark.parametrize("least,entries", [(1, 64), (40, 1000), (10**6, 500)])
def test_hot_columns_and_small_blocks_change_nothing(spark, monkeypatch, least, entries):
    """One passage in all rows, one large open group, some near copies; hot columns from few rows on, and several blocks."""
    monkeypatch.setattr(ngram_join, "HOT_LEAST", least)
    monkeypatch.setattr(ngram_join, "HOT", 40)
    monkeypatch.setattr(ngram_join, "BLOCK_TEXT", 5000)
    monkeypatch.setattr(ngram_join, "BLOCK_ENTRIES", entries)
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    passage = " ".join(f"p{i}" for i in range(6))
    r = np.random.default_rng(11)
    texts = []
    for i in range(120):
        w = [f"w{x}" for x in range(60)]
        for _ in range(int(r.integers(0, 4))):
            w[int(r.integers(0, 60))] = f"e{i}"
        texts.append(" ".join(w if i % 3 else [f"u{i}-{x}" for x in range(30)]) + " " + passage)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(near_copies(spark, 7, 60).selectExpr("doc_id + 1000 AS doc_id", "text")).repartition(6)
    got = ngram_join.ngram_components(df).collect()
    assert Counter((x.doc_id, x.n_shingles, x.component_id) for x in got) == brute_components(rows(df))
    assert Counter((x.doc_id, x.n_links) for x in got) == brute_links(rows(df))


@pytest.mark.parametrize("keys", [0, 5, 3000])
def test_bitmaps_lose_no_row(spark, keys):
    rows = spark.range(10_000)
    some = rows.filter(f"id < {keys}")
    bits = bitmaps.bits_for(keys)
    got = bitmaps.may_have(rows, "id", bitmaps.bitmaps(some, "id", bits), bits)
    assert got.columns == ["id"] and got.join(some, "id").count() == keys and keys <= got.count() <= keys + 1200


@pytest.mark.parametrize("common,wide", [(16, 4096), (16, 3), (1, 4096), (2, 5)])
def test_product_of_a_block(monkeypatch, common, wide):
    monkeypatch.setattr(ngram_join, "COMMON", common)
    monkeypatch.setattr(ngram_join, "WIDE", wide)
    r = np.random.default_rng(9)
    for m in (1, 2, 60):
        sets = [np.unique(r.integers(0, 40, int(r.integers(1, 30)))).astype(np.uint64) for _ in range(m)]
        weight, side = r.integers(1, 5, m), r.integers(0, 2, m) > 0
        for s in (None, side):
            linked = [[i != j and (s is None or s[i] != s[j]) and 10 * len(set(a) & set(b)) >= 5 * len(set(a) | set(b)) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
            root, links = ngram_join.multiply(sets, 50, weight, s)
            assert links.tolist() == [sum(int(w) for w, x in zip(weight, row) if x) for row in linked]
            low = list(range(m))
            for _ in range(m):
                low = [min([low[i], *(low[j] for j in range(m) if linked[i][j])]) for i in range(m)]
            assert root.tolist() == low


def test_a_chain_is_no_full_group(spark):
    w = [f"w{i}" for i in range(120)]
    chain = spark.createDataFrame([(i, " ".join(w[10 * i : 10 * i + 100])) for i in range(3)], "doc_id long, text string")
    got = {r.doc_id: (r.component_id, r.n_links) for r in ngram_join.ngram_components(chain).collect()}
    assert got == {0: (0, 1), 1: (0, 2), 2: (0, 1)}


def test_limits_of_the_threshold():
    for n in range(1, 60):
        for m in range(n, 60):
            for o in range(n + 1):
                if 100 * o >= 80 * (n + m - o):
                    assert ngram_join.linked(o, n, m, 80) and o >= ngram_join.least_overlap(n, 80) and o >= ngram_join.least_overlap(m, 80)
                else:
                    assert not ngram_join.linked(o, n, m, 80)


def test_components_of_links(spark):
    r = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in r.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {x.id: x.label for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    loops = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    assert got == {i: find(i) for i in list(root) if i not in loops}


def test_the_model_is_the_same_however_rows_are_dealt(spark, small):
    """Labelled doc_ids repeat with other texts; of each, one row counts, whatever the partitions."""
    docs = queries.documents(spark, small).select("doc_id", "text")
    again = docs.selectExpr("doc_id", "concat(reverse(text), ' other words') AS text")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    models = [quality_classifier.fit(docs.unionByName(again).repartition(n), labels) for n in (3, 7)]
    assert all(np.array_equal(a, b) for a, b in zip(*(vars(m).values() for m in models), strict=True))


def test_copies_are_sampled_in_proportion(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'one text that stands in a third of all rows' ELSE concat('text ', id) END AS text")
    seen = [quality_rules.order_rules(docs, sample=300, seed=s) for s in range(2)]
    assert all(len(o) == len(quality_rules.BASE + quality_rules.RULES) for o in seen)
    assert quality_rules.order_rules(docs.select("text"), sample=300)
