import re
from collections import Counter

import corpus_pipeline
import pytest

from tidemark.llm import exact_dedup, ngram_join, quality_classifier, quality_rules, queries


def test_stages_take_effect_one_after_the_other(spark, small):
    docs = queries.documents(spark, small)
    labels = spark.read.parquet(f"{small}/labels.parquet")
    columns = docs.columns
    keep = [
        lambda d: quality_classifier.classify(d, labels).filter("kept").select("doc_id"),
        lambda d: quality_rules.judge(d, order=list(quality_rules.RULES)).filter("kept").select("doc_id"),
        lambda d: exact_dedup.exact_groups(d).filter("kept").select("doc_id"),
        lambda d: ngram_join.ngram_components(d).filter("doc_id = component_id").select("doc_id"),
    ]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "quality rules", "exact dedup", "n-gram Jaccard join", "packing"]
    for (_, stage), want in zip(corpus_pipeline.STAGES[:-1], keep, strict=True):
        out = stage(spark, docs, small).cache()
        assert out.columns == columns
        assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(r.doc_id for r in want(docs).collect())
        assert out.join(docs, columns, "left_anti").count() == 0
        assert 0 < out.count() <= docs.count()
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, small)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_stages_take_odd_rows(spark, odd, none, small):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs.select("doc_id", "text", "lang", "source", "n_chars"), small).count() <= 10_000


def squeezed(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def first_of(groups):
    """One row of each group of (doc_id, text): the smallest doc_id, none last."""
    return Counter((d, squeezed(t)) for d, t in (min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups))


def grams(text):
    w = squeezed(text).strip().lower().split(" ") if squeezed(text).strip() else []
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_each_row_goes_by_its_own_verdict(spark, odd, tmp_path):
    clean = "a plain sentence of common words that goes on for a while and then stops near the end of the page"
    more = [(30, clean + " one"), (30, clean + " one"), (30, "#|! " * 90), (None, "#|! " * 90), (31, "#|! " * 90), (32, " ".join(f"v{i}" for i in range(50))), (32, " ".join(f"v{i}" for i in range(51))), (33, " ".join(f"u{i}" for i in range(50)))]
    extra = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in [*more, (33, " ".join(f"t{i}" for i in range(50)))]], "doc_id long, text string, lang string, source string, n_chars long")
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars").unionByName(extra).repartition(3)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (16, 0, 0), (31, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")

    def left(stage):
        return Counter((r.doc_id, squeezed(r.text)) for r in stage(spark, docs, str(tmp_path)).collect())

    scores = quality_classifier.classify(docs, labels).collect()
    kept = Counter(r.doc_id for r in scores if r.kept)
    assert 0 < sum(kept.values()) < len(rows) and any(r.doc_id is None and not r.kept for r in scores)
    out = Counter()
    for (d, _), n in left(corpus_pipeline.classify).items():
        out[d] += n
    assert out == kept

    assert left(corpus_pipeline.rules) == Counter((r.doc_id, squeezed(r.text)) for r in quality_rules.judge(docs, order=list(quality_rules.RULES)).collect() if r.kept)

    same = {}
    for d, t in rows:
        same.setdefault(squeezed(t), []).append((d, t))
    assert left(corpus_pipeline.exact) == first_of(same.values())

    sets = [grams(t) for _, t in rows]
    groups = []
    for i, row in enumerate(rows):
        near = [g for g in groups if row[0] is not None and any(rows[j][0] is not None and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) for j in g)]
        groups = [g for g in groups if g not in near] + [sum(near, [i])]
    got, want = left(corpus_pipeline.near), first_of([rows[j] for j in g] for g in groups)
    assert Counter((d, t if d != 32 else "") for d, t in got.elements()) == Counter((d, t if d != 32 else "") for d, t in want.elements())  # either row of 32 may stay


def left_behind(spark, tmp_path, monkeypatch, query, sf_dir):
    """Names of what lies in the shared folder once a query's rows are read."""
    shared = tmp_path / "shared"
    shared.mkdir()
    monkeypatch.setattr("tidemark.session.shared_dir", lambda s: f"file://{shared}")
    assert query(spark, sf_dir).count() >= 0
    return sorted(p.name for folder in shared.iterdir() for p in folder.iterdir())


def test_the_pipeline_leaves_only_what_its_result_reads(spark, small, tmp_path, monkeypatch):
    assert left_behind(spark, tmp_path, monkeypatch, corpus_pipeline.run, small) == ["n-gram-Jaccard-join"]


LEFT = {
    "op1_token_store": {"tokens"}, "op4_exact_dedup": {"keys", "groups", "clash", "collided"}, "op6_quality_classifier": {"scores", "sites"}, "op7_warc_writer": {"warc"},
    "op11_source_divergence": {"langs", "vectors"}, "op12_substring_dedup": {"marked", "spans"}, "op13_conversation_repair": set(),
}


@pytest.mark.parametrize("name", LEFT)
def test_a_query_leaves_only_what_its_result_reads(spark, small, tmp_path, monkeypatch, name):
    assert set(left_behind(spark, tmp_path, monkeypatch, queries.QUERIES[name], small)) <= LEFT[name]
