import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import substring_dedup

WORD = re.compile("[^\x20\x09-\x0d]+")
W = substring_dedup.WIDTH


def brute(rows):
    docs = [(d, WORD.findall(t or "")) for d, t in rows]
    low = {}
    for d, w in docs:
        if d is not None:
            for i in range(len(w) - W + 1):
                g = tuple(w[i : i + W])
                low[g] = min(low.get(g, d), d)
    out = Counter()
    for d, w in docs:
        gone = {i + k for i in range(len(w) - W + 1) if d is not None and low[tuple(w[i : i + W])] < d for k in range(W)}
        out[d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    return out


def check(docs, **more):
    got = substring_dedup.dedup(docs, **more).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    for r in got:
        assert r.n_removed == sum(b - a for a, b in r.removed) and all(x[1] < y[0] for x, y in zip(r.removed, r.removed[1:], strict=False))
    return got


@pytest.fixture(scope="module")
def passages(spark):
    """Copies, passages shared by many documents beside other passages, parts of copies, passages that repeat inside a document."""
    draw = np.random.default_rng(5)
    words = lambda n, k: " ".join(f"w{x}" for x in draw.integers(0, k, n))
    shared = [words(n, 10_000) for n in (13, 14, 60, 200)]
    rows = []
    for i in range(240):
        parts = [words(int(draw.integers(0, 40)), 10_000), shared[i % 4], words(int(draw.integers(0, 3)), 10_000), shared[(i // 4) % 4]]
        rows.append((1000 - i if i % 2 else i, "  \n".join(parts[: 2 + i % 3])))
    base = words(300, 10_000)
    rows += [(2000 + i, base if i % 3 else base.replace(" w1", " v1", 1 + i)) for i in range(60)]
    rows += [(3000, "ab " * 500), (3001, "ab " * 40), (3002, f"{base} {base}"), (3003, "x" * 3_000_000 + " " + base), (3003, base), (None, base), (-5, base[len(base) // 2 :])]
    return spark.createDataFrame([(d, t, "key", 1, "x") for d, t in rows], "doc_id long, text string, key string, start int, words string").repartition(6).cache()


@pytest.mark.parametrize(("chunk", "buckets"), [(1 << 18, 1024), (200, 1024), (50, 1)])
def test_passages_of_earlier_documents_go(passages, chunk, buckets):
    """With one bucket a window the sketch overestimates many counts; the rows stay the same."""
    got = check(passages, chunk_windows=chunk, buckets_a_window=buckets)
    assert 0 < sum(r.n_removed for r in got) < sum(r.n_words for r in got)


def test_odd_rows(odd, none):
    check(odd)
    assert substring_dedup.dedup(none).count() == 0


def test_all_windows_in_few_buckets(odd, monkeypatch):
    """All documents' hashes collide: every window is estimated repeated, and only the words decide."""
    real = substring_dedup.windows_of
    monkeypatch.setattr(substring_dedup, "windows_of", lambda body: (*real(body)[:4], np.zeros_like(real(body)[4])))
    assert substring_dedup.windows_of(b"a " * 20)[4].any() == 0
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    packed = list(_local(rows))
    assert packed == sorted(brute(rows).elements(), key=repr)


def _local(rows):
    """The sketch's steps by hand on one chunk, without Spark workers, which wouldn't see the patch."""
    import pyarrow as pa
    import zstandard

    bodies = [b" ".join((t or "").encode().split()) for _, t in rows]
    zip_ = zstandard.ZstdCompressor()
    body = zip_.compress(b"\n".join(bodies))
    sketch = pa.Table.from_batches(list(substring_dedup._sketch(20, 4)([pa.RecordBatch.from_pydict({"chunk": [0], "body": pa.array([body], pa.binary())})])))
    merged = pa.concat_tables([substring_dedup._merge(sketch.filter(pa.compute.equal(sketch["range"], r))) for r in set(sketch["range"].to_pylist())])
    packed = pa.table({"chunk": [0], "doc_ids": [[d for d, _ in rows]], "body": pa.array([body], pa.binary())})
    marked = substring_dedup._mark(20)(packed, merged).to_pylist()
    out = []
    for m in marked:
        words = m["words"].split()
        assert m["n_words"] == len(words) and sum(s["n"] for s in m["segments"]) == max(0, len(words) - W + 1)
    low = {}
    for m in marked:
        w = m["words"].split()
        for s in m["segments"]:
            for i in range(s["start"], s["start"] + s["n"]):
                if m["doc_id"] is not None:
                    low[tuple(w[i : i + W])] = min(low.get(tuple(w[i : i + W]), m["doc_id"]), m["doc_id"])
    for m in marked:
        w = m["words"].split()
        gone = {i + k for s in m["segments"] for i in range(s["start"], s["start"] + s["n"]) if m["doc_id"] is not None and low[tuple(w[i : i + W])] < m["doc_id"] for k in range(W)}
        out.append((m["doc_id"], len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=repr)


def test_windows_hash_alike_wherever_they_stand():
    text = " ".join(f"word{i}" for i in range(40))
    a, b = substring_dedup.windows_of(text.encode())[4], substring_dedup.windows_of(("é" * 700_000 + " x\n" + text + "\nlast").encode())[4]
    assert len(a) == 28 and np.array_equal(a, b) and len(set(a.tolist())) == 28


def test_counts_are_never_below_the_truth(passages):
    rows = [r.text for r in passages.select("text").collect()]
    true = Counter(tuple(w[i : i + W]) for w in map(WORD.findall, rows) for i in range(len(w) - W + 1))
    assert max(true.values()) > 200
    import pyarrow as pa
    import zstandard

    parts, batches = [rows[a : a + 50] for a in range(0, len(rows), 50)], []
    for k, part in enumerate(parts):
        body = zstandard.ZstdCompressor().compress(b"\n".join(b" ".join(t.encode().split()) for t in part))
        batches += substring_dedup._sketch(40, 3)([pa.RecordBatch.from_pydict({"chunk": [k], "body": pa.array([body], pa.binary())})])
    sketch = pa.Table.from_batches(batches)
    merged = pa.concat_tables([substring_dedup._merge(sketch.filter(pa.compute.equal(sketch["range"], r))) for r in set(sketch["range"].to_pylist())])
    for k, part in enumerate(parts):
        body = b"\n".join(b" ".join(t.encode().split()) for t in part)
        hashes = substring_dedup.windows_of(body)[4]
        mine = sorted((r, c) for r, x, c in zip(*(merged[n].to_pylist() for n in ("range", "chunk", "counts")), strict=True) if x == k)
        sums = np.concatenate([substring_dedup._from_planes(substring_dedup._unzipped(c), "<u4") for _, c in mine])
        got = sums[np.unique(hashes >> np.uint64(24), return_inverse=True)[1]]
        want = [true[tuple(w[i : i + W])] for w in (t.split() for t in part) for i in range(len(w) - W + 1)]
        assert len(got) == len(want) and all(a >= b for a, b in zip(got.tolist(), want, strict=True))
