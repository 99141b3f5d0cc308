import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, bpe_codec, packing, queries, token_counts, token_store
from tidemark.llm.encoder import encoder


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_tokenizer())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def raw(ids):
    return np.array(ids, "<u4").tobytes()


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def key(x):
    return (x[0] is not None, x[0] or 0, *x[1:])


def test_random_texts_in_chunks_equal_the_library(library):
    import random

    r = random.Random(3)
    parts = ["a", "b", "word", "Z9", ".", ",", "?!", ";:", " ", " ", "\n", "\n", "\t", "\r", "'s", "é", "1", "!", " ", "　", "<|endoftext|>", "日", "\x1c", "\x85"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(4000)] + ["a  ", "a\n\n", "a\n\n\nb", "  ", "\n", " "]
    want = [raw(ids_of(library, t)) for t in texts]
    path = bpe.default_tokenizer()
    texts = pa.array([*texts, None])
    assert encoder(path).apply(texts).to_pylist() == [*want, b""]
    assert bpe_codec.Codec(path).apply(texts).to_pylist() == [*want, b""]
    assert token_counts.Counter(path).apply(texts).to_pylist() == [len(w) // 4 for w in [*want, b""]]


def test_small_caches_change_nothing(library):
    texts = [" ".join(f"w{i * k % 97}" for i in range(60)) for k in range(1, 40)]
    for limit in (0, 300, 2000):
        e = bpe_codec.Codec(bpe.default_tokenizer(), limit)
        for a in range(0, len(texts), 4):
            assert e.apply(pa.array(texts[a : a + 4])).to_pylist() == [raw(ids_of(library, t)) for t in texts[a : a + 4]]
            assert e.keys.nbytes + e.values.nbytes <= limit


def test_store_round_trip(spark, odd, library, tmp_path):
    path = f"file://{tmp_path}/store"
    parts = token_store.write_store(odd, path)
    rows = token_store.read_store(spark, path, parts).collect()
    assert sorted(((r.doc_id, r.ids) for r in rows), key=key) == sorted(((d, raw([*ids_of(library, t), 0])) for d, t in pairs(odd)), key=key)
    rows.sort(key=lambda r: r.start)
    at, last = 0, -1
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids) // 4 and (r.doc_id if r.doc_id is not None else -1) >= last
        at, last = at + r.n_tokens, r.doc_id if r.doc_id is not None else -1
    part = next(p for p, _, _ in parts if token_store.fetch(path, p, 12))
    assert token_store.fetch(path, part, 12) == [[*ids_of(library, "<|endoftext|> a<|endoftext|>"), 0]]
    assert token_store.fetch(path, part, 999) == []


def test_store_of_nothing(spark, none, tmp_path):
    path = f"file://{tmp_path}/store"
    assert token_store.read_store(spark, path, token_store.write_store(none, path)).count() == 0


def test_store_refuses_another_dictionary(spark, odd, tmp_path):
    path = f"file://{tmp_path}/store"
    part = token_store.write_store(odd, path)[0][0]
    with pytest.raises(ValueError, match="dictionary"):
        token_store.Part(path, part, b"another")


def test_op1_on_a_whole_table(spark, small, library):
    docs = sorted(pairs(queries.documents(spark, small)))
    want, at = [], 0
    for d, t in docs:
        ids = [*ids_of(library, t), 0]
        want.append((d, at, len(ids), zlib.crc32(raw(ids))))
        at += len(ids)
    got = [tuple(r) for r in queries.op1_token_store(spark, small).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert sorted(got) == want


def check_packing(rows, docs, most, segments, loss):
    bins, pieces = {}, {}
    for r in rows:
        assert r.length == len(r.ids) // 4 > 0
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length, r.loss_tokens))
        pieces.setdefault(r.doc_id, []).append((r.doc_tokens, r.start, r.ids))
    for b in bins.values():
        b.sort()
        assert [x[0] for x in b] == [sum(y[1] for y in b[:i]) for i in range(len(b))]
        assert sum(x[1] for x in b) <= most and len(b) <= segments and sum(x[2] for x in b) <= loss
    for d, ids in docs.items():
        have = sorted(x[1:] for x in pieces.get(d, []))
        assert b"".join(x[1] for x in have) == ids
        assert all(x[0] == len(ids) // 4 for x in pieces.get(d, []))
    return sum(most - n if n & (n - 1) else 0 for n in (sum(x[1] for x in b) for b in bins.values()))


@pytest.mark.parametrize("most,segments,loss", [(1024, 128, 1024), (256, 3, 256), (512, 8, 100), (64, 1, 64)])
def test_packing_keeps_every_id_within_all_limits(odd, library, most, segments, loss):
    once = odd.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("text").alias("text")).repartition(2)
    docs = {d: raw([*ids_of(library, t), 0]) for d, t in pairs(once)}
    check_packing(packing.pack(once, max_tokens=most, max_segments=segments, max_loss=loss).collect(), docs, most, segments, loss)


def test_packing_pads_little(spark, small, library):
    docs = {d: raw([*ids_of(library, t), 0]) for d, t in pairs(queries.documents(spark, small))}
    rows = packing.pack(queries.documents(spark, small)).collect()
    padding = check_packing(rows, docs, 1024, 32, 1020)
    segments, loss = {}, {}
    for r in rows:
        segments[r.sequence_id] = segments.get(r.sequence_id, 0) + 1
        loss[r.sequence_id] = loss.get(r.sequence_id, 0) + r.loss_tokens
    assert max(loss.values()) == 1020
    assert padding < 0.01 * sum(len(x) // 4 for x in docs.values()) + 1024


def test_packing_of_prompts(spark, library):
    text = " ".join(f"word{i}" for i in range(300))
    df = spark.createDataFrame([(i, text, 50 * i) for i in range(6)], "doc_id long, text string, ask int")
    rows = packing.pack(df, max_tokens=256, max_loss=128, prompt="ask").collect()
    check_packing(rows, {i: raw([*ids_of(library, text), 0]) for i in range(6)}, 256, 128, 128)
    one = [r for r in rows if r.doc_id == 3 and r.start == 0]
    assert one[0].loss_tokens <= max(0, one[0].length - 150)


def test_packing_of_odd_rows(odd, none):
    rows = packing.pack(odd).collect()
    assert sum(r.start == 0 for r in rows) == odd.count() and sum(r.doc_id is None for r in rows) == 2
    assert packing.pack(none).count() == 0


def test_codec_and_counts(odd, none, library):
    docs = pairs(odd)
    got = bpe_codec.encode_decode(odd).collect()
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in got), key=key) == sorted(((d, raw(ids_of(library, t)), library.decode(ids_of(library, t), skip_special_tokens=False)) for d, t in docs), key=key)
    counts = token_counts.count_tokens(odd).collect()
    assert sorted((tuple(r) for r in counts), key=key) == sorted(((d, len((t or "").encode()), len(ids_of(library, t))) for d, t in docs), key=key)
    assert bpe_codec.encode_decode(none).count() == token_counts.count_tokens(none).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_by_other_files_equal_the_library(spark, odd, small, name):
    import random

    import public_tokenizers

    path = public_tokenizers.path(name)
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        other = Tokenizer.from_file(path)
        want = lambda t: len(other.encode(t or "", add_special_tokens=False).ids)
    else:
        from sentencepiece import SentencePieceProcessor

        other = SentencePieceProcessor(model_file=path)
        want = lambda t: len(other.encode(t or ""))
    r = random.Random(5)
    parts = ["a", "b", "Word", "Z9", ".", "?!", " ", " ", " ", "\n", "\t", "'s", "É", "e\u0301", "İ", "ΑΣ", "1", "　", "▁", "<|endoftext|>", "<s>", "<unk>", "<0x41>", "日", "🙂", "\x00", "\u200d"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(4000)] + [" " * k + "x" + " " * k for k in range(20)] + ["", " ", None]
    assert token_counts.counter(path).apply(pa.array(texts)).to_pylist() == [want(t) for t in texts]
    for docs in (odd, queries.documents(spark, small)):
        got = token_counts.count_tokens(docs, path).collect()
        assert sorted((tuple(x) for x in got), key=key) == sorted(((d, len((t or "").encode()), want(t)) for d, t in pairs(docs)), key=key)


def test_decode_of_ids_that_arent_text(library):
    c = bpe_codec.Codec(bpe.default_tokenizer())
    many = [[50256], [220, 50256, 1], [162, 245], [96, 234, 97], [447, 247], [], [10, 50256, 999]]
    want = [library.decode(ids, skip_special_tokens=False) for ids in many]
    assert c.decode(pa.array(map(raw, many), pa.large_binary())).to_pylist() == want
    assert c.decode(pa.array(map(raw, many), pa.large_binary())[5:]).to_pylist() == want[5:]


def test_packing_limits_bind_each(spark):
    long, short = " ".join(f"word{i}" for i in range(2000)), "two words"
    rows = packing.pack(spark.createDataFrame([(i, long if i < 3 else short) for i in range(200)], "doc_id long, text string").coalesce(1)).collect()
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append(r)
    assert max(map(len, bins.values())) == 32
    assert any(sum(r.loss_tokens for r in b) == 1020 and sum(r.length for r in b) < 1024 for b in bins.values())


def test_registered_queries_on_a_whole_table(spark, small, library):
    docs = {d: (t or "", ids_of(library, t)) for d, t in pairs(queries.documents(spark, small))}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    got = {tuple(r) for r in queries.op9_bpe_codec(spark, small).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()}
    assert got == {(d, len(ids), sha(raw(ids)), sha(library.decode(ids, skip_special_tokens=False).encode())) for d, (_, ids) in docs.items()}
    got = {tuple(r) for r in queries.op10_token_counts(spark, small).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()}
    assert got == {(d, len(t.encode()), len(ids), len(ids) > 1024) for d, (t, ids) in docs.items()}
    pieces, bins = {}, {}
    for r in queries.op3_packing(spark, small).collect():
        ids = [*docs[r.doc_id][1], 0]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(raw(ids[r.start : r.start + r.length]))
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d, (_, ids) in docs.items():
        have = sorted(pieces[d])
        assert [a for a, _ in have] == [sum(n for _, n in have[:i]) for i in range(len(have))] and sum(n for _, n in have) == len(ids) + 1
    for b in bins.values():
        b.sort()
        assert [a for a, _ in b] == [sum(n for _, n in b[:i]) for i in range(len(b))] and sum(n for _, n in b) <= 1024
