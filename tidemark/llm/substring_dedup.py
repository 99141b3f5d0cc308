"""Removes passages that an earlier document has too: windows of consecutive words, screened by a count-min sketch, then grouped exactly.

1. Documents are packed into chunks. Each chunk sketches its windows: sorted
   buckets of a hash with their counts, one row of a count-min sketch that is so
   wide that few windows share a bucket, and therefore kept sparse.
2. Sketches are merged by ranges of buckets, in many tasks; each chunk gets
   back the merged count of each of its buckets. That is never less than the
   number of times that the window stands in the corpus, so a window counted
   once is nobody's copy, and none that repeats is lost.
3. Neighbouring windows counted twice or more form segments, which end where the
   counts change much, and at windows that their own hash picks. Segments are
   grouped by their words' SHA-256. If a segment occurs as often as the sketch
   counts its windows at most, these occur nowhere else, and its first document
   settles them all.
4. The windows of each other segment, once for each distinct segment, are
   grouped by their words.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import left_join_by_key
from tidemark.session import materialize, partitions, ship, tidied, tidy

from .bitmaps import bitmaps, bits_for, may_have
from .encoder import slices

#: Words of a window.
WIDTH = 13
#: A chunk ends with the document that reaches one of these: windows, bytes, documents.
CHUNK_WINDOWS, CHUNK_BYTES, CHUNK_ROWS = 1 << 18, 4 << 20, 1 << 18
#: Buckets of the sketch for each window of the corpus, and windows of a range of buckets.
BUCKETS_A_WINDOW, RANGE_WINDOWS = 1024, 2 << 20
#: One window in CUT begins a new segment, by its hash: so an edit in one copy of a passage changes few of its segments.
CUT = 32
PIECE = 1 << 20
PACKED = "chunk long, windows long, doc_ids array<long>, body binary"
SKETCH = "range int, chunk long, counts binary"
MARKED = "uid long, doc_id long, n_words long, words binary, segments array<struct<start: int, n: int, count: long, key: binary>>"
OUT = "doc_id long, n_words long, n_removed long, removed array<struct<start: int, end: int>>, kept string"


def _pack(size: int):
    def run(batches) -> Iterator:
        import pyarrow as pa
        import zstandard
        from pyspark import TaskContext

        zip_ = zstandard.ZstdCompressor(level=1)
        number = TaskContext.get().partitionId() << 20
        ids: list = []
        docs: list[bytes] = []
        windows = held = 0

        def chunk():
            nonlocal number, windows, held
            out = pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([windows], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([zip_.compress(b"\n".join(docs))], pa.binary())],
                names=["chunk", "windows", "doc_ids", "body"],
            )
            ids.clear()
            docs.clear()
            number, windows, held = number + 1, 0, 0
            return out

        for batch in batches:
            for piece in slices(batch, "text"):
                for doc_id, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist(), strict=True):
                    words = (text or "").encode().split()  # of bytes: at \x20 and \x09-\x0D alone
                    ids.append(doc_id)
                    docs.append(b" ".join(words))
                    windows += max(0, len(words) - WIDTH + 1)
                    held += len(docs[-1])
                    if windows >= size or held >= CHUNK_BYTES or len(ids) >= CHUNK_ROWS:
                        yield chunk()
        if ids:
            yield chunk()

    return run


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A value for each byte, powers of an odd base and of its inverse modulo 2**64, and a factor for each word of a window."""
    draw = np.random.default_rng(20240913)
    base = int(draw.integers(1, 2**63)) * 2 + 1
    chain = [np.cumprod(np.full(PIECE, b, np.uint64)) for b in (base, pow(base, -1, 2**64))]
    one = np.ones(1, np.uint64)
    return draw.integers(1, 2**63, 256, np.uint64), np.concatenate([one, chain[0]]), np.concatenate([one, chain[1]]), draw.integers(1, 2**63, WIDTH, np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each word of documents parted by line feeds, whose words are parted by spaces."""
    a = np.frombuffer(body, np.uint8)
    at = np.flatnonzero((a == 32) | (a == 10))
    starts, ends = np.concatenate([[0], at + 1]), np.concatenate([at, [len(a)]])
    doc = np.concatenate([[0], np.cumsum(a[at] == 10)])
    real = ends > starts
    return starts[real], ends[real], doc[real]


def word_hashes(body: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial of each word's bytes, by prefix sums over pieces of the body."""
    value, power, inverse, _ = _powers()
    a = np.frombuffer(body, np.uint8)
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, "right")))
        low, high = int(starts[i]), int(ends[j - 1])
        if high - low <= PIECE:
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value[a[low:high]] * power[: high - low])])
            out[i:j] = (sums[ends[i:j] - low] - sums[starts[i:j] - low]) * inverse[starts[i:j] - low]
        else:  # one very long word
            out[i] = int.from_bytes(hashlib.blake2b(body[low:high], digest_size=8).digest(), "little")
        i = j
    return out


def windows_of(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and documents of words; index of the first word of each window; a 64-bit hash of each window."""
    starts, ends, doc = words_of(body)
    n = len(starts) - WIDTH + 1
    if n <= 0:
        return starts, ends, doc, np.empty(0, np.int64), np.empty(0, np.uint64)
    h = word_hashes(body, starts, ends)
    total = np.zeros(n, np.uint64)
    for k, factor in enumerate(_powers()[3]):
        total += factor * h[k : k + n]
    total ^= total >> np.uint64(32)
    total *= np.uint64(0xD6E8FEB86659FD93)
    total ^= total >> np.uint64(32)
    total *= np.uint64(0xD6E8FEB86659FD93)
    whole = np.flatnonzero(doc[:n] == doc[WIDTH - 1 :])
    return starts, ends, doc, whole, total[whole]


def _planes(x: np.ndarray) -> bytes:
    """All lowest bytes, then all second ones and so on: small numbers compress well so."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _from_planes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _unzipped(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def _sketch(bits: int, ranges: int):
    span = -(-(1 << bits) // ranges)

    def run(batches) -> Iterator:
        import pyarrow as pa
        import zstandard

        zip_ = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for chunk, body in zip(batch.column("chunk").to_pylist(), batch.column("body"), strict=True):
                hashes = windows_of(_unzipped(body.as_py()))[4]
                buckets, counts = np.unique(hashes >> np.uint64(64 - bits), return_counts=True)
                edges = np.searchsorted(buckets, np.arange(ranges + 1, dtype=np.uint64) * np.uint64(span))
                full = np.flatnonzero(np.diff(edges))
                out = []
                for r in full.tolist():
                    b, c = buckets[edges[r] : edges[r + 1]], counts[edges[r] : edges[r + 1]]
                    steps = np.diff(b, prepend=np.uint64(r * span))
                    out.append(zip_.compress(struct.pack("<I", len(b)) + _planes(steps) + _planes(c.astype("<u4"))))
                yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(np.full(len(full), chunk)), pa.array(out, pa.binary())], names=["range", "chunk", "counts"])

    return run


def _merge(table):
    """Sums the sketches of a range; each chunk gets the sum of each of its buckets, in order."""
    import pyarrow as pa
    import zstandard

    zip_ = zstandard.ZstdCompressor(level=1)
    steps, counts, ends = [], [], [0]
    for data in table.column("counts"):
        raw = _unzipped(data.as_py())
        (n,) = struct.unpack_from("<I", raw)
        steps.append(np.cumsum(_from_planes(raw[4 : 4 + 8 * n], "<u8")))
        counts.append(_from_planes(raw[4 + 8 * n :], "<u4"))
        ends.append(ends[-1] + n)
    _, inverse = np.unique(np.concatenate(steps), return_inverse=True)
    sums = np.minimum(np.bincount(inverse, np.concatenate(counts)), 2**32 - 1).astype("<u4")[inverse]
    out = [zip_.compress(_planes(sums[a:b])) for a, b in zip(ends, ends[1:], strict=False)]
    return pa.table({"range": table.column("range"), "chunk": table.column("chunk"), "counts": pa.array(out, pa.binary())})


def _mark(bits: int):
    def run(packed, answers):
        import pyarrow as pa

        rows: dict[str, list] = {c.split()[0]: [] for c in MARKED.split(", ")[:4]} | {"segments": []}
        if packed.num_rows:
            chunk, ids, body = packed.column("chunk")[0].as_py(), packed.column("doc_ids")[0].as_py(), _unzipped(packed.column("body")[0].as_py())
            starts, ends, doc, first, hashes = windows_of(body)
            by_range = sorted(zip(answers.column("range").to_pylist(), answers.column("counts").to_pylist(), strict=True))
            sums = np.concatenate([_from_planes(_unzipped(c), "<u4") for _, c in by_range]) if by_range else np.empty(0, np.uint32)
            count = sums[np.unique(hashes >> np.uint64(64 - bits), return_inverse=True)[1]] if len(hashes) else sums
            again = np.flatnonzero(count > 1)
            at, count = first[again], count[again]
            size = np.frexp(count.astype(np.float64))[1]  # counts up to the next power of two go together
            cut = (hashes[again][1:] >> np.uint64(20)) % np.uint64(CUT) == 0
            head = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (np.diff(size) != 0) | cut])) if len(at) else at
            lengths = np.diff(np.concatenate([head, [len(at)]]))
            most = np.maximum.reduceat(count, head) if len(at) else count
            base = np.searchsorted(doc, np.arange(len(ids) + 1))  # first word of each document
            segments: list[list] = [[] for _ in ids]
            for a, n, c in zip(at[head].tolist(), lengths.tolist(), most.tolist(), strict=True):
                key = hashlib.sha256(body[starts[a] : ends[a + n + WIDTH - 2]]).digest()
                segments[doc[a]].append({"start": int(a - base[doc[a]]), "n": n, "count": c, "key": key})
            rows = {"uid": [chunk << 19 | k for k in range(len(ids))], "doc_id": ids, "n_words": np.diff(base).tolist(), "words": body.split(b"\n"), "segments": segments}
        segment = pa.struct([("start", pa.int32()), ("n", pa.int32()), ("count", pa.int64()), ("key", pa.binary())])
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(segment))
        return pa.table([pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True)], names=list(rows))

    return run


def _open_windows(batches) -> Iterator:
    """(key, at, first, window) of each window of the segments listed with a document."""
    import pyarrow as pa

    names = ["key", "at", "first", "window"]
    kinds = (pa.binary(), pa.int32(), pa.int64(), pa.binary())
    for batch in batches:
        for data, listed in zip(batch.column("words"), batch.column("listed").to_pylist(), strict=True):
            words = data.as_py().split(b" ")
            rows: list[tuple] = []
            for s in listed:
                for i in range(s["start"], s["start"] + s["n"]):
                    rows.append((s["key"], i - s["start"], s["first"], b" ".join(words[i : i + WIDTH])))
                    if len(rows) == 20_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _finish(batches) -> Iterator:
    import pyarrow as pa

    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        for piece in slices(batch, "words"):
            kept, removed, gone = [], [], []
            for data, spans in zip(piece.column("words").to_pylist(), piece.column("spans").to_pylist(), strict=True):
                if not spans:
                    kept.append(data)
                    removed.append([])
                    gone.append(0)
                    continue
                words = data.split(b" ")
                step = np.zeros(len(words) + 1, np.int64)
                np.add.at(step, [s["start"] for s in spans], 1)
                np.add.at(step, [s["end"] for s in spans], -1)
                cover = np.cumsum(step[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[False], cover, [False]])))
                kept.append(b" ".join([words[i] for i in np.flatnonzero(~cover).tolist()]))
                removed.append([{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()])
                gone.append(int(cover.sum()))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("n_words"), pa.array(gone, pa.int64()), pa.array(removed, span), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "removed", "kept"])


def _covered(marked: DataFrame, groups: DataFrame) -> DataFrame:
    """(key, covered) of the segments that occur less often than their windows are counted: places of windows that an earlier document has in another segment or elsewhere in this one."""
    listed = materialize(groups.filter("n_rows < count AND first IS NOT NULL").select("key", "first", F.col("at.uid").alias("uid"), F.col("at.start").alias("start"), "n"), "listed")
    bits = bits_for(listed.count())
    texts = may_have(marked.select("uid", "words"), "uid", bitmaps(listed, "uid", bits), bits)
    by_doc = listed.groupBy("uid").agg(F.collect_list(F.struct("key", "start", "n", "first")).alias("listed"))
    windows = materialize(texts.join(by_doc, "uid").select("words", "listed").mapInArrow(_open_windows, "key binary, at int, first long, window binary"), "windows")
    low = windows.groupBy("window").agg(F.min("first").alias("low"), F.max("first").alias("high"), F.count(F.lit(1)).alias("rows")).filter("low < high").select("window", "low", "rows")
    met = left_join_by_key(windows, materialize(low, "lows"), ["window"], "rows", windows.count())
    return materialize(met.filter("low < first").groupBy("key").agg(F.collect_list("at").alias("covered")), "covered")


@tidied("marked", "spans")
def dedup(docs: DataFrame, chunk_windows: int = CHUNK_WINDOWS, buckets_a_window: int = BUCKETS_A_WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, removed (spans of words), kept (the words left, parted by one space) of every row of docs (doc_id, text).

    A word that a window of WIDTH words covers is removed if that window's
    words also start in a row with a smaller doc_id; all windows are judged on
    the input. Rows with one doc_id don't count against each other, nor does
    what repeats inside a row. A row without doc_id keeps its words and takes
    none from others. Null and empty texts have no word; rows of fewer than
    WIDTH words keep them all. An empty table gives an empty result; other
    columns aren't read. Segments with equal SHA-256 count as equal; windows
    are compared by their words.

    Shuffled: some bytes for each distinct window of a chunk, the packed texts
    once, short rows of segments, windows of segments that aren't settled, and
    the texts of documents with a segment.
    """
    spark = docs.sparkSession
    ship(spark)
    with tidy(spark, "marked"):
        packed = materialize(docs.select("doc_id", "text").mapInArrow(_pack(chunk_windows), PACKED), "packed")
        total = packed.agg(F.sum("windows")).first()[0] or 0
        bits = min(63, max(10, (buckets_a_window * max(1, total) - 1).bit_length()))
        ranges = max(4 * partitions(spark), -(-total // RANGE_WINDOWS))
        sketches = packed.filter("windows > 0").select("chunk", "body").mapInArrow(_sketch(bits, ranges), SKETCH)
        answers = sketches.groupBy("range").applyInArrow(_merge, SKETCH)
        marked = materialize(packed.select("chunk", "doc_ids", "body").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_mark(bits), MARKED), "marked")

    occurrences = marked.select("uid", "doc_id", F.inline("segments"))
    at = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "uid", "start"))).alias("at")
    groups = materialize(occurrences.groupBy("key").agg(F.count(F.lit(1)).alias("n_rows"), F.max("n").alias("n"), F.max("count").alias("count"), F.min("doc_id").alias("first"), at), "groups")
    covered = _covered(marked, groups)
    verdicts = materialize(groups.join(covered, "key", "left").filter("n_rows > 1 OR covered IS NOT NULL").select("key", "first", "n_rows", "covered"), "verdicts")
    met = left_join_by_key(occurrences, verdicts, ["key"], "n_rows", occurrences.count())
    whole = F.array(F.struct(F.col("start"), (F.col("start") + F.col("n") + WIDTH - 1).alias("end")))
    some = F.transform("covered", lambda i: F.struct((F.col("start") + i).alias("start"), (F.col("start") + i + WIDTH).alias("end")))
    spans = met.select("uid", F.when(F.col("doc_id") > F.col("first"), whole).when((F.col("doc_id") == F.col("first")) & F.col("covered").isNotNull(), some).alias("spans")).filter("spans IS NOT NULL")
    spans = materialize(spans.groupBy("uid").agg(F.flatten(F.collect_list("spans")).alias("spans")), "spans")

    rows = marked.select("uid", "doc_id", "n_words", "words", F.size("segments").alias("held"))
    none = rows.filter("held = 0").withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType))
    out = rows.filter("held > 0").join(spans, "uid", "left").unionByName(none)
    return out.select("doc_id", "n_words", "words", "spans").mapInArrow(_finish, OUT)
