"""Token-ID output: per-document Zstandard frames under one shared dictionary.

A store is a folder with `dictionary` (a Zstandard dictionary trained on
serialized id arrays) and files part-NNNNNN.tok in ascending doc_id order:

    magic b"TMTOK01\\n", width byte (2 or 4), 16 bytes BLAKE2b of the dictionary
    one Zstandard frame for each document: its ids, little-endian, `width` bytes each
    index frame: n valid flags (u1), n doc ids (i8), n frame offsets (u8), n token counts (u8)
    trailer: index offset, number of documents, number of tokens (u8 each), magic

A reader of one document reads trailer, index and one frame. Documents whose
doc_id is null come first; repeated doc_ids stay separate documents, beside
each other, in no fixed order. A null or empty text has only the end id. An
empty table gives a store without parts. Other columns aren't read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import partitions, ship

from . import dictionaries
from .bpe import default_tokenizer
from .encoder import encoder, slices

MAGIC = b"TMTOK01\n"


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _put(path: str, data: bytes) -> None:
    fs, p = _open(path)
    fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(p, compression=None) as f:
        f.write(data)


def _get(path: str) -> bytes:
    fs, p = _open(path)
    with fs.open_input_stream(p, compression=None) as f:
        return f.read()


def _hash(dictionary: bytes) -> bytes:
    return hashlib.blake2b(dictionary, digest_size=16).digest()


def train_dictionary(docs: DataFrame, tokenizer: str, width: int, samples: int = 400, sample_ids: int = 4096, size: int = 64 << 10) -> bytes:
    """A dictionary from a bounded sample, drawn by hash in one pass: about `samples` documents, twice as many at most, `sample_ids` ids of each.

    Of a corpus without documents it is empty.
    """
    share = min(1.0, samples / max(1, docs.count()))
    drawn = docs.where(F.abs(F.xxhash64("doc_id", "text") % (1 << 40)) < int(share * (1 << 40))) if share < 1 else docs
    some = drawn.select(F.substring("text", 1, 8 * sample_ids).alias("text")).limit(2 * samples)  # many copies of one row can't swell it
    texts = pa.array(some.agg(F.collect_list("text").alias("texts")).first().texts, pa.string())
    kind = "<u2" if width == 2 else "<u4"
    parts = [np.frombuffer(x, "<u4")[:sample_ids].astype(kind).tobytes() for x in encoder(tokenizer).apply(texts).to_pylist()]
    parts = sorted(p[a : a + 2048] for p in parts for a in range(0, len(p), 2048))
    return dictionaries.train(parts, size)


def _writer(path: str, tokenizer: str, end_id: int | None, width: int, dictionary: bytes, level: int):
    def write(batches) -> Iterator:
        import pyarrow as pa
        import zstandard
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        zip_, plain = zstandard.ZstdCompressor(level=level, dict_data=shared), zstandard.ZstdCompressor(level=level)
        fs, out = _open(path)
        mine = f"{out}/.part-{part:06d}-{uuid.uuid4().hex}"
        final = f"{out}/part-{part:06d}.tok"
        kind, tail = np.dtype("<u2" if width == 2 else "<u4"), np.array([] if end_id is None else [end_id], "<u4").tobytes()
        docs, offsets, counts, at, f = [], [], [], 0, None
        for batch in batches:
            for piece in slices(batch, "text"):
                if f is None:
                    f = fs.open_output_stream(mine, compression=None)
                    f.write(head := MAGIC + bytes([width]) + _hash(dictionary))
                    at = len(head)
                docs += piece.column("doc_id").to_pylist()
                for ids in encoder(tokenizer).apply(piece.column("text")).to_pylist():
                    ids += tail
                    frame = zip_.compress(np.frombuffer(ids, "<u4").astype(kind).tobytes())
                    f.write(frame)
                    offsets.append(at)
                    counts.append(len(ids) // 4)
                    at += len(frame)
        if f is not None:
            with f:
                index = np.array([d is not None for d in docs], "u1").tobytes() + np.array([d or 0 for d in docs], "<i8").tobytes() + np.array(offsets, "<u8").tobytes() + np.array(counts, "<u8").tobytes()
                f.write(plain.compress(index))
                f.write(np.array([at, len(docs), sum(counts)], "<u8").tobytes() + MAGIC)
            fs.move(mine, final)  # a repeated task writes the same file again
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "docs": pa.array([len(docs)], pa.int64()), "tokens": pa.array([sum(counts)], pa.int64())})

    return write


def write_store(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int | None = 0, parts: int | None = None, level: int = 3) -> list[tuple[int, int, int]]:
    """Encodes doc_id and text of docs into a store at path. Returns (part, documents, tokens) of each file, in order.

    One shuffle, by ranges of doc_id; what returns to the driver is one row a file.
    """
    from .bpe import tables

    spark = docs.sparkSession
    ship(spark)
    tokenizer = tokenizer or default_tokenizer()
    width = 2 if max(tables(tokenizer).bytes_of) < 1 << 16 else 4
    docs = docs.select("doc_id", "text")
    dictionary = train_dictionary(docs, tokenizer, width)
    _put(f"{path}/dictionary", dictionary)
    ordered = docs.repartitionByRange(parts or partitions(spark), "doc_id").sortWithinPartitions("doc_id")
    done = ordered.mapInArrow(_writer(path, tokenizer, end_id, width, dictionary, level), "part int, docs long, tokens long").collect()
    return sorted((r.part, r.docs, r.tokens) for r in done)


class Part:
    """One file of a store, open for reading."""

    def __init__(self, path: str, part: int, dictionary: bytes):
        import zstandard

        fs, p = _open(path)
        self.file = fs.open_input_file(f"{p}/part-{part:06d}.tok")
        head = self.file.read(len(MAGIC) + 17)
        if head[: len(MAGIC)] != MAGIC or head[len(MAGIC) + 1 :] != _hash(dictionary):
            raise ValueError(f"part {part} of {path} isn't a token file of this dictionary")
        self.kind = np.dtype("<u2" if head[len(MAGIC)] == 2 else "<u4")
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.unzip = zstandard.ZstdDecompressor(dict_data=shared)
        self.file.seek(self.file.size() - 24 - len(MAGIC))
        trailer = self.file.read(24 + len(MAGIC))
        if trailer[24:] != MAGIC:
            raise ValueError(f"part {part} of {path} has no end")
        self.end, n, self.tokens = (int(x) for x in np.frombuffer(trailer[:24], "<u8"))
        self.file.seek(self.end)
        index = zstandard.ZstdDecompressor().decompress(self.file.read(self.file.size() - 24 - len(MAGIC) - self.end))
        self.valid = np.frombuffer(index[:n], "u1").astype(bool)
        self.docs = np.frombuffer(index[n : 9 * n], "<i8")
        self.offsets = np.append(np.frombuffer(index[9 * n : 17 * n], "<u8"), np.uint64(self.end)).astype(np.int64)
        self.counts = np.frombuffer(index[17 * n :], "<u8").astype(np.int64)

    def ids(self, a: int, b: int) -> list[bytes]:
        """Ids of documents a to b - 1, as unsigned 32-bit integers."""
        self.file.seek(int(self.offsets[a]))
        data = memoryview(self.file.read(int(self.offsets[b] - self.offsets[a])))
        o = self.offsets - self.offsets[a]
        return [np.frombuffer(self.unzip.decompress(data[o[i] : o[i + 1]], max_output_size=int(self.counts[i]) * self.kind.itemsize), self.kind).astype("<u4").tobytes() for i in range(a, b)]


def fetch(path: str, part: int, doc_id: int) -> list[list[int]]:
    """The ids of each document with this doc_id in a part, by its index."""
    p = Part(path, part, _get(f"{path}/dictionary"))
    return [np.frombuffer(p.ids(i, i + 1)[0], "<u4").tolist() for i in np.flatnonzero(p.valid & (p.docs == doc_id)).tolist()]


def _reader(path: str, step: int = 256):
    def read(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part, base in zip(batch.column("part").to_pylist(), batch.column("base").to_pylist(), strict=True):
                p = Part(path, part, _get(f"{path}/dictionary"))
                start = base + np.cumsum(p.counts) - p.counts
                a = 0
                while a < len(p.docs):  # by documents and by tokens, so a batch is bounded
                    b = min(a + step, max(a + 1, int(np.searchsorted(start, start[a] + 2_000_000))), len(p.docs))
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(p.docs[a:b], pa.int64(), mask=~p.valid[a:b]), "start": pa.array(start[a:b], pa.int64()),
                        "n_tokens": pa.array(p.counts[a:b], pa.int64()), "ids": pa.array(p.ids(a, b), pa.binary()),
                    })
                    a = b

    return read


def read_store(spark: SparkSession, path: str, parts: list[tuple[int, int, int]]) -> DataFrame:
    """Every document of a store: doc_id, start (ids of all documents before it), n_tokens, ids (binary, unsigned 32-bit)."""
    ship(spark)
    base, rows = 0, []
    for part, _, tokens in parts:
        rows.append((part, base))
        base += tokens
    files = spark.createDataFrame(rows, "part int, base long")
    if rows:
        files = files.repartitionByRange(len(rows), "part")
    return files.mapInArrow(_reader(path), "doc_id long, start long, n_tokens long, ids binary")
