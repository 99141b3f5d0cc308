"""Byte-level BPE in numpy: merge rounds over many words in one flat array."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.session import ship

from . import bpe
from .encoder import CACHE_BYTES, ByChunk, slices

NONE = np.int64(1 << 40)


def lookup(t: bpe.Tables, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The rank of each pair, by binary search over the sorted pair keys; NONE where there is no merge."""
    keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
    at = np.minimum(np.searchsorted(t.keys, keys), len(t.keys) - 1)
    return np.where(t.keys[at] == keys, t.rank[at], NONE)


def merge_rounds(t: bpe.Tables, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words one after the other, end of each word). In each round every unfinished word merges all places of its lowest-rank pair, from the left."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    sym = t.byte_id[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), lengths)
    done_sym, done_word = [], []
    rank = np.full(len(sym), NONE)  # of the pair that begins here
    inner = np.flatnonzero(word[:-1] == word[1:])
    if len(inner) and len(t.keys):
        rank[inner] = lookup(t, sym[inner], sym[inner + 1])
    while len(sym):
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        low = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(sym))))
        open_ = low < NONE
        if not open_.all():
            done_sym.append(sym[~open_])
            done_word.append(word[~open_])
            sym, word, rank, low = sym[open_], word[open_], rank[open_], low[open_]
            if not len(sym):
                break
        at = np.flatnonzero(rank == low)
        # places that overlap (one symbol repeated): every second one of a run
        starts = np.append(True, np.diff(at) != 1)
        run = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - run) % 2 == 0]
        sym[at] = t.by_rank[rank[at]]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        new = np.cumsum(keep) - 1
        sym, word, rank = sym[keep], word[keep], rank[keep]
        changed = np.unique(np.concatenate([new[at], new[at] - 1]))
        changed = changed[changed >= 0]
        rank[changed] = NONE
        inner = changed[changed + 1 < len(sym)]
        inner = inner[word[inner] == word[inner + 1]]
        if len(inner):
            rank[inner] = lookup(t, sym[inner], sym[inner + 1])
    sym = np.concatenate(done_sym) if done_sym else np.zeros(0, np.uint32)
    word = np.concatenate(done_word) if done_word else np.zeros(0, np.int64)
    order = np.argsort(word, kind="stable")
    return sym[order], np.cumsum(np.bincount(word, minlength=len(words)))


class Codec(ByChunk):
    """encode: ids as little-endian unsigned 32-bit integers; decode: their text."""

    def __init__(self, path: str, limit: int = CACHE_BYTES):
        super().__init__(path, limit)
        self.tables = bpe.tables(path)
        self.pieces = bpe.splitter()
        self.token_bytes = pa.array([self.tables.bytes_of.get(i) for i in range(max(self.tables.bytes_of) + 1)], pa.large_binary())

    def run(self, texts: list[str]) -> list[bytes]:
        cut: list[list[bytes | int]] = []
        for text in texts:
            parts: list[bytes | int] = []
            at = 0
            for m in self.special.finditer(text) if self.special else ():
                parts += [x.encode() for x in self.pieces.findall(text[at : m.start()])]
                parts.append(self.tables.special[m[0]])
                at = m.end()
            cut.append(parts + [x.encode() for x in self.pieces.findall(text[at:] if at else text)])
        words = list({x for parts in cut for x in parts if isinstance(x, bytes)})
        known: dict = {}
        a = 0
        while a < len(words):  # a bounded number of symbols at once
            b, n = a, 0
            while b < len(words) and (b == a or n + len(words[b]) <= 2_000_000):
                n += len(words[b])
                b += 1
            ids, ends = merge_rounds(self.tables, words[a:b])
            flat = ids.astype("<u4").tobytes()
            p = 0
            for w, e in zip(words[a:b], (4 * ends).tolist(), strict=True):
                known[w] = flat[p:e]
                p = e
            a = b
        return [b"".join(known[x] if isinstance(x, bytes) else np.array([x], "<u4").tobytes() for x in parts) for parts in cut]

    def decode(self, ids: pa.Array) -> pa.Array:
        """The text of each array of ids: every id's bytes, special tokens included; bytes that aren't UTF-8 become U+FFFD."""
        ends = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset : ids.offset + len(ids) + 1]
        flat = np.frombuffer(ids.buffers()[2] or b"", "<u4")[ends[0] // 4 : ends[-1] // 4]
        texts = self.gather(self.token_bytes.take(pa.array(flat)), (ends - ends[0]) // 4)
        try:
            return texts.cast(pa.large_string())
        except pa.ArrowInvalid:
            return pa.array([x.decode("utf-8", "replace") for x in texts.to_pylist()], pa.large_string())


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode_decode(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, ids (binary, unsigned 32-bit) and decoded text of every document, in one pass without a shuffle.

    A null text counts as empty: no ids, empty decoded text. A null doc_id
    stays null, repeated doc_ids stay separate rows, an empty table gives an
    empty one, and other columns aren't read.
    """
    ship(docs.sparkSession)
    tokenizer = tokenizer or bpe.default_tokenizer()

    def run(batches) -> Iterator:
        for batch in batches:
            for piece in slices(batch, "text"):
                c = codec(tokenizer)
                ids = c.apply(piece.column("text"))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), ids.cast(pa.binary()), c.decode(ids).cast(pa.string())], names=["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary, decoded string")
