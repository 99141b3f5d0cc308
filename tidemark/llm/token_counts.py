"""Token counts by merging a linked list of symbols with a heap of pairs; no ids are made."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidemark.session import ship

from . import bpe
from .encoder import CACHE_BYTES, ByChunk, slices
from .piece_counts import SentencePieces, WordEnds


def count_merges(symbols: list[int], pair_rank: dict, by_rank: list[int]) -> int:
    """How many merges byte-pair encoding makes: again and again the lowest rank, from the left among equals."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := pair_rank.get((symbols[i], symbols[i + 1]))) is not None]
    heapify(heap)
    merges = 0
    while heap:
        r, i, a, b = heappop(heap)
        j = after[i]
        if symbols[i] != a or j >= n or symbols[j] != b:
            continue  # one of the two has merged meanwhile
        merges += 1
        symbols[i], symbols[j] = by_rank[r], -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (s := pair_rank.get((symbols[i], symbols[k]))) is not None:
                heappush(heap, (s, i, symbols[i], symbols[k]))
        if (h := before[i]) >= 0 and (s := pair_rank.get((symbols[h], symbols[i]))) is not None:
            heappush(heap, (s, h, symbols[h], symbols[i]))
    return merges


class Counter(ByChunk):
    """The number of tokens of a text."""

    kind = pa.int64()

    def __init__(self, path: str, limit: int = CACHE_BYTES):
        super().__init__(path, limit)
        t = bpe.tables(path)
        self.pair_rank, self.by_rank, self.byte_id = t.pair_rank, t.by_rank.tolist(), t.byte_id.tolist()
        self.pieces = bpe.splitter()

    def plus(self, a: pa.Array, b: pa.Array) -> pa.Array:
        return pc.add(a, b)

    def gather(self, values: pa.Array, ends: np.ndarray) -> pa.Array:
        total = np.append(0, np.cumsum(values.to_numpy()))
        return pa.array(total[ends[1:]] - total[ends[:-1]])

    def word(self, w: str) -> int:
        data = w.encode()
        return len(data) - count_merges([self.byte_id[b] for b in data], self.pair_rank, self.by_rank) if len(data) > 1 else 1

    def run(self, texts: list[str]) -> list[int]:
        out, known = [], {}

        def word(w: str) -> int:
            n = known.get(w)
            if n is None:
                n = known[w] = self.word(w)
            return n

        for text in texts:
            n = at = 0
            for m in self.special.finditer(text) if self.special else ():
                n += 1 + sum(map(word, self.pieces.findall(text[at : m.start()])))
                at = m.end()
            out.append(n + sum(map(word, self.pieces.findall(text[at:] if at else text))))
        return out


@lru_cache(maxsize=2)
def counter(path: str):
    """What counts by the file's kind: SentencePiece BPE (.model), BPE with word ends or byte-level BPE (.json)."""
    if path.endswith(".model"):
        return SentencePieces(path)
    with open(path, encoding="utf-8") as f:
        ends = json.load(f)["model"].get("end_of_word_suffix")
    return WordEnds(path) if ends else Counter(path)


def count_tokens(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every document, in one pass without a shuffle.

    A null text counts as empty: no bytes, no tokens. A null doc_id stays null,
    repeated doc_ids stay separate rows, an empty table gives an empty one, and
    other columns aren't read.
    """
    ship(docs.sparkSession)
    tokenizer = tokenizer or bpe.default_tokenizer()

    def run(batches) -> Iterator:
        for batch in batches:
            for piece in slices(batch, "text"):
                text = piece.column("text")
                n = counter(tokenizer).apply(text)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pc.fill_null(pc.binary_length(text), 0).cast(pa.int64()), n], names=["doc_id", "n_bytes", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
