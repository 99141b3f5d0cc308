"""Results of whole texts from results of their chunks, each distinct chunk of a batch worked out once."""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import bpe

#: Bytes of chunks and results that a worker keeps between batches.
CACHE_BYTES = 32 << 20


class ByChunk:
    """apply(texts) gives run([text])[0] for every text of an Arrow array; null counts as empty.

    Texts are split, and equal chunks found, in Arrow. A chunk is a core and a
    tail of plain punctuation, which the pre-tokenizer always parts. Results
    of cores are kept in two Arrow arrays of at most CACHE_BYTES; when they are
    full, only those of the current batch stay. Texts that can't be cut go
    whole. A subclass gives kind, run(texts), run_chunks(chunks), plus(a, b)
    for results one after the other and gather(values, ends).
    """

    kind: pa.DataType = pa.large_binary()

    def __init__(self, path: str, limit: int = CACHE_BYTES):
        t = bpe.tables(path)
        self.special, self.special_strings = t.specials, list(t.special)
        self.limit = limit
        self.keys, self.values = pa.array([], pa.string()), pa.array([], self.kind)

    def run(self, texts: list[str]) -> list:
        raise NotImplementedError

    def run_chunks(self, chunks: list[str]) -> list:
        return self.run([bpe.chunk_text(k) for k in chunks])

    def plus(self, a: pa.Array, b: pa.Array) -> pa.Array:
        return pc.binary_join_element_wise(a, b, pa.scalar(b"", self.kind))

    def gather(self, values: pa.Array, ends: np.ndarray) -> pa.Array:
        """One result for each run of values; run i ends before ends[i + 1]."""
        at = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
        return pa.Array.from_buffers(self.kind, len(ends) - 1, [None, pa.py_buffer(np.ascontiguousarray(at[ends])), values.buffers()[2]])

    def of_cores(self, cores: pa.Array) -> pa.Array:
        """Results of distinct cores."""
        at = pc.index_in(cores, value_set=self.keys)
        if at.null_count:
            lacking = pc.is_null(at)
            new = cores.filter(lacking)
            results = pa.array([r for a in range(0, len(new), 50_000) for r in self.run_chunks(new[a : a + 50_000].to_pylist())], self.kind)
            where = at.to_numpy(zero_copy_only=False).copy()
            where[lacking.to_numpy(zero_copy_only=False)] = np.arange(len(self.keys), len(self.keys) + len(new))
            at = pa.array(where.astype(np.int64))
            self.keys, self.values = pa.concat_arrays([self.keys, new]), pa.concat_arrays([self.values, results])
        out = self.values.take(at)
        if self.keys.nbytes + self.values.nbytes > self.limit:
            few = cores.nbytes + out.nbytes <= self.limit
            self.keys, self.values = (cores, out) if few else (cores[:0], out[:0])
        return out

    def of_chunks(self, chunks: pa.Array) -> pa.Array:
        """Results of distinct chunks."""
        core = pc.utf8_rtrim(chunks, bpe.TAIL)
        core = pc.if_else(pc.match_substring_regex(core, r"[A-Za-z0-9]\z"), core, chunks)
        cut = np.flatnonzero(pc.not_equal(pc.binary_length(core), pc.binary_length(chunks)).to_numpy(zero_copy_only=False))
        cores = core.dictionary_encode()
        out = self.of_cores(cores.dictionary).take(cores.indices)
        if not len(cut):
            return out
        tails = pa.array([k[len(c) :] for k, c in zip(chunks.take(pa.array(cut)).to_pylist(), core.take(pa.array(cut)).to_pylist(), strict=True)]).dictionary_encode()
        tail_values = pa.array([*self.run(tails.dictionary.to_pylist()), self.run([""])[0]], self.kind)
        which = np.full(len(chunks), len(tail_values) - 1)
        which[cut] = tails.indices.to_numpy(zero_copy_only=False)
        return self.plus(out, tail_values.take(pa.array(which)))

    def apply(self, texts: pa.Array) -> pa.Array:
        texts = pc.fill_null(texts, "")
        whole = pc.match_substring_regex(texts, bpe.UNSAFE)
        for s in self.special_strings:
            whole = pc.or_(whole, pc.match_substring(texts, s))
        if not pc.any(whole).as_py():
            return self.cut(texts)
        slow = pa.array(self.run(texts.filter(whole).to_pylist()), self.kind)
        parts = pa.concat_arrays([self.cut(texts.filter(pc.invert(whole))), slow])
        mask = whole.to_numpy(zero_copy_only=False)
        order = np.empty(len(texts), np.int64)
        order[~mask], order[mask] = np.arange(int((~mask).sum())), np.arange(int((~mask).sum()), len(texts))
        return parts.take(pa.array(order))

    def cut(self, texts: pa.Array) -> pa.Array:
        """Results of texts that are safe to cut."""
        if not len(texts):
            return pa.array([], self.kind)
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        ends = split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py()
        chunks = split.flatten().dictionary_encode()
        heads = split.flatten().take(pa.array(ends[:-1])).dictionary_encode()  # no space stands before a text's first chunk
        values = pa.concat_arrays([self.of_chunks(chunks.dictionary), pa.array(self.run(heads.dictionary.to_pylist()), self.kind)])
        at = chunks.indices.to_numpy(zero_copy_only=False).copy()
        at[ends[:-1]] = heads.indices.to_numpy(zero_copy_only=False) + len(chunks.dictionary)
        return self.gather(values.take(pa.array(at)), ends)


class Encoder(ByChunk):
    """Ids as little-endian unsigned 32-bit integers, by the tokenizers library, without added special tokens."""

    def __init__(self, path: str, limit: int = CACHE_BYTES):
        super().__init__(path, limit)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        t = bpe.tables(path)
        self.begins = {b: np.zeros(max(t.bytes_of) + 1, bool) for b in b" \n"}
        for i, data in t.bytes_of.items():
            if data[:1] in (b" ", b"\n"):
                self.begins[data[0]][i] = True
        give_back()  # what reading the two files took

    def run(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def run_chunks(self, chunks: list[str], group: int = 500) -> list[bytes]:
        """Chunks without white space inside go many in one text: of each chunk's ids only the first begins with its space or line feed."""
        out: list[bytes] = [b""] * len(chunks)
        plain, feeds, odd = [], [], []
        for i, k in enumerate(chunks):
            if k.isalnum():
                plain.append(i)
                continue
            body = k[1:] if k[:1] == "\n" else k
            if not body or body.split() != [body]:
                odd.append(i)
            else:
                (plain if body is k else feeds).append(i)
        for places, byte in ((plain, 32), (feeds, 10)):
            groups = [places[a : a + group] for a in range(0, len(places), group)]
            texts = ["".join([bpe.chunk_text(chunks[i]) for i in g]) for g in groups]
            for g, e in zip(groups, self.library.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                ids = np.array(e.ids, "<u4")
                ends = [*(4 * np.flatnonzero(self.begins[byte][ids])).tolist(), 4 * len(ids)]
                flat = ids.tobytes()
                for i, (a, b) in zip(g, pairwise(ends), strict=True):
                    out[i] = flat[a:b]
        for i, ids in zip(odd, self.run([bpe.chunk_text(chunks[i]) for i in odd]), strict=True):
            out[i] = ids
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder a worker process; tasks that follow use its cache again."""
    return Encoder(path)


def give_back() -> None:
    """Returns freed memory to the system, for a worker that lives on after a task that held much; where the C library can't, nothing happens."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batch, column: str, rows: int = 4000, size: int = 4 << 20):
    """Cuts an Arrow batch into runs of at most `rows` rows and about `size` bytes of `column`, so memory doesn't depend on text lengths."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    a = total = 0
    for i, n in enumerate(lengths.tolist()):
        if i > a and (i - a >= rows or total + n > size):
            yield batch.slice(a, i - a)
            a, total = i, 0
        total += n
    if a < batch.num_rows:
        yield batch.slice(a)
