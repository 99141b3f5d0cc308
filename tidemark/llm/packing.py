"""Vector bin packing of examples into sequences under three limits at once.

Each piece has a vector (tokens, segments, loss-bearing tokens); a sequence has
a limit on each. The open sequence takes, of the piece kinds that fit, the one
with the largest dot product with its remaining room (both as shares of the
limits). A text longer than a sequence is cut; where no piece fits but `least`
tokens or more are free, a piece is cut to fill them. Sequences are packed
within an input partition, `pool` documents at a time, without any shuffle.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from tidemark.session import ship

from .bpe import default_tokenizer
from .encoder import encoder, give_back, slices

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, loss_tokens long, ids binary"


class Packer:
    """Packs pieces given by add(); flush() yields (sequence, offset, piece). A piece is (doc_id, start, doc_tokens, ids, prompt).

    prompt counts the leading ids of a document that bear no loss (at least
    one: nothing precedes the first id of a segment).
    """

    def __init__(self, max_tokens: int, max_segments: int, max_loss: int, least: int):
        self.limit = np.array([max_tokens, max_segments, max_loss], np.int64)
        self.least = max(1, least)
        self.sequence = 0
        self.kinds: dict[tuple[int, int], list] = defaultdict(list)

    def loss(self, start: int, length: int, prompt: int) -> int:
        return max(0, length - min(length, max(prompt - start, 1)))

    def within(self, start: int, length: int, prompt: int, room: int) -> int:
        """The most ids, up to length, that bear at most `room` losses."""
        while (over := self.loss(start, length, prompt) - room) > 0:
            length -= over
        return length

    def add(self, doc_id, ids: bytes, prompt: int = 0) -> None:
        n, at = len(ids) // 4, 0
        while at < n:
            m = min(n - at, int(self.limit[0]))
            m = self.within(at, m, prompt, int(self.limit[2]))  # a piece must fit a sequence by itself
            self.put((doc_id, at, n, ids[4 * at : 4 * (at + m)], prompt))
            at += m

    def put(self, piece: tuple) -> None:
        m = len(piece[3]) // 4
        self.kinds[m, self.loss(piece[1], m, piece[4])].append(piece)

    def flush(self) -> Iterator[tuple[int, int, tuple, int]]:
        """(sequence, offset in it, piece, its loss-bearing ids) of all pieces added."""
        kinds = sorted(k for k, v in self.kinds.items() if v)
        limit = self.limit.tolist()

        def arrays():
            tokens, loss = (np.array([k[i] for k in kinds], np.int64) for i in (0, 1))
            return tokens, loss, tokens / limit[0], loss / limit[2], np.array([len(self.kinds[k]) for k in kinds], np.int64)

        tokens, loss, share_t, share_l, count = arrays()
        left = int(count.sum())
        while left:
            room_t, room_s, room_l = limit
            offset = 0
            while left and room_t and room_s:
                k = int(np.searchsorted(tokens, room_t, "right"))
                fits = np.flatnonzero((count[:k] > 0) & (loss[:k] <= room_l))
                if len(fits):  # one segment each, so that part of the product is the same for all
                    best = int(fits[np.argmax(share_t[fits] * (room_t / limit[0]) + share_l[fits] * (room_l / limit[2]))])
                    piece = self.kinds[kinds[best]].pop()
                    count[best] -= 1
                    left -= 1
                else:
                    best = int(np.flatnonzero(count)[-1])  # the longest: its rest stays useful
                    doc_id, start, n, ids, prompt = self.kinds[kinds[best]][-1]
                    take = self.within(start, min(room_t, len(ids) // 4 - 1), prompt, room_l)
                    if take < self.least:
                        break
                    self.kinds[kinds[best]].pop()
                    count[best] -= 1
                    piece, rest = (doc_id, start, n, ids[: 4 * take], prompt), (doc_id, start + take, n, ids[4 * take :], prompt)
                    self.put(rest)
                    kind = (len(rest[3]) // 4, self.loss(rest[1], len(rest[3]) // 4, prompt))
                    at = int(np.searchsorted(tokens, kind[0]))
                    while at < len(kinds) and kinds[at] < kind:
                        at += 1
                    if at < len(kinds) and kinds[at] == kind:
                        count[at] += 1
                    else:
                        kinds = sorted(k for k, v in self.kinds.items() if v)
                        tokens, loss, share_t, share_l, count = arrays()
                m = len(piece[3]) // 4
                lossy = self.loss(piece[1], m, piece[4])
                yield self.sequence, offset, piece, lossy
                room_t, room_s, room_l = room_t - m, room_s - 1, room_l - lossy
                offset += m
            self.sequence += 1
        self.kinds.clear()


def pack(
    docs: DataFrame, tokenizer: str | None = None, end_id: int | None = 0, max_tokens: int = 1024, max_segments: int = 32,
    max_loss: int | None = 1020, least: int = 8, pool: int = 4096, pool_bytes: int = 6 << 20, prompt: str | None = None,
) -> DataFrame:
    """Pieces of doc_id and text in sequences of at most max_tokens ids, max_segments pieces and max_loss loss-bearing ids.

    The limits bind each for some sequences: the first id of a segment bears no
    loss, so a full sequence of under four segments reaches 1,020 losses first,
    and one of short documents 32 segments. max_loss=None is no limit of its own.
    prompt names an integer column: so many leading ids of the document bear no
    loss (null: none). A null or empty text is the end id alone; without an end
    id it has no piece. A null doc_id stays null. Rows with the same doc_id are
    separate documents. An empty table has no pieces. sequence_id is unique and
    follows from the input partition, so a repeated task gives the same rows.
    """
    ship(docs.sparkSession)
    tokenizer = tokenizer or default_tokenizer()
    limits = (max_tokens, max_segments, max_tokens if max_loss is None else min(max_loss, max_tokens), least)
    if min(limits[:3]) < 1:
        raise ValueError("every limit must be at least 1")

    def run(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 33
        tail = np.array([] if end_id is None else [end_id], "<u4").tobytes()
        packer, held, held_bytes = Packer(*limits), 0, 0

        def out():
            rows = list(packer.flush())
            for a in range(0, len(rows), 4096):
                part = rows[a : a + 4096]
                p = [r[2] for r in part]
                yield pa.RecordBatch.from_arrays([
                    pa.array([x[0] for x in p], pa.int64()), pa.array([x[1] for x in p], pa.int64()), pa.array([len(x[3]) // 4 for x in p], pa.int64()),
                    pa.array([x[2] for x in p], pa.int64()), pa.array([base + r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64()),
                    pa.array([r[3] for r in part], pa.int64()), pa.array([x[3] for x in p], pa.binary()),
                ], names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "loss_tokens", "ids"])

        for batch in batches:
            for piece in slices(batch, "text"):
                prompts = piece.column("prompt").to_pylist()
                for doc, ids, k in zip(piece.column("doc_id").to_pylist(), encoder(tokenizer).apply(piece.column("text")).to_pylist(), prompts, strict=True):
                    packer.add(doc, ids + tail, k or 0)
                    held += 1
                    held_bytes += len(ids)
                if held >= pool or held_bytes >= pool_bytes:
                    yield from out()
                    held = held_bytes = 0
                    give_back()  # the worker lives on
        yield from out()
        give_back()

    from pyspark.sql import functions as F

    source = docs.select("doc_id", "text", (F.col(prompt).cast("int") if prompt else F.lit(0)).alias("prompt"))
    return source.mapInArrow(run, SCHEMA)
