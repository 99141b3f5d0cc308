"""N-gram Jaccard join as a blocked sparse product of documents by n-grams.

Exact for every pair at or over the threshold. Nothing is emitted pair by pair.

1. A document's column entries that come first in hash order go to blocks of
   columns, packed. If two sets are similar enough, each sees a size-derived
   number of its entries shared; documents below that bound are discarded.
   Equal sets count as one row of the matrix throughout.
2. The rows left send all their columns to blocks; each learns how many rows
   share each of its columns. Rows whose shared columns don't reach the share
   that a partner must have are discarded; of the others, the rarest columns
   (again a size-derived number) join rows that may be similar into candidates.
3. Candidate groups are multiplied block by block: all overlaps are accumulated
   and pairs below the bound that follows from their sizes are discarded.
   Larger groups are dealt into blocks, and each pair of blocks is multiplied.
   What leaves a block are each row's number of links and its component there.

Columns are 64-bit hashes of n-grams, sets are told apart by 128-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import left_join_by_key
from tidemark.session import materialize, partitions, ship, tidied

from .bitmaps import bitmaps, bits_for, may_have
from .components import components
from .encoder import give_back, slices

#: Odd multipliers that tell the places of an n-gram apart.
MIX = [np.uint64((0x9E3779B97F4A7C15 * (2 * i + 1)) & (1 << 64) - 1) for i in range(64)]
#: Per cent of a set that its first blocks hold beyond what one shared entry needs; more means fewer documents in step 2.
EXTRA = 10
#: Bytes of text whose first entries make up one column block in step 1; entries that make up one in step 2.
BLOCK_TEXT, BLOCK_ENTRIES = 128 << 20, 4 << 20
#: A column with over HOT_LEAST and over one in HOT of all entries of step 2 doesn't go to a column block; there are 2 * HOT of them at most.
HOT, HOT_LEAST = 50_000, 4096
#: Rows of a block in step 3; columns that more than one in COMMON of them have are multiplied as a dense matrix, WIDE columns at a time.
BLOCK, COMMON, WIDE = 1024, 16, 4096


class Words(dict):
    """64-bit hashes of words; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= 300_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


@lru_cache(maxsize=1)
def words() -> Words:
    return Words()


def ngrams(text: str | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct n-grams of A-Z lower-cased words; with fewer words the whole sequence is one; without words none."""
    w = (text or "").encode().lower().split()  # on bytes: A-Z only, and white space 0x20, 0x09-0x0D only
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words().__getitem__, w), np.uint64, len(w))
    k = min(size, len(w))
    m = len(w) - k + 1
    a = np.full(m, k, np.uint64)
    for j in range(k):
        a = (a ^ h[j : j + m]) * MIX[j % len(MIX)]
        a ^= a >> np.uint64(29)
    return np.unique(a)


def least_overlap(n, percent: int):
    """What a set of n must share with any set that is similar enough."""
    return (percent * n + 99) // 100


def extra(n):
    return n * EXTRA // 100 + 1


def linked(overlap, n, m, percent: int):
    """100 * overlap >= percent * union, in whole numbers."""
    return (100 + percent) * overlap >= percent * (n + m)


def _blocks(columns: np.ndarray, blocks: int) -> np.ndarray:
    return ((columns >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def _cut(block: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(block, the arrays' parts one after the other) from arrays sorted by block."""
    if len(block):
        at = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(block)).tolist()
        for a, b in zip(at, at[1:]):
            yield int(block[a]), b"".join(np.ascontiguousarray(x[a:b]).tobytes() for x in arrays)


def _packed(rows: list[tuple]):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int8()), pa.array([r[2] for r in rows], pa.binary())], names=["block", "kind", "data"])


PACKED = "block int, kind tinyint, data binary"
DOC = np.dtype([("doc", "<i8"), ("uid", "<i8"), ("n", "<i8"), ("hi", "<i8"), ("lo", "<i8"), ("shared", "<i8")])
ENTRY = np.dtype([("row", "<i8"), ("column", "<u8"), ("count", "<i4")])
SIZE = np.dtype([("row", "<i8"), ("n", "<i8")])


def _read(batches) -> dict[int, list[bytes]]:
    out: dict[int, list[bytes]] = {}
    for batch in batches:
        for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data").to_pylist(), strict=True):
            out.setdefault(kind, []).append(data)
    return out


def _pairs(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Columns and owners from parts that hold the one after the other, sorted and without repeats."""
    halves = [np.frombuffer(p, "<u8").reshape(2, -1) for p in parts]
    column, owner = (np.concatenate([h[i] for h in halves]) if halves else np.zeros(0, np.uint64) for i in (0, 1))
    order = np.lexsort((owner, column))
    column, owner = column[order], owner[order]
    new = np.append(True, (column[1:] != column[:-1]) | (owner[1:] != owner[:-1]))[: len(column)]
    return column[new], owner[new]


def _runs(values: np.ndarray) -> np.ndarray:
    """How often each entry's value stands in a sorted array."""
    if not len(values):
        return np.zeros(0, np.int64)
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    length = np.diff(np.append(first, len(values)))
    return np.repeat(length, length)


def _first_entries(size: int, percent: int, blocks: int):
    """Step 1, by document: its first entries to column blocks (kind 0), itself to any block (kind 1)."""

    def run(batches) -> Iterator:
        import xxhash

        for batch in batches:
            for piece in slices(batch, "text", 8000, 8 << 20):
                rows, seen = [], {}
                sets, owners = [], []
                docs = np.zeros(piece.num_rows, DOC)
                for i, (doc, uid, text) in enumerate(zip(piece.column("doc_id").to_pylist(), piece.column("uid").to_pylist(), piece.column("text").to_pylist(), strict=True)):
                    s = ngrams(text, size)
                    n = len(s)
                    h = xxhash.xxh3_128_intdigest(s.tobytes())
                    hi, lo = (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63)
                    docs[i] = (doc, uid, n, hi, lo, 0)
                    if n and h not in seen:
                        seen[h] = i
                        need = n - least_overlap(n, percent) + extra(n)
                        sets.append(s[:need])
                        owners.append(np.full(len(sets[-1]), i, np.int64))
                if sets:
                    column, owner = np.concatenate(sets), np.concatenate(owners)
                    order = np.argsort(column, kind="stable")
                    column, owner = column[order], owner[order]
                    many = _runs(column) > 1
                    np.add.at(docs["shared"], owner[many], 1)  # known to be shared here; others learn it from one mark
                    mark = np.unique(column[many])
                    column = np.concatenate([column[~many], mark])
                    key = np.concatenate([docs["lo"][owner[~many]], np.full(len(mark), 0, np.int64)]).view(np.uint64)
                    order = np.argsort(column, kind="stable")
                    column, key = column[order], key[order]
                    rows += [(b, 0, data) for b, data in _cut(_blocks(column, blocks), column, key)]
                if len(docs):
                    rows.append((int(docs["lo"][0] % blocks), 1, docs.tobytes()))
                if rows:
                    yield _packed(rows)
                give_back()
        words().clear()  # the worker lives on and has other things to hold
        give_back()

    return run


def _count_shared(batches) -> Iterator:
    """Step 1, by column block: documents as they come, and how many of a set's entries in this block are shared."""
    import pyarrow as pa

    parts = _read(batches)
    names = ["doc_id", "uid", "n", "hi", "lo", "shared"]
    for data in parts.get(1, []):
        d = np.frombuffer(data, DOC)
        yield pa.RecordBatch.from_arrays([pa.array(d[c], pa.int64()) for c in DOC.names], names=names)
    column, owner = _pairs(parts.get(0, []))
    owner = owner[_runs(column) > 1].view(np.int64)
    key, count = np.unique(owner[owner != 0], return_counts=True)
    for a in range(0, len(key), 50_000):
        m = len(key[a : a + 50_000])
        none = pa.nulls(m, pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(key[a : a + m], pa.int64()), pa.array(count[a : a + m], pa.int64())], names=names)
    give_back()


def _sets(size: int):
    """Step 2: the whole set of each row that is left."""

    def run(batches) -> Iterator:
        import pyarrow as pa
        import xxhash

        for batch in batches:
            for piece in slices(batch, "text", 2000, 8 << 20):
                out = []
                for row, lo, weight, text in zip(*(piece.column(c).to_pylist() for c in ("row", "lo", "weight", "text")), strict=True):
                    s = ngrams(text, size)
                    if (xxhash.xxh3_128_intdigest(s.tobytes()) & (1 << 64) - 1) - (1 << 63) == lo:  # a repeated doc_id can bring another text
                        out.append((row, len(s), s.tobytes(), weight))
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.int64()))], names=["row", "n", "entries", "weight"])
        words().clear()
        give_back()

    return run


def _frequent():
    """Step 2: columns that hold one in 2 * HOT of a batch's entries, with their number in it."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for piece in slices(batch, "entries", 4000, 8 << 20):
                column = np.sort(np.concatenate([np.frombuffer(x, "<u8") for x in piece.column("entries").to_pylist()]))
                first = np.flatnonzero(np.append(True, column[1:] != column[:-1])[: len(column)])
                count = np.diff(np.append(first, len(column)))
                many = count * 2 * HOT > max(len(column), 4 * HOT)
                yield pa.RecordBatch.from_arrays([pa.array(column[first[many]].view(np.int64)), pa.array(count[many])], names=["column", "n"])

    return run


def hot_columns(sets: DataFrame, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """All columns with more than one in HOT of the entries, and perhaps some with half as many, sorted, and about how many rows have each; 2 * HOT of them at most.

    A column that no batch reports where it stays below half its share lacks
    less than half of its entries here, so none is missed. Columns of two
    entries a batch or under HOT_LEAST in all are never hot.
    """
    found = sets.select("entries").mapInArrow(_frequent(), "column long, n long").groupBy("column").agg(F.sum("n").alias("n")).filter(F.col("n") > max(HOT_LEAST, entries / (2 * HOT))).collect()
    column, count = (np.array([r[i] for r in found], np.int64) for i in (0, 1))
    column = column.view(np.uint64)
    order = np.argsort(column)
    return column[order], np.minimum(count[order], 1 << 30)


def _all_entries(blocks: int, hot: np.ndarray, often: np.ndarray):
    """Step 2, by row: entries to column blocks (kind 0), those of hot columns to blocks of rows (kind 1), sizes likewise (kind 2)."""

    def run(batches) -> Iterator:
        for batch in batches:
            for piece in slices(batch, "entries", 4000, 8 << 20):
                sets = [np.frombuffer(x, "<u8") for x in piece.column("entries").to_pylist()]
                row = np.array(piece.column("row").to_pylist(), np.int64)
                column = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                owner = np.repeat(row, [len(s) for s in sets])
                at = np.minimum(np.searchsorted(hot, column), max(0, len(hot) - 1))
                known = hot[at] == column if len(hot) else np.zeros(len(column), bool)
                e = np.zeros(int(known.sum()), ENTRY)
                e["row"], e["column"], e["count"] = owner[known], column[known], often[at[known]]  # the same for all, so all rows order columns alike
                e = e[np.argsort(e["row"] % blocks, kind="stable")]
                column, owner = column[~known], owner[~known]
                order = np.argsort(column, kind="stable")
                column, owner = column[order], owner[order]
                rows = [(b, 0, data) for b, data in _cut(_blocks(column, blocks), column, owner)]
                rows += [(b, 1, data) for b, data in _cut(e["row"] % blocks, e)]
                sizes = np.zeros(len(row), SIZE)
                sizes["row"], sizes["n"] = row, piece.column("n").to_pylist()
                sizes = sizes[np.argsort(row % blocks, kind="stable")]
                rows += [(b, 2, data) for b, data in _cut(sizes["row"] % blocks, sizes)]
                if rows:
                    yield _packed(rows)

    return run


def _shared_entries(blocks: int):
    """Step 2, by column block: entries that several rows have, with their number, back to blocks of rows."""

    def run(batches) -> Iterator:
        parts = _read(batches)
        rows = []
        for kind, form in ((1, ENTRY), (2, SIZE)):
            rows += [(int(np.frombuffer(data, form)["row"][0] % blocks), kind, data) for data in parts.get(kind, [])]
        column, owner = _pairs(parts.get(0, []))
        count = _runs(column)
        keep = count > 1
        e = np.zeros(int(keep.sum()), ENTRY)
        e["row"], e["column"], e["count"] = owner[keep].view(np.int64), column[keep], np.minimum(count[keep], 1 << 30)
        e = e[np.argsort(e["row"] % blocks, kind="stable")]
        rows += [(b, 1, data) for b, data in _cut(e["row"] % blocks, e)]
        for a in range(0, len(rows), 256):
            yield _packed(rows[a : a + 256])
        give_back()

    return run


def _rarest(blocks: int, percent: int):
    """Step 2, by row block: of the rows that may have a partner, the rarest entries, to column blocks."""

    def run(batches) -> Iterator:
        parts = _read(batches)
        sizes = np.concatenate([np.frombuffer(x, SIZE) for x in parts.get(2, [])]) if 2 in parts else np.zeros(0, SIZE)
        e = np.concatenate([np.frombuffer(x, ENTRY) for x in parts.get(1, [])]) if 1 in parts else np.zeros(0, ENTRY)
        e = e[np.lexsort((e["column"], e["count"], e["row"]))]
        if not len(e):
            return
        sizes = sizes[np.argsort(sizes["row"], kind="stable")]
        n = sizes["n"][np.searchsorted(sizes["row"], e["row"])]
        shared = _runs(e["row"])
        first = np.append(True, e["row"][1:] != e["row"][:-1])
        rank = np.arange(len(e)) - np.maximum.accumulate(np.where(first, np.arange(len(e)), 0))
        e = e[rank < shared - least_overlap(n, percent) + 1]
        if not len(e):
            return
        # rows that meet in a column here are linked here; of them only the smallest goes on, so a column block gets a row for each row block at most
        e = e[np.lexsort((e["row"], e["column"]))]
        first = np.append(True, e["column"][1:] != e["column"][:-1])
        low = e["row"][np.flatnonzero(first)][np.cumsum(first) - 1]
        met = _forest(e["row"], low)
        rows = [(b, 0, data) for b, data in _cut(_blocks(e["column"][first], blocks), e["column"][first], e["row"][first].view(np.uint64))]
        rows += [(int(met[0][a] % blocks), 3, np.concatenate([x[a : a + 50_000] for x in met]).tobytes()) for a in range(0, len(met[0]), 50_000)]
        for a in range(0, len(rows), 256):
            yield _packed(rows[a : a + 256])

    return run


def _forest(owner: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (id, smallest id connected to it) for links owner - low."""
    far = low != owner
    if not far.any():
        return owner[:0], owner[:0]
    ids, root = _roots(owner[far], low[far])
    return ids[ids != root], root[ids != root]


def _roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, smallest id connected to each) for links a - b."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            return ids, ids[label]
        label = new


def _candidates(batches) -> Iterator:
    """Step 2, by column block: rows that meet in an entry, as links to the smallest row they are connected to here."""
    import pyarrow as pa

    parts = _read(batches)
    column, owner = _pairs(parts.get(0, []))
    owner = owner.view(np.int64)
    links = [tuple(np.frombuffer(x, "<i8").reshape(2, -1)) for x in parts.get(3, [])]
    if len(column):
        first = np.append(True, column[1:] != column[:-1])
        links.append(_forest(owner, owner[np.flatnonzero(first)][np.cumsum(first) - 1]))
    for ids, root in links:
        for a in range(0, len(ids), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[a : a + 50_000], pa.int64()) for x in (ids, root)], names=["a", "b"])


def multiply(sets: list[np.ndarray], percent: int, weight: np.ndarray, side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(smallest index linked, directly or not; weight of all sets linked directly) for each of the sets. side: only pairs with a set on either side count."""
    m = len(sets)
    n = np.array([len(s) for s in sets], np.int64)
    left = np.arange(m) if side is None else np.flatnonzero(side)
    right = left if side is None else np.flatnonzero(~side)
    column, owner = np.concatenate(sets), np.repeat(np.arange(m), n)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    length = _runs(column)
    overlap = np.zeros((len(left), len(right)), np.float32)  # whole numbers below 2**24
    dense = (length > 1) & (length * COMMON > m)
    new = np.append(True, column[1:] != column[:-1])[: len(column)]
    number, rows = np.cumsum(new[dense]) - 1, owner[dense]
    for first in range(0, int(number[-1]) + 1 if len(number) else 0, WIDE):
        a, b = np.searchsorted(number, (first, first + WIDE))
        tile = np.zeros((m, int(number[b - 1]) - first + 1), np.float32)
        tile[rows[a:b], number[a:b] - first] = 1
        overlap += tile @ tile.T if side is None else tile[left] @ tile[right].T
    light = (length > 1) & ~dense
    if light.any():
        rows, length = owner[light], length[light]
        start = np.maximum.accumulate(np.where(new[light], np.arange(len(rows)), 0))
        order = np.argsort(rows, kind="stable")
        begins = np.searchsorted(rows[order], np.arange(m + 1))
        for k, i in enumerate(left.tolist()):
            e = order[begins[i] : begins[i + 1]]
            at = np.repeat(start[e] - np.append(0, np.cumsum(length[e])[:-1])[: len(e)], length[e]) + np.arange(length[e].sum())
            overlap[k] += np.bincount(rows[at], minlength=m)[right]
    hit = linked(overlap.astype(np.int64), n[left][:, None], n[right], percent) & (overlap > 0)
    link = np.zeros((m, m), bool)
    link[np.ix_(left, right)] = hit
    if side is None:
        np.fill_diagonal(link, False)
    else:
        link[np.ix_(right, left)] = hit.T
    root = np.full(m, -1)
    for i in range(m):
        reached = np.array([i] if root[i] < 0 else [], np.int64)
        while len(reached):
            root[reached] = i
            reached = np.flatnonzero(link[reached].any(0) & (root < 0))
    return root, link @ weight


def _product(percent: int):
    """Step 3, over rows sorted by block: of each row with links in its block, the smallest row it is connected to there and how many documents it links with."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        def close(block, rows, sets, weights, sides):
            rows, once = np.unique(np.array(rows, np.int64), return_index=True)
            side = None if block["i"] == block["j"] else np.array(sides)[once]
            root, links = multiply([sets[i] for i in once], percent, np.array(weights, np.int64)[once], side)
            some = links > 0
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (rows[some], rows[root[some]], links[some])], names=["a", "b", "links"])

        now, held = None, ([], [], [], [])
        for batch in batches:
            for block, row, entries, weight, side in zip(*(batch.column(c).to_pylist() for c in ("block", "row", "entries", "weight", "side")), strict=True):
                if block != now and held[0]:
                    yield close(now, *held)
                    held = ([], [], [], [])
                now = block
                for x, value in zip(held, (row, np.frombuffer(entries, "<u8"), weight, side), strict=True):
                    x.append(value)
        if held[0]:
            yield close(now, *held)
        give_back()

    return run


def _multiplied(blocks: DataFrame, percent: int) -> DataFrame:
    spark = blocks.sparkSession
    dealt = blocks.select("block", "row", "entries", "weight", "side").repartition(partitions(spark), "block").sortWithinPartitions("block")
    return dealt.mapInArrow(_product(percent), "a long, b long, links long")


def linked_rows(sets: DataFrame, percent: int) -> DataFrame:
    """(row, label, links): the component of each row of sets (row, n, entries, weight) that has a partner, and the weight of all its partners; exact."""
    spark = sets.sparkSession
    entries = sets.agg(F.sum("n")).first()[0] or 0
    k = max(partitions(spark), entries // BLOCK_ENTRIES + 1)
    met = sets.mapInArrow(_all_entries(k, *hot_columns(sets, entries)), PACKED).repartitionById(k, F.col("block")).mapInArrow(_shared_entries(k), PACKED)
    rare = met.repartitionById(k, F.col("block")).mapInArrow(_rarest(k, percent), PACKED)
    groups = components(rare.repartitionById(k, F.col("block")).mapInArrow(_candidates, "a long, b long"))
    sizes = groups.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    placed = materialize(sets.join(left_join_by_key(groups, materialize(sizes, "sizes"), ["label"], "size", groups.count()).withColumnRenamed("id", "row"), "row"), "placed")
    small = placed.filter(f"size <= {BLOCK}").withColumn("block", F.struct("label", F.lit(0).alias("i"), F.lit(0).alias("j"))).withColumn("side", F.lit(True))
    links = _multiplied(small, percent)
    large = placed.filter(f"size > {BLOCK}")
    if not large.isEmpty():
        # blocks by hash, and each pair of them
        count = F.expr(f"cast((size + {BLOCK - 1}) div {BLOCK} as int)")
        own = large.withColumn("i", F.pmod(F.xxhash64("row"), count).cast("int"))
        pairs = own.withColumn("o", F.explode(F.sequence(F.lit(0), count - 1)))
        block = F.struct("label", F.least("i", "o").alias("i"), F.greatest("i", "o").alias("j"))
        links = links.unionByName(_multiplied(pairs.withColumn("block", block).withColumn("side", F.col("i") <= F.col("o")), percent))
    links = materialize(links, "linked")
    total = links.groupBy(F.col("a").alias("row")).agg(F.sum("links").alias("links"))
    return components(links.select("a", "b")).withColumnRenamed("id", "row").join(total, "row")


@tidied("seen", "known")
def ngram_components(docs: DataFrame, size: int = 5, percent: int = 80, row: str | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links of every row of docs (doc_id, text).

    Two documents link when 100 * |intersection| >= percent * |union| of their
    sets of n-grams of `size` words; component_id is the smallest doc_id that
    links lead to, n_links the number of documents it links with itself, equal
    ones included. A null, empty or blank text has an empty set and links with
    nothing. Rows with a null doc_id have a null component_id, join nothing and have no links.
    Rows with the same doc_id are documents of their own. An empty table gives
    an empty one; other columns aren't read. row names a column of longs of
    which each row has its own; the result then has it too, as uid, and kept:
    true for one row of each component, that with the smallest doc_id and of
    those with the smallest uid, and for rows that link with nothing.
    """
    if not 0 < percent <= 100 or size < 1:
        raise ValueError("percent must be in 1..100 and size at least 1")
    spark = docs.sparkSession
    ship(spark)
    k = partitions(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col(row) if row else F.lit(0)).cast("long").alias("uid"), "text")
    named = docs.filter("doc_id IS NOT NULL")
    k = max(k, (named.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_TEXT + 1)
    first = named.mapInArrow(_first_entries(size, percent, k), PACKED).repartitionById(k, F.col("block")).mapInArrow(_count_shared, "doc_id long, uid long, n long, hi long, lo long, shared long")
    seen = materialize(first, "seen")
    rows = seen.filter("doc_id IS NOT NULL")
    full = rows.filter("n > 0")
    classes = full.groupBy("hi", "lo").agg(F.min(F.struct("doc_id", "uid")).alias("first"), F.max("n").alias("n"), F.count(F.lit(1)).alias("size"))
    counts = seen.groupBy("lo").agg(F.sum("shared").alias("shared"))
    need = F.expr(f"(({percent} * n + 99) div 100) * {EXTRA} div 100 + 1")
    classes = materialize(classes.join(counts, "lo").withColumn("left", F.col("shared") >= need).withColumn("row", F.monotonically_increasing_id()), "classes")
    left = classes.filter("left").select("first.doc_id", "row", "lo", F.col("size").alias("weight"))
    bits = bits_for(left.count())
    some = may_have(named.select("doc_id", "text"), "doc_id", bitmaps(left, "doc_id", bits), bits)  # so only texts of candidates and few others are shuffled
    sets = materialize(some.join(left, "doc_id").select("row", "lo", "weight", "text").mapInArrow(_sets(size), "row long, n long, entries binary, weight long"), "sets")
    labels = linked_rows(sets, percent)
    near = classes.join(labels, "row")
    lowest = near.groupBy("label").agg(F.min("first").alias("lowest"), F.count(F.lit(1)).alias("rows"))
    near = left_join_by_key(near, materialize(lowest, "lowest"), ["label"], "rows", near.count()).select("row", "lowest", "links")
    known = classes.join(near, "row", "left").select("hi", "lo", "size", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("lowest", "first").alias("lowest"), F.col("lowest").isNotNull().alias("joined"))
    known = materialize(known.filter("size > 1 OR joined").drop("joined"), "known")
    out = left_join_by_key(full, known, ["hi", "lo"], "size", full.count())
    kept = F.col("lowest").isNull() | (F.col("lowest.uid") == F.col("uid"))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("lowest.doc_id", "doc_id").alias("component_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), "uid", kept.alias("kept"))
    out = out.unionByName(rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"), "uid", F.lit(True).alias("kept")))
    if not docs.filter("doc_id IS NULL").isEmpty():
        out = out.unionByName(docs.filter("doc_id IS NULL").mapInArrow(_nameless(size), "doc_id long, n_shingles long, component_id long, n_links long, uid long, kept boolean"))
    return out if row else out.drop("uid", "kept")


def _nameless(size: int):
    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            n = [len(ngrams(t, size)) for t in batch.column("text").to_pylist()]
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([none, pa.array(n, pa.int64()), none, pa.array([0] * len(n), pa.int64()), batch.column("uid"), pa.array([True] * len(n))], names=["doc_id", "n_shingles", "component_id", "n_links", "uid", "kept"])

    return run
