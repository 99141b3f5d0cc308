"""Structure repair of conversations: the cheapest edits that make turns alternate, found by A* on the lattice of rows and states.

A node is (rows consumed, state); the state is the last role of what is
repaired so far. The heap is keyed by (cost plus heuristic, audit), where the
heuristic is a suffix sum over the rows ahead: 2 for each row that must be
deleted, and 2 for each truncated one, which costs that much deleted and 5
kept. It never falls by more than an edit costs, so the first time a node leaves
the heap it has its least cost and, of the audits at that cost, the least: of two
audits that consume the same rows at the same cost, neither begins the other.

A conversation's rows pass twice in one sorted stream, first as short codes for
the search, then as texts for the digest, so no task holds a conversation's
texts. A search spans at most BLOCK rows; between blocks only the best audit of
each state is carried, so memory beyond the audit itself and one digest a row
doesn't grow with a conversation.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from os.path import commonprefix

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ship

#: Costs of edits, states by what is expected next, and the role that each state fills in.
RAISE_ROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
FILL = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
WHOLE = (START, ASSISTANT)
LEGAL = {"su", "ua", "au"}
NOT_WHITE, ENDED = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"
#: Rows of a search.
BLOCK = 512
TURNS = "conv_id long, place long, role string, text string, edit string"
OUT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
MOST_LONG = 2**63 - 1


def search(rows: list[tuple[str, str]], seeds: list[tuple[int, str, int]], final: bool) -> dict[int, tuple[int, str]]:
    """state -> (cost, audit) after rows (initial, fault) from seeds (cost, audit so far, state).

    fault is b, d, t or empty. With final, only the first state that a whole conversation may end in.
    """
    ahead = [0] * (len(rows) + 1)
    for i in range(len(rows) - 1, -1, -1):
        ahead[i] = ahead[i + 1] + (DELETE if rows[i][1] else 0)
    heap = [(cost + ahead[0], audit, 0, state) for cost, audit, state in seeds]
    heapq.heapify(heap)
    done, found = set(), {}
    while heap:
        f, audit, i, state = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        fill = FILL[state]
        if i == len(rows):
            if final and state in WHOLE:
                return {state: (f, audit)}
            found[state] = (f, audit)
            if len(found) == 4:
                break
        else:
            initial, fault = rows[i]
            charged = DELETE if fault else 0  # what the heuristic held for this row
            heapq.heappush(heap, (f + DELETE - charged, audit + "D", i + 1, state))
            if fault in ("", "t"):
                cost = f + (TRUNCATED if fault else 0) - charged
                if initial in KEEP[state]:
                    heapq.heappush(heap, (cost, audit + "K", i + 1, KEEP[state][initial]))
                heapq.heappush(heap, (cost + RAISE_ROLE, audit + "R", i + 1, fill))
        heapq.heappush(heap, (f + INSERT, audit + "I", i, fill))
    return found


class Conversation:
    """One conversation's rows in order: code() for each, then text() for each, then result()."""

    def __init__(self, conv_id: int | None, block: int = BLOCK):
        self.id, self.block = conv_id, block
        self.faults = {"": 0, "b": 0, "d": 0, "t": 0}
        self.illegal = self.turns = 0
        self.last: str | None = None
        self.low = self.high = None
        self.seen: set[bytes] = set()
        self.rows: list[tuple[str, str]] = []
        self.settled: list[str] = []  # what all carried audits begin with
        self.carried: list[tuple[int, str, int]] = [(0, "", START)]
        self.letters: Iterator[str] | None = None
        self.sha, self.state = hashlib.sha256(), START
        self.made: list[tuple] | None = None  # the repaired turns, for who asks for them
        self.place = 0

    def code(self, turn: int | None, initial: str, blank: bool, truncated: bool, digest: bytes) -> None:
        if len(self.rows) == self.block:
            self.settle(False)
        fault = "b" if blank else "d" if digest in self.seen else "t" if truncated else ""
        self.seen.add(digest)
        self.faults[fault] += 1
        if self.last is not None and self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial
        if turn is not None and turn != self.high:  # in ascending order
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        self.rows.append((initial, fault))

    def settle(self, final: bool) -> None:
        """Searches the rows at hand. Audits carried in are told apart by a rank and what is left of one that another begins."""
        heads: list[str] = []
        seeds = []
        for cost, audit, state in sorted(self.carried, key=lambda c: c[1]):
            if not heads or not audit.startswith(heads[-1]):
                heads.append(audit)
            seeds.append((cost, chr(64 + len(heads)) + audit[len(heads[-1]) :], state))
        found = search(self.rows, seeds, final)
        best = [(cost, heads[ord(key[0]) - 65] + key[1:], state) for state, (cost, key) in found.items()]
        shared = commonprefix([audit for _, audit, _ in best])
        self.settled.append(shared)
        self.carried = [(cost, audit[len(shared) :], state) for cost, audit, state in best]
        self.rows = []

    def finish(self) -> None:
        if self.letters is None:
            self.settle(True)
            self.cost, self.audit = self.carried[0][0], "".join(self.settled)
            self.letters = iter(self.audit)
            self.seen.clear()

    def put(self, role: str, text: str, edit: str) -> None:
        if self.made is not None:
            self.made.append((self.id, self.place, role, text, edit))
        else:
            self.sha.update(f"{chr(10) if self.place else ''}{role}:{text}".encode())
        self.place += 1

    def fill(self) -> str:
        self.state = FILL[self.state]
        return NAMES[self.state]

    def text(self, role: str, text: str) -> None:
        self.finish()
        while (letter := next(self.letters)) == "I":
            self.put(self.fill(), "", "I")
        if letter == "K":
            self.state = KEEP[self.state][role[:1]]
            self.put(role, text, letter)
        elif letter == "R":
            self.put(self.fill(), text, letter)

    def result(self) -> tuple:
        self.finish()
        for _ in self.letters:
            self.put(self.fill(), "", "I")
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, MOST_LONG)
        return (self.id, gaps, self.faults["b"], self.faults["d"], self.faults["t"], self.illegal, self.cost, self.audit, self.sha.hexdigest())


COLUMNS = ("conv_id", "pass", "turn", "role", "initial", "blank", "truncated", "digest", "text")


def _streamed(block: int, turns: bool):
    """Of rows sorted by conversation, pass and order: one row of OUT a conversation, or its repaired turns."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int64()] * 2 + [pa.string()] * 3 if turns else [pa.int64()] * 7 + [pa.string()] * 2
        names = [c.split()[0] for c in (TURNS if turns else OUT).split(", ")]
        done: list[tuple] = []
        now: Conversation | None = None
        size = 0

        def batch_of():
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)
            done.clear()
            return out

        def ended():
            if now is not None:
                row = now.result()
                if not turns:
                    done.append(row)

        for batch in batches:
            for conv_id, step, turn, role, initial, blank, truncated, digest, text in zip(*(batch.column(c).to_pylist() for c in COLUMNS), strict=True):
                if step == 0:
                    ended()
                    size += len(now.audit) if now is not None else 0
                    now = Conversation(conv_id, block)
                    now.made = done if turns else None
                elif step == 1:
                    now.code(turn, initial, blank, truncated, digest)
                else:
                    now.text(role, text)
                    size += len(text) if turns else 0
                if done and (len(done) >= 2000 or size > 4 << 20):
                    yield batch_of()
                    size = 0
        ended()
        if done:
            yield batch_of()

    return run


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of rows, with one row in 20 each dropped, emptied, without its full stops, twice, or of role user.

    What happens to a row follows from crc32 of `conv_id:turn`; nulls of role and text, and in that key, are one space.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    plain = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), F.pmod(F.crc32(key.cast("binary")), F.lit(20)).alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
    return plain.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), copies))).drop("col")


def repaired_turns(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The repaired conversations, a row of TURNS each: place counts from 0, edit is K, R or I; see repair()."""
    return _sorted(rows, rows).mapInArrow(_streamed(block, True), TURNS)


def repair(rows: DataFrame, ids: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """One row of OUT for each conv_id of rows (conv_id, turn, role, text) and of ids (conv_id).

    Rows are taken by turn, nulls first, then role, then the text's digest; a
    null role or text counts as one space. The first fault of a row counts:
    blank, duplicate (role and text seen earlier; equal SHA-256 counts as
    equal), truncated (no full stop at the end). Keeping a row is free, another
    role costs 1, deleting 2 (blank and duplicate rows must go), inserting an
    empty turn 5, a truncated row that stays 5 more. audit has the initials of
    the cheapest edits (Delete, Insert, Keep, Rerole), the least of equally
    cheap ones, after which role initials are `(s?(ua)+)?`. gaps counts turns
    missing between the smallest and the largest one that isn't null (at most
    the largest long).

    A conversation without rows gets zeros, an empty audit and the digest of
    the empty text. A null conv_id is a conversation too. An empty table gives
    an empty result; other columns aren't read. A conversation is one task's
    work, as its digest is one sequence of bytes; its texts stream through.
    """
    heads = rows.select("conv_id") if ids is None else rows.select("conv_id").union(ids.select("conv_id"))
    return _sorted(rows, heads).mapInArrow(_streamed(block, False), OUT)


def _sorted(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """For each conversation of ids a row of pass 0, then a code for each of its rows in pass 1, then their texts in pass 2; each conversation in one partition."""
    ship(rows.sparkSession)
    space = F.lit(" ")
    plain = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    filled = plain.withColumns({"digest": digest, "by": F.unhex(F.sha2("text", 256))})
    blank = ~F.col("text").rlike(NOT_WHITE)
    none = F.lit(None)
    steps = F.array(
        F.struct(F.lit(1).alias("pass"), F.substring("role", 1, 1).alias("initial"), blank.alias("blank"), (~blank & ~F.col("text").rlike(ENDED)).alias("truncated"), "digest", none.cast("string").alias("text")),
        F.struct(F.lit(2).alias("pass"), none.cast("string").alias("initial"), none.cast("boolean").alias("blank"), none.cast("boolean").alias("truncated"), none.cast("binary").alias("digest"), "text"),
    )
    twice = filled.select("conv_id", "turn", "role", "by", F.inline(steps))
    heads = ids.select("conv_id").distinct()
    all_ = twice.unionByName(heads.withColumn("pass", F.lit(0)), allowMissingColumns=True)
    order = ["conv_id", "pass", F.asc_nulls_first("turn"), "role", "by"]
    return all_.repartition("conv_id").sortWithinPartitions(*order).select(*COLUMNS)
