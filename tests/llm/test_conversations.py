import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, pass int, digest string"
NAMES = {"u": "user", "a": "assistant"}


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def faults_of(rows):
    """rows: (role, text) in order."""
    seen, out = set(), []
    for role, text in rows:
        last = re.sub("[\x20\x09-\x0d]", "", text)[-1:]
        out.append("b" if not last else "d" if (role, text) in seen else "" if last in ".!?" else "t")
        seen.add((role, text))
    return out


def brute(rows, most=3):
    """(cost, audit, repaired) by trying every sequence of edits with up to `most` insertions before each row and at the end."""
    faults = faults_of(rows)
    best = None
    fills = [f for n in range(most + 1) for f in itertools.product("ua", repeat=n)]

    def go(i, cost, audit, made):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        initials = "".join(r[:1] or "-" for r, _ in made)
        if not re.fullmatch(r"(s?(ua)*u?)?", initials):
            return
        for fill in fills:
            c, a, m = cost + 5 * len(fill), audit + "I" * len(fill), made + [(NAMES[x], "") for x in fill]
            if i == len(rows):
                if re.fullmatch(r"(s?(ua)+)?", "".join(r[:1] for r, _ in m)) and (best is None or (c, a) < best[:2]):
                    best = (c, a, m)
                continue
            (role, text), fault = rows[i], faults[i]
            go(i + 1, c + 2, a + "D", m)
            if fault in ("", "t"):
                more = 5 if fault else 0
                go(i + 1, c + more, a + "K", m + [(role, text)])
                for x in "ua":
                    go(i + 1, c + more + 1, a + "R", m + [(NAMES[x], text)])

    go(0, 0, "", [])
    return best


def expected(rows):
    """What repair() gives for rows (conv_id, turn, role, text)."""
    by = defaultdict(list)
    for c, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        by[c].append((turn is not None, turn or 0, role, hashlib.sha256(text.encode()).digest(), text))
    out = {}
    for c, mine in by.items():
        mine.sort()
        plain = [(r[2], r[4]) for r in mine]
        n = Counter(faults_of(plain))
        turns = {r[1] for r in mine if r[0]}
        pairs = [a[:1] + b[:1] for (a, _), (b, _) in itertools.pairwise(plain)]
        cost, audit, made = brute(plain)
        out[c] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, n["b"], n["d"], n["t"], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha("\n".join(f"{r}:{t}" for r, t in made)))
    return out


def got(df):
    out = {r[0]: tuple(r)[1:] for r in df.select(*(c.split()[0] for c in cr.OUT.split(", "))).collect()}
    assert len(out) == df.count()
    return out


@pytest.fixture(scope="module")
def talks(spark):
    draw = np.random.default_rng(3)
    texts = ["Yes.", "No!", "cut off", " \t\n", "", None, "What? \x0b", "é 日本。", "a. ", "Yes."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "unsure"]
    rows = [(c, int(t) if draw.random() > 0.1 else None, str(r) if (r := roles[draw.integers(9)]) is not None else None, texts[draw.integers(10)]) for c in range(150) for t in draw.integers(0, 6, draw.integers(1, 6))]
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (-1, None, None, None), (-2, 5, "system", "Only."), (-3, -(2**63), "user", "Low."), (-3, 2**63 - 1, "assistant", "High.")]
    return rows, spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(5).cache()


@pytest.mark.parametrize("block", [cr.BLOCK, 2, 1])
def test_the_cheapest_edits_are_found(talks, block):
    rows, table = talks
    want = expected(rows)
    want[-3] = (2**63 - 1, *want[-3][1:])  # at most the largest long
    assert got(cr.repair(table, block=block)) == want
    assert {x for w in want.values() for x in w[6]} == set("DKR")  # an insertion never pays: what it would pair with goes for less


def test_blocks_of_a_long_conversation_give_what_one_search_gives():
    draw = np.random.default_rng(8)
    for n in (1, 7, 300, 700):
        rows = [("sua?"[draw.integers(4)], ["", "", "", "b", "d", "t"][draw.integers(6)]) for _ in range(n)]
        want = min(cr.search(rows, [(0, "", cr.START)], True).values())
        for block in (1, 5, 64, 512):
            talk = cr.Conversation(1, block)
            talk.seen.add(b"same")
            for k, (initial, fault) in enumerate(rows):
                talk.code(k, initial, fault == "b", fault == "t", b"same" if fault == "d" else bytes(str(k), "ascii"))
            talk.finish()
            assert (talk.cost, talk.audit) == want


def test_insertions_are_tried_where_deleting_is_dear(monkeypatch):
    """With other costs, insertions win; blocks agree with brute force there, too."""
    monkeypatch.setattr(cr, "INSERT", 1)
    draw = np.random.default_rng(2)
    seen = set()
    for _ in range(60):
        rows = [("sua"[draw.integers(3)], ["", "", "t", "b"][draw.integers(4)]) for _ in range(int(draw.integers(0, 7)))]
        want = min(cr.search(rows, [(0, "", cr.START)], True).values())
        best = min(every_way(rows))
        assert want == best
        seen |= set(want[1])
        for block in (1, 2, 3):
            talk = cr.Conversation(1, block)
            for k, (initial, fault) in enumerate(rows):
                talk.code(k, initial, fault == "b", fault == "t", bytes([k]))
            talk.finish()
            assert (talk.cost, talk.audit) == want
    assert "I" in seen


def every_way(rows):
    """(cost, audit) of all edits with at most two insertions of cost 1 at a place."""
    out = [(0, "", "")]
    for initial, fault in [*rows, (None, None)]:
        step = []
        for cost, audit, made in out:
            for fill in ("", "u", "a", "ua", "au"):
                c, a, m = cost + len(fill), audit + "I" * len(fill), made + fill
                if initial is None:
                    if re.fullmatch("(s?(ua)+)?", m):
                        step.append((c, a, m))
                    continue
                step.append((c + 2, a + "D", m))
                if fault != "b":
                    more = 5 if fault else 0
                    step += [(c + more, a + "K", m + initial), (c + more + 1, a + "R", m + "u"), (c + more + 1, a + "R", m + "a")]
        best = {}
        for c, a, m in step:
            if re.fullmatch("(s?(ua)*u?)?", m):
                state = (m[-1:], m == "s")
                best[state] = min(best.get(state, (c, a, m)), (c, a, m))
        out = list(best.values())
    return [(c, a) for c, a, _ in out]


def test_a_search_settles_each_state_once_and_never_overestimates():
    rows = [("u", ""), ("u", "t"), ("a", "b"), ("s", ""), ("a", "t"), ("u", "d")]
    every = cr.search(rows, [(0, "", cr.START)], False)
    assert set(every) == {0, 2, 3} | ({1} & set(every))
    for state, (cost, audit) in every.items():
        assert sum({"D": 2, "I": 5, "R": 1, "K": 0}[x] for x in audit) <= cost and len(audit.replace("I", "")) == len(rows), state


def damaged(rows):
    for c, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        if k:
            row = (c, turn, "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text)
            yield from [row] * (1 + (k == 3))


def test_damage(talks, spark):
    rows, table = talks
    assert Counter(tuple(r) for r in cr.damage(table).collect()) == Counter(damaged(rows))
    lost = [(c, 0, "user", "Hi.") for c in range(60)]
    table = spark.createDataFrame([(*r, 1, "x") for r in lost], SCHEMA)
    out = got(cr.repair(cr.damage(table), table))
    want = expected(list(damaged(lost))) | {c: (0, 0, 0, 0, 0, 0, "", sha("")) for c in range(60) if not zlib.crc32(f"{c}:0".encode()) % 20}
    assert out == want and len(want) == 60 and any(w[6] == "" for w in want.values())


def test_a_hot_conversation(spark):
    rows = [(7, i // 3, ("user", "assistant", "user")[i % 3], f"Text {i % 900}" + (" \n" if i % 5 else ".")) for i in range(6000)]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(4)
    (one,) = cr.repair(table).collect()
    plain = [(r[2], r[3]) for r in sorted(rows, key=lambda r: (r[1], r[2], hashlib.sha256(r[3].encode()).digest()))]
    whole = cr.search([(r[:1], f) for (r, _), f in zip(plain, faults_of(plain), strict=True)], [(0, "", cr.START)], True)
    assert (one.cost, one.audit) == min(whole.values())
    assert (one.blank, one.duplicate + one.truncated + faults_of(plain).count("")) == (0, 6000)


def test_repaired_turns_are_what_the_digest_is_of(talks):
    rows, table = talks
    by = defaultdict(list)
    for r in cr.repaired_turns(table).collect():
        by[r.conv_id].append((r.place, f"{r.role}:{r.text}", r.edit))
    for c, out in got(cr.repair(table)).items():
        mine = sorted(by[c])
        assert sha("\n".join(x for _, x, _ in mine)) == out[7]
        assert [p for p, _, _ in mine] == list(range(len(mine))) and "".join(e for _, _, e in mine) == out[6].replace("D", "")


def test_no_conversations(spark):
    assert cr.repair(spark.createDataFrame([], SCHEMA)).count() == 0
