import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from evenkeel.llm.conversations import CUT, FORCED, cheapest_edits, repair, repair_report
from evenkeel.llm.q_conversations import damaged, op12_conversations

DATA = "/root/testdata"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}
LETTERS = "xsua"


def least(turns):
    """(cost, edits) by trying all states, turn by turn; turns: (initial, forced, cut)."""
    best = {"": (0, "")}
    for k in range(len(turns) + 1):
        for _ in range(6):  # inserted turns before this one
            for state, (cost, path) in list(best.items()):
                way = (cost + 2, path + "I")
                best[NEXT[state]] = min(best.get(NEXT[state], way), way)
        if k == len(turns):
            break
        initial, forced, cut = turns[k]
        after = {}
        for state, (cost, path) in best.items():
            ways = [(state, cost + 3, "D")]
            if not forced:
                ways.append((NEXT[state], cost + 2 + cut, "R"))
                if initial == NEXT[state] or (state == "" and initial == "s"):
                    ways.append((initial, cost + cut, "K"))
            for to, c, letter in ways:
                way = (c, path + letter)
                after[to] = min(after.get(to, way), way)
        best = after
    return min(best[s] for s in ("", "a") if s in best)


def codes_of(turns):
    return bytes(LETTERS.index(i) | (FORCED if f else 0) | (CUT if c else 0) for i, f, c in turns)


@pytest.mark.parametrize("block", [1, 2, 3, 7, 256])
def test_cheapest_edits_against_all_ways(block):
    rng = random.Random(block)
    for _ in range(1500):
        usual = rng.random()
        turns = []
        for k in range(rng.randrange(0, 14)):
            initial = "ua"[k % 2] if rng.random() < usual else rng.choice(LETTERS)
            forced = rng.random() < 0.2
            turns.append((initial, forced, not forced and rng.random() < 0.2))
        assert cheapest_edits(codes_of(turns), block) == least(turns), turns


def test_long_conversations():
    rng = random.Random(5)
    for chance in (0.05, 0.5):
        turns = [("ua"[k % 2] if rng.random() > chance else rng.choice(LETTERS), rng.random() < 0.05, False) for k in range(3000)]
        assert cheapest_edits(codes_of(turns)) == least(turns)
    for letter in "xsua":
        turns = [(letter, False, False)] * 1500
        assert cheapest_edits(codes_of(turns)) == least(turns)


def brute(rows, ids=()):
    """Report by conversation of rows (conv, turn, role, text) that are already in order."""
    groups = defaultdict(list)
    for conv in ids:
        groups[conv]
    for conv, turn, role, text in rows:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, turns in groups.items():
        seen, faults = set(), []
        for _, role, text in turns:
            end = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in turns]
        cost, audit = least([(i if i and i in "sua" else "x", f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, faults)])
        lines, state, at = [], "", iter(turns)
        for edit in audit:
            if edit == "I":
                state = NEXT[state]
                lines.append(NAMES[state] + ":")
                continue
            _, role, text = next(at)
            if edit == "K":
                state = role[0]
                lines.append(f"{role}:{text}")
            elif edit == "R":
                state = NEXT[state]
                lines.append(f"{NAMES[state]}:{text}")
        told = [t for t, _, _ in turns if t is not None]
        gaps = max(told) - min(told) + 1 - len(set(told)) if told else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def harmed(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        harm = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
        row = (conv, turn, "user" if harm == 4 else role, "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text)
        out += [row] * (0 if harm == 0 else 2 if harm == 3 else 1)
    return out


def report(df):
    got = df.collect()
    by_id = {r.conv_id: tuple(r)[1:] for r in got}
    assert len(by_id) == len(got)
    return by_id


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_query(spark, sf):
    table = spark.read.parquet(f"{DATA}/{sf}/conversations.parquet")
    rows = sorted((tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()), key=lambda r: r[:2])
    assert report(op12_conversations(spark, f"{DATA}/{sf}")) == brute(harmed(rows), {r[0] for r in rows})


def sha(role, text):
    role, text = (" " if v is None else v for v in (role, text))
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def ordered(rows):
    return sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, sha(*r[2:])))


SCHEMA = "conv_id long, turn long, role string, text string, conv string, phase string, digest string, n int, step int"
ROWS = [
    (1, 0, "system", "Be brief."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello!"), (1, 3, "user", "Hi."), (1, 4, "assistant", "cut off"),
    (2, None, None, None), (2, None, "user", "a."), (2, None, "user", "a."), (2, None, "user", "b?"), (2, 5, "assistant", "\x85"), (2, 900, "", "x."),
    (3, 1, "tool", "t."), (3, 1, "User", "T."), (3, 2, "assistant", "\t\n\x0b\f\r "), (None, 4, "user", "null id."), (None, 4, "assistant", "y."),
    (4, 1, "user", "long " * 200_000 + "."), (4, 2, "assistant", "ü" * 300_000), (5, -3, "user", "q."), (5, 2**62, "assistant", "r."),
    (6, 1, "user:", "a."), (6, 2, "user", ":a."), (6, 3, "assistant", "first.\nsecond."),
    *[(7, k, "user" if k % 2 else "assistant", "same.") for k in range(700)], *[(8, 1, "user", "tie.")] * 40, *[(8, 1, "assistant", f"tie {k}.") for k in range(9)],
]


def test_rows_of_all_kinds(spark):
    df = spark.createDataFrame([(*r, "clash", "clash", "clash", 1, 1) for r in ROWS], SCHEMA).repartition(5)
    ids = spark.createDataFrame([(i,) for i in (1, 99, 99, None)], "conv_id long")
    assert report(repair_report(df, ids)) == brute(ordered(ROWS), [1, 99, None])
    assert report(repair_report(df)) == brute(ordered(ROWS))
    assert report(repair_report(damaged(df), df.select("conv_id"))) == brute(ordered(harmed(ROWS)), {r[0] for r in ROWS})
    assert repair_report(df.limit(0)).count() == 0 and repair(df.limit(0)).count() == 0
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert report(repair_report(df.limit(0), ids)) == {1: empty, 99: empty, None: empty}


def test_repaired_turns(spark):
    df = spark.createDataFrame([(*r, "clash", "clash", "clash", 1, 1) for r in ROWS], SCHEMA).repartition(5)
    expected = brute(ordered(ROWS))
    lines = defaultdict(dict)
    for r in repair(df).collect():
        lines[r.conv_id][r.step] = r
    for conv, (*_, audit, digest) in expected.items():
        turns = [lines[conv][k] for k in sorted(lines[conv])]
        assert [r.step for r in turns] == list(range(1, len(turns) + 1))
        assert "".join(r.edit for r in turns) == audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in turns).encode()).hexdigest() == digest
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in turns))
        assert all((r.turn is None and r.text == "") or r.edit != "I" for r in turns)
