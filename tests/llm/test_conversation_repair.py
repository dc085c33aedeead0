import hashlib
import itertools
import random
import re
import zlib

import pytest

from flowguard.llm import conversation_repair as cr
from flowguard.llm.conversation_repair import block_paths, block_table, choose, repair, repair_conversations, summarise
from flowguard.llm.queries import op13_conversation_repair
from tests.llm.util import SF01, read

LEGAL = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def spelled(audit, initials, faults):
    """(cost, initials, reroled and inserted roles free) of an audit: all role sequences it can give."""
    results = {""}
    cost, i = 0, 0
    for e in audit:
        if e == "I":
            results = {r + x for r in results for x in "ua"}
            cost += 3
            continue
        if i >= len(initials):
            return None
        bad = faults[i] in ("blank", "duplicate")
        if e != "D" and bad:
            return None
        cost += {"D": 4, "K": 0, "R": 3}[e] + (3 if faults[i] == "truncated" and e != "D" else 0)
        if e == "K":
            results = {r + initials[i] for r in results}
        elif e == "R":
            results = {r + x for r in results for x in "ua"}
        i += 1
    return (cost, results) if i == len(initials) else None


def exhaustive(initials, faults):
    """Every audit up to a length, tried in full."""
    best = None
    for n in range(len(initials), len(initials) + 4):
        for audit in itertools.product("DIKR", repeat=n):
            audit = "".join(audit)
            got = spelled(audit, initials, faults)
            if got and any(LEGAL.fullmatch(r) for r in got[1]):
                if best is None or (got[0], audit) < best:
                    best = (got[0], audit)
    return best


def layered(initials, faults):
    """Plain dynamic programming over turns, for longer inputs."""
    ways = block_paths(initials, faults, 0) if initials else {0: (0, "")}
    out = []
    for s, (cost, audit) in ways.items():
        k = 0
        while s not in (0, 3):
            s, k = {1: 2, 2: 3}[s], k + 1
        out.append((cost + 3 * k, audit + "I" * k))
    return min(out)


def random_turns(rnd, n):
    return (tuple(rnd.choice("uuuaaasx ") for _ in range(n)),
            tuple(rnd.choice([None, None, None, "blank", "duplicate", "truncated"]) for _ in range(n)))


def test_repair_equals_trying_everything():
    rnd = random.Random(3)
    assert repair((), ()) == (0, "")
    for n in (1, 2, 3):
        for _ in range(60):
            turns = random_turns(rnd, n)
            assert repair(*turns) == exhaustive(*turns), turns
    for _ in range(4):
        turns = random_turns(rnd, 4)
        assert repair(*turns) == exhaustive(*turns), turns


def test_repair_equals_layers_and_blocks():
    rnd = random.Random(4)
    for _ in range(400):
        turns = random_turns(rnd, rnd.randint(0, 40))
        want = layered(*turns)
        assert repair(*turns) == want
        size = rnd.randint(1, 9)
        parts = [(turns[0][i:i + size], turns[1][i:i + size]) for i in range(0, len(turns[0]), size)]
        ways = choose([block_table(*p) for p in parts])
        got = [block_paths(*p, e)[m] for p, (e, m) in zip(parts, ways)]
        end = cr._to_end(ways[-1][1]) if ways else 0
        assert (sum(c for c, _ in got) + 3 * end, "".join(a for _, a in got) + "I" * end) == want


def crc(s):
    return zlib.crc32(s.encode()) % 20


def show(v):
    return " " if v is None else str(v)


def brute(rows, damaged=True):
    """rows (conv_id, turn, role, text) -> the query's rows."""
    out = {}
    for c in {r[0] for r in rows}:
        turns = []
        for _, t, r, x in (r for r in rows if r[0] == c):
            k, r, x = crc(f"{show(c)}:{show(t)}") if damaged else 9, show(r), show(x)
            if k == 0:
                continue
            x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
            turns += [(t, "user" if k == 4 else r, x)] * (2 if k == 3 else 1)
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        faults, seen = [], set()
        for _, r, x in turns:
            body = x.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not body else "duplicate" if (r, x) in seen else "truncated" if body[-1] not in ".!?" else None)
            seen.add((r, x))
        first = [r[:1] for _, r, _ in turns]
        cost, audit = layered(first, faults)
        left = []
        state, i = 0, 0
        for e in audit:
            role = {0: "user", 1: "user", 2: "assistant", 3: "user"}[state]
            if e == "I":
                left.append(role + ":")
            elif e != "D":
                left.append((role if e == "R" else turns[i][1]) + ":" + turns[i][2])
            i += e != "I"
            if e != "D":
                state = {"s": 1, "u": 2, "a": 3}[left[-1][0]]
        nums = [t for t, _, _ in turns if t is not None]
        out[c] = (max(nums) - min(nums) + 1 - len(set(nums)) if nums else 0,
                  *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                  sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit,
                  hashlib.sha256("\n".join(left).encode()).hexdigest())
    return out


def test_given_table(spark):
    rows = [tuple(r) for r in read(spark, "conversations", SF01).select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in op13_conversation_repair(spark, SF01).collect()}
    assert got == brute(rows)
    assert len({g[6] for g in got.values()}) > 30


@pytest.mark.parametrize("long", [cr.LONG, 7])
def test_odd_rows_and_long_conversations(spark, long):
    """Blocks of 7 turns give what one task gives."""
    rnd = random.Random(long)
    texts = ["Fine.", "Fine. ", "cut", "", " \n\t", None, "é? ", "a.\nb", "What!", "."]
    rows = [(rnd.choice([None, 1, 2, 3]), rnd.choice([None, *range(-3, 60)]), rnd.choice(["user", "assistant", "system", "tool", "", None]),
             rnd.choice(texts) if rnd.random() < 0.5 else f"text {rnd.random()}{rnd.choice('.!?x')}") for _ in range(200)]
    rows += [(4, t, ["user", "assistant"][t % 2], f"turn {t}.") for t in range(60)] + [(5, None, "user", "one.")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS _key", "2 AS fault", "3 AS block", "4 AS position")
    turns = repair_conversations(df.repartition(5), long=long)
    got = {r["conv_id"]: r for r in summarise(turns).collect()}
    want = brute(rows, damaged=False)
    assert set(got) == set(want)
    for c, w in want.items():
        r = got[c]
        assert (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"],
                hashlib.sha256(r["repaired"].encode()).hexdigest()) == w, c
    assert turns.where("edit = 'I' AND text != ''").count() == 0


def test_empty_and_dropped(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    assert repair_conversations(none).collect() == [] and summarise(repair_conversations(none)).collect() == []
    # conversations whose only turn is dropped stay in the result
    gone = [c for c in range(400) if crc(f"{c}:0") == 0][:3]
    rows = [(c, 0, "user", "x.") for c in gone] + [(None, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r[0]: tuple(r)[1:] for r in op13_conversation_repair(spark, str(tmp_path)).collect()}
    assert got == brute(rows) and got[gone[0]] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
