"""Conversation repair against a plain search over all prefixes, in small and in many blocks."""

import random
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from qaloom.llm import repair

SCHEMA = "conv bigint, turn bigint, role string, text string"


def plain(rows):
    """cost, audit and repaired text of one conversation, and its faults, by strings built from the end."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], sha256(r[3].encode()).hexdigest()))
    seen, kinds = set(), []
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        kinds.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turn, name = [2, 2, 3, 2], {2: "user", 3: "assistant"}

    def insert(v):
        return [min(v[x], (v[turn[x]][0] + 5, "I" + v[turn[x]][1], [f"{name[turn[x]]}:"] + v[turn[x]][2])) for x in range(4)]

    far = 10**9
    v = insert(insert(insert([(0, "", []), (far, "", []), (far, "", []), (0, "", [])])))
    for (_, _, role, text), kind in zip(reversed(rows), reversed(kinds)):
        now = []
        for x in range(4):
            arcs = [(v[x][0] + 2, "D" + v[x][1], v[x][2])]
            if kind not in ("blank", "duplicate"):
                more, c = 5 * (kind == "truncated"), role[:1]
                y = {"s": 1 if x == 0 else None, "u": 2 if x != 2 else None, "a": 3 if x == 2 else None}.get(c)
                if y is not None:
                    arcs.append((v[y][0] + more, "K" + v[y][1], [f"{role}:{text}"] + v[y][2]))
                y = turn[x]
                arcs.append((v[y][0] + 1 + more, "R" + v[y][1], [f"{name[y]}:{text}"] + v[y][2]))
            now.append(min(arcs))
        v = insert(insert(insert(now)))
    turns = [t for _, t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    counts = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), v[0][0], v[0][1], sha256("\n".join(v[0][2]).encode()).hexdigest())


def check(spark, rows, everyone=None):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"pos": F.lit(1), "digest": F.lit(1), "block": F.lit(1), "total": F.lit(1)})
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.repair(df, everyone or df).collect()}
    own = {}
    for r in rows:
        own.setdefault(r[0], []).append((r[0], r[1], " " if r[2] is None else r[2], " " if r[3] is None else r[3]))
    for conv, some in own.items():
        assert got[conv] == plain(some), conv
    return got, df


def some_rows(rng, conv, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "u", "Agent"]
    texts = ["Yes.", "no", "", " \n", "What?", "é!", "ok ok", "same.", "a.\x85", "tail .\t"]
    out = []
    for t in range(n):
        turn = None if rng.random() < 0.03 else t + rng.choice([0, 0, 0, 1])
        out.append((conv, turn, rng.choice(roles + [None]), rng.choice(texts + [None, f"t{rng.randrange(9)}."])))
    return out


def test_short_conversations(spark):
    rng = random.Random(3)
    rows = [r for conv in range(400) for r in some_rows(rng, conv, rng.randrange(1, 9))]
    rows += [(None, 1, "user", "hi."), (None, 2, "assistant", "x" * 500_000), (900, None, None, None)]
    rows += [(901, t, "system", f"s{t}.") for t in range(5)]
    all_ = spark.createDataFrame([*rows, (950, 1, "user", "gone.")], SCHEMA)
    got, df = check(spark, rows, all_)
    assert got[950] == (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
    fixed = {}
    for r in repair.repaired_rows(df, repair.plan(repair.placed(df))).collect():
        fixed.setdefault(r["conv"], []).append((r["place"], f"{r['role']}:{r['text']}", r["edit"]))
    for conv, row in got.items():
        lines = sorted(fixed.get(conv, []))
        assert sha256("\n".join(x[1] for x in lines).encode()).hexdigest() == row[-1]
        assert "".join(x[2] for x in lines) == row[-2].replace("D", "")
    empty = df.limit(0)
    assert repair.repair(empty, empty).count() == 0 and repair.repair(empty, df).filter("audit = ''").count() == len(got) - 1


@pytest.mark.parametrize("block", [2, 3])
def test_conversations_of_many_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rng = random.Random(block)
    rows = [r for conv in range(30) for r in some_rows(rng, conv, rng.randrange(1, 40))]
    check(spark, rows)


def test_hot_conversation(spark):
    rng = random.Random(8)
    rows = some_rows(rng, 1, 2600) + some_rows(rng, 2, 5)
    check(spark, rows)


def test_damage(spark):
    rows = [(conv, turn, "assistant", "A. b! c?") for conv in range(30) for turn in range(20)] + [(None, None, None, None)]
    import zlib

    want = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role or " ", text or " "
        row = (conv, turn, "user" if kind == 4 else role, {1: "", 2: text.translate(str.maketrans("", "", ".!?"))}.get(kind, text))
        want += [row] * {0: 0, 3: 2}.get(kind, 1)
    got = [tuple(r) for r in repair.damaged(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_ranks_order_audits():
    rng = random.Random(5)
    n = 60
    arcs = sorted({(x, rng.randrange(4)): rng.randrange(x + 1, n + 1) for x in range(n) for _ in range(2)}.items())
    node, letter, target = (np.array(v) for v in zip(*[(x, c, y) for (x, c), y in arcs]))
    pointer, best = repair.ranked(letter, target, node, n + 1)
    for x in range(n + 1):
        here = x
        while best[here] >= 0:
            assert letter[best[here]] == min(letter[node == here])
            here = target[best[here]]
        assert here == pointer[x] == n
