"""Conversation repair against a plain table of least (cost, audit) for every row and state."""

import hashlib
import random
import re
import zlib

import pytest

from tabulyst.llm import conversations, queries
from tabulyst.llm.common import ship

AFTER = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
NEEDS = {0: "u", 1: "u", 2: "a", 3: "u"}
NAMES = {"u": "user", "a": "assistant"}


def best(rows):
    """(cost, audit, repaired lines) of rows (role, text, fault); least cost, then least audit."""
    never = (1 << 60, "", ())
    later = None
    for i in range(len(rows), -1, -1):
        base = []
        for s in range(4):
            options = []
            if i == len(rows):
                options += [(0, "", ())] if s in (0, 3) else []
            else:
                role, text, fault = rows[i]
                c, w, out = later[s]
                options.append((c + 3, "D" + w, out))
                if fault not in ("blank", "duplicate"):
                    more = fault == "truncated"
                    if s in AFTER.get(role[:1], {}):
                        c, w, out = later[AFTER[role[:1]][s]]
                        options.append((c + more, "K" + w, (f"{role}:{text}", *out)))
                    for initial, name in NAMES.items():
                        if s in AFTER[initial]:
                            c, w, out = later[AFTER[initial][s]]
                            options.append((c + 2 + more, "R" + w, (f"{name}:{text}", *out)))
            base.append(min(options, default=never))
        now = base
        for _ in range(4):
            now = [min(base[s], (now[AFTER[NEEDS[s]][s]][0] + 2, "I" + now[AFTER[NEEDS[s]][s]][1],
                                 (f"{NAMES[NEEDS[s]]}:", *now[AFTER[NEEDS[s]][s]][2]))) for s in range(4)]
        later = now
    return later[0]


def report(conv_id, rows):
    """From (turn, role, text) after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, marked = set(), []
    for _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]+", "", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        marked.append((role, text, fault))
    cost, audit, lines = best(marked)
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    return {
        "conv_id": conv_id, "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{k: sum(f == k for _, _, f in marked) for k in ("blank", "duplicate", "truncated")},
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 4:
            role = "user"
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def expected(rows, damage=True):
    of = {r[0]: [] for r in rows}
    for conv, *rest in damaged(rows) if damage else rows:
        of[conv].append(rest)
    return sorted((report(conv, some) for conv, some in of.items()), key=str)


def got(df):
    return sorted((r.asDict() for r in df.collect()), key=str)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.registered()["op12_hirschberg_repair"](spark, folder)) == expected(rows)


def test_solve():
    rng = random.Random(1)
    for _ in range(3000):
        codes = bytes(rng.choice([3, 3, 6, 6, 0, 9]) + rng.choice([0, 0, 0, 1, 2]) for _ in range(rng.randint(0, 14)))
        rows = [("sua?"[c // 3], "t", (None, "truncated", "blank")[c % 3]) for c in codes]
        audit = conversations.solve(codes)
        assert (conversations._cost(codes, audit), audit) == best(rows)[:2]


SCHEMA = "conv_id long, turn long, role string, text string, audit string, block long, copies int"


def wild(rng, conv, n):
    return [(conv, rng.choice([None, *range(-3, n)]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"]),
             rng.choice([None, "", " \t", "Yes.", "Yes.", "no", "cut ", "Well!\n", "ok?\x0b", "é…", "long " * 50])) for _ in range(n)]


@pytest.mark.parametrize("block", [3, 4096])
def test_odd_rows(spark, monkeypatch, block):
    ship(spark)
    monkeypatch.setattr(conversations, "COPIES", 4)
    rng = random.Random(block)
    rows = [r for conv in [None, *range(12)] for r in wild(rng, conv, rng.randint(1, 25))]
    rows += [(50, 1, "user", "Again.")] * 30 + wild(rng, 60, 300)
    table = spark.createDataFrame([(*r, "a", 1, 2) for r in rows], SCHEMA).repartition(3)
    assert got(conversations.damage_and_repair(table, block)) == expected(rows)
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    pieces = conversations.repair(table, block)
    assert got(conversations.reports(table, block)) == expected(plain, damage=False)
    lines = {}
    for r in conversations.repaired_turns(pieces).orderBy("conv_id", "block", "place").collect():
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for r in expected(plain, damage=False):
        assert hashlib.sha256("\n".join(lines.get(r["conv_id"], [])).encode()).hexdigest() == r["repaired_sha256"]
    assert conversations.damage_and_repair(table.filter("false")).collect() == []


def test_all_dropped(spark):
    ship(spark)
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    (row,) = conversations.damage_and_repair(table).collect()
    assert (row["cost"], row["audit"], row["repaired_sha256"]) == (0, "", hashlib.sha256(b"").hexdigest())
