"""Operator 13 against a search over all edits, row by row from the end."""

import hashlib
import random
import zlib
from functools import lru_cache

import numpy as np
import pytest

from pagelake.llm import turn_repair

WHITE = " \t\n\x0b\f\r"


def after_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 1:
            text = ""
        if code == 2:
            text = text.translate(str.maketrans("", "", ".!?"))
        if code == 4:
            role = "user"
        mine += [(turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(x[2].encode()).digest())) for c, r in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(WHITE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    """(cost, audit, repaired lines) of the cheapest, ASCII-least edits, by recursion over every edit."""
    kinds = faults(rows)

    def step(before, initial):
        legal = {"": "su", "s": "u", "u": "a", "a": "u"}[before]
        return initial if initial and initial in legal else None

    @lru_cache(None)
    def best(k, state, inserts):
        found = []
        if k == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        if inserts < 4:
            for name in ("user", "assistant"):
                to = step(state, name[0])
                if to:
                    c, a, lines = best(k, to, inserts + 1)
                    found.append((c + 2, "I" + a, (name + ":", *lines)))
        if k < len(rows):
            _, role, text = rows[k]
            c, a, lines = best(k + 1, state, 0)
            found.append((c + 3, "D" + a, lines))
            if kinds[k] not in ("blank", "duplicate"):
                for letter, name, price in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                    to = step(state, name[:1])
                    if to:
                        c, a, lines = best(k + 1, to, 0)
                        found.append((c + price + (kinds[k] == "truncated"), letter + a, (f"{name}:{text}", *lines)))
        return min(found, default=(1 << 50, "", ()))

    return best(0, "", 0)


def expected(rows):
    out = {}
    for conv, mine in after_damage(rows).items():
        kinds = faults(mine)
        turns = {t for t, _, _ in mine if t is not None}
        cost, audit, lines = brute(tuple(mine))
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(mine, mine[1:])]
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def random_rows(seed, convs=40, longest=14):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(convs), None]:
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "Über"])
            text = rng.choice(["Yes.", "What?", "no end", " \t", "", None, "same.", " ", "é! \n", "x" * 50])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 2, None]), role, text))
    return rows


def compare(df, rows):
    got = turn_repair.repair(turn_repair.damaged(df)).collect()
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert len(got) == len({r[0] for r in rows})
    assert {r.conv_id: tuple(r[n] for n in names) for r in got} == expected(rows)


@pytest.mark.parametrize("block", [4, 1 << 17])
def test_repair(spark, monkeypatch, block):
    rows = random_rows(block)
    monkeypatch.setattr(turn_repair, "BLOCK_ROWS", block)
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    clash = ["fault", "kind", "copies", "digest", "salt", "result", "cost"]
    compare(df.select("*", *[F.lit("x").alias(c) for c in clash]).repartition(3), rows)
    assert turn_repair.repair(turn_repair.damaged(df.limit(0))).count() == 0


def test_one_conversation_over_many_tasks(spark):
    rng = random.Random(1)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", f"text {t}.", f"cut {t}"])) for t in range(300)] + [(8, 1, "user", "x" * 300_000)]
    import sys

    sys.setrecursionlimit(5000)
    compare(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8), rows)


@pytest.mark.parametrize("seed", range(4))
def test_grammar_spells_what_plain_products_do(seed):
    """Matrices of grammar rules equal the row matrices multiplied one by one, audits included."""
    rng = np.random.default_rng(seed)
    lens = rng.integers(1, 60, 50)
    seqs = [rng.integers(0, 9 if k % 2 else 2, n) for k, n in enumerate(lens)] + [np.zeros(33, np.int64)]
    g = turn_repair.Grammar()
    symbol, held = g.compress(np.concatenate(seqs), np.repeat(np.arange(len(seqs)), [len(s) for s in seqs]))
    assert held.tolist() == list(range(len(seqs)))
    assert len(g.left) < sum(len(s) for s in seqs)  # rules are shared
    for s, seq in zip(symbol.tolist(), seqs):
        best = {(i, i): (0, "") for i in range(4)}
        for x in seq.tolist():
            now = {}
            for (i, k), (c, a) in best.items():
                for j in range(4):
                    if turn_repair._PATHS[x][k][j]:
                        got = (c + turn_repair._PATHS[x][k][j][0], a + turn_repair._PATHS[x][k][j][1])
                        now[i, j] = min(now.get((i, j), got), got)
            best = now
        for (i, j), (c, a) in best.items():
            assert g.cost[s, i, j] == c and g.spell(np.array([s]), np.array([i]), np.array([j])) == [a]
