"""Repair of conversations: the search against a plain table of best ways, segments against the whole."""

import hashlib
import random
import zlib

import brute
import pytest

from tidemark.llm import repair
from tidemark.llm.repair import Row, apply, search

SCHEMA = "conv_id bigint, turn bigint, role string, text string, times string, kept string, gaps int"


def ways(rows: list[Row]) -> tuple[int, str]:
    """Best (cost, audit) by trying every edit of every row from every state."""

    def inserted(best):
        for _ in range(3):
            for s, (cost, audit) in list(best.items()):
                then, way = {0: 2, 1: 2, 2: 3, 3: 2}[s], (cost + 5, audit + "I")
                best[then] = min(way, best.get(then, way))
        return best

    best = inserted({0: (0, "")})
    for row in rows:
        after = {}
        for s, (cost, audit) in best.items():
            options = [(s, cost + 2, "D")]
            if row.fault not in ("blank", "duplicate"):
                more = cost + (5 if row.fault else 0)
                for c, then in {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[s].items():
                    options += [(then, more, "K")] if c == row.initial else []
                    options += [(then, more + 1, "R")] if c != "s" else []
            for then, spent, edit in options:
                after[then] = min((spent, audit + edit), after.get(then, (spent, audit + edit)))
        best = inserted(after)
    return min(best[s] for s in (0, 3) if s in best)


def drawn(draw: random.Random, n: int) -> list[Row]:
    initials = draw.choice(["sua", "uuaaas", "sx", "u", "a", ["", "u"]])
    return [Row(draw.choice(initials), draw.choice([None] * 3 + ["blank", "duplicate", "truncated", "truncated"])) for _ in range(n)]


@pytest.mark.parametrize("seed", range(20))
def test_search(seed):
    draw = random.Random(seed)
    for _ in range(200):
        rows = drawn(draw, draw.randint(0, 10))
        assert search(rows) == ways(rows)


def test_long_search():
    draw = random.Random(7)
    for _ in range(20):
        rows = drawn(draw, 500)
        assert search(rows) == ways(rows)


def plain(rows: list[tuple]) -> dict:
    """The contract row by row: conv_id to (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256)."""
    chats = {}
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        chat = chats.setdefault(conv, [])
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        chat += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, chat in chats.items():
        chat.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in chat:
            last = text.strip(" \t\n\x0b\x0c\r")[-1:]
            faults.append("blank" if not last else "duplicate" if (role, text) in seen else None if last in ".!?" else "truncated")
            seen.add((role, text))
        turns = {t for t, _, _ in chat if t is not None}
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(chat, chat[1:])]
        cost, audit = ways([Row(role[:1], f) for (_, role, _), f in zip(chat, faults)])
        kept = "\n".join(f"{r}:{t}" for r, t in apply(audit, [c[1:] for c in chat], 0))
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(kept.encode()).hexdigest(),
        )
    return out


def awkward() -> list[tuple]:
    draw = random.Random(3)
    texts = ["Yes.", "no", "", " \t\n", None, "What?", "Cut off", "東京!", "x" * 200_000 + ".", "a ", "Yes.", ".!?"]
    roles = ["user", "assistant", "system", None, "", "tool", "User", "user", "assistant"]
    return [
        (draw.choice([None, -3, *range(60)]), draw.choice([None, *range(9)]), draw.choice(roles), draw.choice(texts)) for _ in range(600)
    ]


def found(spark, rows: list[tuple]) -> dict:
    df = spark.createDataFrame([(*r, "t", "k", 1) for r in rows], SCHEMA).repartition(7)
    damaged = repair.damage(df)
    return {r["conv_id"]: (*tuple(r)[1:-1], bytes(r["kept"]).hex()) for r in repair.repair(damaged, digest=True).collect()}


def test_awkward_rows(spark):
    rows = awkward()
    assert found(spark, rows) == plain(rows)


def test_long_conversation_in_segments(spark):
    draw = random.Random(5)
    rows = [(1, k // 2, draw.choice(["user", "assistant", "system"]), draw.choice(["One.", "Two", f"{k}.", f"{k}?", ""])) for k in range(3000)]
    assert found(spark, rows) == plain(rows)


def test_repaired_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (2, 0, "assistant", "Well.")], "conv_id bigint, turn int, role string, text string")
    kept = {r["conv_id"]: (r["cost"], r["audit"], [tuple(k) for k in r["kept"]]) for r in repair.repair(df).collect()}
    assert kept == {1: (4, "DD", []), 2: (2, "D", [])}
    assert repair.repair(df.limit(0)).collect() == [] == repair.repair(repair.damage(df.limit(0)), digest=True).collect()
    assert brute.ordered(repair.damage(df).columns) == brute.ordered(["conv_id", "turn", "role", "text", "times"])
