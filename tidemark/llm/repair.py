"""Conversation structure repair by depth-first branch and bound.

A conversation is legal when the initials of its roles read ``(s?(ua)+)?``. Its rows are edited at
least cost: keep (0), rerole to user or assistant (1), delete (2, required for blank rows and
duplicates), insert an empty user or assistant row anywhere (5). A truncated row that stays costs 5
more. The audit is the initials of the edits in order; of the cheapest audits the ASCII-least is taken.

**Search.** Nodes are (row, state of the grammar, cost, audit) on an explicit stack, the cheapest
edit on top. A node is cut when its cost and a lower bound on what is left (of the rows and from its
state, whatever the audit) exceed the incumbent's cost (or equal it with a later audit), and when the table of its row and state holds a prefix as
good: of two prefixes that read the same rows and end in the same state, with equal costs, neither
audit begins with the other (both name each row once, and an insertion costs), so the lesser stays
less whatever follows. The stack runs empty, so the incumbent is proved best. What it takes is
linear in the rows in practice; a conversation longer than ``SEGMENT`` rows is searched segment by
segment, from each state to each state, and the segments' answers are put together the same way.

Rows of a conversation are taken by turn, nulls first, then role, then text. A null role or text is
one space. Repeated rows are duplicates. Rows with a null conv_id form one conversation. An empty
table gives no rows; columns other than the four (and ``times``) are not read. Rows stream through
a sorted task: texts are held until the edits up to them are settled, so a conversation of any length needs
a segment or two of texts, and 16 bytes for each different row.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches, values

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
SEGMENT = 512
ENDINGS = ".!?"
_SPACES = " \t\n\x0b\x0c\r"

START, SYSTEM, USER, WHOLE = range(4)  #: nothing yet; a system row; a user row waits for its answer; pairs
STATES = (START, SYSTEM, USER, WHOLE)
_NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): WHOLE, (WHOLE, "u"): USER}
_ROLES = {"u": "user", "a": "assistant"}


def damage(conversations: DataFrame) -> DataFrame:
    """The rows as a repair's test damages them, by ``crc32('conv_id:turn') % 20``.

    ``times`` is how often a row is there: 0 drops it, and only its conversation is known.
    """
    space = F.lit(" ")
    named = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *named)) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, f"[{ENDINGS}]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )


@dataclass(frozen=True)
class Row:
    """What the search looks at: the role's initial, and the fault that counts."""

    initial: str
    fault: str | None

    @property
    def must_go(self) -> bool:
        return self.fault in ("blank", "duplicate")


def suffix_bounds(rows: list[Row], accept: tuple[int, ...]) -> list[list[float]]:
    """For each row and state, a cost that what is left of the rows can't be repaired below."""

    def inserted(costs: list[float]) -> list[float]:
        for _ in range(2):  # more than two insertions in a row only come back to where they began
            costs = [min(c, INSERT + costs[_NEXT[s, "a" if s == USER else "u"]]) for s, c in zip(STATES, costs)]
        return costs

    bounds = [inserted([0 if s in accept else math.inf for s in STATES])]
    for row in reversed(rows):
        after, stays = bounds[-1], TRUNCATED if row.fault else 0
        costs = [DELETE + c for c in after]
        if not row.must_go:
            for (state, initial), then in _NEXT.items():
                if initial == row.initial:
                    costs[state] = min(costs[state], stays + after[then])
                elif initial != "s":
                    costs[state] = min(costs[state], stays + REROLE + after[then])
        bounds.append(inserted(costs))
    return bounds[::-1]


def search(rows: list[Row], entry: int = START, accept: tuple[int, ...] = (START, WHOLE)) -> tuple[int, str] | None:
    """The least (cost, audit) that leads from ``entry`` over all rows to an accepted state."""
    n = len(rows)
    bound = suffix_bounds(rows, accept)
    best: tuple[int, str] | None = None
    tables: list[dict[int, tuple[int, str]]] = [{} for _ in range(n + 1)]
    stack = [(0, entry, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        least = cost + bound[at][state]
        if least == math.inf or best and (least > best[0] or least == best[0] and audit > best[1][: len(audit)]):
            continue
        met = tables[at].get(state)
        if met and met <= (cost, audit):
            continue
        tables[at][state] = (cost, audit)
        if at == n and state in accept and (best is None or (cost, audit) < best):
            best = (cost, audit)
        turn = "a" if state == USER else "u"
        children = [(cost + INSERT, "I", at, _NEXT[state, turn])]
        if at < n:
            row = rows[at]
            children.append((cost + DELETE, "D", at + 1, state))
            if not row.must_go:
                stays = cost + (TRUNCATED if row.fault else 0)
                if (state, row.initial) in _NEXT:
                    children.append((stays, "K", at + 1, _NEXT[state, row.initial]))
                if row.initial != turn:
                    children.append((stays + REROLE, "R", at + 1, _NEXT[state, turn]))
        for spent, edit, to, then in sorted(children, key=lambda c: (c[0] + bound[c[2]][c[3]], c[1]), reverse=True):
            stack.append((to, then, spent, audit + edit))
    return best


def fault_of(role: str, text: str, seen: set[bytes]) -> str | None:
    """The first fault of a row; ``seen`` holds digests of the rows before it and takes this one in."""
    mark = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
    again = mark in seen
    seen.add(mark)
    last = text.rstrip(_SPACES)[-1:]
    return "blank" if not last else "duplicate" if again else None if last in ENDINGS else "truncated"


def apply(edits: str, turns: list[tuple[str, str]], state: int) -> Iterator[tuple[str, str]]:
    """The (role, text) rows that the edits leave, from a state of the grammar on."""
    given = iter(turns)
    for edit in edits:
        role, text = next(given) if edit != "I" else ("", "")
        if edit == "D":
            continue
        if edit != "K":
            role = _ROLES["a" if state == USER else "u"]
        state = _NEXT[state, role[:1]]
        yield role, text


@dataclass
class Repair:
    """One conversation as its rows come in: faults, and the repair settled so far."""

    seen: set[bytes] = field(default_factory=set)
    counts: dict[str, int] = field(default_factory=lambda: {"blank": 0, "duplicate": 0, "truncated": 0})
    illegal: int = 0
    last: str | None = None
    low: int | None = None
    high: int | None = None
    turns: int = 0
    rows: list[Row] = field(default_factory=list)
    #: rows of segments that are searched but not settled, and for each state the best way to it
    waiting: list[list[tuple[str, str]]] = field(default_factory=lambda: [[]])
    ways: dict[int, tuple[int, str, tuple]] = field(default_factory=lambda: {START: (0, "", ())})

    def add(self, turn: int | None, role: str, text: str) -> None:
        fault = fault_of(role, text, self.seen)
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        if self.last is not None and (self.last + initial) not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        if turn is not None:
            if turn != self.high:
                self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        self.rows.append(Row(initial, fault))
        self.waiting[-1].append((role, text))

    def close_segment(self) -> Iterator[tuple[str, str]]:
        """Search the segment from each state that can be reached to each state; give what is settled by that."""
        ways: dict[int, tuple[int, str, tuple]] = {}
        for state, (cost, audit, path) in self.ways.items():
            for to in STATES:
                found = search(self.rows, state, (to,))
                if found:
                    way = (cost + found[0], audit + found[1], (*path, (state, found[1])))
                    if to not in ways or way[:2] < ways[to][:2]:
                        ways[to] = way
        self.ways, self.rows = ways, []
        yield from self._settle(max(0, self._agreed()))
        self.waiting.append([])

    def _agreed(self) -> int:
        """Up to where all ways still open say the same."""
        paths = [path for _, _, path in self.ways.values()]
        return next((k for k, steps in enumerate(zip(*paths)) if len(set(steps)) > 1), min(map(len, paths)))

    def _settle(self, n: int) -> Iterator[tuple[str, str]]:
        path = next(iter(self.ways.values()))[2]
        for (state, edits), turns in zip(path[:n], self.waiting[:n]):
            yield from apply(edits, turns, state)
        self.waiting = self.waiting[n:]
        self.ways = {s: (cost, audit, path[n:]) for s, (cost, audit, path) in self.ways.items()}

    def close(self) -> tuple[int, str, Iterator[tuple[str, str]]]:
        """Cost and audit of the whole, and the rows not given yet."""
        ends = []
        for state, (cost, audit, path) in self.ways.items():
            found = search(self.rows, state)
            if found:
                ends.append((cost + found[0], audit + found[1], (*path, (state, found[1]))))
        cost, audit, path = min(ends, key=lambda e: e[:2])
        left = itertools.chain.from_iterable(apply(e, t, s) for (s, e), t in zip(path, self.waiting))
        return cost, audit, left

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


_FACTS = [("gaps", "bigint"), *((c, "bigint") for c in ("blank", "duplicate", "truncated", "illegal", "cost")), ("audit", "string")]


def repair(turns: DataFrame, digest: bool = False) -> DataFrame:
    """One row per conversation: its faults, the cost and audit of the repair, and what is left.

    What is left is an array of (role, text), or with ``digest`` the SHA-256 of its ``role:text``
    lines. A column ``times`` says how often each row counts, 1 where there is none; a conversation
    all of whose rows count 0 times has no faults and nothing left.
    """
    kept = "kept binary" if digest else "kept array<struct<role: string, text: string>>"
    arrow_kept = pa.binary() if digest else pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    arrow = {"bigint": pa.int64(), "string": pa.string()}
    schema = pa.schema([("conv_id", pa.int64()), *((n, arrow[t]) for n, t in _FACTS), ("kept", arrow_kept)])
    ddl = ", ".join(["conv_id bigint", *(f"{n} {t}" for n, t in _FACTS), kept])

    class Lines:
        """Takes the repaired rows: hashes them, or keeps them."""

        def __init__(self) -> None:
            self.sha, self.rows, self.first = hashlib.sha256(), [], True

        def take(self, rows: Iterator[tuple[str, str]]) -> None:
            for role, text in rows:
                if digest:
                    self.sha.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
                    self.first = False
                else:
                    self.rows.append({"role": role, "text": text})

        def result(self) -> bytes | list:
            return self.sha.digest() if digest else self.rows

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for conv_id, group in itertools.groupby(values(stream), key=lambda r: r[0]):
                found, lines = Repair(), Lines()
                for _, turn, role, text, times in group:
                    for _ in range(times):
                        if len(found.rows) == SEGMENT:
                            lines.take(found.close_segment())
                        found.add(turn, role, text)
                cost, audit, left = found.close()
                lines.take(left)
                yield conv_id, found.gaps, *found.counts.values(), found.illegal, cost, audit, lines.result()

        yield from batches(schema, rows(), 256)

    times = F.col("times") if "times" in turns.columns else F.lit(1)
    space = F.lit(" ")
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), times.alias("times")
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(run, ddl)
