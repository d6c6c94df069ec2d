"""Secret scans: assignments are lexed into names and literals, literals are scored by their names.

Two things are found in each text:

* the base patterns (a named assignment, an access key id, a long hexadecimal run);
* ``literal`` spans: text is lexed as source and configuration syntax into statements
  ``name = value`` (also ``:``, ``:=``, ``=>``, ``name: type = value``; ``==`` is no assignment), whose value
  is a quoted literal, a name assigned before, a ``+`` chain of those, or a bare value: all up to white space,
  a comma, a semicolon, a quote or a closing bracket. A name with an opening bracket is a call, no literal.
  Inside a bare value, ``name=value`` with a telling name is looked at as well. Constants
  are propagated: a name stands for the literals it was last given, so a harmless-looking constant
  is found when a sensitive name takes it. A literal is reported if what its name tells and what it
  looks like add up to ``threshold``.

A chain's text is never built: its length and character counts add up from its parts', characters beyond
ASCII in 64 classes; it is a placeholder if its parts hold nothing else. Lengths stop being exact at 2^24.

Null and empty texts have no spans. Each row is judged alone, so repeated rows give repeated rows,
null ids stay null, other columns of the input are not read. A text is scanned whole, whatever its
length, in time and memory linear in it.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import batches, values

Span = tuple[str, int, int]

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_HINTS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "literal")

#: Parts of names, with what each adds to the score of a literal they are given.
SENSITIVE = {
    "password": 3.0, "passwd": 3.0, "pwd": 3.0, "passphrase": 3.0, "secret": 3.0, "token": 2.5,
    "apikey": 3.0, "credential": 2.5, "credentials": 2.5, "privatekey": 3.0, "accesskey": 3.0,
    "authorization": 2.0, "bearer": 2.0, "auth": 1.5, "key": 1.5, "cert": 1.0, "signature": 1.0, "dsn": 1.5,
}
#: Literals that stand for a value which is not there.
PLACEHOLDERS = ("example", "changeme", "placeholder", "your", "dummy", "sample", "todo", "none", "null", "true", "false", "xxx", "***", "...")
#: Words that a placeholder may have beside those.
FILLERS = frozenset("a an api change enter here insert it key me my now passwd password please replace secret the this token user value with".split())
THRESHOLD = 5.0

_TOKEN = re.compile(
    r"""
    (?P<quote>["'`])
  | (?P<compare>[=!<>]=)
  | (?P<operator>:=|=>|=|:)
  | (?P<plus>\+)
  | (?P<name>[A-Za-z_$][A-Za-z0-9_$.\-]*)
  | (?P<number>[0-9][^\s"'`;,=:+()\[\]{}]*)
  | (?P<end>[\n;,(){}\[\]])
  | (?P<other>[^\s"'`;,=:+()\[\]{}A-Za-z_$0-9!<>]+|[!<>])
    """,
    re.X | re.A,
)
_REST = {q: re.compile(rf"(?:[^{q}\\\n]|\\.)*+{q}") for q in "\"'`"}  # of a string, its closing quote included
_BLANKS = re.compile(r"[^\S\n]*")
_BARE = re.compile(r"""[^\s,;"'`)\]}]+""")
_NAME = re.compile(r"[A-Za-z_$][A-Za-z0-9_$.\-]*", re.A)
_INNER = re.compile(r"(?<![A-Za-z0-9_$.])([A-Za-z_$][A-Za-z0-9_$.]*)=([^&=]+)", re.A)
_SCHEMES = ("bearer", "basic")  # words before what is meant, as in "Authorization: Bearer ..."
_ASSIGNMENT = re.compile(r"""[A-Za-z0-9_$"'`\]][\x20\t]*(?::=|=>|=|:)[\x20\t]*[^\s=,;)\]}]""", re.A)
_SIGNS = re.compile(r"[xX]{3,}|\*{3,}|\.{3,}")
_WORDS = re.compile(r"[^\W\d_]+")
_NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def base_spans(text: str) -> list[Span]:
    """The base patterns' matches, in code points, ordered by start, then kind."""
    spans: list[Span] = []
    low = text.lower()
    if any(hint in low for hint in _ASSIGN_HINTS):
        spans += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    if _LONG_HEX.search(text):
        spans += [("hex", m.start(), m.end()) for m in _HEX.finditer(text) if m.end() - m.start() >= 24]
    return _ordered(spans)


def _ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def name_score(name: str) -> float:
    """What a name tells: the best of its parts and of neighbouring parts taken together."""
    parts = [p.lower() for p in _NAME_PARTS.findall(name)]
    joined = parts + [a + b for a, b in zip(parts, parts[1:])]
    return max((SENSITIVE.get(p, 0.0) for p in joined), default=0.0)


_CLASSES, _EXACT = 192, 2.0**24


class Looks(NamedTuple):
    start: str
    length: float
    counts: np.ndarray
    stands_in: bool
    known_only: bool


def _scaled(start: str, length: float, counts: np.ndarray, *told: bool) -> Looks:
    while length > _EXACT:  # only proportions matter by then
        length, counts = length / 2, counts / 2
    return Looks(start, length, counts, *told)


def _literal_looks(text: str) -> Looks:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = np.bincount(np.where(codes < 128, codes, 128 + codes % 64), minlength=_CLASSES).astype(np.float32)
    return _scaled(text[:8], float(len(text)), counts, *_placeholder(text))


def _chain_looks(parts: list[Looks]) -> Looks:
    counts = np.sum([p.counts for p in parts], axis=0, dtype=np.float32)
    told = any(p.stands_in for p in parts), all(p.known_only for p in parts)
    return _scaled(parts[0].start, sum(p.length for p in parts), counts, *told)


class Value:
    """A literal at ``at``, or a chain of ``parts``; what its looks need adds up from part to part."""

    __slots__ = ("at", "parts", "text", "looks", "reported")

    def __init__(self, text: str = "", at: tuple[int, int] | None = None, parts: tuple[Value, ...] = ()):
        self.text, self.at, self.parts, self.reported = text, at, parts, False
        self.looks = _chain_looks([p.seen() for p in parts]) if parts else None

    def seen(self) -> Looks:
        if self.looks is None:  # most literals are never asked
            self.looks = _literal_looks(self.text)
        return self.looks

    def spans(self) -> Iterator[tuple[int, int]]:
        """Where its literals stand, without those that were asked for before."""
        stack = [self]
        while stack:
            value = stack.pop()
            if not value.reported:
                value.reported = True
                stack.extend(value.parts)
                if value.at:
                    yield value.at


def _placeholder(text: str) -> tuple[bool, bool]:
    """Whether a literal stands for a value that is not there, and whether nothing in it speaks against that."""
    words = _WORDS.findall(text.lower())
    if _SIGNS.fullmatch(text) or "".join(words) in PLACEHOLDERS:
        return True, True
    return any(w in PLACEHOLDERS for w in words), all(w in PLACEHOLDERS or w in FILLERS for w in words)


_LOW, _UP, _DIGITS = slice(97, 123), slice(65, 91), slice(48, 58)
_SIGN = np.ones(_CLASSES, bool)
_SIGN[[*range(97, 123), *range(65, 91), *range(48, 58), *range(9, 14), 32]] = False


def literal_score(value: Looks) -> float:
    """What a literal looks like: long, of many different characters, of several kinds, no placeholder."""
    if value.length < 6 or value.start.startswith(("${", "{{", "<", "%(", "$(")) or value.stands_in and value.known_only:
        return -10.0
    shares = value.counts[value.counts > 0].astype(float) / value.length
    entropy = -float((shares * np.log2(shares)).sum())
    kinds = sum(bool(value.counts[of].any()) for of in (_LOW, _UP, _DIGITS, _SIGN))
    path = value.start.startswith(("http://", "https://", "/", "./"))
    return min(entropy, 4.5) / 1.5 + 0.4 * kinds - 0.8 * float(value.counts[32]) - (1.0 if path else 0.0)


def pairs(text: str) -> Iterator[tuple[str, Value]]:
    """(name, value) of each assignment, constants resolved."""
    known: dict[str, Value] = {}
    no_close = dict.fromkeys(_REST, 0)  # up to where a quote is known not to be closed on its line
    name = ""  # what stood last and could be assigned to
    target, by = "", ""  # what is being assigned to, and with which operator
    value: list[Value] = []
    wants = False  # a value may follow
    pos = 0

    def closed() -> Iterator[tuple[str, Value]]:
        nonlocal target, value, wants
        if target and value:
            known[target] = value[0] if len(value) == 1 else Value(parts=tuple(value))
            yield target, known[target]
        target, value, wants = "", [], False

    while True:
        if wants:
            pos = _BLANKS.match(text, pos).end()
            bare = _BARE.match(text, pos)
            if bare and text[pos] not in "([{":
                start, stop = bare.span()
                quoted = text[stop : stop + 1] in _REST
                whole = _NAME.match(text, start, stop)
                after = whole.end() if whole else start
                if whole and after < stop and text[after] in "([{":  # a call
                    target, value, wants, name, pos = "", [], False, "", after
                    continue
                if quoted and after == stop and stop - start <= 2 or whole and whole[0].lower() in _SCHEMES and after == stop:
                    pos = stop  # the prefix of a string, or of a credential
                    continue
                if whole and after < stop and text[after] == "+" and whole[0] in known:
                    stop = after
                elif quoted and text[stop - 1] == "+" and stop - start > 1:
                    stop -= 1
                elif whole and after == stop - 1 and (text[after] == ":" or text[after] == "=" and quoted):
                    stop = after  # the next statement's name, as in a: b: c
                piece, wants, pos = text[start:stop], False, stop
                value.append(known[piece] if piece in known else Value(piece, (start, stop)))
                name = piece
                for m in _INNER.finditer(piece):
                    yield m[1], Value(m[2], (start + m.start(2), start + m.end(2)))
                continue
        m = _TOKEN.search(text, pos)
        if not m:
            break
        kind, token, pos = m.lastgroup, m[0], m.end()
        if kind == "operator" and name and not wants:
            if by == ":" and token == "=" and target and len(value) == 1 and name_score(name) <= name_score(target):  # name: type = value
                value, wants = [], True
            else:
                held = name
                if value:  # the last piece was the next statement's name
                    value.pop()
                yield from closed()
                target, wants = held, True
            name, by = "", token
        elif kind == "plus" and target and value and not wants:
            name, wants = "", True
        elif kind == "quote":
            start = pos
            rest = _REST[token].match(text, start) if start > no_close[token] else None
            if rest:
                pos = rest.end()
                name = text[start : pos - 1]
                if wants:
                    wants = False
                    value.append(Value(name, (start, pos - 1)))
                elif target:
                    yield from closed()
            else:
                line = text.find("\n", start) if start > no_close[token] else no_close[token]
                no_close[token] = len(text) if line < 0 else line
                name = ""
                if target:
                    yield from closed()
        else:
            name = token if kind == "name" else ""
            if target:
                yield from closed()
    yield from closed()


def literal_spans(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """Spans of literals whose name and looks together reach ``threshold``."""
    if not _ASSIGNMENT.search(text):
        return []
    found = set()
    for name, value in pairs(text):
        told = name_score(name)
        if told and told + literal_score(value.seen()) >= threshold:
            found.update(("literal", a, b) for a, b in value.spans() if b - a >= 6)
    return _ordered(list(found))


_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
    ]
)


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, spans (kind, start, end), base and scored ones, in order."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for doc_id, text in values(stream):
                spans = _ordered(base_spans(text) + literal_spans(text, threshold)) if text else []
                yield doc_id, [{"kind": k, "start": a, "end": b} for k, a, b in spans]

        yield from batches(_SCHEMA, rows())

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>")


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def digest(spans: list[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
