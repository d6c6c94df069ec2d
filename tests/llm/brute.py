"""Plain answers to compare the operators with, and rows that are awkward in every column."""

from __future__ import annotations

import hashlib
import itertools
import random
from collections import Counter

import xxhash

#: Columns of documents, and others named like what the operators use inside.
EXTRA = "k1 bigint, size string, fingerprint string, kept string, runs int, n bigint, score double, number int, row string, `copies` int, term string"
SCHEMA = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {EXTRA}"
NO_EXTRA = (7, "s", None, "kept", 1, None, 0.5, 3, "row", 9, "t")


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghiäöü") for _ in range(draw.randint(1, 7))) for _ in range(n))


def awkward() -> list[tuple]:
    """doc_id, text, lang, source, n_chars and the other columns."""
    a, b, c = prose(1, 160), prose(2, 120), prose(3, 90)
    texts = [
        (1, a), (2, f"{b} {a}"), (None, a), (None, b), (3, None), (4, ""), (5, " \t\n\x0b"), (6, c), (6, c), (6, f"{c} {b}"),
        (7, "x" * 5000), (8, "ab " * 3000), (9, f"{prose(4, 3000)} {a} {prose(5, 10)}"), (10, a.upper()), (11, "Ünï ✓ 東京 \u0000 \u00a0 İ"),
        (12, c + "."), (-5, f"{a[:300]} {c}"), (13, "one two three"), (14, None), (15, "x" * 199), (16, "x" * 200), (17, None),
    ]
    return [(d, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"s{k % 3}", None, *NO_EXTRA) for k, (d, t) in enumerate(texts)]


def documents(spark, rows: list[tuple] | None = None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def recurring_bytes(texts: list[str | None], length: int = 200) -> list[tuple]:
    """(n_bytes, n_removed, n_spans, sha256 of what is kept) of each text."""
    raws = [(t or "").encode() for t in texts]
    met = Counter(r[k : k + length] for r in raws for k in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for k in range(len(r) - length + 1):
            if met[r[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((len(r), sum(gone), spans, sha(bytes(x for x, g in zip(r, gone) if not g))))
    return out


def recurring_words(docs: list[tuple], window: int = 50) -> list[tuple]:
    """(n_words, n_removed, sha256 of what is kept) of each (doc_id, text)."""
    words = [(d, (t or "").encode().split()) for d, t in docs]
    first: dict[tuple, int] = {}
    for d, w in words:
        for k in range(len(w) - window + 1 if d is not None else 0):
            key = tuple(w[k : k + window])
            first[key] = min(d, first.get(key, d))
    out = []
    for d, w in words:
        gone = bytearray(len(w))
        for k in range(len(w) - window + 1 if d is not None else 0):
            if first[tuple(w[k : k + window])] < d:
                gone[k : k + window] = b"\1" * window
        out.append((len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def simhash(text: str | None, words: int = 4) -> int:
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    n = max(1, len(parts) - words + 1)
    hashes = [xxhash.xxh64_intdigest(b" ".join(parts[k : k + words]), 42) for k in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def components(nodes: list, linked) -> dict:
    """Each node's component, as the set of its nodes, by trying all pairs."""
    of = {n: {n} for n in nodes}
    for a, b in itertools.combinations(nodes, 2):
        if of[a] is not of[b] and linked(a, b):
            whole = of[a] | of[b]
            for n in whole:
                of[n] = whole
    return of


def ordered(rows) -> list:
    return sorted((tuple(r) for r in rows), key=repr)
