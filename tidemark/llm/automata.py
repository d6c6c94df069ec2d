"""Substring dedup: recurring passages found again by sharded Aho-Corasick automata.

Shards of spans (``repeats``) are read as words. A shard confirms which windows of ``WINDOW`` words recur in a later
document, and compiles them into one automaton, a character for each of the shard's words, so that it compares
words and nothing else. Every span of the shard is then streamed through it, and each place where a window ends
is reported with the smallest document the window is in. Documents greater than that one lose it.

Words are what ASCII white space parts, unchanged. A null text has no words. Documents with a null id are neither
smaller nor greater than others: nothing is removed from them, nor because of them. Rows with the same id do not
remove anything from each other. Other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches, values
from tidemark.llm.repeats import KEY, Kind, covered, packed, repeated, unpacked

WINDOW = 50
#: Characters that cannot stand in a string by themselves.
_SURROGATES = 0xD800, 0x800


def _character(k: int) -> str:
    return chr(k + 1 if k + 1 < _SURROGATES[0] else k + 1 + _SURROGATES[1])


def solve(rows: list[tuple], window: int = WINDOW) -> Iterator[tuple]:
    """Of a shard's distinct spans (mark, key, n, low, high, text): runs of windows that recur, with their first document."""
    code: dict[bytes, str] = {}
    coded = []
    for row in rows:
        words = row[-1].split(b" ")
        for w in words:
            if w not in code:
                code[w] = _character(len(code))
        coded.append("".join(map(code.__getitem__, words)))

    met: dict[str, tuple[int, int]] = {}
    for (_, _, _, low, high, _), text in zip(rows, coded):
        for k in range(len(text) - window + 1):
            w = text[k : k + window]
            l, h = met.get(w, (low, high))
            met[w] = min(l, low), max(h, high)
    passages = ahocorasick.Automaton()
    for w, (low, high) in met.items():
        if low < high:
            passages.add_word(w, low)
    if not len(passages):
        return
    passages.make_automaton()
    for k, text in enumerate(coded):
        start, n, first = 0, 0, None  # the run so far
        for end, low in passages.iter(text):
            at = end - window + 1
            if n and at == start + n and low == first:
                n += 1
                continue
            if n:
                yield k, start, n, first
            start, n, first = at, 1, low
        if n:
            yield k, start, n, first


def _units(raw: bytes) -> tuple[np.ndarray, list[bytes]]:
    words = raw.split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), words


WORDS = Kind(
    size=WINDOW,
    grams=(8, 24, WINDOW),
    units=_units,
    piece=lambda words, a, b: b" ".join(words[a:b]),
    recurs=lambda: F.col("low") < F.col("high"),
    solve=solve,
    shard=1 << 18,
    most=1 << 19,  # with what a shard had before, fewer words than there are characters
    needs_id=True,
)

_REMOVED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])


def deduplicate(docs: DataFrame, digest: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: kept words with one space between, as UTF-8.

    With ``digest``, ``kept`` holds the SHA-256 of that text instead.
    """
    runs = repeated(docs, WORDS)
    later = F.filter("runs", lambda r: r["low"] < F.col("doc_id")).alias("runs")
    joined = packed(docs).join(runs, KEY, "left").select("doc_id", "packed", later)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for doc_id, data, found in values(stream):
                words = unpacked(data).split()
                gone = covered(WINDOW, len(words), found or [])
                kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g) if found else b" ".join(words)
                yield doc_id, len(words), int(gone.sum()), hashlib.sha256(kept).digest() if digest else kept

        yield from batches(_REMOVED, rows(), 256)

    return joined.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept binary")
