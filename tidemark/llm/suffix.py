"""Suffix-array dedup: common prefixes from a Burrows-Wheeler transform, by intervals, up to a length.

Shards of spans (``repeats``) are put in suffix order, to the depth that matters. On the Burrows-Wheeler transform of
that order, intervals are extended backward breadth-first: an interval holds the suffixes that start with some
string, and the same string with a character before it is again an interval, found by counting that character. A
round takes all strings of one length; where an extended interval ends at a boundary that has no value yet, the
common prefix there is that length, and only such intervals are extended further. Values therefore come in increasing
order, and rounds stop at the minimum length: boundaries still without a value have a common prefix of at least
that length, and their suffixes start with a string that stands somewhere else too.

Before a shard is put in order, its windows are hashed. Equal windows have equal hashes, so a string without a hash
that stands twice in the shard has nothing to find there and is left out; what recurs is told by the intervals alone.

A text is its UTF-8 bytes, a null text is empty. Matches never cross documents. Texts shorter than the length lose
nothing. Repeated rows are copies of each other; null ids are kept as they are. Other columns are not read; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches, values
from tidemark.llm.repeats import KEY, Kind, covered, packed, repeated, unpacked
from tidemark.llm.spans import Rolling

LENGTH = 200
#: Intervals up to this size are extended row by row, larger ones character by character.
NARROW = 48


def suffix_order(text: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` characters at least; strings end at 0s, which sort first.

    Each round doubles the depth: ranks by the first half and by the second half make ranks by both. Only
    suffixes that are not alone with their rank are sorted again.
    """
    n = len(text)
    key = np.zeros(n, np.int64)
    padded = np.r_[text.astype(np.int64), np.zeros(7, np.int64)]
    stopped = np.zeros(n, bool)
    for k in range(7):  # seven characters of nine bits
        key = (key << 9) | np.where(stopped, 0, padded[k : k + n])
        stopped |= padded[k : k + n] == 0
    order = np.argsort(key).astype(np.int32)
    first = np.r_[True, key[order][1:] != key[order][:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0)) + 1
    reach = 7
    while reach < depth:
        shared = ~(first & np.r_[first[1:], True])  # rows of groups
        at = np.flatnonzero(shared)
        if not len(at):
            break
        rows = order[at]
        next_ = rows + reach
        inside = next_ < ends[rows]
        second = np.where(inside, rank[np.where(inside, next_, 0)], 0)
        both = rank[rows] * (n + 2) + second
        sorted_ = np.argsort(both)
        order[at] = rows[sorted_]
        ordered = both[sorted_]
        first[at] = np.r_[True, ordered[1:] != ordered[:-1]]
        rank[order[at]] = np.maximum.accumulate(np.where(first[at], at, 0)) + 1
        reach *= 2
    return order


def shared_prefixes(bwt: np.ndarray, length: int) -> np.ndarray:
    """For rows in suffix order, whether the common prefix with the row before is ``length`` or more.

    ``bwt`` has the character before each row's suffix, 0 where its string begins. Values below the length
    are derived by increasing value; what has none at the end is at least the length.
    """
    n = len(bwt)
    by_char = np.argsort(bwt, kind="stable").astype(np.int32)
    chars = bwt[by_char]
    lead = np.empty(n, np.int32)  # row -> the row of its suffix with the character before it
    lead[by_char] = np.arange(n, dtype=np.int32)
    same = chars[1:] == chars[:-1]
    following = np.full(n, n, np.int32)  # row -> the next row with the same character before it
    following[by_char[:-1][same]] = by_char[1:][same]
    keys = chars.astype(np.int64) * (n + 1) + by_char  # for counting a character up to a row
    alphabet = np.unique(chars).astype(np.int64)
    begins = bwt == 0  # a string begins here: nothing is before it

    known = np.zeros(n + 1, bool)
    known[[0, n]] = True
    low, high = np.zeros(1, np.int32), np.full(1, n, np.int32)
    for value in range(length):
        sizes = high - low
        # one row: what is before it is one row too
        rows = low[sizes == 1]
        rows = rows[~begins[rows]] if value else rows
        begin, finish = [lead[rows]], [lead[rows] + 1]
        # wide intervals: every character of the alphabet, counted up to either end
        wide = sizes > NARROW
        if wide.any():
            first = np.searchsorted(keys, (alphabet * (n + 1) + low[wide][:, None]).reshape(-1))
            last = np.searchsorted(keys, (alphabet * (n + 1) + high[wide][:, None]).reshape(-1))
            extends = last > first
            if value:  # at first, the ends of strings are an interval too
                extends &= np.tile(alphabet, int(wide.sum())) > 0
            begin.append(first[extends].astype(np.int32))
            finish.append(last[extends].astype(np.int32))
        # the others: the last row of each character in the interval
        rest = (sizes > 1) & ~wide
        nl, nh, ns = low[rest], high[rest], sizes[rest]
        rows = np.arange(ns.sum(), dtype=np.int32) + np.repeat(nl - np.r_[0, np.cumsum(ns)[:-1]].astype(np.int32), ns)
        chosen = following[rows] >= np.repeat(nh, ns)
        if value:
            chosen &= ~begins[rows]
        chosen &= ~known[lead[rows] + 1]
        rows, left = rows[chosen], np.repeat(nl, ns)[chosen]
        begin.append(np.searchsorted(keys, bwt[rows].astype(np.int64) * (n + 1) + left).astype(np.int32))
        finish.append(lead[rows] + 1)
        low, high = np.concatenate(begin), np.concatenate(finish)
        fresh = ~known[high]
        low, high = low[fresh], high[fresh]
        known[high] = True
        if not len(low):
            break
    return ~known[:n]


def _may_recur(texts: list[bytes], length: int) -> np.ndarray:
    """Which of the strings, none shorter than ``length``, have a window whose hash stands twice in all of them."""
    sizes = np.array([len(t) for t in texts])
    hashes = Rolling(np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64) + np.uint64(1)).grams(length)
    before_end = np.repeat(np.cumsum(sizes), sizes)[: len(hashes)] - np.arange(len(hashes))
    at = np.flatnonzero(before_end >= length)  # windows that lie in one string
    order = at[np.argsort(hashes[at])]
    same = hashes[order[1:]] == hashes[order[:-1]]
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    found = np.zeros(len(texts), bool)
    found[np.repeat(np.arange(len(texts)), sizes)[order[twice]]] = True
    return found


def solve(rows: list[tuple], length: int = LENGTH) -> Iterator[tuple]:
    """Of a shard's distinct strings (mark, key, n, low, high, text): runs of starts of strings that recur.

    A string that stands several times recurs from start to end. It is put in order with the others of its
    mark, which may share parts of it; the only one of its mark has nothing to be compared with. Strings that
    share no window's hash with another place are left out.
    """
    of_mark = Counter(row[0] for row in rows)
    put = [k for k, row in enumerate(rows) if row[2] == 1 or of_mark[row[0]] > 1]
    for k, row in enumerate(rows):
        if row[2] > 1:
            yield k, 0, len(row[-1]) - length + 1, 0
    if put:
        put = np.array(put)[_may_recur([rows[k][-1] for k in put], length)].tolist()
    if not put:
        return
    texts = [rows[k][-1] for k in put]
    sizes = np.array([len(t) for t in texts])
    joined = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.uint16) + 1
    ends = np.cumsum(sizes + 1) - 1  # where each string's end stands
    joined[ends] = 0
    of_end = np.repeat(ends, sizes + 1)
    order = suffix_order(joined, of_end, length)
    shared = shared_prefixes(np.r_[np.uint16(0), joined[:-1]][order], length)
    recurs = np.zeros(len(joined), bool)
    recurs[order] = shared | np.r_[shared[1:], False]
    for k, b, size in zip(put, ends, sizes):
        if rows[k][2] == 1:
            yield from _runs(k, recurs[b - size : b - length + 1])


def _runs(k: int, flags: np.ndarray) -> Iterator[tuple]:
    edge = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        yield k, a, b - a, 0


def _units(raw: bytes) -> tuple[np.ndarray, bytes]:
    return np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1), raw


BYTES = Kind(
    size=LENGTH,
    grams=(32, 160, 190, LENGTH),
    units=_units,
    piece=lambda raw, a, b: raw[a:b],
    recurs=lambda: F.col("n") > 1,
    solve=solve,
    shard=1 << 19,
    most=1 << 22,
)

_REMOVED = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())]
)
_REMOVED_DDL = "doc_id bigint, n_bytes bigint, removed array<struct<start:bigint,end:bigint>>, kept binary"


def deduplicate(docs: DataFrame, digest: bool = False) -> DataFrame:
    """``doc_id, n_bytes, removed, kept``: the maximal runs of bytes that recur, and the bytes that stay.

    With ``digest``, ``kept`` holds the SHA-256 of those bytes instead.
    """
    runs = repeated(docs, BYTES)
    joined = packed(docs).join(runs, KEY, "left").select("doc_id", "packed", "runs")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for doc_id, data, found in values(stream):
                raw = unpacked(data)
                gone = covered(LENGTH, len(raw), found or [])
                edge = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
                removed = [{"start": a, "end": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes() if removed else raw
                yield doc_id, len(raw), removed, hashlib.sha256(kept).digest() if digest else kept

        yield from batches(_REMOVED, rows(), 256)

    return joined.mapInArrow(run, _REMOVED_DDL)
