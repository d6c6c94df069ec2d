"""SimHash near-duplicates: fingerprints compared as bit planes.

A fingerprint's bit is 1 if it is set in over half of the hashes of a text's word shingles, repeats
included. Distinct fingerprints that share a block key meet in one task. There they are stored
vertically, a plane per bit with 64 fingerprints to a word; a query's distances to all of them are
added up at once in bit-sliced counters by carry-save adders, eight planes at a time, and words whose
64 counters are all past the radius are left out of the planes that follow.

Block keys come in two kinds:

* ``bit_keys``: the fingerprint is cut into ``radius + 2`` pieces; two fingerprints within the radius
  agree on at least two of them, so the keys are all pairs of pieces. No link is lost.
* ``minimum_keys``: for longer fingerprints and larger radii, the smallest shingle hash under each of
  ``n`` orders. Texts of Jaccard similarity s miss each other with probability (1 - s) ** n.

Equal fingerprints are one row before anything is compared. A block with over ``CHUNK``
distinct fingerprints is dealt into chunks and every pair of chunks is a task of its own, so that memory
stays bounded and no link is lost. A task returns a spanning forest of the links it finds, not all
pairs: a fingerprint once reached is compared no more but as a query.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batches, values, written
from tidemark.llm.components import components

CHUNK = 16_384
#: Blocks up to this many fingerprints are compared together with others, pair by pair in lanes.
SMALL = 24
SEED = 42
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_STEP = 0x9E3779B97F4A7C15
_WORD = (1 << 64) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of each shingle: words in ASCII lower case, one space between; a short text is one shingle."""
    parts = text.encode().lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return np.array([digest(joined, SEED)], np.uint64)
    starts = [0, *itertools.accumulate(len(p) + 1 for p in parts)]
    ends = itertools.islice(starts, words, None)
    return np.fromiter((digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends)), np.uint64)


def fingerprint(hashes: np.ndarray, bits: int = 64) -> bytes:
    """The majority of each bit, highest first; further 64 bits come from scrambled hashes."""
    if not len(hashes):
        return bytes(bits // 8)
    out = []
    for k in range(bits // 64):
        of_word = hashes if k == 0 else mixed(hashes + np.uint64(k * _STEP & _WORD))
        counts = np.zeros(64, np.int64)
        for start in range(0, len(of_word), 1 << 15):
            rows = of_word[start : start + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int32)
        out.append(np.packbits(counts * 2 > len(hashes)).tobytes())
    return b"".join(out)


def fingerprints(docs: DataFrame, words: int, bits: int = 64, minima: int = 0, sets: bool = False) -> DataFrame:
    """``doc_id, text_hash, fingerprint, minima`` of each row.

    A null text is an empty one; a text without words has the fingerprint zero and minima of -1. With ``sets`` each
    shingle counts once, and 16 bytes that tell the set follow the fingerprint's bits.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fingerprint", pa.binary()), ("minima", pa.list_(pa.int64()))]
    )
    orders = [np.uint64((k + 1) * 0xD6E8FEB86659FD93 & _WORD) for k in range(minima)]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for doc_id, text_hash, text in values(stream):
                hashes = shingle_hashes(text or "", words)
                hashes = np.unique(hashes) if sets else hashes
                least = [int(mixed(hashes ^ o).min().view(np.int64)) if len(hashes) else -1 for o in orders]
                told = xxhash.xxh3_128_digest(hashes.tobytes()) if sets else b""
                yield doc_id, text_hash, fingerprint(hashes, bits) + told, least

        yield from batches(schema, rows())

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, "doc_id bigint, text_hash bigint, fingerprint binary, minima array<bigint>"
    )


def planes_of(prints: np.ndarray) -> np.ndarray:
    """Fingerprints (rows of bytes) as bit planes: a row per bit, 64 fingerprints to a word."""
    bits = np.unpackbits(prints, axis=1).T
    bits = np.pad(bits, ((0, 0), (0, -bits.shape[1] % 64)))
    return np.ascontiguousarray(np.packbits(bits, axis=1, bitorder="little")).view("<u8")


def _add3(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save: three bits of one weight as one of that weight and one of the next."""
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def _add8(x: list[np.ndarray]) -> list[np.ndarray]:
    """Eight bits of one weight as a count of four bits."""
    s1, c1 = _add3(x[0], x[1], x[2])
    s2, c2 = _add3(x[3], x[4], x[5])
    s3, c3 = _add3(s1, s2, x[6])
    ones, c4 = s3 ^ x[7], s3 & x[7]
    t1, d1 = _add3(c1, c2, c3)
    twos, d2 = t1 ^ c4, t1 & c4
    return [ones, twos, d1 ^ d2, d1 & d2]


def _past(counter: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count is over ``radius``."""
    more, same = np.zeros_like(counter[0]), np.full_like(counter[0], _ALL)
    for k in reversed(range(len(counter))):
        if radius >> k & 1:
            same &= counter[k]
        else:
            more |= same & counter[k]
            same &= ~counter[k]
    return more


def near_lanes(planes: np.ndarray, word: np.ndarray, other: np.ndarray, of: np.ndarray, radius: int) -> np.ndarray:
    """For each k, the lanes of ``planes[:, word[k]] ^ other[:, of[k]]`` with ``radius`` bits or fewer."""
    near = np.zeros(len(word), np.uint64)
    alive = np.arange(len(word))
    width = int(planes.shape[0]).bit_length()
    counter = [np.zeros(len(word), np.uint64) for _ in range(width)]
    for start in range(0, planes.shape[0], 8):
        w, o = word[alive], of[alive]
        digits = _add8([planes[p][w] ^ other[p][o] for p in range(start, start + 8)])
        carry = np.zeros(len(alive), np.uint64)
        for k in range(width):
            if k < 4:
                counter[k], carry = _add3(counter[k], digits[k], carry)
            else:
                counter[k], carry = counter[k] ^ carry, counter[k] & carry
        past = _past(counter, radius)
        left = past != _ALL
        if start + 8 >= planes.shape[0]:
            near[alive[left]] = ~past[left]
        elif not left.all():
            alive = alive[left]
            counter = [c[left] for c in counter]
            if not len(alive):
                break
    return near


def _flags(words: np.ndarray, n: int) -> np.ndarray:
    """Words of lanes (rows of them) as booleans, ``n`` to a row."""
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=-1, bitorder="little")[..., :n].astype(bool)


def forest(prints: np.ndarray, radius: int, queries: int = 64) -> list[tuple[int, int]]:
    """Links that span the components of one block: a search that compares with what is not yet reached."""
    links: list[tuple[int, int]] = []
    rest = np.arange(len(prints))  # not yet reached
    planes = planes_of(prints)
    front: list[int] = []
    while len(rest):
        if not front:
            front = [int(rest[0])]
            rest = rest[1:]
            if not len(rest):
                break
        asked, front = front[:queries], front[queries:]
        other = np.where(np.unpackbits(prints[asked], axis=1).T.astype(bool), _ALL, np.uint64(0))
        held = planes_of(prints[rest]) if len(rest) < len(prints) else planes
        n_words = held.shape[1]
        word = np.tile(np.arange(n_words), len(asked))
        of = np.repeat(np.arange(len(asked)), n_words)
        near = _flags(near_lanes(held, word, other, of, radius).reshape(len(asked), n_words), len(rest))
        hit = near.any(axis=0)
        if hit.any():
            by = near.argmax(axis=0)
            links += [(asked[by[k]], int(rest[k])) for k in np.flatnonzero(hit)]
            front += rest[hit].tolist()
            rest = rest[~hit]
    return links


def pair_links(prints: np.ndarray, block: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links inside many small blocks at once: lanes hold neighbours at one distance in the sorted rows."""
    links: list[tuple[int, int]] = []
    for d in range(1, SMALL):
        left = np.flatnonzero(block[:-d] == block[d:]) if d < len(block) else []
        if not len(left):
            break
        a, b = planes_of(prints[left]), planes_of(prints[left + d])
        words = np.arange(a.shape[1])
        near = np.flatnonzero(_flags(near_lanes(a, words, b, words, radius), len(left)))
        links += [(int(left[k]), int(left[k]) + d) for k in near]
    return _spanning(links)


def _spanning(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := above.get(x, x)) != x:
            above[x] = above.get(up, up)
            x = up
        return x

    kept = []
    for a, b in links:
        ra, rb = root(a), root(b)
        if ra != rb:
            above[ra] = rb
            kept.append((a, b))
    return kept


_LINKS = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _links_of(radius: int, n_bytes: int):
    """What a task does with rows (key, fingerprint) sorted by key; bytes past ``n_bytes`` are not compared."""

    def solve(keys: list, prints: list[bytes]) -> Iterator[tuple]:
        """Whole blocks: the small ones together, the others one by one."""
        rows = np.frombuffer(b"".join(prints), np.uint8).reshape(len(prints), -1)[:, :n_bytes]
        key = np.array(keys, np.int64)
        cuts = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
        sizes = np.diff(cuts)
        small = np.repeat((sizes > 1) & (sizes <= SMALL), sizes)
        at = np.flatnonzero(small)
        for a, b in pair_links(rows[at], key[at], radius):
            yield prints[at[a]], prints[at[b]]
        for k in np.flatnonzero(sizes > SMALL):
            low = cuts[k]
            for a, b in forest(rows[low : cuts[k + 1]], radius):
                yield prints[low + a], prints[low + b]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            keys: list[int] = []
            prints: list[bytes] = []
            last, number = None, 0
            for *key, print_ in values(stream):
                if key != last:
                    last, number = key, number + 1
                    if len(keys) >= 1 << 15:
                        yield from solve(keys, prints)
                        keys, prints = [], []
                keys.append(number)
                prints.append(print_)
            if keys:
                yield from solve(keys, prints)

        yield from batches(_LINKS, rows())

    return run


def bit_keys(radius: int, bits: int = 64) -> Column:
    """All pairs of ``radius + 2`` pieces of a 64-bit fingerprint: arrays of (order, key)."""
    pieces = radius + 2
    cuts = [bits * k // pieces for k in range(pieces + 1)]
    masks = [((1 << b) - (1 << a)) for a, b in zip(cuts, cuts[1:])]
    number = F.conv(F.hex("fingerprint"), 16, -10).cast("bigint")
    pairs = [x | y for x, y in itertools.combinations(masks, 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in pairs]
    return F.array(*[F.struct(F.lit(k).alias("order"), number.bitwiseAND(F.lit(m).cast("bigint")).alias("key")) for k, m in enumerate(signed)])


def minimum_keys() -> Column:
    return F.transform("minima", lambda key, k: F.struct(k.cast("int").alias("order"), key.alias("key")))


def links(prints: DataFrame, keys: Column, radius: int, bits: int = 64) -> DataFrame:
    """Links (a, b) between fingerprints that share a key and differ in ``radius`` bits or fewer: a forest."""
    keyed = prints.select(F.explode(keys).alias("k"), "fingerprint").select("k.order", "k.key", "fingerprint")
    sizes = keyed.groupBy("order", "key").count().where(F.col("count") > 1)
    dealt = keyed.join(sizes, ["order", "key"]).withColumn("n", F.ceil(F.col("count") / CHUNK).cast("int"))
    own = F.pmod(F.xxhash64("fingerprint"), F.col("n")).cast("int")
    dealt = dealt.withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    ends = [F.least("own", "with").alias("low"), F.greatest("own", "with").alias("high")]
    group = ["order", "key", "low", "high"]
    rows = dealt.select("order", "key", *ends, "fingerprint").repartition(*group).sortWithinPartitions(*group, "fingerprint")
    return rows.mapInArrow(_links_of(radius, bits // 8), "a binary, b binary")


def groups(prints: DataFrame, keys: Column, radius: int, bits: int = 64) -> DataFrame:
    """``fingerprint, root`` of every fingerprint that is linked with another one."""
    distinct = prints.select("fingerprint", *(["minima"] if "minima" in prints.columns else [])).distinct()
    found = components(links(distinct, keys, radius, bits))
    return found.withColumnRenamed("node", "fingerprint")


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """``doc_id, fingerprint, component_id``: documents whose 64-bit fingerprints are linked.

    component_id is the smallest doc_id of the component (null where all are null). Texts without
    words share the fingerprint zero. Repeated rows are kept as they are; other columns are not read;
    an empty table gives no rows.
    """
    prints = written(fingerprints(docs, words).select("doc_id", "fingerprint"), "fingerprints")
    least = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    rooted = least.join(groups(prints, bit_keys(radius), radius), "fingerprint", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fingerprint"))
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(lowest, "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select("doc_id", F.lower(F.hex("fingerprint")).alias("fingerprint"), "component_id")


def _picked(docs: DataFrame, first: DataFrame) -> DataFrame:
    """``row`` and what ``first`` has besides doc_id, text_hash and no_id, for one of the rows that each row of it tells."""
    key = ["k1", "k2", "no_id"]
    others = [c for c in first.columns if c not in ("doc_id", "text_hash", "no_id")]
    first = first.select(F.coalesce("doc_id", F.lit(0)).alias("k1"), F.col("text_hash").alias("k2"), "no_id", *others)
    no_id = F.col("doc_id").isNull().alias("no_id")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, F.coalesce("doc_id", F.lit(0)).alias("k1"), F.xxhash64("text").alias("k2"), no_id).join(first, key)
    number = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))
    return rows.withColumn("number", number).where("number = 1").select("row", *others)


def keep_one(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """Rows of ``docs`` without near-duplicates: of each component the row with the smallest doc_id stays.

    Components are those of ``near_duplicates``. Ids that are null come last, rows of one id are ordered by their texts'
    hash; of repeated rows one stays.
    """
    prints = written(fingerprints(docs, words), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    firsts = prints.groupBy("fingerprint").agg(F.min(order).alias("first"))
    rooted = firsts.join(groups(prints, bit_keys(radius), radius), "fingerprint", "left")
    first = rooted.groupBy(F.coalesce("root", "fingerprint")).agg(F.min("first").alias("first")).select("first.*")
    return _picked(docs, first).select("row.*")
