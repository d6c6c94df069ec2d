"""Spelling variants of a corpus's words: near words by a bidirectional FM-index, forms and roots by frequency.

Words one edit apart share their first or second half. Each word goes to the shards of the halves it
could be asked for by, and asks in the shards of its own two halves; a shard is a run of keys with a
bounded number of characters, and has an index of its own. A key with more than ``CHUNK`` words is dealt
into chunks, and all that ask for it ask in each chunk, so no task holds more than a chunk whatever the key.

Null texts have no words; a null doc_id counts as the text ``null``. Repeated rows are documents like
others. Texts of any length are read whole. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches, values, written
from tidemark.llm.fmindex import near_words

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
DAMAGE = 199  #: one run in so many loses a character
CHUNK = 4096  #: words of one key in an index
SHARD = 65536  #: characters in an index, but for a chunk of long words
HELD = 200_000  #: counts that a task keeps before it passes them on


def lowered(text: str) -> str:
    """A-Z lower-cased, nothing else."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def damaged(run: str, crc: int) -> str:
    """The run, or without one character, as its checksum with the document's id before it says."""
    mark = zlib.crc32(run.encode("utf-8", "surrogatepass"), crc)
    if mark % DAMAGE:
        return run
    at = mark % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n``: the words of all texts that are long enough and stand often enough."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            held: Counter[str] = Counter()
            for doc_id, text in values(stream):
                crc = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(LETTERS.findall(lowered(text or ""))).items():
                    if len(word) >= min_length:
                        word = damaged(word, crc)
                        if len(word) >= min_length:
                            held[word] += n
                if len(held) > HELD:
                    yield from held.items()
                    held.clear()
            yield from held.items()

        yield from batches(schema, rows(), 10_000)

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n bigint").groupBy("word")
    return counted.agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _halves(words: DataFrame, min_length: int) -> DataFrame:
    """``key, asks, word, n``: each word under the halves of words one shorter, as long and one longer.

    A key is a half with its side. Under its own halves the word also asks.
    """
    length, word = F.length("word"), F.col("word")
    keys = []
    for away in (-1, 0, 1):
        cut = F.floor((length + away) / 2).cast("int")
        rest = length + away - cut
        there = length + away >= min_length
        keys += [F.when(there, F.concat(F.lit("<"), word.substr(F.lit(1), cut)))]
        keys += [F.when(there, F.concat(F.lit(">"), word.substr(length - rest + 1, rest)))]
    own = F.array(keys[2], keys[3])
    key = F.explode(F.array_distinct(F.array_compact(F.array(*keys)))).alias("key")
    return words.select("word", "n", own.alias("own"), key).select("key", F.array_contains("own", F.col("key")).alias("asks"), "word", "n")


def near_pairs(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``word, near, near_n``: all pairs of words one edit apart, in both directions, each once."""
    rows = written(_halves(words, min_length), "halves")
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    chunks = F.ceil(F.col("size") / CHUNK).cast("int").alias("chunks")
    rows = rows.join(sizes.select("key", chunks), "key")
    # chunk 0 is a whole key; chunks of a key that is dealt count from 1 and share their index with no other key,
    # where a word of another chunk could stand by that other key
    whole = F.col("chunks") == 1
    home = F.when(whole, 0).otherwise(F.pmod(F.xxhash64("word"), F.col("chunks")) + 1).cast("int")
    everywhere = F.when(whole, F.array(home)).otherwise(F.sequence(F.lit(1), F.col("chunks")))
    asked_in = F.when(F.col("asks"), everywhere).otherwise(F.array(home))
    dealt = rows.select("key", "asks", "word", "n", home.alias("home"), F.explode(asked_in).alias("chunk"))
    dealt = dealt.select("key", "chunk", "word", "n", "asks", (F.col("home") == F.col("chunk")).alias("stands"))
    schema = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])

    def found(group: list[tuple]) -> Iterator[tuple]:
        for side, rows in groupby(group, key=lambda r: r[0][0]):
            counts: dict[str, int] = {}
            asked: dict[str, None] = {}
            for _, _, word, n, asks, stands in rows:
                if stands:
                    counts[word] = n
                if asks:
                    asked[word] = None
            words, asking = list(counts), list(asked)
            if not words or not asking:
                continue
            for a, w in near_words(words, asking, side == "<"):
                word, near = asking[a], words[w]
                # pairs that share the first half are the other side's, so that each is found once
                if side == "<" or near[: len(word) // 2] != word[: len(word) // 2]:
                    yield word, near, counts[near]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            held: list[tuple] = []
            size = 0
            for (_, chunk), group in groupby(values(stream), key=lambda r: r[:2]):
                group = list(group)
                chars = sum(len(r[2]) + 1 for r in group)
                if held and (size + chars > SHARD or chunk > 0 or held[-1][1] > 0):
                    yield from found(held)
                    held, size = [], 0
                held += group
                size += chars
            if held:
                yield from found(held)

        yield from batches(schema, rows(), 10_000)

    laid = dealt.repartition("key", "chunk").sortWithinPartitions("key", "chunk")
    return laid.mapInArrow(run, "word string, near string, near_n bigint")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``(word, form)``: the last word that following the forms leads to.

    A form is at least ``RATIO`` times as frequent as its word, so there are no rings, and a path is short; each round
    doubles how far a word looks ahead.
    """
    known = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        known = written(known.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        if known.where("next is not null").isEmpty():
            return known.select("word", "root")
        known = known.select("word", "root")


def group_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the vocabulary.

    ``form`` is the near word of largest n (ties: the smallest) if that is ``ratio`` times the word's
    n at least; ``root`` follows forms to the last.
    """
    words = written(vocabulary(docs, min_length, min_count), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near"))).alias("best")
    near = near_pairs(words, min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    joined = words.join(near, "word", "left")
    is_form = -F.col("best.n") >= ratio * F.col("n")
    formed = written(
        joined.select(
            "word",
            F.when(is_form, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, -F.col("best.n")).alias("form_n"),
        ),
        "forms",
    )
    led = roots(formed.where("form is not null"))
    root = F.coalesce("root", "word").alias("root")
    return formed.join(led, "word", "left").select("word", "form", root, "n", "n_near", "form_n")
