"""Windows of the corpus that stand in it more than once: the frame that suffix order and automata work in.

1. Every text is cut once into spans by content (``spans``), so that equal windows lie in spans of one mark. They are written.
2. Marks are counted, and the spans of marks that are met again are kept.
3. Equal spans become one row with their number, their smallest and their largest document; one of them lends
   its text.
4. Spans of a mark meet in a shard, where ``solve`` finds the windows that recur. Shards are bounded in bytes.
5. What is found goes back to every place the span stands at, and by document to the texts.

A mark whose different spans are longer than ``most`` in all would make a shard without bound. Its different spans are texts themselves
then, and go through the same steps with longer pieces, which fewer of them share; the last pieces are as long as a window, so that
a mark is one window and what a shard holds of it is bounded. Spans of a mark are dealt by joins whose other side has one row
per mark, so that a mark that every third text has is split like any skewed key. Texts are compressed for their way
through the shuffle.

A document is known by its id and its text's hash. Repeated rows are counted as often as they stand there, and get
the same answer each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batches, values, written
from tidemark.llm.spans import cut

KEY = ["k1", "k2"]
#: Windows of a span, at most.
SPAN = 1024


@dataclass(frozen=True)
class Kind:
    """What a text is made of, and when a window counts as met again."""

    size: int  # units of a window
    grams: tuple[int, ...]  # units of the pieces that marks are from: of all texts, of marks with too many spans, and so on up to ``size``
    units: Callable[[bytes], tuple[np.ndarray, object]]  # a text's units as numbers, and as what ``piece`` takes
    piece: Callable[[object, int, int], bytes]  # the units from one to another
    recurs: Callable[[], Column]  # of ``n``, ``low``, ``high``: number, smallest and largest document
    solve: Callable[[list[tuple]], Iterator[tuple]]  # a shard's (mark, key, n, low, high, text) to (index, start, n, low)
    shard: int  # bytes of text after which a shard is closed
    most: int  # units of one mark's different spans that a shard takes
    needs_id: bool = False  # documents without an id take no part


def packed(docs: DataFrame) -> DataFrame:
    """``k1, k2, doc_id, packed``: keys without nulls, and the text as compressed UTF-8 (null: empty)."""
    return _packed(_keyed(docs))


def _packed(texts: DataFrame) -> DataFrame:
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("doc_id", pa.int64()), ("packed", pa.binary())])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shrink = zstandard.ZstdCompressor(level=1)
        yield from batches(schema, ((a, b, d, shrink.compress(t or b"")) for a, b, d, t in values(stream)), 256)

    return texts.select(*KEY, "doc_id", "text").mapInArrow(run, "k1 bigint, k2 bigint, doc_id bigint, packed binary")


def _keyed(docs: DataFrame) -> DataFrame:
    no_id = F.col("doc_id").isNull()
    text = F.col("text").cast("binary").alias("text")
    return docs.select(F.coalesce("doc_id", F.lit(0)).alias("k1"), F.xxhash64("text", no_id).alias("k2"), "doc_id", text)


def unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


_SPANS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("mark", pa.int64()), ("key", pa.int64()), ("start", pa.int32()), ("windows", pa.int32()), ("weight", pa.int32())])
_SPANS_DDL = "k1 bigint, k2 bigint, mark bigint, key bigint, start int, windows int, weight int"
_FACTS = pa.schema([("n", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])
_FACTS_DDL = ", n bigint, low bigint, high bigint"


def _spans_of(texts: DataFrame, kind: Kind, level: int) -> DataFrame:
    """Every span: where it is, its mark, its content's hash, 2 as weight if it may hold a window twice.

    Beyond level 0, also the ``n, low, high`` of the text it is from.
    """
    facts = [f.name for f in _FACTS] if level else []
    schema = pa.schema([*_SPANS, *_FACTS]) if level else _SPANS

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_of = xxhash.xxh3_64_intdigest
        held: list[list[np.ndarray]] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], schema=schema)

        for k1, k2, text, *known in values(stream):
            units, pieces = kind.units(text)
            marks, starts, counts, inside = cut(units, kind.size, kind.grams[level], SPAN)
            if not len(starts):
                continue
            ends = starts + counts + kind.size - 1
            content = np.array([hash_of(kind.piece(pieces, a, b)) for a, b in zip(starts.tolist(), ends.tolist())], np.uint64)
            columns = [np.full(len(starts), k1), np.full(len(starts), k2), marks.view(np.int64), content.view(np.int64)]
            columns += [starts.astype(np.int32), counts.astype(np.int32), 1 + inside.astype(np.int32)]
            held.append(columns + [np.full(len(starts), fact) for fact in known])
            if sum(len(h[0]) for h in held[-64:]) > 20_000 or len(held) >= 512:
                yield batch()
                held = []
        if held:
            yield batch()

    return texts.where("text IS NOT NULL").select(*KEY, "text", *facts).mapInArrow(run, _SPANS_DDL + (_FACTS_DDL if level else ""))


_TEXTS = pa.schema([("mark", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("hot", pa.bool_()), ("text", pa.binary())])
_TEXTS_DDL = "mark bigint, key bigint, n bigint, low bigint, high bigint, hot boolean, text binary"


def _lent(texts: DataFrame, distinct: DataFrame, kind: Kind) -> DataFrame:
    """The text of every distinct span, from the text it is taken from."""
    asked = distinct.groupBy(F.col("from.k1").alias("k1"), F.col("from.k2").alias("k2"))
    asked = asked.agg(F.collect_list(F.struct("mark", "key", "n", "low", "high", "hot", F.col("from.start").alias("start"), F.col("from.windows").alias("windows"))).alias("asked"))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for data, wanted in values(stream):
                _, held = kind.units(unpacked(data))
                for w in wanted:
                    text = kind.piece(held, w["start"], w["start"] + w["windows"] + kind.size - 1)
                    yield w["mark"], w["key"], w["n"], w["low"], w["high"], w["hot"], text

        yield from batches(_TEXTS, rows())

    return _packed(texts).join(asked, KEY).select("packed", "asked").mapInArrow(run, _TEXTS_DDL)


_FOUND = pa.schema([("mark", pa.int64()), ("key", pa.int64()), ("offset", pa.int32()), ("windows", pa.int32()), ("low", pa.int64())])
_FOUND_DDL = "mark bigint, key bigint, offset int, windows int, low bigint"


def _sharded(texts: DataFrame, kind: Kind) -> DataFrame:
    """Runs of recurring windows, found shard by shard: marks stay whole, full shards are closed."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(held: list[tuple]) -> Iterator[tuple]:
            for k, offset, windows, low in kind.solve(held):
                yield held[k][0], held[k][1], offset, windows, low

        def rows() -> Iterator[tuple]:
            held: list[tuple] = []
            size = 0
            for row in values(stream):
                if held and row[:2] == held[-1][:2]:  # lent by a repeated row
                    continue
                if size >= kind.shard and row[0] != held[-1][0]:
                    yield from solved(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[-1])
            yield from solved(held)

        yield from batches(_FOUND, rows(), 8192)

    rows = texts.select("mark", "key", "n", "low", "high", "text").repartition("mark")
    return rows.sortWithinPartitions("mark", "key").mapInArrow(run, _FOUND_DDL)


def _merged(runs: DataFrame) -> DataFrame:
    """Runs of a text that follow each other, with the same smallest document, as one; a text is a span here."""
    ordered = Window.partitionBy(*KEY).orderBy("start")
    follows = (F.lag(F.col("start") + F.col("windows")).over(ordered) == F.col("start")) & (F.lag("low").over(ordered) == F.col("low"))
    numbered = runs.withColumn("begins", F.when(follows, 0).otherwise(1)).withColumn("run", F.sum("begins").over(ordered))
    merged = numbered.groupBy(*KEY, "run").agg(F.min("start").alias("start"), F.sum("windows").cast("int").alias("windows"), F.min("low").alias("low"))
    return merged.drop("run")


def _found(texts: DataFrame, kind: Kind, level: int = 0) -> DataFrame:
    """``k1, k2, start, windows, low``: runs of recurring windows of texts.

    At level 0 texts are documents. Further on they are different spans of marks that had too many, with ``n, low, high``.
    """
    spans = written(_spans_of(texts, kind, level), "spans")
    n, low, high = (F.col("n"), F.col("low"), F.col("high")) if level else (F.lit(1), F.col("k1"), F.col("k1"))
    marks = spans.groupBy("mark").agg(F.sum(n * F.col("weight")).alias("n"), F.min(low).alias("low"), F.max(high).alias("high"))
    marks = written(marks.where(kind.recurs()).select("mark"), "marks")  # on its own, so that a hot mark's spans are split
    kept = written(spans.join(marks, "mark"), "met")

    lender = F.min(F.struct("k1", "k2", "start", "windows")).alias("from")
    one = kept.groupBy("mark", "key").agg(F.sum(n).alias("n"), F.min(low).alias("low"), F.max(high).alias("high"), lender)
    one, last = written(one, "distinct"), level + 1 == len(kind.grams)
    length = F.sum(F.col("from.windows") + (kind.size - 1)).alias("length")
    many = one.groupBy("mark").agg(length).where(F.lit(not last) & (F.col("length") > kind.most)).select("mark", F.lit(True).alias("hot"))
    distinct = one.join(written(many, "many"), "mark", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    lent = written(_lent(texts, distinct, kind), "texts")

    found, hot = _sharded(lent.where("NOT hot"), kind), lent.where("hot")
    if not last and not hot.isEmpty():
        inner = hot.dropDuplicates(["mark", "key"])  # lent by a repeated row
        inner = inner.select(F.col("mark").alias("k1"), F.col("key").alias("k2"), F.lit(0).cast("bigint").alias("doc_id"), "n", "low", "high", "text")
        inner = _found(written(inner, "hot"), kind, level + 1)
        found = found.unionByName(_merged(inner).select(F.col("k1").alias("mark"), F.col("k2").alias("key"), F.col("start").alias("offset"), "windows", "low"))
    found = written(found, "found")

    places = kept.select("mark", "key", *KEY, "start").join(found, ["mark", "key"])
    return places.select(*KEY, (F.col("start") + F.col("offset")).alias("start"), "windows", found["low"].alias("low"))


def repeated(docs: DataFrame, kind: Kind) -> DataFrame:
    """``k1, k2, runs``: of each document that has any, the runs (start, windows, low) of recurring windows."""
    texts = _keyed(docs.where("doc_id IS NOT NULL") if kind.needs_id else docs)
    return _found(texts, kind).groupBy(*KEY).agg(F.collect_list(F.struct("start", "windows", "low")).alias("runs"))


def covered(size: int, n_units: int, runs: list[dict]) -> np.ndarray:
    """Which units of a text lie in a window of the runs."""
    change = np.zeros(n_units + 1, np.int64)
    if runs:
        starts = np.array([r["start"] for r in runs])
        np.add.at(change, starts, 1)
        np.add.at(change, starts + np.array([r["windows"] for r in runs]) + size - 1, -1)
    return np.cumsum(change[:-1]) > 0
