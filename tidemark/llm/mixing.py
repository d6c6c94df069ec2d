"""Mixing sources to target weights: balanced sampling by the cube method.

**Targets.** Sources are ordered by code point, null last, and weigh ``WEIGHTS`` in turn. Together they
get ``SHARE`` of all sizes; no source more than ``MOST`` times its own size, what it cannot take goes to
the others by weight until none is above. That has one solution: every source takes the smaller of its
cap and ``level * weight``, and sorting by cap over weight finds the level in one pass.

**Copies.** A document of a source is due target / source size copies. Whole copies are taken outright;
the fraction is an inclusion probability, and the cube method decides it: within a source the vector of
probabilities moves through the null space of the constraints (number of documents, words), each move
random and without drift, until every entry but a few is 0 or 1. Both totals stay as they were.

**In Spark.** The flight runs in strata of (source, hash) of about ``STRATUM`` documents, a few at a
time in constant memory, and leaves two undecided documents per stratum at most. Those meet in fewer strata
in the next round, and so on until a source fits in one; there the last two or so are landed, so that a
source's total is off by less than a document, and a short one. Each round is one shuffle of what is left. Random numbers
come from hashes of the stratum, and rows are sorted, so reruns agree.

Size is the number of words; a null or empty text has size 0 and is taken 0 words. Null and repeated
doc_ids are documents like others, repeated rows are separate ones. A source without words has target 0.
Other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, batches, values, written

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2.0
STRATUM = 4096
#: Undecided documents held at once where a source's last ones are decided: enough for the long ones to
#: be decided against many short ones, so that short ones are landed.
LAST = 128
#: Closer to 0 or 1 than this is decided.
EDGE = 1e-9


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACES}]+")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, n_docs, target`` from rows ``source, size``: one row per source."""
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    cycle = F.array(*[F.lit(w) for w in WEIGHTS])
    weighed = total.withColumn("weight", F.element_at(cycle, (F.row_number().over(order) - 1) % len(WEIGHTS) + 1))
    cap = F.col("source_size") * MOST
    by_ratio = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    up_to, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(0))
    # with all sources before this one at their caps, the level at which the rest of the share is dealt out
    level = (F.sum("source_size").over(every) * SHARE - F.coalesce(F.sum(cap).over(up_to), F.lit(0.0))) / F.sum("weight").over(after)
    levelled = weighed.withColumn("level", level).withColumn("holds", F.col("level") * F.col("weight") < cap)
    # the first source that stays below its cap sets the level; the sources before it are at their caps
    found = F.min(F.when(F.col("holds"), F.struct((cap / F.col("weight")).alias("ratio"), F.col("level").alias("level")))).over(every)
    target = F.least(cap, F.coalesce(found["level"] * F.col("weight"), cap))
    return levelled.select("source", "source_size", "n_docs", target.alias("target"))


class Cube:
    """The flight of one stratum: holds ``width`` undecided units at most, whatever the stratum's size."""

    def __init__(self, random: np.random.Generator, width: int):
        self.random = random
        self.width = width
        self.open: list[list] = []  # [key, probability, size]

    def add(self, key, probability: float, size: float) -> Iterator[tuple]:
        """Take one unit in; yields (key, 0 or 1) of units that are decided by it."""
        self.open.append([key, probability, size])
        if len(self.open) >= self.width:
            yield from self._decide()

    def rest(self) -> Iterator[tuple]:
        """Decide all but the last two or so."""
        while len(self.open) > 2:
            yield from self._decide()

    def _decide(self) -> Iterator[tuple]:
        """One move inside the null space of the totals, along what it leaves of the longest text's axis."""
        if len(self.open) == 3:
            x, y, z = (u[2] for u in self.open)
            move = (y - z, z - x, x - y)
        else:
            size = np.array([u[2] for u in self.open])
            bound = np.stack([np.ones(len(size)), size / size.max()])
            most = int(size.argmax())
            step = -bound.T @ (np.linalg.pinv(bound @ bound.T) @ bound[:, most])
            step[most] += 1
            move = tuple(np.where(np.abs(step) < 1e-12, 0.0, step).tolist())
        if not any(move):
            move = (1.0, -1.0) + (0.0,) * (len(self.open) - 2)
        yield from self._step(move)

    def _step(self, move: tuple[float, ...]) -> Iterator[tuple]:
        """To the end of the cube one way or the other, with the chances that leave no drift."""
        at = [u[1] for u in self.open]
        up = min((1 - p) / m if m > 0 else p / -m for p, m in zip(at, move) if m)
        down = min(p / m if m > 0 else (1 - p) / -m for p, m in zip(at, move) if m)
        go = up if self.random.random() * (up + down) < down else -down
        rest = []
        for unit, m in zip(self.open, move):
            unit[1] += go * m
            if unit[1] < EDGE or unit[1] > 1 - EDGE:
                yield unit[0], int(unit[1] > 0.5)
            else:
                rest.append(unit)
        if len(rest) == len(self.open):  # rounding kept the nearest unit off the edge
            nearest = min(rest, key=lambda u: min(u[1], 1 - u[1]))
            rest.remove(nearest)
            yield nearest[0], int(nearest[1] > 0.5)
        self.open = rest

    def land(self) -> Iterator[tuple]:
        """Decide what the flight left: words first, the number of documents may change by one."""
        yield from self.rest()
        while self.open:
            if len(self.open) == 2 and all(u[2] for u in self.open):
                (_, _, x), (_, _, y) = self.open
                yield from self._step((y, -x))
            else:
                key, p, _ = self.open.pop()
                yield key, int(self.random.random() < p)


_OUT = pa.schema(
    [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("source", pa.string()), ("size", pa.int64())]
    + [("whole", pa.int32()), ("fraction", pa.float64()), ("n_open", pa.int64()), ("picked", pa.int32())]
)
_OUT_DDL = "doc_id bigint, text_hash bigint, source string, size bigint, whole int, fraction double, n_open bigint, picked int"


def _flight(round_: int):
    """Rows sorted by (source, stratum): each with its decision, null if still open."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            last, cube, final = None, None, False

            def decided(found: Iterator[tuple]) -> Iterator[tuple]:
                for key, picked in found:
                    yield *key, picked

            def closed() -> Iterator[tuple]:
                if cube and final:
                    yield from decided(cube.land())
                elif cube:
                    yield from decided(cube.rest())
                    yield from ((*u[0][:5], u[1], u[0][6], None) for u in cube.open)

            for seed, stratum, strata, *row in values(stream):
                if (seed, row[2], stratum) != last:
                    yield from closed()
                    last, final = (seed, row[2], stratum), strata == 1
                    cube = Cube(np.random.default_rng([seed & (2**63 - 1), stratum, round_]), LAST if final else 3)
                yield from decided(cube.add(tuple(row), row[5], float(row[3])))
            yield from closed()

        yield from batches(_OUT, rows(), 4096)

    return run


def text_hash() -> Column:
    """With doc_id (0 for null), what tells documents apart."""
    return F.xxhash64("text", "source", F.col("doc_id").isNull(), F.col("source").isNull())


def copies(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, source, size, source_size, target, copies``: how often the mix takes each row."""
    sizes = docs.select("doc_id", text_hash().alias("text_hash"), "source", size_of(F.col("text")).alias("size"))
    sizes = written(sizes, "sizes")
    goals = written(targets(sizes), "targets")
    due = F.coalesce(F.col("target") / F.col("source_size"), F.lit(0.0))
    # one row per source, and a row with a hundred bytes for each: joined by size, as the optimizer finds it
    joined = sizes.join(goals.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    whole = F.floor(due + EDGE).cast("int")
    fraction = F.when(due - whole > EDGE, due - whole).otherwise(0.0)
    start = joined.select(
        "doc_id", "text_hash", "source", "size", whole.alias("whole"), fraction.alias("fraction"), F.col("n_docs").alias("n_open")
    )
    sure = start.where("fraction = 0 OR size = 0").withColumn("picked", F.lit(0))
    left = start.where("fraction > 0 AND size > 0")
    done, largest = [sure], goals.agg(F.max("n_docs")).first()[0] or 0
    for round_ in range(1 + max(0, math.ceil(math.log(max(1, largest / STRATUM), STRATUM / 4)))):
        # n_open bounds the rows a source has left, so strata hold STRATUM rows on average
        strata = F.ceil(F.col("n_open") / STRATUM).cast("bigint")
        stratum = F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(round_)), strata)
        dealt = left.select(F.xxhash64("source").alias("seed"), stratum.alias("stratum"), strata.alias("strata"), *left.columns[:7])
        dealt = dealt.repartition("seed", "stratum")
        # long texts first, so that what is open at the end, and landed, are short ones
        dealt = dealt.sortWithinPartitions("seed", "source", "stratum", F.col("size").desc(), "doc_id", "text_hash")
        flown = written(dealt.mapInArrow(_flight(round_), _OUT_DDL), "flight")
        done.append(flown.where("picked IS NOT NULL"))
        left = flown.where("picked IS NULL").withColumn("n_open", F.ceil(F.col("n_open") / STRATUM).cast("bigint") * 2)
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    goals = goals.withColumnRenamed("source", "of")
    return every.join(goals, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "text_hash", "source", "size", "source_size", "target", (F.col("whole") + F.col("picked")).alias("copies")
    )


def repeated(docs: DataFrame) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken. Repeated rows are paired by their number."""
    key = ["k1", "k2", "number"]
    number = F.row_number().over(Window.partitionBy("k1", "k2").orderBy(F.lit(0)))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce("doc_id", F.lit(0)).alias("k1"), text_hash().alias("k2"))
    taken = copies(docs).select(F.coalesce("doc_id", F.lit(0)).alias("k1"), F.col("text_hash").alias("k2"), "copies")
    both = rows.withColumn("number", number).join(taken.withColumn("number", number), key)
    return both.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).select("row.*")


def mix(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken``: the words the mix takes of each document, repeats counted."""
    return copies(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
