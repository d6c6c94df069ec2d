"""Running values and row positions that no single key can pull into one task.

A plain window puts a whole key, or without one the whole table, into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import new_dir, remove

RANGE_BITS = 20  # a key is cut into ranges of 2**20 order values

_AGGREGATE = {"max": F.max, "sum": F.sum}
_FIRST = -(2**63)


def running(
    rows: DataFrame,
    keys: list[str],
    seq: str,
    value: Column,
    how: str,
    out: str,
    start: DataFrame | None = None,
    bits: int = RANGE_BITS,
) -> DataFrame:
    """Add ``out``: the max or sum of ``value`` over the earlier rows of the same keys.

    ``seq`` is an arrival number: a bigint, unique within a key, and as dense over the whole table as
    arrival numbers are. The current row is not included. ``start`` (keys + ``out``) gives a value from
    before the first row.

    Every key is cut into fixed ranges of ``seq``, of 2**bits rows at most. A window runs inside each, and
    what the ranges before add up to, combined before its shuffle, is carried in. That is two
    reads of the rows, of which the second takes keys, ``seq`` and value only.
    """
    aggregate = _AGGREGATE[how]
    valued = rows.withColumn("_value", value).withColumn("_given", F.lit(True))
    if start is not None:
        before = start.select(*keys, F.lit(_FIRST).cast("bigint").alias(seq), F.col(out).alias("_value"))
        valued = valued.unionByName(before, allowMissingColumns=True)
    ranged = valued.withColumn("_range", F.shiftright(seq, bits))

    earlier_rows = Window.partitionBy(*keys, "_range").orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumn("_inside", aggregate("_value").over(earlier_rows)).where("_given")

    totals = ranged.groupBy(*keys, "_range").agg(aggregate("_value").alias("_total"))
    earlier_ranges = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*keys, "_range", aggregate("_total").over(earlier_ranges).alias("_carried"))

    if how == "max":
        combined = F.greatest("_carried", "_inside")
    else:
        combined = F.coalesce("_carried", F.lit(0)) + F.coalesce("_inside", F.lit(0))
    return (
        inside.join(carried, [*keys, "_range"], "left")
        .withColumn(out, combined)
        .select(*rows.columns, out)
    )


def _sorted(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows in one global order, each with its task and its place there.

    The rows are sorted by ranges that Spark samples, so that a value many rows share is cut by
    the columns after it.
    """
    return rows.orderBy(*order).select(
        *rows.columns, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row")
    )


def _starts(written: DataFrame) -> DataFrame:
    """Of each task of the sort, what to add to a place there to get the place in all: one row per task."""
    parts = written.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"), F.min("_row").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(
        "_part", "_size", (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first")).alias("_start")
    )


def positions(rows: DataFrame, order: list[str], out: str = "position") -> DataFrame:
    """Number all rows from 0 in one global order; ``order`` must tell all rows apart.

    The sorted rows are checkpointed before the tasks are counted: were they computed twice, they
    could be cut differently. Spark drops the checkpoint with the frame, if its cleaner is told to
    (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(new_dir(rows.sparkSession, "checkpoints"))
    written = _sorted(rows, order).checkpoint()
    starts = _starts(written).drop("_size")
    return written.join(F.broadcast(starts), "_part").select(*rows.columns, (F.col("_start") + F.col("_row")).alias(out))


class SortedCopy:
    """A table sorted once and written, to be read page by page and then removed.

    Each page reads the files its rows lie in: the task's number, which is the same all through a file,
    is pushed to the reader.
    """

    def __init__(self, rows: DataFrame, order: list[str]):
        self.spark, self.columns = rows.sparkSession, rows.columns
        self.path = new_dir(self.spark, "sorted")
        numbered = _sorted(rows, order)
        numbered.write.parquet(self.path)
        self._rows = self.spark.read.schema(numbered.schema).parquet(self.path)
        self._tasks = _starts(self._rows).orderBy("_part").collect()  # one row per task
        self.size = sum(t["_size"] for t in self._tasks)

    def page(self, low: int, high: int) -> DataFrame:
        """Rows with ``position`` from ``low`` up to, not including, ``high``."""
        known, at = [], 0
        for task in self._tasks:
            if at < high and at + task["_size"] > low:
                known.append((task["_part"], task["_start"]))
            at += task["_size"]
        if not known:
            return self._rows.limit(0).select(*self.columns, F.col("_row").alias("position"))
        starts = F.create_map(*[F.lit(x) for pair in known for x in pair])
        near = self._rows.where(F.col("_part").between(known[0][0], known[-1][0]))
        placed = near.select(*self.columns, (starts[F.col("_part")] + F.col("_row")).alias("position"))
        return placed.where((F.col("position") >= low) & (F.col("position") < high))

    def remove(self) -> None:
        remove(self.spark, self.path)
