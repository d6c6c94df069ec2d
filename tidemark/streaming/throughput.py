"""Rows per second as a stream: counted per micro-batch, folded on read, so that no row is ever too late."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.batches import throughput
from tidemark.session import remove, subfolders

COUNTS = "bucket TIMESTAMP_NTZ, rows BIGINT"
#: Buckets older than the first, seen from the newest, become one per unit of the second.
COARSER = (("1 HOUR", "minute"), ("7 DAYS", "hour"))


def count_throughput(
    attempts: DataFrame,
    path: str,
    width: str = "1 second",
    trigger: dict | None = None,
    fold_every: int | None = None,
    coarser: Sequence[tuple[str, str]] = COARSER,
) -> StreamingQuery:
    """Write each batch's rows per bucket to ``path``; a batch that runs again replaces its counts.

    Every ``fold_every`` batches the counts so far become one table, in which old buckets are wider (``coarser``, from
    the youngest age on), and what the fold before had taken in is removed. No row is lost: sums stay.
    """

    def count(rows: DataFrame, batch_id: int) -> None:
        throughput(rows, width).write.mode("overwrite").parquet(f"{path}/counts/batch_id={batch_id}")
        if fold_every and (batch_id + 1) % fold_every == 0:
            _fold(rows.sparkSession, path, batch_id, coarser)

    return (
        attempts.writeStream.foreachBatch(count)
        .option("checkpointLocation", f"{path}/_checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(f.removeprefix("batch_id=")) for f in subfolders(spark, path) if f.startswith("batch_id="))


def _last_fold(spark: SparkSession, path: str, before: int | None = None) -> int:
    """The newest fold (before a batch) that was written to its end; -1 if there is none."""
    folds = [n for n in _numbers(spark, f"{path}/folds") if before is None or n < before]
    return max((n for n in folds if "_SUCCESS" in subfolders(spark, f"{path}/folds/batch_id={n}")), default=-1)


def _counts(spark: SparkSession, path: str, fold: int, upto: int | None = None) -> DataFrame:
    """Rows per bucket: a fold and the batches after it."""
    paths = [f"{path}/folds/batch_id={fold}"] if fold >= 0 else []
    recent = [n for n in _numbers(spark, f"{path}/counts") if n > fold and (upto is None or n <= upto)]
    paths += [f"{path}/counts/batch_id={n}" for n in recent]
    if not paths:
        return spark.createDataFrame([], COUNTS)
    return spark.read.schema(COUNTS).parquet(*paths).groupBy("bucket").agg(F.sum("rows").alias("rows"))


def _fold(spark: SparkSession, path: str, batch_id: int, coarser: Sequence[tuple[str, str]]) -> None:
    """Write the counts up to a batch as one table, then remove what the fold before it had taken in.

    That fold and the batches since stay until the next one, for readers that have listed them and for a batch that
    runs again: it starts from the same fold and writes the same.
    """
    before = _last_fold(spark, path, batch_id)
    counts = _counts(spark, path, before, batch_id)
    newest = counts.agg(F.max("bucket")).first()[0]
    bucket = F.col("bucket")
    for age, width in coarser:
        old = F.col("bucket") < F.lit(newest).cast("timestamp_ntz") - F.expr(f"INTERVAL {age}")
        bucket = F.when(old, F.date_trunc(width, "bucket").cast("timestamp_ntz")).otherwise(bucket)
    folded = counts.select(bucket.alias("bucket"), "rows").groupBy("bucket").agg(F.sum("rows").alias("rows"))
    folded.coalesce(1).write.mode("overwrite").parquet(f"{path}/folds/batch_id={batch_id}")
    for number in _numbers(spark, f"{path}/counts"):
        if number <= before:
            remove(spark, f"{path}/counts/batch_id={number}")
    for number in _numbers(spark, f"{path}/folds"):
        if number < before:
            remove(spark, f"{path}/folds/batch_id={number}")


def counted(spark: SparkSession, path: str, as_of: Column | None = None, kept: str | None = None) -> DataFrame:
    """All buckets; with ``as_of``, those no older by then than ``kept``: buckets expire, rows do not."""
    folded = _counts(spark, path, _last_fold(spark, path))
    if as_of is None:
        return folded
    return folded.where((F.col("bucket") > as_of - F.expr(f"INTERVAL {kept}")) & (F.col("bucket") <= as_of))
