"""Keyset extraction: pages, page boundaries, and the cursor that remembers how far a mode got."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import schema as S
from tidemark.functions.cursors import after_id, after_key
from tidemark.functions.times import utc
from tidemark.operators.ordered import positions


def scan(records: DataFrame) -> DataFrame:
    """The source table with its columns named, so that the reader prunes any others."""
    return records.select(*S.RECORD_COLUMNS)


def backfill_page(records: DataFrame, cursor_id, limit: int = S.BATCH_ROWS) -> DataFrame:
    return scan(records).where(after_id(cursor_id)).orderBy("id").limit(limit)


def incremental_page(
    records: DataFrame, cursor_ts, cursor_id, limit: int = S.BATCH_ROWS, overlap: str | None = None
) -> DataFrame:
    """The next rows by (updated_at, id).

    A row committed late with an older ``updated_at`` lies behind the cursor. ``overlap`` (such as
    ``"5 minutes"``) reads that much again; the repeats are absorbed by version and event id. A page that
    is full ends inside the overlap, maybe; read on from its last row, given as cursor without
    ``overlap``, and save ``later_cursor`` of that row and the old cursor.
    """
    return scan(records).where(past_key(cursor_ts, cursor_id, overlap)).orderBy("updated_at", "id").limit(limit)


def past_key(cursor_ts, cursor_id, overlap: str | None = None) -> Column:
    """Rows past a cursor, or past that much before it."""
    since = utc(cursor_ts)
    if overlap is None:
        return after_key(since, cursor_id)
    return F.col("updated_at") >= since - F.expr(f"INTERVAL {overlap}")


def later_cursor(cursor: tuple, other: tuple) -> tuple:
    """Of two (time, id) cursors the one further on, so that an overlap never moves a cursor back."""
    return max((c for c in (cursor, other) if c[0] is not None), default=cursor)


def rows_after_checkpoint(records: DataFrame, checkpoints: DataFrame, mode: str) -> DataFrame:
    """All rows past the stored cursor of a mode; all rows when there is none.

    The cursor, one row, is read first, so that the scan is given plain values to filter by.
    """
    cursor = checkpoint(checkpoints, mode).first()
    if cursor is None:
        return scan(records)
    if mode == S.BACKFILL:
        return scan(records).where(after_id(cursor["cursor_id"]))
    since = cursor["cursor_ts"] or S.EPOCH
    return scan(records).where(after_key(utc(since), cursor["cursor_id"]))


def backfill_pages(records: DataFrame, size: int = S.BATCH_ROWS) -> DataFrame:
    """Every page of a whole backfill at once: its number, row count and closing cursor."""
    numbered = positions(records.select("id"), ["id"])
    return (
        numbered.groupBy(F.expr(f"position div {size}").alias("page"))
        .agg(F.max("id").alias("cursor_id"), F.count(F.lit(1)).alias("rows"))
    )


def incremental_pages(records: DataFrame, size: int = S.BATCH_ROWS) -> DataFrame:
    """As ``backfill_pages`` in (updated_at, id) order; ties of any size are split by id."""
    numbered = positions(records.select("updated_at", "id"), ["updated_at", "id"])
    last = F.max(F.struct("updated_at", "id")).alias("_last")
    return (
        numbered.groupBy(F.expr(f"position div {size}").alias("page"))
        .agg(last, F.count(F.lit(1)).alias("rows"))
        .select(
            "page",
            F.col("_last.updated_at").alias("cursor_ts"),
            F.col("_last.id").alias("cursor_id"),
            "rows",
        )
    )


def batch_cursor(rows: DataFrame, mode: str) -> DataFrame:
    """The cursor a batch ends at, as one row; null cursor_id when the batch is empty."""
    if mode == S.BACKFILL:
        return rows.agg(
            F.max("id").alias("cursor_id"), F.lit(None).cast("timestamp_ntz").alias("cursor_ts")
        )
    last = rows.agg(F.max(F.struct("updated_at", "id")).alias("_last"))
    return last.select(
        F.col("_last.id").alias("cursor_id"), F.col("_last.updated_at").alias("cursor_ts")
    )


def initial_checkpoints(spark) -> DataFrame:
    rows = [(S.BACKFILL, 0, None), (S.INCREMENTAL, 0, S.EPOCH)]
    return spark.createDataFrame(rows, S.CHECKPOINTS)


def checkpoint(checkpoints: DataFrame, mode: str) -> DataFrame:
    return checkpoints.where(F.col("mode") == mode).select("mode", "cursor_id", "cursor_ts")


def save_checkpoint(checkpoints: DataFrame, cursor: DataFrame, mode: str) -> DataFrame:
    """Checkpoints after a batch; an empty batch leaves the cursor where it was."""
    moved = cursor.where(F.col("cursor_id").isNotNull()).select(
        F.lit(mode).alias("mode"), "cursor_id", "cursor_ts", F.lit(1).alias("_age")
    )
    found = checkpoints.select("mode", "cursor_id", "cursor_ts", F.lit(0).alias("_age"))
    newest = F.max_by(F.struct("cursor_id", "cursor_ts"), "_age").alias("_at")
    return found.unionByName(moved).groupBy("mode").agg(newest).select("mode", "_at.*")


def with_boot_watermark(checkpoints: DataFrame, started_at: Column) -> DataFrame:
    """Start a never-used incremental cursor at the job's start: history belongs to the backfill."""
    epoch = utc(S.EPOCH)
    untouched = (
        (F.col("mode") == S.INCREMENTAL)
        & (F.col("cursor_id") == 0)
        & (F.coalesce("cursor_ts", epoch) <= epoch)
    )
    return checkpoints.select(
        "mode", "cursor_id", F.when(untouched, started_at).otherwise(F.col("cursor_ts")).alias("cursor_ts")
    )


def resume_positions(checkpoints: DataFrame) -> DataFrame:
    """The ids both modes resume from, as one row."""
    at = lambda mode: F.max(F.when(F.col("mode") == mode, F.col("cursor_id"))).alias(mode)
    return checkpoints.agg(at(S.BACKFILL), at(S.INCREMENTAL))


def dual_mode(records: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Both modes' remaining rows with their mode; a row past both cursors appears twice."""
    backfill = rows_after_checkpoint(records, checkpoints, S.BACKFILL)
    incremental = rows_after_checkpoint(records, checkpoints, S.INCREMENTAL)
    return backfill.withColumn("mode", F.lit(S.BACKFILL)).unionByName(
        incremental.withColumn("mode", F.lit(S.INCREMENTAL))
    )
