"""Replication from a table that changes in place: pages past the mode's cursor, in key order.

Rows of such a table are updated, not appended, so there are no new files to stream; what is new
is found by key. The rows past the cursor are sorted and written once, whole; pages are committed
from there, several in one job, so that a page is the same rows however often it is tried, and the source is read once
however many pages there are. The copy is removed at the end.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tidemark import schema as S
from tidemark.functions.cursors import after_id
from tidemark.functions.times import utc
from tidemark.operators.cursor import checkpoint, initial_checkpoints, past_key, scan, with_boot_watermark
from tidemark.operators.ordered import SortedCopy
from tidemark.operators.validate import Rule
from tidemark.streaming.replicate import Sender, commit_pages
from tidemark.streaming.tables import ReplicationTables

ROWS_PER_BATCH = 10_000_000
PAGES_PER_COMMIT = 16


def resume_point(
    spark, tables: ReplicationTables, mode: str, started_at: datetime
) -> tuple[int | None, datetime | None]:
    """The cursor a mode goes on from; an incremental one never used starts at ``started_at``.

    A backfill never used has no cursor, and so no lower bound: ids may be of any sign.
    """
    moved = checkpoint(tables.checkpoints(spark), mode).first()
    if moved is None and mode == S.BACKFILL:
        return None, None
    if moved is None:
        begun = with_boot_watermark(initial_checkpoints(spark), utc(started_at))
        moved = checkpoint(begun, mode).first()
    return moved["cursor_id"], moved["cursor_ts"]


def remaining(source: DataFrame, mode: str, cursor: tuple[int | None, datetime | None], overlap: str | None) -> DataFrame:
    """What the source has past a cursor; nulls in the key lie past every cursor and before none."""
    rows = scan(source)
    if mode == S.BACKFILL:
        return rows if cursor[0] is None else rows.where(after_id(cursor[0]))
    return rows.where(past_key(cursor[1], cursor[0], overlap))


def sync(
    source: DataFrame,
    tables: ReplicationTables,
    mode: str,
    started_at: datetime,
    rows_per_batch: int = ROWS_PER_BATCH,
    rules: list[Rule] | None = None,
    overlap: str | None = None,
    store_to: Sender | None = None,
    publish_to: Sender | None = None,
    pages_per_commit: int = PAGES_PER_COMMIT,
) -> int:
    """Replicate all there is past the mode's cursor; returns how many batches that took.

    Stopped anywhere, the next call goes on after the last batch committed. ``overlap`` reads again
    that far behind the incremental cursor, for rows committed late; the repeats are absorbed,
    and the cursor stays where it was until rows past it are committed. Up to ``pages_per_commit`` pages
    are written in one job and then logged one after the other; with ``store_to`` each is committed by itself.
    """
    spark, owner = source.sparkSession, f"sync-{mode}"
    log = tables.batch_log(spark).where(F.col("ok") & (F.col("mode") == mode))
    ours = F.col("owner") == owner
    number, last_seq = log.agg(
        F.coalesce(F.max(F.when(ours, F.col("number"))) + 1, F.lit(0)), F.coalesce(F.max("last_seq"), F.lit(-1))
    ).first()
    cursor = resume_point(spark, tables, mode, started_at)
    order = ["id"] if mode == S.BACKFILL else ["updated_at", "id"]
    copy = SortedCopy(remaining(source, mode, cursor, overlap), order)
    try:
        pages = range(0, copy.size, rows_per_batch)
        together = 1 if store_to is not None else pages_per_commit
        # Arrival numbers go on from the mode's last one; even for the backfill, odd for the other
        # mode, so that none is used twice.
        first = last_seq // 2 + 1
        for start in range(0, len(pages), together):
            some = pages[start : start + together]
            rows = copy.page(some[0], some[-1] + rows_per_batch)
            arrival = (F.lit(first) + F.col("position")) * 2 + (0 if mode == S.BACKFILL else 1)
            page = F.floor((F.col("position") - some[0]) / rows_per_batch)
            rows = rows.withColumns({"seq": arrival, "page": page})
            numbers = list(range(number + start, number + start + len(some)))
            commit_pages(rows, numbers, tables, mode, rules, store_to, publish_to, owner)
    finally:
        copy.remove()
    return len(pages)
