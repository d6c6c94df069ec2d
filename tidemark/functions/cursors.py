"""Keyset predicates, written so that the Parquet and JDBC readers can use them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def after_id(cursor_id, id_col: str = "id") -> Column:
    """Rows strictly past an id cursor."""
    return F.col(id_col) > cursor_id


def after_key(cursor_ts, cursor_id, ts_col: str = "updated_at", id_col: str = "id") -> Column:
    """Rows strictly past a (timestamp, id) cursor.

    A struct comparison would say the same but is not pushed down. The leading range on the
    timestamp alone lets the scan skip row groups and partitions before the tie-break is read.
    """
    ts = F.col(ts_col)
    return (ts >= cursor_ts) & ((ts > cursor_ts) | (F.col(id_col) > cursor_id))
