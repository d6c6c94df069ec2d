"""A repeatable sample of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def sample_ids(records: DataFrame, rows: int, seed: int = 0) -> DataFrame:
    """``rows`` ids in hash order: looks random, and a retry picks the same ones."""
    order = F.md5(F.concat_ws(":", F.lit(seed), F.col("id")))
    return records.select("id").orderBy(order, "id").limit(rows)
