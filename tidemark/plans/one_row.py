"""Putting one-row results side by side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def beside(*rows: DataFrame) -> DataFrame:
    """One-row tables as a single row: stacked, then each column's only value taken.

    This needs neither a cross join nor a subquery per value, so all of them run as one job.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.any_value(c, F.lit(True)).alias(c) for c in stacked.columns])


def packed(row: DataFrame, name: str) -> DataFrame:
    """A one-row table as one struct column."""
    return row.select(F.struct(*row.columns).alias(name))
