"""Deduplicated events with hit counts, kept as partial counts that merge in any order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def consumed_events(deliveries: DataFrame) -> DataFrame:
    """One row per event id: fields of its first delivery and how often it came again.

    The aggregate keeps only numbers per key, so it hashes, and combines before the shuffle.
    """
    return deliveries.groupBy("event_id").agg(
        F.min_by("record_id", "seq").alias("record_id"),
        F.min_by("version", "seq").alias("version"),
        (F.count(F.lit(1)) - F.lit(1)).cast("bigint").alias("duplicate_hits"),
        F.min("seq").alias("first_seq"),
    )


def merge_consumed(*parts: DataFrame) -> DataFrame:
    """Fold consumed tables into one: of n deliveries in all, n - 1 are duplicates."""
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return together.groupBy("event_id").agg(
        F.min_by("record_id", "first_seq").alias("record_id"),
        F.min_by("version", "first_seq").alias("version"),
        (F.sum(F.col("duplicate_hits") + F.lit(1)) - F.lit(1)).cast("bigint").alias("duplicate_hits"),
        F.min("first_seq").alias("first_seq"),
    )


def consumed_totals(consumed: DataFrame) -> DataFrame:
    """Distinct records seen and redeliveries absorbed."""
    return consumed.agg(
        F.count_distinct("record_id").alias("distinct_records"),
        F.coalesce(F.sum("duplicate_hits"), F.lit(0)).cast("bigint").alias("deduplicated"),
    )
