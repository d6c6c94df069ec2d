"""Time values without a zone: every timestamp in the tables is UTC."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F


def utc(value: datetime | str | Column) -> Column:
    """A UTC timestamp without a zone; a literal, so that it can be pushed to the reader."""
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def micros(value: Column) -> Column:
    return F.unix_micros(value.cast("timestamp"))


def seconds_between(earlier: Column, later: Column) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(1_000_000)


def second_of(value: Column) -> Column:
    return F.date_trunc("second", value).cast("timestamp_ntz")
