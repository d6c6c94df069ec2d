"""Row rules checked at the sink: a failing row is marked, never dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import schema as S

Rule = tuple[str, Column]  # (error text, condition under which the row is rejected)


def default_rules() -> list[Rule]:
    return [(S.POISON_ERROR, F.col("poison"))]


def with_error(rows: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Add ``error``: the text of the first rule that rejects the row, else null."""
    checks = [F.when(rejects, F.lit(text)) for text, rejects in (default_rules() if rules is None else rules)]
    return rows.withColumn("error", F.coalesce(*checks, F.lit(None).cast("string")))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("error").isNull())


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("error").isNotNull())
