"""Fixtures: rows added to and changed in the source: top-up, a flagged batch, sampled updates, one insert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import schema as S
from tidemark.operators.sample import sample_ids

# What generated rows look like.
SEED_TIERS = 5
FLAGGED_BATCH_ROWS = 500
FLAGGED_BATCH_FLAGGED = 3
FLAGGED_BATCH_KIND = "g4"
BUMPED_ROWS = 10
# End of fixed values.


def _new_rows(numbers: DataFrame, columns: dict[str, Column], now: Column) -> DataFrame:
    defaults = {
        "payload": F.lit(S.EMPTY_PAYLOAD),
        "version": F.lit(1).cast("bigint"),
        "poison": F.lit(False),
        "updated_at": now,
        "created_at": now,
    }
    return numbers.select(*[{**defaults, **columns}[c].alias(c) for c in S.RECORD_COLUMNS])


def _next_id(records: DataFrame) -> Column:
    """One past the highest id, as a scalar subquery of the same plan."""
    return records.agg((F.coalesce(F.max("id"), F.lit(0)) + 1).alias("next")).scalar()


def top_up(records: DataFrame, target: int, now: Column) -> DataFrame:
    """The table filled up to ``target`` rows; as it is when it has that many."""
    have = records.count()
    numbers = records.sparkSession.range(have + 1, max(target, have) + 1).withColumnRenamed("id", "g")
    g = F.col("g")
    new = _new_rows(
        numbers,
        {
            "id": _next_id(records) + g - F.lit(have + 1),
            "email": F.concat(F.lit("user"), g, F.lit("@example.com")),
            "name": F.concat(F.lit("User "), g),
            "payload": F.to_json(F.struct(g.alias("seq"), (g % SEED_TIERS).alias("tier"))),
        },
        now,
    )
    return records.select(*S.RECORD_COLUMNS).unionByName(new)


def flagged_batch(
    records: DataFrame, now: Column, rows: int = FLAGGED_BATCH_ROWS, flagged: int = FLAGGED_BATCH_FLAGGED
) -> DataFrame:
    """New rows to append, the first ``flagged`` of them poison."""
    numbers = records.sparkSession.range(1, rows + 1).withColumnRenamed("id", "g")
    g = F.col("g")
    epoch = F.unix_timestamp(now.cast("timestamp"))
    return _new_rows(
        numbers,
        {
            "id": _next_id(records) + g - 1,
            "email": F.concat(F.lit("poison-batch-"), g, F.lit("-"), epoch, F.lit("@example.com")),
            "name": F.concat(F.lit("PoisonBatch "), g),
            "payload": F.to_json(F.struct(F.lit(FLAGGED_BATCH_KIND).alias("kind"), g.alias("i"))),
            "poison": g <= flagged,
        },
        now,
    )


def insert_record(records: DataFrame, email: str, name: str, now: Column, poison: bool = False) -> DataFrame:
    """The table with one more row; what is not given gets its default."""
    one = records.sparkSession.range(1)
    columns = {"id": _next_id(records), "email": F.lit(email), "name": F.lit(name), "poison": F.lit(poison)}
    return records.select(*S.RECORD_COLUMNS).unionByName(_new_rows(one, columns, now))


def bump(records: DataFrame, now: Column, rows: int = BUMPED_ROWS, seed: int = 0) -> DataFrame:
    """The table with a sample of rows at their next version; ``bumped`` says which."""
    picked = sample_ids(records, rows, seed).withColumn("bumped", F.lit(True))
    marked = records.select(*S.RECORD_COLUMNS).join(picked, "id", "left")
    bumped = F.col("bumped").isNotNull()
    return marked.withColumns(
        {
            "version": F.when(bumped, F.col("version") + 1).otherwise(F.col("version")),
            "updated_at": F.when(bumped, now).otherwise(F.col("updated_at")),
            "bumped": bumped,
        }
    )
