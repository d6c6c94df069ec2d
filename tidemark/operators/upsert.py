"""Versioned, idempotent upsert: the state it ends in, and what happened to each row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark import schema as S
from tidemark.operators.ordered import running
from tidemark.operators.validate import Rule, accepted, with_error


def current_state(
    log: DataFrame, key: str = "id", order: tuple[str, ...] = ("version", "seq")
) -> DataFrame:
    """One row per key: the highest version, and of equal versions the one that arrived last.

    The rank limit is applied before the shuffle as well as after it, so each task sends at most
    one row per key and a hot key costs no more than any other.
    """
    newest = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return log.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def upsert(state: DataFrame | None, rows: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """State after the rows of a batch arrived, in ``seq`` order, on top of a stored state."""
    incoming = accepted(with_error(rows, rules)).select(*S.RECORD_COLUMNS, "seq")
    if state is not None:
        before_all = F.lit(-(2**63)).cast("bigint").alias("seq")
        incoming = incoming.unionByName(state.select(*S.RECORD_COLUMNS, before_all))
    return current_state(incoming)


def outcomes(
    rows: DataFrame, stored: DataFrame | None = None, rules: list[Rule] | None = None
) -> DataFrame:
    """What each row of a log meets on arrival: created, updated, version_conflict or rejected.

    A row competes with the highest valid version that arrived before it (or is in ``stored``).
    A conflict means something as new is already there, so it counts as success.
    """
    checked = with_error(rows.select("id", "version", "seq", "poison"), rules)
    valid_version = F.when(F.col("error").isNull(), F.col("version"))
    start = None
    if stored is not None:  # only what the batch touches
        start = stored.join(rows.select("id").distinct(), "id", "left_semi").select("id", F.col("version").alias("_prior"))
    placed = running(checked, ["id"], "seq", valid_version, "max", "_prior", start)
    outcome = (
        F.when(F.col("error").isNotNull(), "rejected")
        .when(F.col("_prior").isNull(), "created")
        .when(F.col("version") >= F.col("_prior"), "updated")
        .otherwise("version_conflict")
    )
    return placed.select(
        "id", "version", "seq", outcome.alias("outcome"), F.col("error").isNull().alias("ok"), "error"
    )


def match_results(submitted: DataFrame, results: DataFrame) -> DataFrame:
    """Put a sink's item results beside the rows submitted; a row without one counts as rejected."""
    keys = ["id", "version", "seq"]
    answered = results.select(*keys, "outcome", "error", F.lit(True).alias("_answered"))
    missing = F.col("_answered").isNull()
    return submitted.select(*keys).join(answered, keys, "left").select(
        *keys,
        F.when(missing, "rejected").otherwise(F.col("outcome")).alias("outcome"),
        F.when(missing, S.MISSING_RESULT_ERROR).otherwise(F.col("error")).alias("error"),
    )


def completeness(submitted: DataFrame, results: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Per batch: rows submitted against rows stored or rejected; short batches must be redone."""
    sent = submitted.select(batch, F.lit(1).alias("_sent"), F.lit(0).alias("_stored"), F.lit(0).alias("_rejected"))
    rejected = F.col("outcome") == "rejected"
    came = results.select(
        batch,
        F.lit(0).alias("_sent"),
        F.when(rejected, 0).otherwise(1).alias("_stored"),
        F.when(rejected, 1).otherwise(0).alias("_rejected"),
    )
    counts = sent.unionByName(came).groupBy(batch).agg(
        F.sum("_sent").alias("submitted"),
        F.sum("_stored").alias("stored"),
        F.sum("_rejected").alias("rejected"),
    )
    return counts.withColumn("complete", F.col("submitted") == F.col("stored") + F.col("rejected"))
