"""Rows the sink rejected: kept with what is needed to look at them, and to send them again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark import schema as S
from tidemark.functions.documents import document_json
from tidemark.operators.validate import Rule, rejected, with_error

OPEN_KEY = ["record_id", "version", "sink"]


def entries(checked: DataFrame, batch_id: Column, created_at: Column, sink: str = S.DEFAULT_SINK) -> DataFrame:
    """Dead letters for the rejected rows of checked rows; ``seq`` becomes the entry's id."""
    return rejected(checked).select(
        F.col("seq").alias("id"),
        F.col("id").alias("record_id"),
        "version",
        batch_id.cast("string").alias("batch_id"),
        F.lit(sink).alias("sink"),
        document_json().alias("payload"),
        "error",
        F.lit(S.STATUS_OPEN).alias("status"),
        created_at.alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("replayed_at"),
    )


def is_open() -> Column:
    return F.col("status") == S.STATUS_OPEN


def to_append(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Entries to add, so that at most one is open per record, version and sink.

    Repeats inside the batch go first (the earliest stays), before and after the shuffle; what is
    left is unique on the join key.
    """
    earliest = Window.partitionBy(*OPEN_KEY).orderBy("id")
    first = new.withColumn("_rank", F.row_number().over(earliest)).where("_rank = 1").drop("_rank")
    return first.join(existing.where(is_open()).select(*OPEN_KEY), OPEN_KEY, "left_anti").select(*new.columns)


def fold_status(appended: DataFrame, replayed: DataFrame) -> DataFrame:
    """Entries with their status now: appended entries and, appended apart, (id, replayed_at) marks."""
    marks = replayed.groupBy("id").agg(F.max("replayed_at").alias("_at"))
    marked = F.col("_at").isNotNull()
    return appended.join(marks, "id", "left").select(
        *[c for c in appended.columns if c not in ("status", "replayed_at")],
        F.when(marked, F.lit(S.STATUS_REPLAYED)).otherwise(F.col("status")).alias("status"),
        F.coalesce("_at", "replayed_at").alias("replayed_at"),
    )


def newest(dead_letters: DataFrame, limit: int = S.DEAD_LETTERS_SHOWN) -> DataFrame:
    return dead_letters.orderBy(F.col("id").desc()).limit(limit)


def has_replay_context() -> Column:
    """Open, with a payload that has an email (a JSON null counts), an error, a batch and a record."""
    has_email = F.array_contains(F.json_object_keys("payload"), "email")
    return (
        is_open()
        & F.coalesce(has_email, F.lit(False))
        & (F.length("error") > 0)
        & (F.length("batch_id") > 0)
        & F.col("record_id").isNotNull()
    )


def _stored_row(as_of: Column) -> list[Column]:
    """The record as the dead letter has it, for when the source no longer does."""
    stored = F.from_json("payload", S.DOCUMENT)
    text = lambda name: F.coalesce(stored[name], F.lit(""))
    at = lambda name: F.coalesce(stored[name].try_cast("timestamp_ntz"), as_of)
    return [
        F.coalesce(stored["id"], F.col("record_id")).alias("id"),
        text("email").alias("email"),
        text("name").alias("name"),
        F.coalesce(stored["payload"], F.lit(S.EMPTY_PAYLOAD)).alias("payload"),
        F.col("version").alias("version"),
        F.lit(False).alias("poison"),
        at("updated_at").alias("updated_at"),
        at("created_at").alias("created_at"),
    ]


def replay(
    requests: DataFrame,
    dead_letters: DataFrame,
    records: DataFrame,
    as_of: Column,
    rules: list[Rule] | None = None,
) -> DataFrame:
    """What to send for each requested dead letter id, or why it is refused.

    The record's latest source row is sent, not the version that failed, with its poison flag
    cleared; a record gone from the source is sent as stored. Other open entries of the record
    stay open. Rows with ``ok`` go to the upsert and the feed, then to ``replay_marks``.
    """
    wanted = requests.select(F.col("id").alias("dlq_id")).distinct()
    found = wanted.join(
        dead_letters.select(
            F.col("id").alias("dlq_id"), "record_id", "version", "payload", "status", F.lit(True).alias("_found")
        ),
        "dlq_id",
        "left",
    )
    refused = F.when(F.col("_found").isNull(), F.lit("not found")).when(
        ~is_open(), F.concat(F.lit("status="), F.col("status"))
    )
    guarded = found.select(
        "dlq_id", "record_id", refused.alias("_refused"), F.struct(*_stored_row(as_of)).alias("_stored")
    )
    source = records.select(
        F.col("id").alias("_record"),
        F.struct(
            *[F.lit(False).alias(c) if c == "poison" else F.col(c) for c in S.RECORD_COLUMNS]
        ).alias("_source"),
    )
    # requests without a record match nothing; dealt by their own id they do not all land in one task
    same = F.coalesce("record_id", "dlq_id") == F.col("_record")
    chosen = guarded.join(source, same & F.col("record_id").isNotNull(), "left").select(
        "dlq_id", "record_id", "_refused", F.coalesce("_source", "_stored").alias("_row")
    )
    checked = with_error(chosen.select("dlq_id", "record_id", "_refused", "_row.*"), rules)
    reason = F.coalesce("_refused", "error")
    send = reason.isNull()
    return checked.select(
        "dlq_id",
        "record_id",
        send.alias("ok"),
        reason.alias("reason"),
        *[F.when(send, F.col(c)).alias(c) for c in S.RECORD_COLUMNS],
    )


def replay_rows(replayed: DataFrame) -> DataFrame:
    """The rows of a replay to upsert and publish; the entry's id is their arrival order."""
    return replayed.where("ok").select(*S.RECORD_COLUMNS, F.col("dlq_id").alias("seq"))


def replay_marks(replayed: DataFrame, as_of: Column) -> DataFrame:
    return replayed.where("ok").select(F.col("dlq_id").alias("id"), as_of.alias("replayed_at"))
