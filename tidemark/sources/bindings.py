"""The replication tables as derived from the given test tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark import schema as S
from tidemark.functions.documents import document_json, event_id
from tidemark.functions.times import utc
from tidemark.operators.ordered import running
from tidemark.operators.validate import rejected, with_error
from tidemark.sources.tables import read_table

CHECKPOINT_ID = 5000
CHECKPOINT_TS = "1996-09-17 00:00:00"
TIED_ID = 6865  # in the middle of the rows of that time
AS_OF = "2000-01-01 00:00:00"
SINK_DOWN = "sink: unavailable"
FEED_DOWN = "feed: not confirmed"


def _user(prefix: str, user: Column, suffix: str = "") -> Column:
    return F.concat(F.lit(prefix), user, F.lit(suffix))


def records(spark: SparkSession, folder: str) -> DataFrame:
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    ordered = F.col("o_orderdate")
    return read_table(spark, folder, "orders").select(
        key.alias("id"),
        _user("user", customer, "@example.com").alias("email"),
        _user("User ", customer).alias("name"),
        F.to_json(F.struct(F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))).alias("payload"),
        (key % 3 + 1).alias("version"),
        (key % 167 == 0).alias("poison"),
        ordered.alias("updated_at"),
        ordered.alias("created_at"),
    )


def _event_rows(events: DataFrame, version: Column) -> DataFrame:
    user = F.col("user_id")
    return events.select(
        user.alias("id"),
        _user("user", user, "@example.com").alias("email"),
        _user("User ", user).alias("name"),
        F.col("props").alias("payload"),
        version.alias("version"),
        (F.col("event_type") == "error").alias("poison"),
        F.col("ts").alias("updated_at"),
        F.col("ts").alias("created_at"),
        F.col("event_id").alias("seq"),
    )


def changes(spark: SparkSession, folder: str) -> DataFrame:
    """Each event is the next version of its user's record; event ids are in arrival order."""
    events = read_table(spark, folder, "events")
    numbered = running(events, ["user_id"], "event_id", F.lit(1), "sum", "_earlier")
    return _event_rows(numbered, F.col("_earlier") + 1)


def unordered(events: DataFrame) -> DataFrame:
    """As changes, with versions that arrive stale and equal."""
    return _event_rows(events, (F.col("event_id") * 7919) % 13)


def changes_unordered(spark: SparkSession, folder: str) -> DataFrame:
    return unordered(read_table(spark, folder, "events"))


def deliveries(rows: DataFrame) -> DataFrame:
    """The rows' events, every third of them delivered a second time."""
    times = F.when(F.col("seq") % 3 == 0, F.sequence(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("_copy", F.explode(times)).select(
        event_id().alias("event_id"),
        F.col("id").alias("record_id"),
        "version",
        (F.col("seq") * 2 + F.col("_copy")).alias("seq"),
    )


def sink(source: DataFrame) -> DataFrame:
    """The source as a faulty sink has it: rows lost, rows stale, rows that should not be there."""
    kept = source.where(F.col("id") % 101 != 0).withColumn(
        "version", F.col("version") - F.when(F.col("id") % 211 == 0, 1).otherwise(0)
    )
    extra = source.where(F.col("id") % 997 == 0).withColumn("id", F.col("id") + 1_000_000)
    return kept.unionByName(extra)


def dead_letters(rows: DataFrame) -> DataFrame:
    """The dead letters there already are when the rows arrive: some open, some replayed."""
    opened = F.col("seq") % 3 == 0
    failed = rejected(with_error(rows)).where(opened | (F.col("seq") % 5 == 0))
    return failed.select(
        F.col("seq").alias("id"),
        F.col("id").alias("record_id"),
        "version",
        F.expr(f"seq div {S.BATCH_ROWS}").cast("string").alias("batch_id"),
        F.lit(S.DEFAULT_SINK).alias("sink"),
        document_json().alias("payload"),
        "error",
        F.when(opened, S.STATUS_OPEN).otherwise(S.STATUS_REPLAYED).alias("status"),
        F.col("updated_at").alias("created_at"),
        F.when(~opened, F.col("updated_at") + F.expr("INTERVAL 1 HOUR")).alias("replayed_at"),
    )


def attempt_rows(events: DataFrame) -> DataFrame:
    """One attempt per event, failed where the event is an error."""
    key, failed = F.col("event_id"), F.col("event_type") == "error"
    return events.select(
        F.when(key % 2 == 0, S.BACKFILL).otherwise(S.INCREMENTAL).alias("mode"),
        key.alias("batch_id"),
        key.alias("attempt"),
        F.col("ts").alias("attempted_at"),
        (~failed).alias("ok"),
        F.when(failed, 0).otherwise(S.BATCH_ROWS).cast("bigint").alias("rows"),
        F.when(failed, 0).otherwise(key % 3).cast("bigint").alias("rejected"),
        F.col("ts").alias("read_ts"),
        F.when(failed & (key % 7 != 0), F.col("ts")).alias("since"),
        F.when(failed, F.when(key % 7 == 0, FEED_DOWN).otherwise(SINK_DOWN)).alias("error"),
    )


def attempts(spark: SparkSession, folder: str) -> DataFrame:
    """A batch log, with the cursor each mode had reached, and what it had read."""
    read = attempt_rows(read_table(spark, folder, "events"))
    moved = running(read, ["mode"], "attempt", F.col("rows"), "sum", "_earlier")
    cursor = F.col("_earlier") + F.col("rows")
    read = F.when(F.col("ok"), cursor).otherwise(cursor + S.BATCH_ROWS)
    return moved.withColumns({"cursor_id": cursor, "read_id": read}).drop("_earlier")


def text_records(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("email"), F.col("text").alias("name")
    )


def text_queries(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )


def checkpoints(spark: SparkSession) -> DataFrame:
    """A backfill part of the way, and an incremental cursor in the middle of a tie."""
    rows = [(S.BACKFILL, CHECKPOINT_ID, None), (S.INCREMENTAL, TIED_ID, CHECKPOINT_TS)]
    return spark.createDataFrame(rows, "mode STRING, cursor_id BIGINT, cursor_ts STRING").withColumn(
        "cursor_ts", F.col("cursor_ts").cast("timestamp_ntz")
    )


def as_of() -> Column:
    return utc(AS_OF)
