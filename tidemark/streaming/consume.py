"""The feed's independent consumer: each event kept once, with how often it came again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schema as S
from tidemark.operators.consume import consumed_events, merge_consumed
from tidemark.operators.feed import parse_messages, parsed_messages, split_messages
from tidemark.operators.upsert import current_state
from tidemark.session import subfolders
from tidemark.sources.tables import NEVER_TOO_OLD
from tidemark.streaming.tables import ROW_LOG, ReplicationTables, feed_of

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENT_COLUMNS = [c.split()[0] for c in S.EVENT.split(", ")]
COUNT_LOG = S.CONSUMED + ", batch_id BIGINT"
CONSUMED_LOG = S.CONSUMED + ", mode STRING, batch_id BIGINT"
ALL = "all"  # counts are of no mode


def feed_stream(
    spark: SparkSession, tables: ReplicationTables, files_per_batch: int | None = None, as_messages: bool = False
) -> DataFrame:
    """The feed's events as they are appended; ``as_messages`` gives their JSON text instead.

    A batch that runs again replaces its files: the consumer may miss the old ones (their rows
    are in the new ones) or see both (the repeats are counted as such). No file is too old to be read.
    """
    reader = spark.readStream.schema(ROW_LOG).option("ignoreMissingFiles", "true").option("maxFileAge", NEVER_TOO_OLD)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    feed = feed_of(reader.parquet(tables.path("rows")))
    return feed.select("seq", "value") if as_messages else feed.select("seq", *EVENT_COLUMNS)


def _count_batch(events: DataFrame, batch_id: int, tables: ReplicationTables) -> None:
    tables.write_batch(consumed_events(events), "consumed", ALL, batch_id)


def _consume_batch(rows: DataFrame, batch_id: int, tables: ReplicationTables, compact_every: int | None) -> None:
    if "value" in rows.columns:
        parsed = parsed_messages(rows).persist()  # texts are parsed once for both outputs; only unreadable ones are kept
        try:
            events, unreadable = split_messages(parsed)
            _count_batch(events, batch_id, tables)
            unreadable.write.mode("overwrite").parquet(tables.path(f"unreadable/batch_id={batch_id}"))
        finally:
            parsed.unpersist()
    else:
        _count_batch(rows, batch_id, tables)
    if compact_every and (batch_id + 1) % compact_every == 0:
        spark = rows.sparkSession
        folded = consumed(spark, tables, batch_id)
        folded.write.mode("overwrite").parquet(tables.path(f"consumed_upto/batch_id={batch_id}"))


def _folded_upto(spark: SparkSession, tables: ReplicationTables) -> int:
    """The last batch whose counts are folded; a fold without its success mark is not one."""
    folds = sorted(int(f.removeprefix("batch_id=")) for f in subfolders(spark, tables.path("consumed_upto")))
    done = [n for n in folds if "_SUCCESS" in subfolders(spark, tables.path(f"consumed_upto/batch_id={n}"))]
    return max(done, default=-1)


def consume(
    source: DataFrame, tables: ReplicationTables, trigger: dict | None = None, compact_every: int | None = None
) -> StreamingQuery:
    """Count each batch's events on their own; ``consumed`` folds the counts when read.

    ``source`` has events, or messages in a column ``value``; messages that cannot be read are
    kept apart. Nothing is held in memory between batches, however many events there have been.
    ``compact_every`` batches, the counts so far are folded into one table.
    """
    return (
        source.writeStream.foreachBatch(lambda rows, batch_id: _consume_batch(rows, batch_id, tables, compact_every))
        .option("checkpointLocation", tables.path("_checkpoints/consume"))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def consumed(spark: SparkSession, tables: ReplicationTables, upto: int | None = None) -> DataFrame:
    """Counts of all batches, or of those up to one: the newest fold, and the batches after it."""
    folded = _folded_upto(spark, tables)
    recent = tables.read_after(spark, "consumed", CONSUMED_LOG, {ALL: folded})
    if upto is not None:
        recent = recent.where(F.col("batch_id") <= upto)
    parts = [recent.drop("mode", "batch_id")]
    if folded >= 0:
        parts.append(spark.read.schema(S.CONSUMED).parquet(tables.path(f"consumed_upto/batch_id={folded}")))
    return merge_consumed(*parts)


def consume_stateful(source: DataFrame, tables: ReplicationTables, trigger: dict | None = None) -> StreamingQuery:
    """The same with running counts in the state store, for readers that want them as they change.

    State grows with the number of distinct events; it is kept in RocksDB, off the heap. A query takes
    its settings when it starts, so the session's are put back then.
    """
    conf, provider = source.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(provider)
    events = parse_messages(source)[0] if "value" in source.columns else source

    def write(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(tables.path(f"counts/batch_id={batch_id}"))

    conf.set(provider, STATE_STORE)
    try:
        return (
            consumed_events(events)
            .writeStream.outputMode("update")
            .foreachBatch(write)
            .option("checkpointLocation", tables.path("_checkpoints/consume_stateful"))
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
    finally:
        conf.set(provider, before)


def running_counts(spark: SparkSession, tables: ReplicationTables) -> DataFrame:
    """The last count written for each event."""
    return current_state(tables.read(spark, "counts", COUNT_LOG), "event_id", ("batch_id",)).drop("batch_id")


def first_deliveries(events: DataFrame, event_time: str, within: str) -> DataFrame:
    """Events of a stream without repeats that come within a time of the first; state is bounded."""
    return events.withWatermark(event_time, within).dropDuplicatesWithinWatermark(["event_id"])
