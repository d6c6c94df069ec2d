"""Continuous replication in micro-batches: rows with their verdicts, dead letters, then the commit row."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schema as S
from tidemark.functions.documents import to_documents
from tidemark.functions.times import utc
from tidemark.operators import dead_letters
from tidemark.operators.cursor import later_cursor
from tidemark.operators.ordered import positions
from tidemark.operators.search import record_terms
from tidemark.operators.upsert import completeness, match_results
from tidemark.operators.validate import Rule, accepted, with_error
from tidemark.plans.batches import FEED_ERROR, SINK_ERROR
from tidemark.session import remove, subfolders
from tidemark.streaming.tables import ROW_LOG, ReplicationTables, feed_of, utc_now

#: Takes documents (with ``seq``) or messages to another system. What takes documents may return its
#: item results (id, version, seq, outcome, error); without a result an item counts as rejected.
Sender = Callable[[DataFrame], DataFrame | None]

REPLAY_SEQ = 1 << 58  # arrival numbers of replayed rows: later than any other
REPLAY_BITS = 36


class IncompleteBatch(RuntimeError):
    """Fewer rows were stored or rejected than were submitted."""


def _last_attempt(spark: SparkSession, tables: ReplicationTables, mode: str) -> tuple[int, datetime | None]:
    """Number of the mode's last attempt, -1 before the first, and since when it fails."""
    log = tables.batch_log(spark).where(F.col("mode") == mode)
    before = log.agg(F.max_by(F.struct("attempt", "since"), "attempt")).first()[0]
    return (before["attempt"], before["since"]) if before else (-1, None)


def _log_attempt(
    spark, tables, mode, batch, ok, before, owner="", number=0, rows=0, rejected=0, cursor=(None, None), read=(None, None),
    last_seq=None, error=None,
) -> tuple[int, datetime | None]:
    """Write the attempt after ``before`` down; returns it as what the next one comes after."""
    attempt, since = before
    now = utc_now()
    down = error is not None and error.startswith(SINK_ERROR)
    since = since or now if down else None
    values: dict[str, Column] = {
        "attempt": F.lit(attempt + 1).cast("bigint"),
        "attempted_at": utc(now),
        "ok": F.lit(ok),
        "rows": F.lit(rows).cast("bigint"),
        "rejected": F.lit(rejected).cast("bigint"),
        "cursor_id": F.lit(cursor[0]).cast("bigint"),
        "cursor_ts": utc(cursor[1]),
        "read_id": F.lit(read[0]).cast("bigint"),
        "read_ts": utc(read[1]),
        "last_seq": F.lit(last_seq).cast("bigint"),
        "owner": F.lit(owner),
        "number": F.lit(number).cast("bigint"),
        "since": utc(since),
        "error": F.lit(error).cast("string"),
    }
    path = tables.batch_path("batch_log", mode, batch.batch_id)
    row = spark.range(1).select(*[v.alias(c) for c, v in values.items()]).coalesce(1)
    row.write.mode("overwrite").parquet(f"{path}/try={len(subfolders(spark, path))}")
    return attempt + 1, since


def store_rows(checked: DataFrame, tables: ReplicationTables, mode: str, batch_ids: list[int], emitted_at: Column) -> DataFrame:
    """Write the batches' rows, accepted and rejected, each with its error; returns them as read back.

    Rows say by ``batch_id`` whose they are; those of several batches are written in one job.
    """
    rows = checked.select(*S.RECORD_COLUMNS, "seq", "error", emitted_at.alias("emitted_at"), "batch_id")
    if len(batch_ids) == 1:
        tables.write_batch(rows.drop("batch_id"), "rows", mode, batch_ids[0])
    else:
        tables.write_batches(rows, "rows", mode, batch_ids)
    return stored_rows(checked.sparkSession, tables, mode, batch_ids)


def stored_rows(spark: SparkSession, tables: ReplicationTables, mode: str, batch_ids: list[int]) -> DataFrame:
    return tables.read_batches(spark, "rows", mode, batch_ids, ROW_LOG)


def send_documents(
    checked: DataFrame, store_to: Sender, tables: ReplicationTables, mode: str, batch_id: int
) -> DataFrame:
    """Give the accepted rows to a sender; rows that it rejects by themselves get its error.

    The rows are written before they are sent, and the results before they are used, so that both
    are computed once.
    """
    spark = checked.sparkSession
    tables.write_batch(checked, "submitted", mode, batch_id)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in checked.schema)
    submitted = tables.read_batch(spark, "submitted", mode, batch_id, schema)
    sent = accepted(submitted)
    results = store_to(to_documents(sent, "seq"))
    if results is None:
        return submitted
    tables.write_batch(match_results(sent, results), "results", mode, batch_id)
    found = tables.read_batch(spark, "results", mode, batch_id, "id BIGINT, version BIGINT, seq BIGINT, outcome STRING, error STRING")
    one = F.lit(0)
    counts = completeness(sent.withColumn("batch_id", one), found.withColumn("batch_id", one)).first()
    if counts is not None and not counts["complete"]:
        raise IncompleteBatch(f"{counts['stored']} stored and {counts['rejected']} rejected of {counts['submitted']} rows")
    keys = ["id", "version", "seq"]
    refused = found.where("outcome = 'rejected'").select(*keys, F.coalesce("error", F.lit("unknown")).alias("_error"))
    return submitted.join(refused, keys, "left").withColumn("error", F.coalesce("error", "_error")).select(*submitted.columns)


def store_dead_letters(stored: DataFrame, tables: ReplicationTables, mode: str, batch_ids: list[int]) -> dict[int, int]:
    """Append entries for the rejected rows, unless the same entry is open already; how many, by batch.

    Entries are numbered on from those of the mode's batches before; the mode is in the last bits.
    """
    spark = stored.sparkSession
    before = tables.batch_log(spark).where(F.col("ok") & (F.col("mode") == mode) & (F.col("batch_id") < min(batch_ids)))
    appended = before.agg(F.coalesce(F.sum("rejected"), F.lit(0))).first()[0]
    here = F.concat_ws("-", F.lit(mode), F.col("batch_id"))
    entries = dead_letters.entries(stored, here, F.col("emitted_at"))
    others = ~F.col("batch_id").isin([f"{mode}-{b}" for b in batch_ids])
    new = dead_letters.to_append(entries, tables.dead_letters(spark, only_open=True).where(others))
    batch = F.substring_index("batch_id", "-", -1).cast("bigint")
    numbered = positions(new.withColumn("batch_id", batch), ["batch_id", "id", "record_id", "version"])
    number = (F.col("position") + appended) * 4 + S.MODES.index(mode)
    tables.write_batches(numbered.withColumn("id", number).drop("position"), "dead_letters", mode, batch_ids)
    written = tables.read_batches(spark, "dead_letters", mode, batch_ids, "id BIGINT, batch_id BIGINT")
    return {r["batch_id"]: r["count"] for r in written.groupBy("batch_id").count().collect()}


def store_terms(stored: DataFrame, tables: ReplicationTables, mode: str, batch_ids: list[int]) -> None:
    """Write what the accepted rows are found by, each batch's terms apart, each file in the order of its terms.

    Terms are written by the task that reads the rows; ``compact`` lays all of them out by term.
    """
    terms = record_terms(accepted(stored), "version", "seq", "batch_id")
    if len(batch_ids) == 1:
        tables.write_batch(terms.drop("batch_id").sortWithinPartitions("term", "kind"), "terms", mode, batch_ids[0])
    else:
        tables.write_batches(terms.sortWithinPartitions("batch_id", "term", "kind"), "terms", mode, batch_ids)


def commit_batch(
    rows: DataFrame,
    number: int,
    tables: ReplicationTables,
    mode: str,
    rules: list[Rule] | None = None,
    store_to: Sender | None = None,
    publish_to: Sender | None = None,
    owner: str = "",
) -> None:
    """Write one batch's outputs, check them, then log it as done.

    ``owner`` and ``number`` say whose batch this is and which one; done before, it is left alone.
    The rows are read from their source once; dead letters, documents and events are made from what
    was written. Whatever fails, the batch is not done, the failed attempt is logged with
    the cursor it holds, and the error is passed on; the same batch then runs again. ``store_to`` and
    ``publish_to`` are given the documents and the messages to send elsewhere too; when they
    raise, the batch fails like any other.
    """
    commit_pages(rows.withColumn("page", F.lit(0)), [number], tables, mode, rules, store_to, publish_to, owner)


def commit_pages(
    rows: DataFrame,
    numbers: list[int],
    tables: ReplicationTables,
    mode: str,
    rules: list[Rule] | None = None,
    store_to: Sender | None = None,
    publish_to: Sender | None = None,
    owner: str = "",
) -> None:
    """``commit_batch`` of several batches at once: ``page`` says which of ``numbers`` a row belongs to.

    All rows are written in one job, by batch, and looked at in one; then batch after batch is published and
    logged, so that the cursor never passes a batch that is not done. Killed between two log rows,
    those logged are done and the others run again. ``store_to`` takes one batch at a time.
    """
    if store_to is not None and len(numbers) > 1:
        raise ValueError("item results are those of one batch: commit pages one by one")
    spark = rows.sparkSession
    begun = tables.begin_all(spark, mode, owner, numbers)
    open_ = [(page, number, batch) for page, (number, batch) in enumerate(zip(numbers, begun)) if not batch.done]
    if not open_:
        return
    ids = [batch.batch_id for _, _, batch in open_]
    tried = [batch.batch_id for _, _, batch in open_ if batch.tried]
    place = F.col("page").cast("int") + 1
    batch_id = F.element_at(F.array(*[F.lit(b.batch_id).cast("bigint") for b in begun]), place)
    emitted_at = F.element_at(F.array(*[utc(b.started_at) for b in begun]), place)
    if len(open_) < len(numbers):
        rows = rows.where(F.col("page").isin([page for page, _, _ in open_]))
    given = rows.select(*S.RECORD_COLUMNS, "seq", batch_id.alias("batch_id"), emitted_at.alias("emitted_at"))
    checked = with_error(given, rules)
    before = _last_attempt(spark, tables, mode)
    held = tables.checkpoints(spark).where(F.col("mode") == mode).first()
    held = (held["cursor_id"], held["cursor_ts"]) if held else (None, None)
    stage, read, (_, number, batch) = SINK_ERROR, (None, None), open_[0]
    try:
        if store_to is not None:
            checked = send_documents(checked, store_to, tables, mode, ids[0])
        stored = store_rows(checked, tables, mode, ids, F.col("emitted_at"))
        facts = _facts(stored)
        if len(open_) == 1:
            read = _reached(facts.get(ids[0]), mode)
        tables.remove_batches(spark, "dead_letters", mode, tried)
        entered = {}
        if any(f["rejected"] for f in facts.values()):
            entered = store_dead_letters(stored, tables, mode, ids)
        if tables.terms:
            store_terms(stored, tables, mode, ids)
        stage = FEED_ERROR
        for _, number, batch in open_:
            fact = facts.get(batch.batch_id)
            read = _reached(fact, mode)
            publish(stored.where(F.col("batch_id") == batch.batch_id) if len(open_) > 1 else stored, publish_to)
            cursor = later_cursor(read[::-1], held[::-1])[::-1] if mode == S.INCREMENTAL else read
            counts = (fact["rows"], entered.get(batch.batch_id, 0)) if fact else (0, 0)
            last_seq = fact["last_seq"] if fact else None
            before = _log_attempt(spark, tables, mode, batch, True, before, owner, number, *counts, cursor, read, last_seq)
            held = cursor if fact else held
    except Exception as failure:
        _log_attempt(
            spark, tables, mode, batch, False, before, owner, number, cursor=held, read=read, error=f"{stage} {failure}"
        )
        raise
    for staged in ("submitted", "results"):
        if store_to is not None:
            remove(spark, tables.batch_path(staged, mode, ids[0]))


def _facts(stored: DataFrame) -> dict[int, Row]:
    """What a batch's log row says of its rows, by batch; a batch without rows is not there."""
    found = stored.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("error").alias("rejected"),
        F.max("id").alias("max_id"),
        F.max("seq").alias("last_seq"),
        F.max(F.struct("updated_at", "id")).alias("last"),
    )
    return {r["batch_id"]: r for r in found.collect()}


def _reached(fact: Row | None, mode: str) -> tuple[int | None, datetime | None]:
    """The cursor that a batch read up to."""
    if fact is None:
        return None, None
    return (fact["max_id"], None) if mode == S.BACKFILL else (fact["last"]["id"], fact["last"]["updated_at"])


def publish(stored: DataFrame, publish_to: Sender | None) -> None:
    """Send an event per row of the batch, accepted or not; the table of events is made from the rows."""
    if publish_to is not None:
        publish_to(feed_of(stored).select("key", "value"))


def replicate(
    source: DataFrame,
    tables: ReplicationTables,
    mode: str,
    rules: list[Rule] | None = None,
    trigger: dict | None = None,
    store_to: Sender | None = None,
    publish_to: Sender | None = None,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Start replicating a stream of rows (record columns and ``seq``, their arrival number).

    Stopped or killed, it resumes from its checkpoint; the batch that was open runs again under
    the same number with the same rows. With its checkpoint lost it starts anew, under new batch
    numbers, and repeats are absorbed. By default it ends when the source has no more.
    ``compact_every`` batches, a snapshot is written.
    """

    def run(rows: DataFrame, number: int) -> None:
        owner = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
        commit_batch(rows, number, tables, mode, rules, store_to, publish_to, owner)
        if compact_every and (number + 1) % compact_every == 0:
            tables.compact(rows.sparkSession)

    return (
        source.writeStream.queryName(f"replicate-{mode}-{tables.root[-8:]}")
        .foreachBatch(run)
        .option("checkpointLocation", tables.path(f"_checkpoints/{mode}"))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def replay_dead_letters(
    spark: SparkSession,
    tables: ReplicationTables,
    records: DataFrame,
    requests: DataFrame,
    number: int,
    rules: list[Rule] | None = None,
    store_to: Sender | None = None,
    publish_to: Sender | None = None,
) -> DataFrame:
    """Send requested dead letters again as a batch of their own, then mark those that were stored.

    Returns what became of each request. Rules and senders are those of the replication, so that a
    row is judged as it was the first time, and reaches the sink that rejected it. What to send is
    written down before anything is sent, so running the batch again after a failure, or after it
    was done, sends the same.
    """
    mode, owner = S.REPLAY, "replay"
    batch_id, started, done = tables.begin(spark, mode, owner, number)
    now = utc(started)
    plan = dead_letters.replay(requests, tables.dead_letters(spark), records, now, rules)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plan.schema)
    this = (F.col("mode") == mode) & (F.col("batch_id") == batch_id)
    if not done and tables.batch_log(spark).where(this & F.col("ok")).isEmpty():
        tables.write_batch(plan, "replays", mode, batch_id)
        written = tables.read_batch(spark, "replays", mode, batch_id, schema)
        arrival = F.lit(REPLAY_SEQ + (batch_id << REPLAY_BITS)) + F.col("position")
        rows = positions(dead_letters.replay_rows(written), ["seq"]).withColumn("seq", arrival)
        commit_batch(rows, number, tables, mode, rules, store_to, publish_to, owner)
    asked = tables.read_batch(spark, "replays", mode, batch_id, schema)
    # rejected once more, by id: the entry stays open, and says why
    again = stored_rows(spark, tables, mode, [batch_id]).where(F.col("error").isNotNull())
    again = again.groupBy(F.col("id").alias("record_id")).agg(F.min("error").alias("_error"))
    said = asked.join(again, "record_id", "left").withColumn("_error", F.when(F.col("ok"), F.col("_error")))
    said = said.withColumn("ok", F.col("ok") & F.col("_error").isNull()).withColumn("reason", F.coalesce("reason", "_error"))
    said = said.select(*asked.columns)
    marks = dead_letters.replay_marks(said, now)
    tables.write_batch(marks, "replay_marks", mode, batch_id)
    return said
