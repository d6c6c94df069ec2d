"""The registered queries: each runs an operator on the given tables, beside the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schema as S
from tidemark.functions.times import utc
from tidemark.functions.documents import event_id, to_documents
from tidemark.operators import consume, cursor, dead_letters, feed, sample, search, upsert
from tidemark.operators.validate import accepted, rejected, with_error
from tidemark.plans import batches, reconcile, status
from tidemark.session import new_dir
from tidemark.sources import bindings as B
from tidemark.sources.changing import changed_rows
from tidemark.sources.tables import read_table, stream_table
from tidemark.streaming import consume as feed_consumer
from tidemark.streaming.replicate import commit_batch, replay_dead_letters, replicate
from tidemark.streaming.sync import sync
from tidemark.streaming.tables import ReplicationTables
from tidemark.streaming.throughput import count_throughput, counted

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DOCUMENT_SQL = """to_json({'id': id, 'email': email, 'name': name, 'payload': payload::JSON, 'version': version,
 'poison': poison, 'updated_at': strftime(updated_at, '%Y-%m-%dT%H:%M:%S.%gZ'),
 'created_at': strftime(created_at, '%Y-%m-%dT%H:%M:%S.%gZ')})::VARCHAR"""

EVENT_ROW_SQL = """user_id AS id, 'user' || user_id || '@example.com' AS email, 'User ' || user_id AS name,
 props AS payload, {version} AS version, event_type = 'error' AS poison, ts AS updated_at, ts AS created_at,
 event_id AS seq FROM events"""

TABLE_SQL = {
    "records": """SELECT o_orderkey AS id, 'user' || o_custkey || '@example.com' AS email, 'User ' || o_custkey AS name,
 to_json({'priority': o_orderpriority, 'status': o_orderstatus})::VARCHAR AS payload, o_orderkey % 3 + 1 AS version,
 o_orderkey % 167 = 0 AS poison, o_orderdate AS updated_at, o_orderdate AS created_at FROM orders""",
    "changes": "SELECT " + EVENT_ROW_SQL.format(version="row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)"),
    "unordered": "SELECT " + EVENT_ROW_SQL.format(version="(event_id * 7919) % 13"),
    "deliveries": """SELECT id || ':' || version AS event_id, id AS record_id, version, seq * 2 AS seq FROM changes
 UNION ALL SELECT id || ':' || version, id, version, seq * 2 + 1 FROM changes WHERE seq % 3 = 0""",
    "sink": """SELECT id, email, name, payload, CASE WHEN id % 211 = 0 THEN version - 1 ELSE version END AS version, poison,
 updated_at, created_at FROM records WHERE id % 101 <> 0
 UNION ALL SELECT id + 1000000, email, name, payload, version, poison, updated_at, created_at FROM records WHERE id % 997 = 0""",
    "dlq": f"""SELECT seq AS id, id AS record_id, version, (seq // 500)::VARCHAR AS batch_id, 'elasticsearch' AS sink,
 {DOCUMENT_SQL} AS payload, '{S.POISON_ERROR}' AS error, CASE WHEN seq % 3 = 0 THEN 'open' ELSE 'replayed' END AS status,
 updated_at AS created_at, CASE WHEN seq % 3 <> 0 THEN updated_at + INTERVAL 1 HOUR END AS replayed_at
 FROM changes WHERE poison AND (seq % 3 = 0 OR seq % 5 = 0)""",
    "attempts": f"""SELECT mode, batch_id, attempt, attempted_at, ok, rows, rejected, error, read_ts, since,
 (sum(rows) OVER (PARTITION BY mode ORDER BY attempt))::BIGINT AS cursor_id,
 (sum(rows) OVER (PARTITION BY mode ORDER BY attempt))::BIGINT + CASE WHEN ok THEN 0 ELSE 500 END AS read_id FROM (
 SELECT ts AS read_ts, CASE WHEN event_type = 'error' AND event_id % 7 <> 0 THEN ts END AS since, CASE WHEN event_id % 2 = 0 THEN 'backfill' ELSE 'incremental' END AS mode, event_id AS batch_id, event_id AS attempt,
 ts AS attempted_at, event_type <> 'error' AS ok, CASE WHEN event_type = 'error' THEN 0 ELSE 500 END AS rows,
 CASE WHEN event_type = 'error' THEN 0 ELSE event_id % 3 END AS rejected,
 CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 7 = 0 THEN '{B.FEED_DOWN}' ELSE '{B.SINK_DOWN}' END END AS error
 FROM events)""",
    "checkpoints": f"""SELECT * FROM (VALUES ('backfill', {B.CHECKPOINT_ID}::BIGINT, NULL::TIMESTAMP),
 ('incremental', {B.TIED_ID}::BIGINT, TIMESTAMP '{B.CHECKPOINT_TS}')) AS t(mode, cursor_id, cursor_ts)""",
    "text_records": "SELECT doc_id AS id, source AS email, text AS name FROM documents",
    "renamed_records": """SELECT doc_id AS id, source AS email,
 CASE WHEN doc_id % 7 = 0 THEN 'Eauouon ' || source ELSE text END AS name FROM documents""",
}
TABLE_NEEDS = {"deliveries": ["changes"], "sink": ["records"], "dlq": ["changes"]}
RECORD_SQL = "id, email, name, payload, version, poison, updated_at, created_at"


def given(tables: str, select: str) -> str:
    """The SELECT with the derived tables it names in front."""
    order: list[str] = []

    def need(name: str) -> None:
        for inner in TABLE_NEEDS.get(name, []):
            need(inner)
        if name not in order:
            order.append(name)

    for name in tables.split():
        need(name)
    return "WITH " + ", ".join(f"{name} AS ({TABLE_SQL[name]})" for name in order) + " " + select


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


# --- upsert -----------------------------------------------------------------------------------

STATE_SQL = """SELECT id, email, name, payload, version, poison, updated_at, created_at, seq FROM {table}
 WHERE NOT poison QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC, seq DESC) = 1"""


@query("upsert_state", given("changes", STATE_SQL.format(table="changes")))
def upsert_state(spark, folder):
    return upsert.upsert(None, B.changes(spark, folder))


@query(
    "upsert_onto_stored",
    given(
        "records unordered",
        f"""SELECT * EXCLUDE (seq) FROM (SELECT {RECORD_SQL}, -1 AS seq FROM records WHERE NOT poison
 UNION ALL SELECT {RECORD_SQL}, seq FROM unordered WHERE NOT poison)
 QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC, seq DESC) = 1""",
    ),
)
def upsert_onto_stored(spark, folder):
    stored = accepted(with_error(B.records(spark, folder)))
    return upsert.upsert(stored, B.changes_unordered(spark, folder)).drop("seq")


OUTCOME_SQL = f"""SELECT id, version, seq, CASE WHEN poison THEN 'rejected' WHEN prior IS NULL THEN 'created'
 WHEN version >= prior THEN 'updated' ELSE 'version_conflict' END AS outcome, NOT poison AS ok,
 CASE WHEN poison THEN '{S.POISON_ERROR}' END AS error FROM (SELECT *, {{prior}} AS prior FROM unordered)"""
PRIOR_SQL = "max(CASE WHEN NOT poison THEN version END) OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
STORED_SQL = "greatest((SELECT r.version FROM records r WHERE r.id = unordered.id AND NOT r.poison), {prior})"


@query("upsert_outcomes", given("unordered", OUTCOME_SQL.format(prior=PRIOR_SQL)))
def upsert_outcomes(spark, folder):
    return upsert.outcomes(B.changes_unordered(spark, folder))


@query(
    "upsert_outcomes_onto_stored",
    given("records unordered", OUTCOME_SQL.format(prior=STORED_SQL.format(prior=PRIOR_SQL))),
)
def upsert_outcomes_onto_stored(spark, folder):
    stored = accepted(with_error(B.records(spark, folder)))
    return upsert.outcomes(B.changes_unordered(spark, folder), stored)


def _answers(spark, folder):
    """Results of a sink that forgets to answer for some rows."""
    return upsert.outcomes(B.changes_unordered(spark, folder)).where(F.col("seq") % 97 != 0)


@query(
    "item_results",
    given(
        "unordered",
        f"""SELECT id, version, seq, CASE WHEN seq % 97 = 0 THEN 'rejected' ELSE outcome END AS outcome,
 CASE WHEN seq % 97 = 0 THEN '{S.MISSING_RESULT_ERROR}' ELSE error END AS error FROM ({OUTCOME_SQL.format(prior=PRIOR_SQL)})""",
    ),
)
def item_results(spark, folder):
    return upsert.match_results(B.changes_unordered(spark, folder), _answers(spark, folder))


@query(
    "batch_completeness",
    given(
        "unordered",
        """SELECT seq // 500 AS batch_id, count(*) AS submitted, count(*) FILTER (NOT poison AND seq % 97 <> 0) AS stored,
 count(*) FILTER (poison AND seq % 97 <> 0) AS rejected, count(*) = count(*) FILTER (seq % 97 <> 0) AS complete
 FROM unordered GROUP BY ALL""",
    ),
)
def batch_completeness(spark, folder):
    batch = F.expr(f"seq div {S.BATCH_ROWS}")
    submitted = B.changes_unordered(spark, folder).withColumn("batch_id", batch)
    return upsert.completeness(submitted, _answers(spark, folder).withColumn("batch_id", batch))


@query(
    "reject_split",
    given(
        "changes",
        f"""SELECT id, version, seq, CASE WHEN poison THEN '{S.POISON_ERROR}' END AS error, NOT poison AS accepted FROM changes""",
    ),
)
def reject_split(spark, folder):
    checked = with_error(B.changes(spark, folder)).select("id", "version", "seq", "error")
    return accepted(checked).withColumn("accepted", F.lit(True)).unionByName(
        rejected(checked).withColumn("accepted", F.lit(False))
    )


# --- cursors ----------------------------------------------------------------------------------


@query("source_scan", given("records", f"SELECT {RECORD_SQL} FROM records"))
def source_scan(spark, folder):
    return cursor.scan(B.records(spark, folder))


@query(
    "source_documents",
    given(
        "records",
        """SELECT id, email, name, payload, version, poison, strftime(updated_at, '%Y-%m-%dT%H:%M:%S.%gZ') AS updated_at,
 strftime(created_at, '%Y-%m-%dT%H:%M:%S.%gZ') AS created_at FROM records""",
    ),
)
def source_documents(spark, folder):
    return to_documents(B.records(spark, folder))


@query(
    "backfill_page",
    given("records", f"SELECT {RECORD_SQL} FROM records WHERE id > {B.CHECKPOINT_ID} ORDER BY id LIMIT 500"),
)
def backfill_page(spark, folder):
    return cursor.backfill_page(B.records(spark, folder), B.CHECKPOINT_ID)


AFTER_KEY_SQL = f"(updated_at > TIMESTAMP '{B.CHECKPOINT_TS}' OR (updated_at = TIMESTAMP '{B.CHECKPOINT_TS}' AND id > {B.TIED_ID}))"


@query(
    "incremental_page",
    given("records", f"SELECT {RECORD_SQL} FROM records WHERE {AFTER_KEY_SQL} ORDER BY updated_at, id LIMIT 500"),
)
def incremental_page(spark, folder):
    return cursor.incremental_page(B.records(spark, folder), B.CHECKPOINT_TS, B.TIED_ID)


@query(
    "incremental_page_overlap",
    given(
        "records",
        f"SELECT {RECORD_SQL} FROM records WHERE updated_at >= TIMESTAMP '{B.CHECKPOINT_TS}' - INTERVAL 2 DAY ORDER BY updated_at, id LIMIT 500",
    ),
)
def incremental_page_overlap(spark, folder):
    return cursor.incremental_page(B.records(spark, folder), B.CHECKPOINT_TS, B.TIED_ID, overlap="2 DAYS")


@query(
    "page_cursors",
    given(
        "records",
        """SELECT page, max(id) AS cursor_id, count(*) AS rows FROM
 (SELECT id, (row_number() OVER (ORDER BY id) - 1) // 500 AS page FROM records) GROUP BY page""",
    ),
)
def page_cursors(spark, folder):
    return cursor.backfill_pages(B.records(spark, folder))


@query(
    "page_cursors_incremental",
    given(
        "records",
        """SELECT page, max(updated_at) AS cursor_ts, arg_max(id, n) AS cursor_id, count(*) AS rows FROM
 (SELECT id, updated_at, n, (n - 1) // 500 AS page FROM
 (SELECT id, updated_at, row_number() OVER (ORDER BY updated_at, id) AS n FROM records)) GROUP BY page""",
    ),
)
def page_cursors_incremental(spark, folder):
    return cursor.incremental_pages(B.records(spark, folder))


@query(
    "boot_watermark",
    given(
        "records",
        """SELECT 'backfill' AS mode, 0::BIGINT AS cursor_id, NULL::TIMESTAMP AS cursor_ts
 UNION ALL SELECT 'incremental', 0, max(updated_at) FROM records""",
    ),
)
def boot_watermark(spark, folder):
    started_at = B.records(spark, folder).agg(F.max("updated_at")).scalar()
    return cursor.with_boot_watermark(cursor.initial_checkpoints(spark), started_at)


@query(
    "saved_checkpoints",
    given(
        "records",
        f"""SELECT 'backfill' AS mode, max(id) AS cursor_id, NULL::TIMESTAMP AS cursor_ts FROM records WHERE id > {B.CHECKPOINT_ID}
 UNION ALL SELECT 'incremental', arg_max(id, (updated_at, id)), max(updated_at) FROM records WHERE {AFTER_KEY_SQL}""",
    ),
)
def saved_checkpoints(spark, folder):
    records, checkpoints = B.records(spark, folder), B.checkpoints(spark)
    for mode in (S.BACKFILL, S.INCREMENTAL):
        batch = cursor.rows_after_checkpoint(records, checkpoints, mode)
        checkpoints = cursor.save_checkpoint(checkpoints, cursor.batch_cursor(batch, mode), mode)
    return checkpoints


BOTH_MODES_SQL = f"""SELECT *, 'backfill' AS mode FROM records WHERE id > {B.CHECKPOINT_ID}
 UNION ALL SELECT *, 'incremental' FROM records WHERE {AFTER_KEY_SQL}"""


@query(
    "dual_mode_remaining",
    given("records", f"SELECT mode, count(*) AS rows, min(id) AS first_id, max(id) AS last_id FROM ({BOTH_MODES_SQL}) GROUP BY mode"),
)
def dual_mode_remaining(spark, folder):
    return (
        cursor.dual_mode(B.records(spark, folder), B.checkpoints(spark))
        .groupBy("mode")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    )


@query(
    "dual_mode_events",
    given(
        "records",
        f"""SELECT id || ':' || version AS event_id, id AS record_id, version, count(*) - 1 AS duplicate_hits
 FROM ({BOTH_MODES_SQL}) GROUP BY id, version""",
    ),
)
def dual_mode_events(spark, folder):
    both = cursor.dual_mode(B.records(spark, folder), B.checkpoints(spark))
    sent = both.select(
        event_id().alias("event_id"),
        F.col("id").alias("record_id"),
        "version",
        (F.col("id") * 2 + F.when(F.col("mode") == S.BACKFILL, 0).otherwise(1)).alias("seq"),
    )
    return consume.consumed_events(sent).drop("first_seq")


@query(
    "dual_mode_state",
    given("records", f"SELECT DISTINCT {RECORD_SQL} FROM ({BOTH_MODES_SQL}) WHERE NOT poison"),
)
def dual_mode_state(spark, folder):
    both = cursor.dual_mode(B.records(spark, folder), B.checkpoints(spark))
    arrival = F.col("id") * 2 + F.when(F.col("mode") == S.BACKFILL, 0).otherwise(1)
    return upsert.upsert(None, both.withColumn("seq", arrival)).drop("seq")


# --- dead letters -----------------------------------------------------------------------------

NEW_ENTRIES_SQL = f"""SELECT seq AS id, id AS record_id, version, (seq // 500)::VARCHAR AS batch_id, 'elasticsearch' AS sink,
 {DOCUMENT_SQL} AS payload, '{S.POISON_ERROR}' AS error, 'open' AS status, updated_at AS created_at,
 NULL::TIMESTAMP AS replayed_at FROM changes WHERE poison"""
TO_APPEND_SQL = f"""SELECT * FROM ({NEW_ENTRIES_SQL}) n WHERE NOT EXISTS (SELECT 1 FROM dlq WHERE dlq.status = 'open'
 AND dlq.record_id = n.record_id AND dlq.version = n.version AND dlq.sink = n.sink)"""


def _entries(rows: DataFrame) -> DataFrame:
    batch = F.expr(f"seq div {S.BATCH_ROWS}")
    return dead_letters.entries(with_error(rows), batch, F.col("updated_at"))


@query("dlq_entries", given("changes", NEW_ENTRIES_SQL))
def dlq_entries(spark, folder):
    return _entries(B.changes(spark, folder))


@query("dlq_append", given("dlq", TO_APPEND_SQL))
def dlq_append(spark, folder):
    rows = B.changes(spark, folder)
    return dead_letters.to_append(_entries(rows), B.dead_letters(rows))


def _all_dead_letters(spark, folder):
    """Those there already and those appended; an id that is there gets a new one."""
    rows = B.changes(spark, folder)
    existing = B.dead_letters(rows)
    new = dead_letters.to_append(_entries(rows), existing)
    return existing.withColumn("id", F.col("id") * 2).unionByName(new.withColumn("id", F.col("id") * 2 + 1))


ALL_DLQ_SQL = f"SELECT * REPLACE (id * 2 AS id) FROM dlq UNION ALL SELECT * REPLACE (id * 2 + 1 AS id) FROM ({TO_APPEND_SQL})"


@query(
    "dlq_context",
    given(
        "dlq",
        f"""SELECT record_id, count(*) AS open_entries, count(*) FILTER (json_exists(payload, '$.email') AND length(error) > 0
 AND length(batch_id) > 0) AS with_context FROM ({ALL_DLQ_SQL}) WHERE status = 'open' AND record_id IS NOT NULL GROUP BY record_id""",
    ),
)
def dlq_context(spark, folder):
    return (
        _all_dead_letters(spark, folder)
        .where(dead_letters.is_open())
        .groupBy("record_id")
        .agg(
            F.count(F.lit(1)).alias("open_entries"),
            F.count_if(dead_letters.has_replay_context()).alias("with_context"),
        )
    )


@query("dlq_newest", given("dlq", f"SELECT * FROM ({ALL_DLQ_SQL}) ORDER BY id DESC LIMIT 100"))
def dlq_newest(spark, folder):
    return dead_letters.newest(_all_dead_letters(spark, folder))


def _replayed(spark, folder):
    """A request for every event's number, against a source that has lost some records."""
    requests = read_table(spark, folder, "events").select((F.col("event_id") * 2).alias("id"))
    left_over = B.records(spark, folder).where(F.col("id") % 7 != 0)
    return dead_letters.replay(requests, _all_dead_letters(spark, folder), left_over, B.as_of())


def _source_or(column: str, stored: str) -> str:
    return f"CASE WHEN r.id IS NOT NULL THEN r.{column} ELSE {stored} END"


REPLAY_SQL = f"""SELECT q.dlq_id, d.record_id, d.status IS NOT NULL AND d.status = 'open' AS ok,
 CASE WHEN d.id IS NULL THEN 'not found' WHEN d.status <> 'open' THEN 'status=' || d.status END AS reason,
 {_source_or('email', "d.payload->>'$.email'")} AS email, {_source_or('name', "d.payload->>'$.name'")} AS name,
 {_source_or('payload', "(d.payload::JSON->'$.payload')::VARCHAR")} AS payload, {_source_or('version', 'd.version')} AS version,
 {_source_or('updated_at', "strptime(d.payload->>'$.updated_at', '%Y-%m-%dT%H:%M:%S.%gZ')")} AS updated_at,
 {_source_or('created_at', "strptime(d.payload->>'$.created_at', '%Y-%m-%dT%H:%M:%S.%gZ')")} AS created_at
 FROM (SELECT event_id * 2 AS dlq_id FROM events) q LEFT JOIN all_dlq d ON d.id = q.dlq_id
 LEFT JOIN (SELECT * FROM records WHERE id % 7 <> 0) r ON r.id = d.record_id"""
REPLAYED_SQL = f"""SELECT dlq_id, record_id, ok, reason, CASE WHEN ok THEN record_id END AS id, CASE WHEN ok THEN email END AS email,
 CASE WHEN ok THEN name END AS name, CASE WHEN ok THEN payload END AS payload, CASE WHEN ok THEN version END AS version,
 CASE WHEN ok THEN false END AS poison, CASE WHEN ok THEN updated_at END AS updated_at,
 CASE WHEN ok THEN created_at END AS created_at FROM ({REPLAY_SQL})"""


def _with_all_dlq(select: str) -> str:
    return given("records dlq", "").rstrip() + f", all_dlq AS ({ALL_DLQ_SQL}), replayed AS ({REPLAYED_SQL}) " + select


@query("dlq_replay", _with_all_dlq("SELECT * FROM replayed"))
def dlq_replay(spark, folder):
    return _replayed(spark, folder)


@query(
    "dlq_replay_state",
    _with_all_dlq(
        f"""SELECT {RECORD_SQL} FROM (SELECT {RECORD_SQL}, -1 AS seq FROM records WHERE NOT poison
 UNION ALL SELECT {RECORD_SQL}, dlq_id FROM replayed WHERE ok)
 QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC, seq DESC) = 1"""
    ),
)
def dlq_replay_state(spark, folder):
    stored = accepted(with_error(B.records(spark, folder)))
    return upsert.upsert(stored, dead_letters.replay_rows(_replayed(spark, folder))).drop("seq")


@query(
    "dlq_after_replay",
    _with_all_dlq(
        f"""SELECT d.id, d.record_id, d.version, d.batch_id, d.sink, d.payload, d.error,
 CASE WHEN r.ok THEN 'replayed' ELSE d.status END AS status, d.created_at,
 CASE WHEN r.ok THEN TIMESTAMP '{B.AS_OF}' ELSE d.replayed_at END AS replayed_at
 FROM all_dlq d LEFT JOIN replayed r ON r.dlq_id = d.id"""
    ),
)
def dlq_after_replay(spark, folder):
    marks = dead_letters.replay_marks(_replayed(spark, folder), B.as_of())
    return dead_letters.fold_status(_all_dead_letters(spark, folder), marks)


# --- change feed and its consumer ---------------------------------------------------------------


@query(
    "feed_envelope",
    given(
        "changes",
        f"""SELECT 'record.' || id AS key, to_json({{'event_id': id || ':' || version, 'record_id': id, 'version': version,
 'document': ({DOCUMENT_SQL})::JSON, 'emitted_at': strftime(TIMESTAMP '{B.AS_OF}', '%Y-%m-%dT%H:%M:%S.%gZ')}})::VARCHAR AS value
 FROM changes""",
    ),
)
def feed_envelope(spark, folder):
    return feed.feed_messages(B.changes(spark, folder), B.as_of())


@query(
    "feed_events",
    given(
        "changes",
        f"""SELECT id || ':' || version AS event_id, id AS record_id, version, email, name, payload, poison,
 strftime(updated_at, '%Y-%m-%dT%H:%M:%S.%gZ') AS updated_at, strftime(TIMESTAMP '{B.AS_OF}', '%Y-%m-%dT%H:%M:%S.%gZ') AS emitted_at
 FROM changes""",
    ),
)
def feed_events(spark, folder):
    flat = ["email", "name", "payload", "poison", "updated_at"]
    return feed.feed_events(B.changes(spark, folder), B.as_of()).select(
        "event_id", "record_id", "version", *[f"document.{c}" for c in flat], "emitted_at"
    )


@query(
    "recent_changes",
    given(
        "changes",
        """SELECT updated_at AS changed_at, id AS record_id, version, 'incremental' AS mode FROM changes
 ORDER BY seq // 500 DESC, seq DESC LIMIT 50""",
    ),
)
def recent_changes(spark, folder):
    batch = F.expr(f"seq div {S.BATCH_ROWS}")
    rows = B.changes(spark, folder).withColumn("batch_id", batch)
    return feed.recent_changes(feed.changes(rows, F.lit(S.INCREMENTAL)))


CONSUMED_SQL = """SELECT event_id, arg_min(record_id, seq) AS record_id, arg_min(version, seq) AS version,
 count(*) - 1 AS duplicate_hits, min(seq) AS first_seq FROM deliveries GROUP BY event_id"""


@query("consume_dedup", given("deliveries", CONSUMED_SQL))
def consume_dedup(spark, folder):
    return consume.consumed_events(B.deliveries(B.changes(spark, folder)))


@query("consume_merge", given("deliveries", CONSUMED_SQL))
def consume_merge(spark, folder):
    sent = B.deliveries(B.changes(spark, folder))
    is_repeat = F.col("seq") % 2 == 1
    return consume.merge_consumed(
        consume.consumed_events(sent.where(is_repeat)), consume.consumed_events(sent.where(~is_repeat))
    )


@query(
    "consume_messages",
    given(
        "changes",
        """SELECT id || ':' || version AS event_id, id AS record_id, version, seq % 3 = 0 AND seq % 6 <> 0 AS unreadable
 FROM changes""",
    ),
)
def consume_messages(spark, folder):
    """Messages parsed back into events; those cut short are set aside, not dropped."""
    rows = B.changes(spark, folder)
    sent = rows.select(
        "seq", F.struct(event_id(), "id", "version").alias("sent"), feed.event_json(B.as_of()).alias("whole")
    )
    cut = (F.col("seq") % 3 == 0) & (F.col("seq") % 6 != 0)
    body = F.when(cut, F.substring("whole", 1, 20)).otherwise(F.col("whole"))
    events, unreadable = feed.parse_messages(sent.select("sent", body.alias("value")))
    set_aside = unreadable.select(
        F.col("sent").getField("col1").alias("event_id"),
        F.col("sent").getField("id").alias("record_id"),
        F.col("sent").getField("version").alias("version"),
        F.lit(True).alias("unreadable"),
    )
    return events.select("event_id", "record_id", "version", F.lit(False).alias("unreadable")).unionByName(set_aside)


@query(
    "consume_totals",
    given("deliveries", f"SELECT count(DISTINCT record_id) AS distinct_records, sum(duplicate_hits)::BIGINT AS deduplicated FROM ({CONSUMED_SQL})"),
)
def consume_totals(spark, folder):
    return consume.consumed_totals(consume_dedup(spark, folder))


# --- status -------------------------------------------------------------------------------------

LAG_SQL = f"""SELECT count(*) AS lag_count, CASE WHEN count(*) = 0 THEN 0.0::DOUBLE ELSE
 round(greatest(0.0, (epoch_us({{as_of}}) - epoch_us(TIMESTAMP '{B.CHECKPOINT_TS}')) / 1000000.0), 1)::DOUBLE END AS lag_seconds
 FROM records WHERE {AFTER_KEY_SQL}"""


@query("lag", given("records", LAG_SQL.format(as_of=f"TIMESTAMP '{B.AS_OF}'")))
def lag(spark, folder):
    return status.lag(B.records(spark, folder), B.checkpoints(spark), B.as_of())


PROGRESS_SQL = f"""SELECT count(*) AS source_count, coalesce(max(id), 0) AS max_id, {B.CHECKPOINT_ID}::BIGINT AS backfill_cursor,
 round({B.CHECKPOINT_ID} / max(id)::DOUBLE * 100.0, 2) AS backfill_percent FROM records"""


@query("progress", given("records", PROGRESS_SQL))
def progress(spark, folder):
    return status.progress(B.records(spark, folder), B.checkpoints(spark))


LAST_SECOND_SQL = """(SELECT date_trunc('second', max(ts)) AS now FROM events)"""
RATE_SQL = f"""SELECT CASE WHEN this > 0 THEN this ELSE last END AS rows_per_second FROM (
 SELECT coalesce(sum(rows) FILTER (date_trunc('second', attempted_at) = now), 0)::BIGINT AS this,
 coalesce(sum(rows) FILTER (date_trunc('second', attempted_at) = now - INTERVAL 1 SECOND), 0)::BIGINT AS last
 FROM attempts, {LAST_SECOND_SQL} WHERE ok)"""


def _last_event(spark, folder):
    return read_table(spark, folder, "events").agg(F.max("ts")).scalar()


def _attempt_rows(spark, folder):
    """The batch log without its cursors, which these reports do not look at."""
    return B.attempt_rows(read_table(spark, folder, "events"))


@query("throughput_now", given("attempts", RATE_SQL))
def throughput_now(spark, folder):
    return batches.current_rate(_attempt_rows(spark, folder), _last_event(spark, folder))


@query(
    "throughput_buckets",
    given("attempts", "SELECT date_trunc('second', attempted_at) AS bucket, sum(rows)::BIGINT AS rows FROM attempts WHERE ok GROUP BY 1"),
)
def throughput_buckets(spark, folder):
    return batches.throughput(_attempt_rows(spark, folder))


@query(
    "throughput_hourly",
    given("attempts", "SELECT date_trunc('hour', attempted_at) AS bucket, sum(rows)::BIGINT AS rows FROM attempts WHERE ok GROUP BY 1"),
)
def throughput_hourly(spark, folder):
    return batches.throughput(_attempt_rows(spark, folder), "1 hour")


@query(
    "throughput_recent",
    given(
        "attempts",
        """SELECT date_trunc('second', attempted_at) AS bucket, sum(rows)::BIGINT AS rows FROM attempts
 WHERE ok AND attempted_at > (SELECT max(ts) FROM events) - INTERVAL 1 DAY GROUP BY 1""",
    ),
)
def throughput_recent(spark, folder):
    return batches.throughput(_attempt_rows(spark, folder), as_of=_last_event(spark, folder), kept="1 DAY")


COUNTERS_SQL = """SELECT count(*) FILTER (error LIKE 'sink:%') AS backoff_sleeps, count(*) FILTER (error LIKE 'sink:%') AS es_transport_errors,
 sum(rejected) FILTER (ok)::BIGINT AS dlq_written, count(*) FILTER (error LIKE 'feed:%') AS rabbit_errors,
 sum(rows) FILTER (ok)::BIGINT AS records_processed FROM attempts"""


@query("counters", given("attempts", f"SELECT name, value FROM (UNPIVOT ({COUNTERS_SQL}) ON COLUMNS(*) INTO NAME name VALUE value)"))
def counters(spark, folder):
    return batches.counters(_attempt_rows(spark, folder))


STATUS_SQL = f"""SELECT CASE WHEN circuit THEN 'red' ELSE 'green' END AS health, NOT circuit AS healthy, 'effectively-once' AS guarantee,
 {B.CHECKPOINT_ID}::BIGINT AS resumed_backfill, {B.TIED_ID}::BIGINT AS resumed_incremental, true AS backfill_running,
 false AS incremental_running, backfill_cursor, last_read_id, last_read_incremental.read_id AS last_read_incremental_id,
 last_read_incremental.read_ts AS last_read_incremental_ts, backfill_percent, source_count, max_id, {B.TIED_ID}::BIGINT AS incremental_cursor_id,
 TIMESTAMP '{B.CHECKPOINT_TS}' AS incremental_cursor_ts, lag_count, lag_seconds, rows_per_second AS throughput_per_sec,
 (SELECT count(*) FROM dlq WHERE status = 'open') AS dlq_open, circuit AS circuit_open,
 CASE WHEN circuit THEN last_error ELSE '' END AS circuit_reason, CASE WHEN circuit THEN last_since END AS circuit_since, (SELECT count(*) FROM sink) AS sink_docs,
 backoff_sleeps, es_transport_errors, dlq_written, rabbit_errors, records_processed
 FROM ({PROGRESS_SQL}), ({LAG_SQL.format(as_of='(SELECT max(ts) FROM events)')}), ({RATE_SQL}), ({COUNTERS_SQL}),
 (SELECT coalesce(arg_max(coalesce(error, ''), (attempted_at, attempt)) LIKE 'sink:%', false) AS circuit,
 arg_max(coalesce(error, ''), (attempted_at, attempt)) AS last_error, arg_max(since, (attempted_at, attempt)) AS last_since,
 coalesce(max(read_id) FILTER (mode = 'backfill'), 0) AS last_read_id,
 arg_max({{'read_id': read_id, 'read_ts': read_ts}}, (attempted_at, attempt)) FILTER (mode = 'incremental') AS last_read_incremental FROM attempts)"""
STATUS_TABLES = "records sink dlq attempts"


@query("status", given(STATUS_TABLES, STATUS_SQL))
def status_row(spark, folder):
    records, checkpoints = B.records(spark, folder), B.checkpoints(spark)
    return status.status(
        records,
        B.sink(records),
        checkpoints,
        B.dead_letters(B.changes(spark, folder)),
        B.attempts(spark, folder),
        checkpoints,
        _last_event(spark, folder),
        backfill_running=True,
    )


def _line_sql(n: int, key: str, column: str) -> str:
    flag = column in ("circuit_open", "backfill_running")
    value = f"CASE WHEN {column} THEN '1' ELSE '0' END" if flag else f"{column}::VARCHAR"
    value = f"{column}::DECIMAL(38,1)::VARCHAR" if column == "lag_seconds" else value
    return f"SELECT {n} AS line, '{key}' AS key, {value} AS value FROM s"


LINES_SQL = " UNION ALL ".join(
    _line_sql(n, key, column) for n, (key, column) in enumerate(status.STATUS_FIELDS.items(), 1)
)


@query("status_lines", given(STATUS_TABLES, f"SELECT * FROM (WITH s AS ({STATUS_SQL}) {LINES_SQL})"))
def status_lines(spark, folder):
    return status.status_lines(status_row(spark, folder))


METRICS_SQL = " UNION ALL ".join(
    f"SELECT 'tidemark_{name}' AS name, '{kind}' AS type, '{text}' AS help, {column}::DOUBLE AS value FROM s"
    for name, kind, text, column in status.METRICS
)


@query("metric_rows", given(STATUS_TABLES, f"SELECT * FROM (WITH s AS ({STATUS_SQL}) {METRICS_SQL})"))
def metric_rows(spark, folder):
    return status.metric_rows(status_row(spark, folder))


@query(
    "metric_text",
    given(
        STATUS_TABLES,
        f"""SELECT name, '# HELP ' || name || ' ' || help || chr(10) || '# TYPE ' || name || ' ' || type || chr(10) || name
 || ' ' || value::BIGINT AS text FROM (WITH s AS ({STATUS_SQL}) {METRICS_SQL})""",
    ),
)
def metric_text(spark, folder):
    return status.metric_text(metric_rows(spark, folder))


# --- reconciliation -----------------------------------------------------------------------------

# Deliveries of everything the source sent, plus the changes made since.
LOST_SQL = f"""SELECT *, greatest(0, source_rows - sink_rows) AS lost, greatest(0, sink_rows - source_rows)
 + CASE WHEN distinct_records <> source_rows THEN 1 ELSE 0 END AS duplicates FROM (
 SELECT (SELECT count(*) FROM records) AS source_rows, (SELECT count(*) FROM sink) AS sink_rows,
 count(DISTINCT record_id) AS distinct_records, sum(duplicate_hits)::BIGINT AS deduplicated FROM ({CONSUMED_SQL}))"""


@query("lost_dupes", given("records sink deliveries", LOST_SQL))
def lost_dupes(spark, folder):
    source = B.records(spark, folder)
    return reconcile.lost_and_duplicated(source, B.sink(source), consume_dedup(spark, folder))


VERDICT_SQL = """SELECT coalesce(r.id, k.id) AS id, r.version AS source_version, k.version AS sink_version, CASE WHEN k.id IS NULL THEN 'lost'
 WHEN r.id IS NULL THEN 'extra' WHEN k.version < r.version THEN 'stale' WHEN k.version > r.version THEN 'ahead'
 WHEN (r.email, r.name, r.payload, r.updated_at, r.created_at) IS DISTINCT FROM (k.email, k.name, k.payload, k.updated_at, k.created_at)
 THEN 'differs' ELSE 'ok' END AS verdict FROM records r FULL JOIN sink k ON r.id = k.id"""


@query("reconcile", given("records sink", VERDICT_SQL))
def reconcile_keys(spark, folder):
    source = B.records(spark, folder)
    return reconcile.by_key(source, B.sink(source))


@query("reconcile_counts", given("records sink", f"SELECT verdict, count(*) AS rows FROM ({VERDICT_SQL}) GROUP BY verdict"))
def reconcile_counts(spark, folder):
    return reconcile.verdict_counts(reconcile_keys(spark, folder))


OUTAGES_SQL = """SELECT mode, min(attempted_at) FILTER (NOT ok) AS started_at, max(attempted_at) FILTER (NOT ok) AS last_failed_at,
 min(attempted_at) FILTER (ok) AS recovered_at, count(*) FILTER (NOT ok) AS failed_attempts,
 max(cursor_id) FILTER (NOT ok) - min(cursor_id) FILTER (NOT ok) AS cursor_delta,
 round((epoch_us(max(attempted_at) FILTER (NOT ok)) - epoch_us(min(attempted_at) FILTER (NOT ok))) / 1000000.0, 1)::DOUBLE AS down_seconds,
 round((epoch_us(min(attempted_at) FILTER (ok)) - epoch_us(max(attempted_at) FILTER (NOT ok))) / 1000000.0, 1)::DOUBLE AS recovery_seconds
 FROM (SELECT *, max(CASE WHEN ok THEN attempt END) OVER (PARTITION BY mode ORDER BY attempt
 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_ok FROM attempts) GROUP BY mode, last_ok
 HAVING count(*) FILTER (NOT ok) >= 2"""


@query("outages", given("attempts", OUTAGES_SQL))
def outages(spark, folder):
    return batches.outages(B.attempts(spark, folder), min_failures=2)


@query(
    "record_detail",
    given(
        "records sink",
        """SELECT coalesce(r.id, k.id) AS id, r.version AS source_version, r.updated_at AS source_updated_at,
 k.version AS sink_version, k.updated_at AS sink_updated_at FROM records r FULL JOIN sink k ON r.id = k.id""",
    ),
)
def record_detail(spark, folder):
    source = B.records(spark, folder)
    return search.record_detail(source, B.sink(source))


GATES_SQL = f"""WITH c AS ({LOST_SQL}), o AS (SELECT sum(failed_attempts)::BIGINT AS sleeps, max(cursor_delta) AS cursor_delta,
 max(recovery_seconds) AS recovery_seconds FROM ({OUTAGES_SQL})),
 p AS (SELECT count(*) FILTER (NOT poison) AS stored, count(*) FILTER (poison) AS flagged, count(*) AS expected FROM changes),
 d AS (SELECT count(*) AS dead_lettered FROM ({NEW_ENTRIES_SQL})),
 x AS (SELECT count(*) FILTER (json_exists(payload, '$.email') AND length(error) > 0 AND length(batch_id) > 0) AS with_context FROM ({NEW_ENTRIES_SQL}))
 SELECT 'G1' AS gate, cp > 0 AND cp = {B.CHECKPOINT_ID} AND read_id - cp <= 1000 AND sink_rows = source_rows AND lost = 0 AS passed,
 'killed at ' || read_id || ' resumed={B.CHECKPOINT_ID} checkpoint=' || cp || ' lost=' || lost AS detail FROM c, (
 SELECT arg_max(cursor_id, attempt) FILTER (ok) AS cp, max(read_id) AS read_id FROM attempts WHERE mode = 'backfill')
 UNION ALL SELECT 'G2', sink_rows = source_rows AND lost = 0 AND distinct_records = source_rows AND duplicates = 0,
 'source=' || source_rows || ' sink=' || sink_rows || ' distinct=' || distinct_records || ' duplicates=' || duplicates
 || ' deduplicated=' || deduplicated FROM c
 UNION ALL SELECT 'G3', sleeps BETWEEN 2 AND 200 AND cursor_delta <= 1000 AND recovery_seconds <= 180 AND lost = 0,
 'sleeps=' || sleeps || ' cursor_delta=' || cursor_delta || ' lost=' || lost FROM c, o
 UNION ALL SELECT 'G4', stored = expected - flagged AND dead_lettered = flagged AND with_context >= flagged,
 'stored=' || stored || ' dead_lettered=' || dead_lettered || ' with_context=' || with_context FROM p, d, x
 UNION ALL SELECT 'G5', source_count IS NOT NULL, 'fields=17' FROM ({STATUS_SQL})"""


@query("gate_report", given("records sink deliveries dlq attempts", f"SELECT * FROM ({GATES_SQL})"))
def gate_report(spark, folder):
    rows = B.changes(spark, folder)
    entries = _entries(rows)
    found = B.checkpoints(spark)
    outage = outages(spark, folder).agg(
        F.sum("failed_attempts").alias("sleeps"),
        F.max("cursor_delta").alias("cursor_delta"),
        F.max("recovery_seconds").alias("recovery_seconds"),
    )
    partial = with_error(rows).agg(
        F.count(F.lit(1)).alias("expected"),
        F.count_if("poison").alias("flagged"),
        F.count_if(F.col("error").isNull()).alias("stored"),
    )
    entry_counts = entries.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.count_if(dead_letters.has_replay_context()).alias("ctx"))
    ).scalar()
    partial = partial.withColumn("_e", entry_counts).select(
        "expected", "flagged", "stored", F.col("_e.n").alias("dead_lettered"), F.col("_e.ctx").alias("with_context")
    )
    log = B.attempts(spark, folder).where(F.col("mode") == S.BACKFILL)
    resume = log.agg(
        F.max_by("cursor_id", F.when(F.col("ok"), F.col("attempt"))).alias("checkpoint_id"), F.max("read_id").alias("read_id")
    ).withColumn("resumed_id", cursor.resume_positions(found).select(S.BACKFILL).scalar())
    return reconcile.gate_report(
        lost_dupes(spark, folder), resume, outage, partial, status_row(spark, folder)
    )


# --- search -------------------------------------------------------------------------------------

TEXT_QUERY = "  Eauouon enerth  "
WORDS_SQL = "list_distinct(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}_]+'))"
NAME_WORDS_SQL = WORDS_SQL.format(text="name")


@query(
    "search_text",
    given(
        "text_records",
        f"""SELECT id, email, name FROM text_records WHERE list_has_any({NAME_WORDS_SQL}, ['eauouon', 'enerth'])
 OR email = 'Eauouon enerth' OR name = 'Eauouon enerth' ORDER BY id DESC LIMIT 50""",
    ),
)
def search_text(spark, folder):
    return search.search(B.text_records(spark, folder), TEXT_QUERY)


@query("search_indexed", ORACLES["search_text"])
def search_indexed(spark, folder):
    """As search_text, from a table of words."""
    records = B.text_records(spark, folder)
    path = new_dir(spark, "words")
    search.write_words(records, path)
    return search.search_words(records, search.read_words(spark, path), TEXT_QUERY)


@query("search_email", given("records", f"SELECT {RECORD_SQL} FROM records WHERE email = 'user7@example.com' ORDER BY id DESC LIMIT 50"))
def search_email(spark, folder):
    return search.search(B.records(spark, folder), "user7@example.com")


@query("search_id", given("records", f"SELECT {RECORD_SQL} FROM records WHERE id = 42"))
def search_id(spark, folder):
    return search.search(B.records(spark, folder), " 042 ")


@query("search_blank", given("records", f"SELECT {RECORD_SQL} FROM records ORDER BY id DESC LIMIT 50"))
def search_blank(spark, folder):
    return search.search(B.records(spark, folder), "  ")


@query(
    "search_ilike",
    given(
        "records",
        f"""SELECT {RECORD_SQL} FROM records WHERE email ILIKE '%SER1_3@%' OR name ILIKE '%SER1_3@%' OR id::VARCHAR = 'SER1_3@'
 ORDER BY id DESC LIMIT 50""",
    ),
)
def search_ilike(spark, folder):
    return search.search_like(B.records(spark, folder), "SER1_3@")


@query(
    "search_ilike_grams",
    given(
        "text_records",
        """SELECT id, email, name FROM text_records WHERE email ILIKE '%ing%th_t%' OR name ILIKE '%ing%th_t%'
 ORDER BY id DESC LIMIT 50""",
    ),
)
def search_ilike_grams(spark, folder):
    """What a text contains, from a table of its runs of three characters."""
    records = B.text_records(spark, folder)
    path = new_dir(spark, "grams")
    search.write_grams(records, path)
    return search.search_grams(records, search.read_grams(spark, path), "ING%th_t").select("id", "email", "name")


SEARCH_MANY_SQL = f"""SELECT query_id, rank, id FROM (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY id DESC) AS rank
 FROM (SELECT DISTINCT query_id, id FROM (SELECT item_id AS query_id, unnest({WORDS_SQL.format(text='trim(text)')}) AS word FROM benchmark) q
 JOIN (SELECT id, unnest({NAME_WORDS_SQL}) AS word FROM text_records) d USING (word) WHERE word <> ''
 UNION SELECT item_id, id FROM benchmark JOIN text_records ON email = trim(text) OR name = trim(text))) WHERE rank <= 50"""


@query("search_many", given("text_records", SEARCH_MANY_SQL))
def search_many(spark, folder):
    return search.search_many(B.text_records(spark, folder), B.text_queries(spark, folder))


@query(
    "newest_text_ids",
    given("records", "SELECT id FROM (SELECT id::VARCHAR AS id FROM records) ORDER BY id::BIGINT DESC LIMIT 100"),
)
def newest_text_ids(spark, folder):
    """Ids kept as text, in the order of their numbers."""
    text = B.records(spark, folder).select(F.col("id").cast("string").alias("id"))
    return search.by_number(text, descending=True).limit(100)


# --- samples --------------------------------------------------------------------------------------

NOW_SQL = f"TIMESTAMP '{B.AS_OF}'"


SAMPLED = 10
PICKED_SQL = f"SELECT id FROM records ORDER BY md5('0:' || id), id LIMIT {SAMPLED}"


@query("sample_ids", given("records", f"SELECT id FROM records WHERE id IN ({PICKED_SQL})"))
def sample_ids(spark, folder):
    records = B.records(spark, folder)
    return records.join(sample.sample_ids(records, SAMPLED), "id", "left_semi").select("id")


# --- search by terms that the replication keeps ---------------------------------------------------


def _text_replica(spark: SparkSession, folder: str) -> ReplicationTables:
    """Texts replicated with their terms, taken into a snapshot, and every seventh renamed after that."""
    tables = ReplicationTables(new_dir(spark, "texts"), terms=True)
    texts = B.text_records(spark, folder).withColumns(
        {"payload": F.lit("{}"), "poison": F.lit(False), "updated_at": B.as_of(), "created_at": B.as_of(), "seq": F.col("id")}
    )
    commit_batch(texts.withColumn("version", F.lit(1).cast("bigint")), 0, tables, S.BACKFILL)
    tables.compact(spark)
    renamed = texts.where("id % 7 = 0").withColumn("name", F.concat(F.lit("Eauouon "), "email"))
    commit_batch(renamed.withColumn("version", F.lit(2).cast("bigint")), 0, tables, S.INCREMENTAL)
    return tables


@query("search_replicated", given("renamed_records", SEARCH_MANY_SQL.replace("text_records", "renamed_records")))
def search_replicated(spark, folder):
    """As search_many, from the terms that were written with each batch."""
    queries = B.text_queries(spark, folder)
    terms = _text_replica(spark, folder).search_terms(spark, search.asked_for(queries))
    return search.search_many_terms(terms, queries)


# --- streams --------------------------------------------------------------------------------------


PARTS = 4
FILE_ROWS = 1 << 17  # rows of a file of events: what a task of a batch reads


def _stream_events(spark: SparkSession, folder: str, *starts: Callable[[DataFrame], StreamingQuery]) -> None:
    """The events streamed in arrival order, in several batches, to each of the queries that are started.

    A part of the events is written as files of ``FILE_ROWS`` rows and taken as one batch; then the queries go on
    from their checkpoints with the next part. So files that tasks write side by side need no order among them.
    """
    root = new_dir(spark, "events")
    events = read_table(spark, folder, "events")
    first, last, rows = events.agg(F.min("event_id"), F.max("event_id"), F.count("event_id")).first()
    width = (last - first) // PARTS + 1
    files = rows // PARTS // FILE_ROWS + 1
    for n in range(PARTS):
        part = events.where(F.col("event_id").between(first + n * width, first + (n + 1) * width - 1))
        part.repartitionByRange(files, "event_id").write.mode("append").parquet(f"{root}/events.parquet")
        for running in [start(stream_table(spark, root, "events")) for start in starts]:
            running.awaitTermination()


def _replicated(spark: SparkSession, folder: str) -> ReplicationTables:
    """The changes of all events replicated as a stream of several batches into a new folder."""
    tables = ReplicationTables(new_dir(spark, "replica"))
    _stream_events(spark, folder, lambda events: replicate(B.unordered(events), tables, S.INCREMENTAL))
    return tables


@query("stream_state", given("unordered", STATE_SQL.format(table="unordered")))
def stream_state(spark, folder):
    return _replicated(spark, folder).state(spark).select(*S.RECORD_COLUMNS, "seq")


@query(
    "stream_compacted_state",
    given("unordered", STATE_SQL.format(table="unordered")),
)
def stream_compacted_state(spark, folder):
    tables = _replicated(spark, folder)
    tables.compact(spark)
    return tables.state(spark).select(*S.RECORD_COLUMNS, "seq")


@query("stream_both_modes", given("unordered", STATE_SQL.format(table="unordered")))
def stream_both_modes(spark, folder):
    """Both modes at once on the same tables: every row twice, and the state of one."""
    tables = ReplicationTables(new_dir(spark, "replica"))
    in_mode = lambda mode: lambda events: replicate(B.unordered(events), tables, mode)
    _stream_events(spark, folder, in_mode(S.BACKFILL), in_mode(S.INCREMENTAL))
    return tables.state(spark).select(*S.RECORD_COLUMNS, "seq")


LATER = "2010-01-01 00:00:00"  # past every time in the source


def _changed(records: DataFrame, at: str = B.AS_OF) -> DataFrame:
    """The source later on: some rows at their next version."""
    picked = sample.sample_ids(records, SAMPLED).withColumn("_new", F.lit(True))
    new = F.col("_new").isNotNull()
    return records.join(picked, "id", "left").select(
        *[
            F.when(new, {"version": F.col("version") + 1, "updated_at": utc(at)}[c]).otherwise(F.col(c)).alias(c)
            if c in ("version", "updated_at")
            else F.col(c)
            for c in S.RECORD_COLUMNS
        ]
    )


@query(
    "sync_state",
    given(
        "records",
        f"""SELECT id, email, name, payload, CASE WHEN bumped THEN version + 1 ELSE version END AS version, poison,
 CASE WHEN bumped THEN {NOW_SQL} ELSE updated_at END AS updated_at, created_at
 FROM (SELECT *, id IN ({PICKED_SQL}) AS bumped FROM records) WHERE NOT poison""",
    ),
)
def sync_state(spark, folder):
    return _synced(spark, folder).state(spark).select(*S.RECORD_COLUMNS)


@query(
    "stream_changing_table",
    given(
        "records",
        f"""SELECT id, email, name, payload, CASE WHEN bumped THEN version + 1 ELSE version END AS version, poison,
 CASE WHEN bumped THEN TIMESTAMP '{LATER}' ELSE updated_at END AS updated_at, created_at
 FROM (SELECT *, id IN ({PICKED_SQL}) AS bumped FROM records) WHERE NOT poison""",
    ),
)
def stream_changing_table(spark, folder):
    """A table replicated as a stream by its keys, changed in place, and replicated on from the checkpoint."""
    tables, path = ReplicationTables(new_dir(spark, "replica")), new_dir(spark, "changing")
    records = B.records(spark, folder)
    for now in (records, _changed(records, LATER)):
        now.write.mode("overwrite").parquet(path)
        replicate(changed_rows(spark, path), tables, S.INCREMENTAL).awaitTermination()
    return tables.state(spark).select(*S.RECORD_COLUMNS)


def _synced(spark: SparkSession, folder: str) -> ReplicationTables:
    """A backfill in two pages, source rows changed after it, and an incremental sync."""
    tables = ReplicationTables(new_dir(spark, "sync"))
    records = B.records(spark, folder)
    started = datetime(1999, 12, 31)
    sync(records, tables, S.BACKFILL, started, rows_per_batch=records.count() // 2 + 1)
    sync(_changed(records), tables, S.INCREMENTAL, started)
    return tables


@query(
    "sync_feed",
    given(
        "records",
        f"""SELECT id || ':' || version AS event_id, id AS record_id, version, 'backfill' AS mode FROM records
 UNION ALL SELECT id || ':' || v, id, v, 'incremental' FROM (SELECT id, CASE WHEN bumped THEN version + 1 ELSE version END AS v,
 CASE WHEN bumped THEN {NOW_SQL} ELSE updated_at END AS t FROM (SELECT *, id IN ({PICKED_SQL}) AS bumped FROM records))
 WHERE t > TIMESTAMP '1999-12-31' OR (t = TIMESTAMP '1999-12-31' AND id > 0)""",
    ),
)
def sync_feed(spark, folder):
    return _synced(spark, folder).feed(spark).select("event_id", "record_id", "version", "mode")


@query(
    "sync_dead_letters",
    given(
        "records",
        f"""SELECT id AS record_id, version, '{S.POISON_ERROR}' AS error, 'open' AS status FROM records WHERE poison
 UNION ALL SELECT id, version + 1, '{S.POISON_ERROR}', 'open' FROM records WHERE poison AND id IN ({PICKED_SQL})""",
    ),
)
def sync_dead_letters(spark, folder):
    return _synced(spark, folder).dead_letters(spark).select("record_id", "version", "error", "status")


def _first_rejected_sql(status_sql: str) -> str:
    return f"""SELECT (row_number() OVER (ORDER BY seq) - 1) * 4 + 1 AS id, record_id, version, sink, payload, error,
 {status_sql} AS status FROM (SELECT seq, id AS record_id, version, 'elasticsearch' AS sink, {DOCUMENT_SQL} AS payload,
 '{S.POISON_ERROR}' AS error FROM unordered WHERE poison QUALIFY row_number() OVER (PARTITION BY id, version ORDER BY seq) = 1)"""


@query("stream_dead_letters", given("unordered", _first_rejected_sql("'open'")))
def stream_dead_letters(spark, folder):
    entries = _replicated(spark, folder).dead_letters(spark)
    return entries.select("id", "record_id", "version", "sink", "payload", "error", "status")


@query(
    "stream_replay",
    given(
        "unordered",
        _first_rejected_sql("CASE WHEN row_number() OVER (ORDER BY seq) % 2 = 1 THEN 'replayed' ELSE 'open' END"),
    ),
)
def stream_replay(spark, folder):
    """Every second dead letter of a replicated stream sent again and marked."""
    tables = _replicated(spark, folder)
    every_second = tables.dead_letters(spark).where(F.col("id") % 8 == 1).select("id")
    replay_dead_letters(spark, tables, B.records(spark, folder), every_second, 0)
    return tables.dead_letters(spark).select("id", "record_id", "version", "sink", "payload", "error", "status")


@query(
    "stream_feed",
    given("unordered", "SELECT id || ':' || version AS event_id, id AS record_id, version, seq, 'record.' || id AS key FROM unordered"),
)
def stream_feed(spark, folder):
    return _replicated(spark, folder).feed(spark).select("event_id", "record_id", "version", "seq", "key")


@query(
    "stream_checkpoints",
    given(
        "unordered",
        """SELECT 'incremental' AS mode, arg_max(id, (updated_at, id)) AS cursor_id, max(updated_at) AS cursor_ts FROM unordered""",
    ),
)
def stream_checkpoints(spark, folder):
    return _replicated(spark, folder).checkpoints(spark)


STREAM_CONSUMED_SQL = """SELECT id || ':' || version AS event_id, arg_min(id, seq) AS record_id, arg_min(version, seq) AS version,
 count(*) - 1 AS duplicate_hits, min(seq) AS first_seq FROM unordered GROUP BY 1"""


@query("stream_consume", given("unordered", STREAM_CONSUMED_SQL))
def stream_consume(spark, folder):
    tables = _replicated(spark, folder)
    feed_consumer.consume(feed_consumer.feed_stream(spark, tables), tables).awaitTermination()
    return feed_consumer.consumed(spark, tables)


@query("stream_consume_messages", given("unordered", STREAM_CONSUMED_SQL))
def stream_consume_messages(spark, folder):
    """As stream_consume, from the messages' JSON text."""
    tables = _replicated(spark, folder)
    feed_consumer.consume(feed_consumer.feed_stream(spark, tables, as_messages=True), tables).awaitTermination()
    return feed_consumer.consumed(spark, tables)


@query("stream_consume_stateful", given("unordered", STREAM_CONSUMED_SQL))
def stream_consume_stateful(spark, folder):
    tables = _replicated(spark, folder)
    feed_consumer.consume_stateful(feed_consumer.feed_stream(spark, tables), tables).awaitTermination()
    return feed_consumer.running_counts(spark, tables)


@query("stream_throughput", ORACLES["throughput_hourly"])
def stream_throughput(spark, folder):
    """Hourly buckets of a stream, from several batches."""
    root = new_dir(spark, "throughput")
    _stream_events(spark, folder, lambda events: count_throughput(B.attempt_rows(events), root, "1 hour"))
    return counted(spark, root)
