"""Position, lag, throughput and health as one row, and that row in two text forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import schema as S
from tidemark.functions.cursors import after_key
from tidemark.functions.times import seconds_between, utc
from tidemark.operators.cursor import checkpoint, resume_positions
from tidemark.operators.dead_letters import is_open
from tidemark.plans.one_row import beside, packed
from tidemark.plans.batches import COUNTERS, SINK_ERROR, counter_columns, current_rate_column

# Names and texts of the two text forms.
STATUS_FIELDS = {
    "backfill_cursor": "backfill_cursor",
    "last_read": "last_read_id",
    "max_id": "max_id",
    "resumed_from": "resumed_backfill",
    "throughput": "throughput_per_sec",
    "lag_count": "lag_count",
    "lag_seconds": "lag_seconds",
    "dlq_open": "dlq_open",
    "circuit_open": "circuit_open",
    "backoff_sleeps": "backoff_sleeps",
    "es_transport_errors": "es_transport_errors",
    "health": "health",
    "es_docs": "sink_docs",
    "source_count": "source_count",
    "backfill_running": "backfill_running",
    "guarantee": "guarantee",
}
METRICS = [
    ("backfill_cursor", "gauge", "Backfill checkpoint cursor id", "backfill_cursor"),
    ("throughput_per_sec", "gauge", "Recent throughput", "throughput_per_sec"),
    ("incremental_lag_count", "gauge", "Incremental lag in records", "lag_count"),
    ("dlq_open", "gauge", "Open DLQ entries", "dlq_open"),
    ("circuit_open", "gauge", "Elasticsearch circuit open (1/0)", "circuit_open"),
    ("health", "gauge", "1=healthy 0=unhealthy", "healthy"),
    ("backoff_sleeps", "counter", "Count of backoff sleeps during sink outage", "backoff_sleeps"),
    ("es_transport_errors", "counter", "Elasticsearch transport errors", "es_transport_errors"),
    ("records_processed", "counter", "Records processed through pipeline", "records_processed"),
]
# End of fixed values.


def lag_columns(cursor_ts: Column, cursor_id: Column, as_of: Column) -> list[Column]:
    """Rows past the incremental cursor, and its age while there are any; 0 without a cursor."""
    count = F.when(cursor_ts.isNull(), F.lit(0)).otherwise(F.count_if(after_key(cursor_ts, cursor_id))).cast("bigint")
    return _lag(count, cursor_ts, as_of)


def _lag(count: Column, cursor_ts: Column, as_of: Column) -> list[Column]:
    age = F.round(F.greatest(F.lit(0.0), seconds_between(cursor_ts, as_of)), 1)
    return [count.alias("lag_count"), F.when(count == 0, F.lit(0.0)).otherwise(age).alias("lag_seconds")]


def _cursor(checkpoints: DataFrame, mode: str, column: str) -> Column:
    return checkpoint(checkpoints, mode).select(column).scalar()


def lag(records: DataFrame, checkpoints: DataFrame, as_of: Column) -> DataFrame:
    """The cursor, one row, is read first, so that the reader is given plain values to filter by."""
    found = checkpoint(checkpoints, S.INCREMENTAL).first()
    at = found["cursor_ts"] if found else None
    past = records.where(after_key(utc(at), found["cursor_id"]) if at else F.lit(False))
    return past.agg(*_lag(F.count(F.lit(1)), utc(at), as_of))


def _percent(cursor_id: Column, max_id: Column) -> Column:
    share = F.round(cursor_id / F.when(max_id > 0, max_id) * F.lit(100.0), 2)
    return F.coalesce(share, F.lit(0.0))


def progress(records: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """How far the backfill is, in percent of the highest id."""
    return records.agg(
        F.count(F.lit(1)).alias("source_count"), F.coalesce(F.max("id"), F.lit(0)).alias("max_id")
    ).select(
        "source_count",
        "max_id",
        _cursor(checkpoints, S.BACKFILL, "cursor_id").alias("backfill_cursor"),
        _percent(_cursor(checkpoints, S.BACKFILL, "cursor_id"), F.col("max_id")).alias("backfill_percent"),
    )


def status(
    records: DataFrame,
    sink: DataFrame,
    checkpoints: DataFrame,
    dead_letters: DataFrame,
    batch_log: DataFrame,
    resumed: DataFrame,
    as_of: Column,
    backfill_running: bool = False,
    incremental_running: bool = False,
) -> DataFrame:
    """The status row, one plan with one scan per table.

    ``resumed`` holds the checkpoints found at the start. The circuit is open if the last attempt in
    time, of whichever mode, failed at the sink; a feed that fails does not open it. What was read
    last may be ahead of the cursor: an attempt that failed had read its rows.
    """
    cursor_ts = _cursor(checkpoints, S.INCREMENTAL, "cursor_ts")
    cursor_id = _cursor(checkpoints, S.INCREMENTAL, "cursor_id")
    source = records.agg(
        F.count(F.lit(1)).alias("source_count"),
        F.coalesce(F.max("id"), F.lit(0)).alias("max_id"),
        *lag_columns(cursor_ts, cursor_id, as_of),
    )

    is_backfill, is_incremental = F.col("mode") == S.BACKFILL, F.col("mode") == S.INCREMENTAL
    last_read = F.coalesce(F.max(F.when(is_backfill, F.col("read_id"))), F.lit(0)).cast("bigint")
    order = F.struct("attempted_at", "attempt", "mode")
    down = F.coalesce(F.col("error").startswith(SINK_ERROR), F.lit(False))
    log = batch_log.agg(
        current_rate_column(as_of).alias("throughput_per_sec"),
        last_read.alias("last_read_id"),
        F.max_by(F.struct("read_id", "read_ts"), F.when(is_incremental & F.col("read_id").isNotNull(), order)).alias("last_read_incremental"),
        F.coalesce(F.max_by(down, order), F.lit(False)).alias("circuit_open"),
        F.coalesce(F.max_by(F.when(down, F.col("error")).otherwise(F.lit("")), order), F.lit("")).alias("circuit_reason"),
        F.max_by(F.struct(F.when(down, F.col("since")).alias("since")), order).alias("circuit"),
        *counter_columns(),
    )
    together = beside(
        source,
        packed(log, "log"),
        packed(resume_positions(resumed), "started"),
        dead_letters.agg(F.count_if(is_open()).alias("dlq_open")),
        sink.agg(F.count(F.lit(1)).alias("sink_docs")),
        checkpoint(checkpoints, S.BACKFILL).select(F.col("cursor_id").alias("backfill_cursor")),
        checkpoint(checkpoints, S.INCREMENTAL).select(
            F.col("cursor_id").alias("incremental_cursor_id"), F.col("cursor_ts").alias("incremental_cursor_ts")
        ),
    )
    circuit_open = F.col("log.circuit_open")
    return together.select(
        F.when(circuit_open, "red").otherwise("green").alias("health"),
        (~circuit_open).alias("healthy"),
        F.lit(S.GUARANTEE).alias("guarantee"),
        F.col(f"started.{S.BACKFILL}").alias("resumed_backfill"),
        F.col(f"started.{S.INCREMENTAL}").alias("resumed_incremental"),
        F.lit(backfill_running).alias("backfill_running"),
        F.lit(incremental_running).alias("incremental_running"),
        "backfill_cursor",
        F.col("log.last_read_id").alias("last_read_id"),
        F.col("log.last_read_incremental.read_id").alias("last_read_incremental_id"),
        F.col("log.last_read_incremental.read_ts").alias("last_read_incremental_ts"),
        _percent(F.col("backfill_cursor"), F.col("max_id")).alias("backfill_percent"),
        "source_count",
        "max_id",
        "incremental_cursor_id",
        "incremental_cursor_ts",
        "lag_count",
        "lag_seconds",
        F.col("log.throughput_per_sec").alias("throughput_per_sec"),
        "dlq_open",
        circuit_open.alias("circuit_open"),
        F.col("log.circuit_reason").alias("circuit_reason"),
        F.col("log.circuit.since").alias("circuit_since"),
        "sink_docs",
        *[F.col(f"log.{name}").alias(name) for name in COUNTERS],
    )


def _as_number(status_row: DataFrame, name: str) -> Column:
    """Booleans as 1 and 0, fractions without an exponent, other columns as they are."""
    kind = status_row.schema[name].dataType.simpleString()
    return F.col(name).cast({"boolean": "bigint", "double": "decimal(38,1)"}.get(kind, kind))


def status_lines(status_row: DataFrame) -> DataFrame:
    """The status row as (key, value) text rows, in their usual order."""
    pairs = [
        F.struct(F.lit(n).alias("line"), F.lit(key).alias("key"), _as_number(status_row, column).cast("string").alias("value"))
        for n, (key, column) in enumerate(STATUS_FIELDS.items(), 1)
    ]
    return status_row.select(F.inline(F.array(*pairs)))


def metric_rows(status_row: DataFrame, prefix: str = "tidemark") -> DataFrame:
    """The status row as (name, type, help, value) rows."""
    rows = [
        F.struct(
            F.lit(f"{prefix}_{name}").alias("name"),
            F.lit(kind).alias("type"),
            F.lit(text).alias("help"),
            _as_number(status_row, column).cast("double").alias("value"),
        )
        for name, kind, text, column in METRICS
    ]
    return status_row.select(F.inline(F.array(*rows)))


def metric_text(metrics: DataFrame) -> DataFrame:
    """Metric rows in the Prometheus text format, one row per metric."""
    whole = F.col("value") == F.floor("value")
    number = F.when(whole, F.col("value").cast("bigint").cast("string")).otherwise(F.col("value").cast("string"))
    return metrics.select(
        "name",
        F.concat(
            F.lit("# HELP "), "name", F.lit(" "), "help", F.lit("\n# TYPE "), "name", F.lit(" "), "type",
            F.lit("\n"), "name", F.lit(" "), number,
        ).alias("text"),
    )
