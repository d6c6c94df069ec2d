"""Reports over the batch log: counters, throughput and outages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import schema as S
from tidemark.functions.times import second_of, seconds_between
from tidemark.operators.ordered import running

# Counter names, and how a failed attempt's error begins.
COUNTERS = ["backoff_sleeps", "es_transport_errors", "dlq_written", "rabbit_errors", "records_processed"]
SINK_ERROR = "sink:"
FEED_ERROR = "feed:"
# End of fixed values.


def counter_columns() -> list[Column]:
    """All counters as aggregates of one scan.

    A failed sink attempt is followed by one sleep. ``dlq_written`` counts rows that were added,
    not rows that were skipped because the same entry was open.
    """
    total = lambda value: F.coalesce(F.sum(value), F.lit(0)).cast("bigint")
    sink_failures = F.count_if(F.col("error").startswith(SINK_ERROR))
    by_name = {
        "backoff_sleeps": sink_failures,
        "es_transport_errors": sink_failures,
        "dlq_written": total(F.when(F.col("ok"), F.col("rejected"))),
        "rabbit_errors": F.count_if(F.col("error").startswith(FEED_ERROR)),
        "records_processed": total(F.when(F.col("ok"), F.col("rows"))),
    }
    return [by_name[name].alias(name) for name in COUNTERS]


def counters(batch_log: DataFrame) -> DataFrame:
    return batch_log.agg(*counter_columns()).unpivot([], COUNTERS, "name", "value")


def throughput(
    batch_log: DataFrame, width: str = "1 second", as_of: Column | None = None, kept: str = S.THROUGHPUT_KEPT
) -> DataFrame:
    """Rows per time bucket; with ``as_of``, only of buckets not yet expired by then."""
    done = batch_log.where("ok")
    if as_of is not None:
        done = done.where((F.col("attempted_at") > as_of - F.expr(f"INTERVAL {kept}")) & (F.col("attempted_at") <= as_of))
    return (
        done.groupBy(F.window("attempted_at", width).alias("_w"))
        .agg(F.sum("rows").alias("rows"))
        .select(F.col("_w.start").alias("bucket"), "rows")
    )


def current_rate_column(as_of: Column) -> Column:
    """Rows of this second so far or, when there are none, of the second before."""
    at, now = second_of(F.col("attempted_at")), second_of(as_of)
    rows_at = lambda second: F.coalesce(F.sum(F.when(F.col("ok") & (at == second), F.col("rows"))), F.lit(0))
    this, last = rows_at(now), rows_at(now - F.expr("INTERVAL 1 second"))
    return F.when(this > 0, this).otherwise(last).cast("bigint")


def current_rate(batch_log: DataFrame, as_of: Column) -> DataFrame:
    recent = batch_log.where(F.col("attempted_at") >= second_of(as_of) - F.expr("INTERVAL 1 second"))
    return recent.agg(current_rate_column(as_of).alias("rows_per_second"))


def outages(batch_log: DataFrame, min_failures: int = 1) -> DataFrame:
    """Runs of failed attempts per mode, with the attempt that ended each.

    All attempts up to and including the next success share the last success before them, so that
    is the run's key, and a plain aggregate does the rest. An outage still open has no recovery.
    """
    succeeded = F.when(F.col("ok"), F.col("attempt"))
    keyed = running(batch_log, ["mode"], "attempt", succeeded, "max", "_last_ok")
    failed = lambda value: F.when(~F.col("ok"), F.col(value))
    runs = keyed.groupBy("mode", "_last_ok").agg(
        F.min(failed("attempted_at")).alias("started_at"),
        F.max(failed("attempted_at")).alias("last_failed_at"),
        F.min(F.when(F.col("ok"), F.col("attempted_at"))).alias("recovered_at"),
        F.count_if(~F.col("ok")).alias("failed_attempts"),
        (F.max(failed("cursor_id")) - F.min(failed("cursor_id"))).alias("cursor_delta"),
    )
    down = seconds_between(F.col("started_at"), F.col("last_failed_at"))
    recovery = seconds_between(F.col("last_failed_at"), F.col("recovered_at"))
    return runs.where(F.col("failed_attempts") >= min_failures).select(
        "mode",
        "started_at",
        "last_failed_at",
        "recovered_at",
        "failed_attempts",
        "cursor_delta",
        F.round(down, 1).alias("down_seconds"),
        F.round(recovery, 1).alias("recovery_seconds"),
    )
