"""Time the headline queries; prints one JSON line.

Each query runs over its whole tables into a sink that takes all rows and keeps none. The time is
the better of two runs after one that warms the JVM up; the sync of 20 batches runs once, and is not in the total. ``rows_per_sec`` says how many source rows
per second a query, or the whole replication stream, got through.
"""

from __future__ import annotations

import json
import os
import time
from datetime import datetime

from tidemark import catalog
from tidemark.session import local_session, new_dir
from tidemark.sources import bindings as B
from tidemark.sources.tables import read_table, stream_table
from tidemark.streaming.replicate import replicate
from tidemark.streaming.sync import sync
from tidemark.streaming.tables import ReplicationTables

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 2

HEADLINE = {
    "backfill_page": "orders",
    "incremental_page": "orders",
    "page_cursors": "orders",
    "page_cursors_incremental": "orders",
    "upsert_state": "events",
    "upsert_outcomes": "events",
    "dlq_append": "events",
    "dlq_replay": "events",
    "feed_envelope": "events",
    "consume_dedup": "events",
    "dual_mode_state": "orders",
    "reconcile_counts": "orders",
    "outages": "events",
    "throughput_buckets": "events",
    "status": "orders",
    "search_text": "documents",
    "search_many": "documents",
}


def timed(run) -> float:
    started = time.perf_counter()
    run()
    return time.perf_counter() - started


def main() -> None:
    spark = local_session(CPUS, int(CPUS) if CPUS.isdigit() else 8, os.environ.get("BENCH_MEMORY", "8g"))
    sizes = {t: read_table(spark, FOLDER, t).count() for t in sorted(set(HEADLINE.values()))}
    seconds, rates = {}, {}

    def note(name: str, run, rows: int) -> None:
        run()
        seconds[name] = round(min(timed(run) for _ in range(RUNS)), 3)
        rates[name] = round(rows / seconds[name])

    for name, table in HEADLINE.items():
        query = catalog.QUERIES[name]
        note(name, lambda: query(spark, FOLDER).write.format("noop").mode("overwrite").save(), sizes[table])

    def stream() -> None:
        rows = B.unordered(stream_table(spark, FOLDER, "events"))
        replicate(rows, ReplicationTables(new_dir(spark, "bench")), "incremental").awaitTermination()

    note("stream_replicate", stream, sizes["events"])

    def synced() -> None:
        """The orders in 20 batches."""
        rows = sizes["orders"] // 20 + 1
        sync(B.records(spark, FOLDER), ReplicationTables(new_dir(spark, "bench")), "backfill", datetime(2000, 1, 1), rows)

    many = {"sync_20_batches": round(timed(synced), 3)}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rates,
                "many_batches": many,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
