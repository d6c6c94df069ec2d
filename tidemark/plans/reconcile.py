"""Source against sink: by count, and by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import schema as S
from tidemark.operators.consume import consumed_totals
from tidemark.plans.one_row import beside, packed

COMPARED = ("email", "name", "payload", "updated_at", "created_at")


def lost_and_duplicated(source: DataFrame, sink: DataFrame, consumed: DataFrame) -> DataFrame:
    """Counts of both sides as one row. A lost and an extra row cancel out: see ``by_key``."""
    counts = beside(
        source.agg(F.count(F.lit(1)).alias("source_rows")),
        sink.agg(F.count(F.lit(1)).alias("sink_rows")),
        consumed_totals(consumed),
    )
    short = F.col("source_rows") - F.col("sink_rows")
    feed_differs = F.col("distinct_records") != F.col("source_rows")
    return counts.select(
        "*",
        F.greatest(F.lit(0), short).alias("lost"),
        (F.greatest(F.lit(0), -short) + F.when(feed_differs, 1).otherwise(0)).alias("duplicates"),
    )


def by_key(source: DataFrame, sink: DataFrame, compared: tuple[str, ...] = COMPARED) -> DataFrame:
    """A verdict per id. Only the id, version and a hash of the content are shuffled.

    The poison flag is left out: a replayed document has it cleared while the source may not.
    """
    # a hash skips nulls: where they are goes in too; payloads are compared as JSON, not as text
    value = lambda name: F.coalesce(F.to_json(F.try_parse_json(name)), F.col(name)) if name == "payload" else F.col(name)
    content = F.xxhash64(*[c for name in compared for c in (value(name), F.col(name).isNull())])
    left = source.select("id", F.col("version").alias("source_version"), content.alias("_source_hash"))
    right = sink.select("id", F.col("version").alias("sink_version"), content.alias("_sink_hash"))
    verdict = (
        F.when(F.col("sink_version").isNull(), "lost")
        .when(F.col("source_version").isNull(), "extra")
        .when(F.col("sink_version") < F.col("source_version"), "stale")
        .when(F.col("sink_version") > F.col("source_version"), "ahead")
        .when(F.col("_source_hash") != F.col("_sink_hash"), "differs")
        .otherwise("ok")
    )
    return left.join(right, "id", "full_outer").select(
        "id", "source_version", "sink_version", verdict.alias("verdict")
    )


def verdict_counts(verdicts: DataFrame) -> DataFrame:
    return verdicts.groupBy("verdict").agg(F.count(F.lit(1)).alias("rows"))


# What the gates allow.
SLEEPS_ALLOWED = (2, 200)
CURSOR_BATCHES_ALLOWED = 2
READ_BATCHES_ALLOWED = 2
RECOVERY_SECONDS_ALLOWED = 180
# End of fixed values.


#: Status fields that are never null; a closed circuit has no ``since``, a mode not yet run has read nothing.
REQUIRED = (
    "health healthy guarantee backfill_running incremental_running backfill_cursor last_read_id backfill_percent source_count "
    "max_id lag_count lag_seconds throughput_per_sec dlq_open circuit_open circuit_reason sink_docs"
).split()


def _gate(name: str, passed: Column, detail: Column) -> Column:
    return F.struct(F.lit(name).alias("gate"), passed.alias("passed"), detail.alias("detail"))


def gate_report(
    counts: DataFrame, resume: DataFrame, outage: DataFrame, partial: DataFrame, status: DataFrame
) -> DataFrame:
    """One row per gate, from one-row tables.

    counts: ``lost_and_duplicated``; resume: checkpoint_id (what the log committed last before the kill),
    resumed_id (what the restart went on from), read_id (how far had been read); outage: sleeps,
    cursor_delta, recovery_seconds; partial: expected, flagged, stored, dead_lettered,
    with_context; status: the status row.
    """
    facts = beside(
        packed(counts, "c"), packed(resume, "r"), packed(outage, "o"), packed(partial, "p"), packed(status, "s")
    )
    c, r, o, p = (F.col(name) for name in ("c", "r", "o", "p"))
    nothing_lost = (c["lost"] == 0) & (c["sink_rows"] == c["source_rows"])
    say = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])
    gates = F.array(
        _gate(
            "G1",
            (r["checkpoint_id"] > 0)
            & (r["resumed_id"] == r["checkpoint_id"])
            & (r["read_id"] - r["checkpoint_id"] <= READ_BATCHES_ALLOWED * S.BATCH_ROWS)
            & nothing_lost,
            say("killed at ", r["read_id"], " resumed=", r["resumed_id"], " checkpoint=", r["checkpoint_id"], " lost=", c["lost"]),
        ),
        _gate(
            "G2",
            nothing_lost & (c["distinct_records"] == c["source_rows"]) & (c["duplicates"] == 0),
            say("source=", c["source_rows"], " sink=", c["sink_rows"], " distinct=", c["distinct_records"],
                " duplicates=", c["duplicates"], " deduplicated=", c["deduplicated"]),
        ),
        _gate(
            "G3",
            o["sleeps"].between(*SLEEPS_ALLOWED)
            & (o["cursor_delta"] <= CURSOR_BATCHES_ALLOWED * S.BATCH_ROWS)
            & (o["recovery_seconds"] <= RECOVERY_SECONDS_ALLOWED)
            & (c["lost"] == 0),
            say("sleeps=", o["sleeps"], " cursor_delta=", o["cursor_delta"], " lost=", c["lost"]),
        ),
        _gate(
            "G4",
            (p["stored"] == p["expected"] - p["flagged"])
            & (p["dead_lettered"] == p["flagged"])
            & (p["with_context"] >= p["flagged"]),
            say("stored=", p["stored"], " dead_lettered=", p["dead_lettered"], " with_context=", p["with_context"]),
        ),
        _gate(
            "G5",
            F.forall(F.array(*[F.col("s")[f].isNotNull() for f in REQUIRED]), lambda present: present),
            say("fields=", F.lit(len(REQUIRED))),
        ),
    )
    return facts.select(F.inline(gates)).select(
        "gate", F.coalesce("passed", F.lit(False)).alias("passed"), F.coalesce("detail", F.lit("")).alias("detail")
    )
