"""Kills, outages and redeliveries: the outputs must be those of a run without them."""

from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.functions.times import utc
import synth
from tidemark import catalog
from tidemark.operators import consume, upsert
from tidemark.operators.dead_letters import has_replay_context, is_open
from tidemark.plans import batches, reconcile, status
from tidemark.session import new_dir
from tidemark.sources import bindings as B
from tidemark.sources.tables import read_table, stream_table
from tidemark.streaming import consume as consumer, replicate as replication
from tidemark.streaming.replicate import replay_dead_letters, replicate
from tidemark.streaming.sync import sync
from tidemark.streaming.tables import ReplicationTables
from tidemark.streaming.throughput import count_throughput, counted

FILES = 3


@pytest.fixture(scope="module")
def split(spark):
    """The events as several files in one folder, in arrival order."""
    folder = new_dir(spark, "split")
    events = read_table(spark, "/root/testdata/sf0.001", "events")
    for n in range(FILES):
        part = events.where(F.col("event_id").between(n * 334, n * 334 + 333))
        part.coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    return folder


def rows(spark, split):
    return B.unordered(stream_table(spark, split, "events", files_per_batch=1))


def everything(spark, tables):
    """What a reader sees: state, dead letters and feed, without wall-clock columns."""
    state = sorted(tables.state(spark).select(*S.RECORD_COLUMNS).collect())
    dead = sorted(tables.dead_letters(spark).select("id", "record_id", "version", "payload", "error", "status").collect())
    feed = sorted(tables.feed(spark).select("event_id", "seq", "key").collect())
    return state, dead, feed


@pytest.fixture(scope="module")
def clean(spark, split):
    tables = ReplicationTables(new_dir(spark, "clean"))
    replicate(rows(spark, split), tables, S.INCREMENTAL).awaitTermination()
    return tables


def test_stream_equals_batch(spark, split, clean):
    all_rows = B.unordered(read_table(spark, split, "events"))
    expected = upsert.upsert(None, all_rows).select(*S.RECORD_COLUMNS)
    state, dead, feed = everything(spark, clean)
    assert state == sorted(expected.collect())
    assert len(feed) == all_rows.count() == 1000
    poison = all_rows.where("poison")
    assert len(dead) == poison.select("id", "version").distinct().count()
    log = clean.batch_log(spark)
    assert log.where("ok").count() == FILES
    assert log.agg(F.sum("rows"), F.sum("rejected")).first()[:] == (1000, len(dead))


@pytest.mark.parametrize("step", ["store_rows", "store_dead_letters", "publish", "_log_attempt"])
def test_killed_between_two_outputs(spark, split, clean, tables, monkeypatch, step):
    real, calls = getattr(replication, step), []
    dies_at = 1 if step == "_log_attempt" else 3

    def dies_once(*args, **kwargs):
        calls.append(1)
        written = real(*args, **kwargs) if step != "_log_attempt" or len(calls) != dies_at else None
        if len(calls) == dies_at:
            raise RuntimeError("killed")
        return written

    monkeypatch.setattr(replication, step, dies_once)
    with pytest.raises(StreamingQueryException):
        replicate(rows(spark, split), tables, S.INCREMENTAL).awaitTermination()
    done = tables.batch_log(spark).where("ok").count()
    assert done < FILES
    resumed = tables.checkpoints(spark).first()
    replicate(rows(spark, split), tables, S.INCREMENTAL).awaitTermination()
    assert everything(spark, tables) == everything(spark, clean)
    if done:
        assert resumed["cursor_id"] is not None


def test_outage_holds_the_cursor_and_is_reported(spark, split, clean, tables):
    calls, sent = [], []

    def sink(documents):
        calls.append(1)
        if 3 <= len(calls) <= 5:
            raise ConnectionError("unavailable")
        sent.append(documents.count())

    published = []
    run = lambda: replicate(
        rows(spark, split), tables, S.INCREMENTAL, store_to=sink, publish_to=lambda m: published.append(m.count())
    ).awaitTermination()
    cursors = []
    for _ in range(3):
        with pytest.raises(StreamingQueryException):
            run()
        cursors.append(tables.checkpoints(spark).first()[:])
    assert len(set(cursors)) == 1
    log = tables.batch_log(spark)
    assert log.where("ok").count() == 2
    open_outage = batches.outages(log).first()
    assert (open_outage["failed_attempts"], open_outage["recovered_at"]) == (3, None)

    run()
    assert sum(published) == 1000 and sum(sent) == clean.documents(spark).count()
    assert everything(spark, tables) == everything(spark, clean)
    outage = batches.outages(tables.batch_log(spark)).collect()
    assert len(outage) == 1 and outage[0]["failed_attempts"] == 3 and outage[0]["recovered_at"] is not None
    counted = {r["name"]: r["value"] for r in batches.counters(tables.batch_log(spark)).collect()}
    assert counted["es_transport_errors"] == counted["backoff_sleeps"] == 3
    assert counted["records_processed"] == 1000


def results(documents, refuse="false", error=None):
    """What a sink answers, item by item."""
    said = F.when(F.expr(refuse), "rejected").otherwise("created")
    return documents.select("id", "version", "seq", said.alias("outcome"), F.when(F.expr(refuse), F.lit(error)).alias("error"))


def test_incomplete_write_is_not_committed(spark, split, clean, tables):
    twice = lambda documents: results(documents).union(results(documents))  # more answers than rows
    with pytest.raises(StreamingQueryException, match="IncompleteBatch"):
        replicate(rows(spark, split), tables, S.INCREMENTAL, store_to=twice).awaitTermination()
    assert tables.documents(spark).count() == 0
    assert tables.feed(spark).count() == 0
    replicate(rows(spark, split), tables, S.INCREMENTAL, store_to=results).awaitTermination()
    assert everything(spark, tables) == everything(spark, clean)


def test_a_batch_committed_twice(spark, split, clean, tables):
    batch = B.unordered(read_table(spark, split, "events"))
    sent = []
    for _ in range(2):
        replication.commit_batch(batch, 0, tables, S.INCREMENTAL, publish_to=lambda messages: sent.append(messages.count()))
    assert everything(spark, tables) == everything(spark, clean)
    counted = {r["name"]: r["value"] for r in batches.counters(tables.batch_log(spark)).collect()}
    assert counted["records_processed"] == 1000 and sent == [1000]


def test_both_modes_overlap(spark, split, clean, tables):
    for mode in (S.BACKFILL, S.INCREMENTAL):
        replicate(rows(spark, split), tables, mode).awaitTermination()
    assert everything(spark, tables)[0] == everything(spark, clean)[0]
    assert tables.dead_letters(spark).count() == clean.dead_letters(spark).count()
    consumer.consume(consumer.feed_stream(spark, tables, 3), tables).awaitTermination()
    seen = consumer.consumed(spark, tables)
    assert seen.count() == clean.feed(spark).select("event_id").distinct().count()
    assert seen.agg(F.sum(F.col("duplicate_hits") + 1)).first()[0] == 2000


def test_compaction_changes_nothing(spark, split, clean, tables):
    source = rows(spark, split)
    replicate(source, tables, S.INCREMENTAL).awaitTermination()
    before = everything(spark, tables)
    tables.compact(spark)
    assert everything(spark, tables) == before == everything(spark, clean)
    replicate(source, tables, S.BACKFILL).awaitTermination()
    assert everything(spark, tables)[0] == before[0]
    tables.compact(spark)
    tables.compact(spark)
    assert everything(spark, tables)[0] == before[0]
    assert tables.read(spark, "snapshot_log", "snapshot BIGINT").distinct().count() == 2


def test_flagged_batch_of_500(spark, tables, folder):
    now = utc("2024-06-01 00:00:00")
    source = B.records(spark, folder)
    seed = source.where("not poison").withColumn("seq", F.col("id"))
    replication.commit_batch(seed, 0, tables, S.BACKFILL)
    stored = tables.state(spark).count()
    batch = synth.flagged_batch(source, now).withColumn("seq", F.col("id"))
    replication.commit_batch(batch, 0, tables, S.INCREMENTAL)
    assert tables.state(spark).count() - stored == 497
    entries = tables.dead_letters(spark)
    assert entries.where(is_open()).count() == 3
    assert entries.where(has_replay_context()).count() == 3
    assert tables.feed(spark).where("mode = 'incremental'").count() == 500


def test_replay_marks_entries_and_is_repeatable(spark, tables, folder):
    source = B.records(spark, folder).withColumn("seq", F.col("id"))
    replication.commit_batch(source, 0, tables, S.BACKFILL)
    flagged = source.where("poison").count()
    wanted = tables.dead_letters(spark).select("id").unionByName(spark.createDataFrame([(-5,)], "id BIGINT"))
    for _ in range(2):
        said = replay_dead_letters(spark, tables, source.select(*S.RECORD_COLUMNS), wanted, 0)
        assert said.where("ok").count() == flagged
        assert [r["reason"] for r in said.where("not ok").collect()] == ["not found"]
        assert tables.dead_letters(spark).where(is_open()).count() == 0
        assert tables.state(spark).count() == source.count()
    again = replay_dead_letters(spark, tables, source.select(*S.RECORD_COLUMNS), wanted, 1)
    assert {r["reason"] for r in again.collect()} == {"not found", "status=replayed"}
    assert reconcile.verdict_counts(reconcile.by_key(source, tables.state(spark))).collect()[0][:] == ("ok", source.count())


def test_rejected_again_after_replay(spark, tables):
    at = utc("2024-01-01 00:00:00")
    row = spark.range(1).select(
        F.lit(7).cast("bigint").alias("id"), F.lit("e").alias("email"), F.lit("n").alias("name"), F.lit("{}").alias("payload"),
        F.lit(1).cast("bigint").alias("version"), F.lit(True).alias("poison"), at.alias("updated_at"), at.alias("created_at"),
    )
    send = lambda n: replication.commit_batch(row.withColumn("seq", F.lit(n).cast("bigint")), n, tables, S.INCREMENTAL)
    send(0)
    send(1)
    assert [r["id"] for r in tables.dead_letters(spark).collect()] == [1]
    replay_dead_letters(spark, tables, row.limit(0), spark.createDataFrame([(1,)], "id BIGINT"), 0)
    send(2)
    assert {r["id"]: r["status"] for r in tables.dead_letters(spark).collect()} == {1: "replayed", 5: "open"}
    # the same arrival number in the other mode is an entry of its own
    replay_dead_letters(spark, tables, row.limit(0), spark.createDataFrame([(5,)], "id BIGINT"), 1)
    replication.commit_batch(row.withColumn("seq", F.lit(0).cast("bigint")), 0, tables, S.BACKFILL)
    assert {r["id"]: r["status"] for r in tables.dead_letters(spark).collect()} == {1: "replayed", 5: "replayed", 0: "open"}


def test_consumer_redelivery_and_unreadable(spark, tables):
    body = lambda event, record, version: f'{{"event_id":"{event}","record_id":{record},"version":{version}}}'
    sent = [(1, body("1:1", 1, 1)), (2, body("1:2", 1, 2)), (3, "{broken"), (4, body("1:1", 1, 1)), (5, body("2:1", 2, 1))]
    for n, part in enumerate((sent[:3], sent[3:])):
        spark.createDataFrame(part, "seq BIGINT, value STRING").coalesce(1).write.mode("append").parquet(tables.path("messages"))
    messages = spark.readStream.schema("seq BIGINT, value STRING").option("maxFilesPerTrigger", 1).parquet(tables.path("messages"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    for run in (consumer.consume, consumer.consume_stateful):
        run(messages, tables).awaitTermination()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    expected = {("1:1", 1, 1, 1, 1), ("1:2", 1, 2, 0, 2), ("2:1", 2, 1, 0, 5)}
    assert {r[:] for r in consumer.consumed(spark, tables).collect()} == expected
    columns = ["event_id", "record_id", "version", "duplicate_hits", "first_seq"]
    assert {r[:] for r in consumer.running_counts(spark, tables).select(columns).collect()} == expected
    assert [r["value"] for r in tables.read(spark, "unreadable", "seq BIGINT, value STRING").collect()] == ["{broken"]


def test_first_deliveries_within_a_time(spark, split, tables):
    source = stream_table(spark, split, "events", files_per_batch=1)
    twice = source.withColumn("n", F.explode(F.array(F.lit(0), F.lit(1)))).select(
        F.col("event_id").cast("string").alias("event_id"), F.col("ts").cast("timestamp").alias("ts")
    )
    query = consumer.first_deliveries(twice, "ts", "10 days").writeStream.format("parquet").option(
        "checkpointLocation", tables.path("_checkpoints/first")
    ).trigger(availableNow=True).start(tables.path("first"))
    query.awaitTermination()
    assert spark.read.parquet(tables.path("first")).count() == 1000


def test_throughput_counts_rows_whatever_their_time(spark, tables):
    """Files out of time order, a day apart: every row is counted; only buckets expire."""
    at = lambda day, n: [(datetime(2024, 1, day, 12, 0, k), True, 500) for k in range(n)]
    for day, n in ((2, 3), (3, 4), (1, 5)):
        part = spark.createDataFrame(at(day, n), "attempted_at TIMESTAMP_NTZ, ok BOOLEAN, rows BIGINT")
        part.coalesce(1).write.mode("append").parquet(tables.path("attempts"))
    source = spark.readStream.schema(part.schema).option("maxFilesPerTrigger", 1).parquet(tables.path("attempts"))
    count_throughput(source, tables.path("t"), "1 hour").awaitTermination()
    got = {r["bucket"].day: r["rows"] for r in counted(spark, tables.path("t")).collect()}
    assert got == {2: 1500, 3: 2000, 1: 2500}
    recent = counted(spark, tables.path("t"), utc("2024-01-03 13:00:00"), "26 HOURS")
    assert {r["bucket"].day for r in recent.collect()} == {2, 3}


def test_throughput_keeps_few_folders_and_every_row(spark, tables):
    """Fifteen batches, folded every third: old buckets get wider, sums stay, folders do not pile up; a fold cut short is not used."""
    import os

    source, path, want = tables.path("many"), tables.path("folded"), 0
    for k in range(15):
        at = datetime(2024, 1, 1 + k % 5, 12, k, 3 * k)
        part = spark.createDataFrame([(at, True, 10 + k), (at.replace(second=59), True, 1)], "attempted_at TIMESTAMP_NTZ, ok BOOLEAN, rows BIGINT")
        part.coalesce(1).write.mode("append").parquet(source)
        want += 11 + k
    stream = spark.readStream.schema(part.schema).option("maxFilesPerTrigger", 1).parquet(source)
    coarser = (("1 HOUR", "minute"), ("3 DAYS", "day"))
    count_throughput(stream, path, fold_every=3, coarser=coarser).awaitTermination()
    assert len(os.listdir(f"{path}/counts")) <= 6 and len(os.listdir(f"{path}/folds")) <= 2
    got = {r["bucket"]: r["rows"] for r in counted(spark, path).collect()}
    assert sum(got.values()) == want
    assert got[datetime(2024, 1, 1)] == sum(11 + k for k in (0, 5, 10))  # a day
    assert got[datetime(2024, 1, 4, 12, 3)] == 14  # a minute
    assert got[datetime(2024, 1, 5, 12, 14, 42)] == 24  # a second
    os.remove(f"{path}/folds/batch_id=14/_SUCCESS")
    assert sum(r["rows"] for r in counted(spark, path).collect()) == want


def test_a_late_old_file_is_read(spark, tables):
    import os
    import time

    rows = read_table(spark, "/root/testdata/sf0.001", "events")
    for n in range(4):
        folder = tables.path("late/events.parquet")
        before = set(os.listdir(folder)) if n else set()
        rows.where(F.col("event_id") % 4 == n).coalesce(1).write.mode("append").parquet(folder)
        if n == 2:
            for name in set(os.listdir(folder)) - before:
                os.utime(f"{folder}/{name}", (time.time() - 30 * 86400,) * 2)
        if n in (1, 3):  # the third file is found with the fourth, and is a month old
            replicate(B.unordered(stream_table(spark, tables.path("late"), "events", 1)), tables, S.INCREMENTAL).awaitTermination()
    assert tables.feed(spark).count() == 1000


def test_status_of_a_replication_has_every_field(spark, split, clean):
    source = B.unordered(read_table(spark, split, "events")).drop("seq")
    found = clean.checkpoints(spark).unionByName(
        spark.createDataFrame([(S.BACKFILL, 0, None)], S.CHECKPOINTS)
    )
    row = status.status(
        source, clean.state(spark), found, clean.dead_letters(spark), clean.batch_log(spark), found, utc("2024-03-01")
    )
    facts = row.first().asDict()
    assert all(facts[name] is not None for name in reconcile.REQUIRED)
    assert facts["circuit_since"] is None and facts["last_read_incremental_id"] is not None
    assert facts["health"] == "green" and facts["records_processed"] == 1000 and facts["lag_count"] == 0
    assert status.status_lines(row).where("value IS NULL").count() == 0
    assert status.metric_rows(row).where("value IS NULL").count() == 0


def test_sync_of_a_changing_table_survives_a_kill(spark, tables, folder, monkeypatch):
    source = B.records(spark, folder).withColumn("id", F.col("id") - 100)  # ids of 0 and below too
    boot = datetime(2002, 1, 1)
    real, calls = replication.publish, []

    def dies_once(*args):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("killed")
        return real(*args)

    monkeypatch.setattr(replication, "publish", dies_once)
    with pytest.raises(RuntimeError):
        sync(source, tables, S.BACKFILL, boot, rows_per_batch=400)
    ordered = sorted(r["id"] for r in source.collect())
    assert tables.checkpoints(spark).first()["cursor_id"] == ordered[799]
    assert sync(source, tables, S.BACKFILL, boot, rows_per_batch=400) == 2
    assert sync(source, tables, S.BACKFILL, boot, rows_per_batch=400) == 0
    assert {r["verdict"] for r in reconcile.by_key(source.where("not poison"), tables.state(spark)).collect()} == {"ok"}
    assert tables.feed(spark).count() == source.count() == tables.batch_log(spark).where("ok").agg(F.sum("rows")).first()[0]

    assert sync(source, tables, S.INCREMENTAL, boot) == 0
    changed = synth.bump(source, utc("2003-01-01 00:00:00"), 30).drop("bumped")
    assert sync(changed, tables, S.INCREMENTAL, boot) == 1
    assert sync(changed, tables, S.INCREMENTAL, boot) == 0
    assert {r["verdict"] for r in reconcile.by_key(changed.where("not poison"), tables.state(spark)).collect()} == {"ok"}
    ids = tables.dead_letters(spark).select("id")
    assert ids.distinct().count() == ids.count()

    late = changed.withColumn("version", F.when(F.col("id") == 5, 99).otherwise(F.col("version")).cast("bigint"))
    late = late.withColumn("updated_at", F.when(F.col("id") == 5, utc("2002-12-31 23:00:00")).otherwise(F.col("updated_at")))
    assert sync(late, tables, S.INCREMENTAL, boot) == 0
    assert sync(late, tables, S.INCREMENTAL, boot, overlap="2 HOURS") == 1
    assert tables.state(spark).where("id = 5").first()["version"] == 99


def test_sync_then_a_stream_in_the_same_mode(spark, split, tables, folder):
    """Batch numbers are the log's: nobody writes over another one's, and a new checkpoint starts new ones."""
    source = B.records(spark, folder).withColumn("id", F.col("id") + 10**9)
    sync(source, tables, S.INCREMENTAL, datetime(1900, 1, 1), rows_per_batch=600)
    before = tables.state(spark).count()
    replicate(rows(spark, split), tables, S.INCREMENTAL).awaitTermination()
    both = before + upsert.upsert(None, B.unordered(read_table(spark, split, "events"))).count()
    assert tables.state(spark).count() == both and tables.feed(spark).count() == source.count() + 1000
    anew = ReplicationTables(tables.root)
    lost = rows(spark, split).writeStream.foreachBatch(
        lambda r, n: replication.commit_batch(r, n, anew, S.INCREMENTAL, owner="another checkpoint")
    )
    lost.option("checkpointLocation", tables.path("_checkpoints/other")).trigger(availableNow=True).start().awaitTermination()
    assert tables.state(spark).count() == both and tables.feed(spark).count() == source.count() + 2000
    ids = [r["id"] for r in tables.dead_letters(spark).collect()]
    assert len(ids) == len(set(ids))


def test_both_modes_at_the_same_time(spark, split, clean, tables):
    running = [replicate(rows(spark, split), tables, mode) for mode in (S.BACKFILL, S.INCREMENTAL)]
    for query in running:
        query.awaitTermination()
    assert everything(spark, tables)[0] == everything(spark, clean)[0]
    found = tables.dead_letters(spark)
    assert found.where(is_open()).count() == found.select("record_id", "version", "sink").distinct().count()
    assert found.count() == found.select("id").distinct().count()
    assert tables.feed(spark).count() == 2000


def test_a_source_that_grows_inside_a_page(spark, tables, folder, monkeypatch):
    """Rows that appear while a page is committed are left for the next call; numbers are used once."""
    stored = new_dir(spark, "growing")
    records = B.records(spark, folder)
    records.where("id % 2 = 0").coalesce(1).write.parquet(stored)
    real = replication.store_rows

    def grows(*args):
        records.where("id % 2 = 1").coalesce(1).write.mode("append").parquet(stored)
        monkeypatch.setattr(replication, "store_rows", real)
        return real(*args)

    monkeypatch.setattr(replication, "store_rows", grows)
    growing = lambda: spark.read.schema(records.schema).parquet(stored)
    sync(growing(), tables, S.BACKFILL, datetime(2000, 1, 1), rows_per_batch=200)
    feed = tables.feed(spark)
    even = records.where("id % 2 = 0").count()
    assert feed.count() == feed.select("seq").distinct().count() == even
    sync(growing(), tables, S.INCREMENTAL, datetime(1900, 1, 1), rows_per_batch=500)
    feed = tables.feed(spark)
    assert feed.select("seq").distinct().count() == feed.count() == records.count() + even


def test_sink_rejects_items_by_itself(spark, tables, folder):
    """3 of 500 rejected by the sink: 497 stored, 3 dead-lettered, and replayed through the same sink."""
    source = B.records(spark, folder).where("NOT poison").limit(500).withColumn("seq", F.col("id")).cache()
    bad = [r["id"] for r in source.orderBy("id").limit(3).collect()]
    sent = []

    def sink(documents, refuse=f"id IN ({bad[0]}, {bad[1]}, {bad[2]})"):
        sent.append(documents.count())
        answered = results(documents, refuse, "mapper_parsing_exception")
        return answered.where(f"id <> {bad[2]}")  # one is not answered at all

    replication.commit_batch(source, 0, tables, S.BACKFILL, store_to=sink)
    assert tables.documents(spark).count() == 497 and tables.feed(spark).count() == 500
    entries = tables.dead_letters(spark)
    assert {r["record_id"]: r["error"] for r in entries.collect()} == {
        bad[0]: "mapper_parsing_exception", bad[1]: "mapper_parsing_exception", bad[2]: S.MISSING_RESULT_ERROR
    }
    assert entries.where(has_replay_context()).count() == 3
    again = replay_dead_letters(spark, tables, source.select(*S.RECORD_COLUMNS), entries.select("id"), 0, store_to=sink)
    assert again.where("ok").count() == 0 and tables.dead_letters(spark).where(is_open()).count() == 3
    healed = lambda documents: sink(documents, "false").unionByName(results(documents.where(f"id = {bad[2]}")))
    published = []
    again = replay_dead_letters(
        spark, tables, source.select(*S.RECORD_COLUMNS), entries.select("id"), 1, store_to=healed, publish_to=lambda m: published.append(m.count())
    )
    assert again.where("ok").count() == 3 and published == [3] and sent == [500, 3, 3]
    assert tables.dead_letters(spark).where(is_open()).count() == 0 and tables.state(spark).count() == 500


def test_replay_keeps_the_rules(spark, tables, folder):
    rules = [("too long", F.length("email") > 0)]
    source = B.records(spark, folder).limit(4).withColumn("seq", F.col("id")).cache()
    replication.commit_batch(source, 0, tables, S.BACKFILL, rules)
    said = replay_dead_letters(spark, tables, source.select(*S.RECORD_COLUMNS), tables.dead_letters(spark).select("id"), 0, rules)
    assert {(r["ok"], r["reason"]) for r in said.collect()} == {(False, "too long")} and tables.state(spark).count() == 0


def test_failed_attempts_hold_the_cursor_in_the_log(spark, split, tables):
    """Outages and their gate from a log that replication wrote itself."""
    calls = []

    def sink(documents):
        calls.append(1)
        if 2 <= len(calls) <= 4:
            raise ConnectionError("x" * 5000)

    for _ in range(4):
        try:
            replicate(rows(spark, split), tables, S.INCREMENTAL, store_to=sink).awaitTermination()
        except StreamingQueryException:
            pass
    log = tables.batch_log(spark)
    outage = batches.outages(log).first()
    assert (outage["failed_attempts"], outage["cursor_delta"]) == (3, 0) and outage["recovered_at"] is not None
    assert log.where("NOT ok").agg(F.min(F.length("error"))).first()[0] > 5000
    assert log.where("NOT ok").select("since").distinct().count() == 1
    assert [r["attempt"] for r in log.orderBy("attempt").collect()] == list(range(6))


def test_batches_read_no_more_files_after_compaction(spark, tables, folder):
    small = ReplicationTables(tables.root, generation=4)
    source = B.records(spark, folder).where("id < 400").withColumn("seq", F.col("id"))

    def looked_at():
        frames = [small.dead_letters(spark, only_open=True), small.batch_log(spark), small.state(spark)]
        return sum(len(f.inputFiles()) for f in frames)

    counts = []
    for n in range(24):
        part = source.where(F.col("id") % 24 == n).withColumn("poison", F.col("id") % 5 == 0)
        replication.commit_batch(part.coalesce(1), n, small, S.INCREMENTAL)
        if n % 8 == 7:
            small.compact(spark)
            counts.append(looked_at())
    assert max(counts) <= counts[0] + 2
    assert small.feed(spark).count() == source.count()
    assert small.state(spark).count() + small.dead_letters(spark).count() == source.count()
    assert [r["b"] for r in small.batch_log(spark).select(F.max("batch_id").alias("b")).collect()] == [23]


def test_consumer_counts_are_folded(spark, split, clean, tables):
    replicate(rows(spark, split), tables, S.INCREMENTAL).awaitTermination()
    consumer.consume(consumer.feed_stream(spark, tables, 1), tables, compact_every=2).awaitTermination()
    folded = tables.read(spark, "consumed_upto", "event_id STRING, batch_id BIGINT")
    assert folded.count() > 0
    seen = consumer.consumed(spark, tables)
    assert seen.agg(F.sum(F.col("duplicate_hits") + 1)).first()[0] == 1000
    assert seen.count() == tables.feed(spark).select("event_id").distinct().count()


def test_sync_reads_its_source_a_fixed_number_of_times(spark, tables, folder):
    """However many pages: the scan for the sort's ranges, and the scan that is sorted."""
    reads = spark.sparkContext.accumulator(0)
    records = B.records(spark, folder)

    def count(rows):
        reads.add(1)
        yield from rows

    def counted_rows():
        return records.coalesce(1).mapInArrow(count, records.schema)

    times = []
    for pages in (1, 6):
        before = reads.value
        into = ReplicationTables(new_dir(spark, "pages"))
        assert sync(counted_rows(), into, S.BACKFILL, datetime(2000, 1, 1), rows_per_batch=1500 // pages) == pages
        times.append(reads.value - before)
    assert times[0] == times[1] <= 2


@pytest.mark.parametrize("step, dies_at", [("store_rows", 1), ("store_dead_letters", 1), ("publish", 3), ("_log_attempt", 4)])
def test_pages_committed_together_survive_a_kill(spark, folder, monkeypatch, step, dies_at):
    """Five pages in one job: whatever it dies after, the next call leaves what single pages leave."""
    source = B.records(spark, folder)
    one_by_one, tables = (ReplicationTables(new_dir(spark, "pages")) for _ in range(2))
    sync(source, one_by_one, S.BACKFILL, datetime(2000, 1, 1), rows_per_batch=300, pages_per_commit=1)
    real, calls = getattr(replication, step), []

    def dies_once(*args, **kwargs):
        calls.append(1)
        if step == "_log_attempt" and len(calls) == dies_at:
            raise RuntimeError("killed")
        written = real(*args, **kwargs)
        if len(calls) == dies_at:
            raise RuntimeError("killed")
        return written

    monkeypatch.setattr(replication, step, dies_once)
    with pytest.raises(RuntimeError):
        sync(source, tables, S.BACKFILL, datetime(2000, 1, 1), rows_per_batch=300)
    done = {"store_rows": 0, "store_dead_letters": 0, "publish": 2, "_log_attempt": 3}[step]
    ids = sorted(r["id"] for r in source.select("id").collect())
    assert tables.feed(spark).count() == 300 * done
    assert [r["cursor_id"] for r in tables.checkpoints(spark).collect()] == [ids[300 * done - 1]] * bool(done)
    assert sync(source, tables, S.BACKFILL, datetime(2000, 1, 1), rows_per_batch=300) == 5 - done
    assert everything(spark, tables) == everything(spark, one_by_one)
    log = lambda t: sorted(t.batch_log(spark).where("ok").select("batch_id", "rows", "rejected", "cursor_id", "read_id", "last_seq", "number").collect())
    assert log(tables) == log(one_by_one)


def test_a_smaller_redo_leaves_nothing_of_the_first_try(spark, tables, folder, monkeypatch):
    """Rows and dead letters that a page wrote before it failed are gone when the source has changed by the redo."""
    source = B.records(spark, folder)
    monkeypatch.setattr(replication, "publish", lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        sync(source, tables, S.BACKFILL, datetime(2000, 1, 1), rows_per_batch=500)
    monkeypatch.undo()
    later = source.where("not poison and id % 2 = 0")
    assert sync(later, tables, S.BACKFILL, datetime(2000, 1, 1), rows_per_batch=500) == 2
    assert tables.dead_letters(spark).count() == 0
    assert tables.feed(spark).count() == later.count() == tables.state(spark).count()


def _written_events(spark, rows):
    """Events of a few users as one file."""
    folder, n = new_dir(spark, "given"), F.col("id")
    at = F.timestamp_seconds(F.lit(1_700_000_000) + n).cast("timestamp_ntz")
    spark.range(rows).select(
        n.alias("event_id"), at.alias("ts"), (n % 7).alias("user_id"),
        F.when(n % 5 == 0, "error").otherwise("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit('{"k": 1}').alias("props"),
    ).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


def test_a_batch_of_events_is_many_files(spark, monkeypatch):
    made = {}
    monkeypatch.setattr(catalog, "new_dir", lambda spark, name: made.setdefault(name, new_dir(spark, name)))
    monkeypatch.setattr(catalog, "FILE_ROWS", 50, raising=False)
    stored = catalog._replicated(spark, _written_events(spark, 1000))
    files = spark.read.parquet(f"{made['events']}/events.parquet").groupBy(F.input_file_name()).count()
    assert files.agg(F.sum("count"), F.max("count") < 100).first()[:] == (1000, True)
    in_batch = stored.feed(spark).groupBy("batch_id").agg(F.min("seq"), F.max("seq"), F.count("seq"))
    assert sorted(r[:] for r in in_batch.collect()) == [(n, 250 * n, 250 * n + 249, 250) for n in range(4)]


def test_a_message_is_parsed_once(spark, tables):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def body(n):
        made.add(1)
        return "{broken" if n % 10 == 0 else f'{{"event_id":"{n % 7}:1","record_id":{n % 7},"version":1}}'

    messages = spark.range(100).select(F.col("id").alias("seq"), body("id").alias("value"))
    consumer._consume_batch(messages, 0, tables, None)
    counts = consumer.consumed(spark, tables).agg(F.count("event_id"), F.sum("duplicate_hits")).first()
    assert counts[:] == (7, 83) and made.value == 100
    unreadable = tables.read(spark, "unreadable", "seq BIGINT, value STRING").collect()
    assert sorted(r[:] for r in unreadable) == [(n, "{broken") for n in range(0, 100, 10)]
