"""Cursors, dead letters, search, synthesis and reports on small hand-made inputs."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.functions.times import utc
import synth
from tidemark.operators import consume, cursor, dead_letters, feed, search
from tidemark.operators.validate import with_error
from tidemark.plans import batches, reconcile, status
from tidemark.session import new_dir
from tidemark.sources import bindings as B
from tidemark.sources.tables import id_ranges

def now():
    return utc("2024-06-01 12:00:00")


def people(spark, rows):
    """(id, email, name) as records."""
    at = utc("2024-01-01 00:00:00")
    return spark.createDataFrame(rows, "id BIGINT, email STRING, name STRING").select(
        "*", F.lit("{}").alias("payload"), F.lit(1).cast("bigint").alias("version"), F.lit(False).alias("poison"),
        at.alias("updated_at"), at.alias("created_at"),
    )


# --- cursors


def test_paging_by_key_reads_everything_once(spark, folder):
    records = B.records(spark, folder).cache()
    at, last, seen = "1900-01-01 00:00:00", -1, []
    while True:
        page = cursor.incremental_page(records, at, last, 400).collect()
        if not page:
            break
        seen += [r["id"] for r in page]
        at, last = page[-1]["updated_at"], page[-1]["id"]
    assert sorted(seen) == sorted(r["id"] for r in records.select("id").collect())
    assert len(seen) == len(set(seen))


def test_late_commit_is_read_again_with_overlap(spark):
    times = ["2024-01-01 00:10:00.000001", "2024-01-01 00:04:00", "2024-01-01 00:09:30"]
    rows = people(spark, [(i, "e", "n") for i in range(3)]).drop("updated_at")
    at = F.element_at(F.array(*[F.lit(t) for t in times]), F.col("id").cast("int") + 1)
    rows = rows.withColumn("updated_at", at.cast("timestamp_ntz"))
    after = lambda **kw: {r["id"] for r in cursor.incremental_page(rows, times[0], 0, **kw).collect()}
    assert after() == set()
    assert after(overlap="1 MINUTE") == {0, 2}
    assert after(overlap="10 MINUTES") == {0, 1, 2}


def test_boot_watermark_only_for_a_cursor_never_used(spark):
    begun = spark.createDataFrame([(S.INCREMENTAL, 0, None), (S.BACKFILL, 0, None)], S.CHECKPOINTS)
    moved = spark.createDataFrame([(S.INCREMENTAL, 5, datetime(2020, 1, 1))], S.CHECKPOINTS)
    got = {r["mode"]: r["cursor_ts"] for r in cursor.with_boot_watermark(begun, now()).collect()}
    assert got == {S.INCREMENTAL: datetime(2024, 6, 1, 12), S.BACKFILL: None}
    assert cursor.with_boot_watermark(moved, now()).first()["cursor_ts"] == datetime(2020, 1, 1)


def test_rows_after_a_missing_or_null_cursor(spark, folder):
    records = B.records(spark, folder)
    none = spark.createDataFrame([], S.CHECKPOINTS)
    null = spark.createDataFrame([(S.INCREMENTAL, 0, None)], S.CHECKPOINTS)
    for checkpoints in (none, null):
        assert cursor.rows_after_checkpoint(records, checkpoints, S.INCREMENTAL).count() == records.count()


def test_empty_batch_leaves_the_cursor(spark, folder):
    checkpoints = B.checkpoints(spark)
    none = B.records(spark, folder).limit(0)
    for mode in (S.BACKFILL, S.INCREMENTAL):
        saved = cursor.save_checkpoint(checkpoints, cursor.batch_cursor(none, mode), mode)
        assert sorted(saved.collect(), key=str) == sorted(checkpoints.collect(), key=str)


# --- dead letters


def letters(spark, rows):
    """(id, record_id, version, status, payload)"""
    df = spark.createDataFrame(rows, "id BIGINT, record_id BIGINT, version BIGINT, status STRING, payload STRING")
    return df.select(
        "id", "record_id", "version", F.lit("b").alias("batch_id"), F.lit(S.DEFAULT_SINK).alias("sink"), "payload",
        F.lit("err").alias("error"), "status", now().alias("created_at"), F.lit(None).cast("timestamp_ntz").alias("replayed_at"),
    )


def test_one_open_entry_per_key(spark):
    new = letters(spark, [(10, 1, 1, "open", "{}"), (9, 1, 1, "open", "{}"), (11, 1, 2, "open", "{}"), (12, 2, 1, "open", "{}")])
    there = letters(spark, [(1, 1, 2, "open", "{}"), (2, 2, 1, "replayed", "{}")])
    assert {r["id"] for r in dead_letters.to_append(new, there).collect()} == {9, 12}


def test_replay_context(spark):
    payloads = ['{"email":null}', '{"email":"a"}', '{"name":"email"}', "not json", None, '["email"]']
    rows = letters(spark, [(n, 1, n, "open", p) for n, p in enumerate(payloads)] + [(9, 1, 9, "replayed", '{"email":1}')])
    assert {r["id"] for r in rows.where(dead_letters.has_replay_context()).collect()} == {0, 1}
    no_error = rows.withColumn("error", F.lit(""))
    assert no_error.where(dead_letters.has_replay_context()).count() == 0


def test_replay_takes_the_source_row_or_what_was_stored(spark):
    stored = '{"id":8,"email":"old@x","payload":{"a":[1]},"updated_at":"2024-01-02T03:04:05.678Z"}'
    there = letters(spark, [(1, 7, 1, "open", "{}"), (2, 8, 3, "open", stored), (3, 7, 2, "discarded", "{}"), (4, 9, 1, "open", "?")])
    source = people(spark, [(7, "new@x", "n")]).withColumn("version", F.lit(5).cast("bigint"))
    source = source.withColumn("poison", F.lit(True))
    asked = spark.createDataFrame([(1,), (1,), (2,), (3,), (4,), (99,)], "id BIGINT")
    got = {r["dlq_id"]: r for r in dead_letters.replay(asked, there, source, now()).collect()}
    assert {k: (r["ok"], r["reason"]) for k, r in got.items()} == {
        1: (True, None), 2: (True, None), 3: (False, "status=discarded"), 4: (True, None), 99: (False, "not found"),
    }
    assert (got[1]["version"], got[1]["email"], got[1]["poison"]) == (5, "new@x", False)
    assert (got[2]["id"], got[2]["version"], got[2]["email"], got[2]["name"], got[2]["payload"]) == (8, 3, "old@x", "", '{"a":[1]}')
    assert got[2]["updated_at"] == datetime(2024, 1, 2, 3, 4, 5, 678000) and got[2]["created_at"] == datetime(2024, 6, 1, 12)
    assert (got[4]["id"], got[4]["payload"]) == (9, "{}")


def test_replay_checks_the_row_again(spark):
    there = letters(spark, [(1, 7, 1, "open", "{}")])
    got = dead_letters.replay(there.select("id"), there, people(spark, [(7, "", "n")]), now(), [("no email", F.col("email") == "")])
    assert [(r["ok"], r["reason"], r["id"]) for r in got.collect()] == [(False, "no email", None)]


def test_requests_without_a_record_are_not_one_task(spark):
    there = letters(spark, [(1, 7, 1, "open", "{}"), (5, None, 1, "open", "{}")])
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        got = dead_letters.replay(spark.range(800), there, people(spark, [(7, "a@x", "n"), (5, "b@x", "n"), (9, "c@x", "n")]), now())
        placed = got.select("dlq_id", "reason", "email", F.spark_partition_id().alias("part")).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    tasks = [r["part"] for r in placed]
    assert len(placed) == 800 and max(tasks.count(t) for t in set(tasks)) < 200
    assert {r["dlq_id"]: r["email"] for r in placed if r["reason"] is None} == {1: "a@x", 5: ""}
    assert sum(r["reason"] == "not found" for r in placed) == 798


# --- feed


def test_event_text_is_the_same_on_a_redo_and_nests_the_payload(spark):
    rows = people(spark, [(1, "e", "n")])
    payloads = {'{"b": 2, "a": [1, null]}': {"a": [1, None], "b": 2}, "plain": "plain"}
    import json

    for text, expected in {**payloads, None: {}}.items():
        sent = feed.feed_messages(rows.withColumn("payload", F.lit(text).cast("string")), now())
        key, value = sent.first()
        assert (key, sent.first()[1]) == ("record.1", value)
        body = json.loads(value)
        assert body["document"]["payload"] == expected
        assert (body["event_id"], body["emitted_at"]) == ("1:1", "2024-06-01T12:00:00.000Z")


def test_recent_changes_show_no_more_than_are_kept(spark):
    rows = people(spark, [(i, "e", "n") for i in range(600)]).withColumn("seq", F.col("id")).withColumn("batch_id", F.col("id") % 3)
    shown = feed.recent_changes(feed.changes(rows, F.lit(S.BACKFILL)), 1000).collect()
    assert len(shown) == S.RECENT_KEPT
    assert [r["record_id"] for r in shown[:2]] == [599, 596]


# --- consumer


def test_merging_parts_in_any_order(spark):
    r = random.Random(8)
    sent = [(f"{k}:1", k, 1, n) for n, k in enumerate(r.choices([0] * 10 + list(range(20)), k=300))]
    df = spark.createDataFrame(sent, "event_id STRING, record_id BIGINT, version BIGINT, seq BIGINT")
    whole = sorted(consume.consumed_events(df).collect())
    parts = [consume.consumed_events(df.where(F.col("seq") % 4 == n)) for n in range(4)]
    assert sorted(consume.merge_consumed(*parts).collect()) == whole
    assert sorted(consume.merge_consumed(consume.merge_consumed(parts[3], parts[1]), parts[2], parts[0]).collect()) == whole


# --- search

WORD = re.compile(r"[\u4e00-\u9fff\u3040-\u309f]|(?:(?![\u4e00-\u9fff\u3040-\u309f])[\w\u0300-\u036f])+", re.UNICODE)


def found(rows, query, limit=50):
    q = query.strip(" \t\n\r\u00a0\ufeff")
    words = set(WORD.findall(q.lower()))
    hit = lambda i, e, n: (
        True if not q else i == int(q) if re.fullmatch("[0-9]+", q) else bool(words & set(WORD.findall(n.lower()))) or q in (e, n)
    )
    return sorted((i for i, e, n in rows if hit(i, e, n)), reverse=True)[:limit]


QUERIES = ["", "  ", "12", " 0012 ", "hot", "HOT cold7", "cold3 cold4", "a@x.com", "---", "--", "nothing", "99999999999999999999", "Été_1"]
QUERIES += ["\t", "\t42", "\u00a012\n", "東京", "京", "e\u0301te", "e", "\ufeffhot"]


@pytest.fixture(scope="module")
def texts():
    r = random.Random(9)
    rows = []
    for i in range(400):
        words = [f"Cold{r.randrange(60)}"] + (["hot"] if r.random() < 0.4 else []) + (["été_1"] if i % 50 == 0 else [])
        words += ["東京都は日本の首都"] if i % 70 == 0 else []
        words += ["e\u0301te\u0301", "e\u0301te"] if i % 75 == 0 else []
        rows.append((i, r.choice(["a@x.com", "b@x.com"]), "---" if i % 90 == 0 else " ".join(words)))
    return rows


def test_search_equals_a_scan(spark, texts):
    df = people(spark, texts)
    for q in QUERIES:
        assert [r["id"] for r in search.search(df, q, 20).collect()] == found(texts, q, 20), q


def test_search_by_words_equals_a_scan(spark, texts):
    df, path = people(spark, texts), new_dir(spark, "words")
    search.write_words(df, path)
    words = search.read_words(spark, path)
    for q in QUERIES:
        assert [r["id"] for r in search.search_words(df, words, q, 20).collect()] == found(texts, q, 20), q
    plan = words.where(F.col("word").isin("hot", "cold7"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(word" in plan


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_many_searches_equal_single_ones(spark, texts, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        many_searches(spark, texts)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError):
        search.search_many(people(spark, texts), spark.createDataFrame([(1, "x")], "query_id BIGINT, query STRING"), 5000)


def many_searches(spark, texts):
    queries = spark.createDataFrame(list(enumerate(QUERIES)), "query_id BIGINT, query STRING")
    got = search.search_many(people(spark, texts), queries, 20).collect()
    for n, q in enumerate(QUERIES):
        ranked = sorted((r["rank"], r["id"]) for r in got if r["query_id"] == n)
        assert ranked == list(enumerate(found(texts, q, 20), 1)), q


def test_like_takes_a_backslash(spark):
    df = people(spark, [(1, "ab", "n"), (2, "a\\b", "n"), (3, "a%b", "n"), (4, "aXb", "n"), (5, "x", "A_B"), (6, "a\\%b", "n")])
    hits = lambda q: sorted(r["id"] for r in search.search_like(df, q).collect())
    assert hits("a\\b") == [1] and hits("a\\\\b") == [2] and hits("a\\%b") == [3] and hits("a_b") == [2, 3, 4, 5]
    assert hits("a\\_b") == [5] and hits("\\ab") == [1] and hits("a\\\\\\%b") == [6]


def test_no_rules_reject_nothing(spark, folder):
    rows = B.records(spark, folder)
    assert with_error(rows, []).where("error IS NOT NULL").count() == 0 < with_error(rows).where("error IS NOT NULL").count()


def test_messages_need_all_three_fields(spark):
    bodies = ['{"event_id":"1:1","record_id":1,"version":1}', '{"event_id":"1:1","version":1}', '{"event_id":"1:1","record_id":1}', '{"record_id":1,"version":1}']
    events, rest = feed.parse_messages(spark.createDataFrame([(b,) for b in bodies], "value STRING"))
    assert events.count() == 1 and sorted(r["value"] for r in rest.collect()) == sorted(bodies[1:])


def test_overlap_pages_go_on_and_never_move_the_cursor_back(spark, folder):
    records = B.records(spark, folder)
    at, last = datetime(1996, 9, 17), 0
    page, seen, cursors = cursor.incremental_page(records, at, last, 50, overlap="100 DAYS").collect(), [], [(at, last)]
    while page:
        seen += [r["id"] for r in page]
        end = page[-1]["updated_at"], page[-1]["id"]
        cursors.append(cursor.later_cursor(end, cursors[-1]))
        page = cursor.incremental_page(records, *end, 400).collect()
    since = records.where(F.col("updated_at") >= utc(at) - F.expr("INTERVAL 100 DAYS"))
    assert len(seen) == len(set(seen)) == since.count()
    assert cursors == sorted(cursors) and cursors[0] == cursors[1]


# --- changed sources


def test_top_up_fills_once(spark, folder):
    records = B.records(spark, folder)
    full = synth.top_up(records, 1700, now())
    assert full.count() == 1700 and full.select("id").distinct().count() == 1700
    assert synth.top_up(full, 1700, now()).count() == 1700
    assert synth.top_up(full, 10, now()).count() == 1700
    empty = synth.top_up(records.limit(0), 3, now()).orderBy("id").collect()
    assert [(r["id"], r["email"], r["payload"]) for r in empty[:2]] == [
        (1, "user1@example.com", '{"seq":1,"tier":1}'), (2, "user2@example.com", '{"seq":2,"tier":2}'),
    ]


def test_bump_is_the_same_sample_each_time(spark, folder):
    records = B.records(spark, folder)
    a, b, c = (synth.bump(records, now(), 25, seed).where("bumped") for seed in (1, 1, 2))
    assert a.count() == 25
    assert sorted(a.collect()) == sorted(b.collect()) != sorted(c.collect())


# --- reports


def log(spark, rows, start=datetime(2024, 1, 1)):
    """(mode, attempt, seconds, ok) as a batch log."""
    full = [
        (m, a, a, start + timedelta(seconds=s), ok is True, 500 if ok is True else 0, 0, 500 * a, None, 500 * a + 500, start, a, "", a,
         start + timedelta(seconds=s) if ok is False else None, None if ok is True else "feed: x" if ok is None else "sink: x")
        for m, a, s, ok in rows
    ]
    return spark.createDataFrame(full, S.BATCH_LOG)


def health(spark, folder, rows):
    source, found = B.records(spark, folder).limit(5), B.checkpoints(spark)
    none = spark.createDataFrame([], S.DEAD_LETTERS)
    return status.status(source, source, found, none, log(spark, rows), found, now(), incremental_running=True).first()


def test_health_is_the_last_attempt_in_time(spark, folder):
    """A sink that is down for one mode is down, however far the other one got; a feed that fails is not the sink."""
    down = health(spark, folder, [(S.BACKFILL, 9, 0, True), (S.INCREMENTAL, 1, 5, False), (S.INCREMENTAL, 2, 9, False)])
    assert (down["health"], down["circuit_reason"], down["circuit_since"]) == ("red", "sink: x", datetime(2024, 1, 1, 0, 0, 9))
    assert (down["last_read_id"], down["last_read_incremental_id"], down["incremental_running"]) == (5000, 1500, True)
    for rows in ([(S.INCREMENTAL, 2, 5, False), (S.BACKFILL, 1, 9, True)], [(S.BACKFILL, 1, 1, True), (S.BACKFILL, 2, 2, None)]):
        up = health(spark, folder, rows)
        assert (up["health"], up["circuit_reason"], up["circuit_since"]) == ("green", "", None)


def test_outages_of_two_modes(spark):
    rows = [(S.BACKFILL, 1, 0, True), (S.BACKFILL, 2, 1, False), (S.BACKFILL, 3, 3, False), (S.BACKFILL, 4, 60, True),
            (S.BACKFILL, 5, 61, False), (S.INCREMENTAL, 1, 0, False), (S.INCREMENTAL, 2, 9, False)]
    got = sorted((r["mode"], r["failed_attempts"], r["down_seconds"], r["recovery_seconds"]) for r in batches.outages(log(spark, rows)).collect() if r["failed_attempts"] > 1)
    assert got == [(S.BACKFILL, 2, 2.0, 57.0), (S.INCREMENTAL, 2, 9.0, None)]
    assert batches.outages(log(spark, rows)).count() == 3


def test_current_rate_falls_back_to_the_second_before(spark):
    rows = log(spark, [(S.BACKFILL, 1, 10, True), (S.BACKFILL, 2, 11, False)])
    at = lambda s: batches.current_rate(rows, utc(f"2024-01-01 00:00:{s}")).first()[0]
    assert [at("10.9"), at("11.5"), at("12.0")] == [500, 500, 0]


def test_lag_without_a_cursor_and_without_rows(spark, folder):
    records = B.records(spark, folder)
    none = spark.createDataFrame([(S.INCREMENTAL, 0, None)], S.CHECKPOINTS)
    assert status.lag(records, none, now()).first()[:] == (0, 0.0)
    ahead = spark.createDataFrame([(S.INCREMENTAL, 0, datetime(2100, 1, 1))], S.CHECKPOINTS)
    assert status.lag(records, ahead, now()).first()[:] == (0, 0.0)


def test_empty_source_has_zero_percent(spark, folder):
    got = status.progress(B.records(spark, folder).limit(0), B.checkpoints(spark)).first()
    assert (got["max_id"], got["backfill_percent"]) == (0, 0.0)


def test_reconcile_verdicts(spark):
    source = people(spark, [(i, "e", "n") for i in range(1, 7)]).withColumn("version", F.lit(2).cast("bigint"))
    version = F.when(F.col("id") == 2, 1).when(F.col("id") == 3, 3).otherwise(2).cast("bigint")
    sink = source.where("id <> 1").withColumn("version", version)
    sink = sink.withColumn("id", F.when(F.col("id") == 6, 60).otherwise(F.col("id")))
    sink = sink.withColumn("name", F.when(F.col("id") == 4, "other").otherwise(F.col("name"))).withColumn("poison", F.lit(True))
    got = {r["id"]: r["verdict"] for r in reconcile.by_key(source, sink).collect()}
    assert got == {1: "lost", 2: "stale", 3: "ahead", 4: "differs", 5: "ok", 6: "lost", 60: "extra"}


def test_gates_pass_for_a_sink_that_has_everything(spark, folder):
    source = B.records(spark, folder)
    rows = with_error(source.withColumn("seq", F.col("id")))
    seen = consume.consumed_events(
        rows.select(F.concat_ws(":", "id", "version").alias("event_id"), F.col("id").alias("record_id"), "version", "seq")
    )
    one = lambda **kw: spark.createDataFrame([tuple(kw.values())], list(kw))
    partial = one(expected=500, flagged=3, stored=497, dead_lettered=3, with_context=3)
    args = dict(
        resume=one(checkpoint_id=40, resumed_id=40, read_id=1040), outage=one(sleeps=9, cursor_delta=0, recovery_seconds=23.0),
        partial=partial, status=one(**{name: 1 for name in reconcile.REQUIRED}),
    )
    good = reconcile.gate_report(reconcile.lost_and_duplicated(source, source, seen), **args)
    assert [r["passed"] for r in good.orderBy("gate").collect()] == [True] * 5
    short = reconcile.gate_report(reconcile.lost_and_duplicated(source, source.where("id <> 3"), seen), **args)
    assert [r["passed"] for r in short.orderBy("gate").collect()] == [False, False, False, True, True]
    for resume in (one(checkpoint_id=40, resumed_id=41, read_id=41), one(checkpoint_id=40, resumed_id=40, read_id=1041)):
        told = reconcile.gate_report(reconcile.lost_and_duplicated(source, source, seen), **{**args, "resume": resume})
        assert [r["passed"] for r in told.orderBy("gate").collect()] == [False, True, True, True, True]


def test_reconcile_sees_where_a_null_is(spark):
    one = people(spark, [(1, "x", None), (2, "e", "n")])
    other = people(spark, [(1, None, "x"), (2, "e", "n")])
    spaced = other.withColumn("payload", F.lit('{"a": 1,  "b": 2}')), other.withColumn("payload", F.lit('{"b":2,"a":1}'))
    assert {r["id"]: r["verdict"] for r in reconcile.by_key(one, other).collect()} == {1: "differs", 2: "ok"}
    assert {r["verdict"] for r in reconcile.by_key(*spaced).collect()} == {"ok"}


# --- sources


def test_id_ranges_cover_every_id_once(spark):
    ids = list(range(-20, 60)) + [None, 10**15, -(10**15)]
    df = spark.createDataFrame([(i,) for i in ids], "id BIGINT")
    for low, high, parts in [(0, 40, 7), (0, 0, 5), (3, 5, 10), (-20, 59, 1)]:
        predicates = id_ranges(low, high, parts)
        counts = df.agg(*[F.count_if(F.expr(p)).alias(f"p{n}") for n, p in enumerate(predicates)]).first()
        assert sum(counts) == len(ids), (low, high, parts)


def test_shared_folder_is_the_one_the_cluster_names():
    from types import SimpleNamespace

    from tidemark.session import shared_dir

    session = lambda folder, master: SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: folder if name == "spark.checkpoint.dir" else default),
        sparkContext=SimpleNamespace(master=master, applicationId="app"),
    )
    assert shared_dir(session("hdfs://nn/shared", "yarn")) == "hdfs://nn/shared"
    with pytest.raises(ValueError):
        shared_dir(session(None, "yarn"))
    assert shared_dir(session(None, "local[8]")) == shared_dir(session(None, "local[8]"))
