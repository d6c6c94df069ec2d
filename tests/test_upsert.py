"""Upsert state and outcomes against a loop over the rows."""

import random

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.operators.upsert import completeness, match_results, outcomes, upsert
from tidemark.sources import bindings as B

ROW = "id BIGINT, email STRING, name STRING, payload STRING, version BIGINT, poison BOOLEAN, seq BIGINT"


def frame(spark, log):
    """Rows of (id, version, poison, seq); the email says which row it was."""
    rows = [(i, f"row{s}", "n", "{}", v, p, s) for i, v, p, s in log]
    at = F.lit("2024-01-01").cast("timestamp_ntz")
    return spark.createDataFrame(rows, ROW).withColumns({"updated_at": at, "created_at": at})


def loop(log, stored=()):
    """What a store that takes one row at a time ends in, and says to each."""
    state = {i: (v, None) for i, v in stored}
    said = {}
    for i, version, poison, seq in sorted(log, key=lambda x: x[3]):
        if poison:
            said[seq] = "rejected"
        elif i not in state:
            said[seq], state[i] = "created", (version, seq)
        elif version >= state[i][0]:
            said[seq], state[i] = "updated", (version, seq)
        else:
            said[seq] = "version_conflict"
    return state, said


logs = st.lists(
    st.tuples(st.integers(0, 8), st.integers(-3, 6), st.booleans()), min_size=1, max_size=120
).map(lambda rows: [(i, v, p, n) for n, (i, v, p) in enumerate(rows)])


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(log=logs)
def test_state_and_outcomes_equal_the_loop(spark, log):
    df = frame(spark, log)
    state, said = loop(log)
    got = {r["id"]: (r["version"], r["seq"]) for r in upsert(None, df).collect()}
    assert got == state
    assert {r["seq"]: r["outcome"] for r in outcomes(df).collect()} == said


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(log=logs, stored=st.dictionaries(st.integers(0, 10), st.integers(-2, 5), max_size=8))
def test_onto_a_stored_state(spark, log, stored):
    df = frame(spark, log)
    before = frame(spark, [(i, v, False, -1) for i, v in stored.items()])
    state, said = loop(log, stored.items())
    got = {r["id"]: r["version"] for r in upsert(before, df).collect()}
    assert got == {i: v for i, (v, _) in state.items()}
    assert {r["seq"]: r["outcome"] for r in outcomes(df, before).collect()} == said


def _random_log(seed, rows=3000):
    r = random.Random(seed)
    return [(0 if r.random() < 1 / 3 else r.randrange(1, 300), r.randrange(9), r.random() < 0.1, n) for n in range(rows)]


def test_a_key_with_a_third_of_the_rows(spark):
    log = _random_log(5)
    state, said = loop(log)
    df = frame(spark, log)
    assert {r["id"]: (r["version"], r["seq"]) for r in upsert(None, df).collect()} == state
    assert {r["seq"]: r["outcome"] for r in outcomes(df).collect()} == said


def test_applying_a_batch_twice_is_applying_it_once(spark):
    df = frame(spark, _random_log(6, 500))
    once = upsert(None, df)
    twice = upsert(once.select(*S.RECORD_COLUMNS), df)
    assert sorted(once.drop("seq").collect()) == sorted(twice.drop("seq").collect())


def test_arrival_order_does_not_matter_for_distinct_versions(spark):
    r = random.Random(7)
    versions = [(i, v) for i in range(20) for v in r.sample(range(50), 8)]
    states = []
    for _ in range(3):
        r.shuffle(versions)
        log = [(i, v, False, n) for n, (i, v) in enumerate(versions)]
        states.append({x["id"]: x["version"] for x in upsert(None, frame(spark, log)).collect()})
    assert states[0] == states[1] == states[2]


def test_user_rules_replace_the_default(spark):
    df = frame(spark, [(1, 1, True, 0), (2, 9, False, 1)])
    got = outcomes(df, rules=[("too new", F.col("version") > 5), ("poison", F.col("poison"))])
    assert {r["seq"]: r["error"] for r in got.collect()} == {0: "poison", 1: "too new"}


def test_a_rule_that_is_null_does_not_reject(spark):
    df = frame(spark, [(1, 1, None, 0)])
    assert [r["outcome"] for r in outcomes(df).collect()] == ["created"]


def test_rows_the_sink_did_not_answer_for(spark, folder):
    rows = B.changes_unordered(spark, folder).withColumn("batch_id", F.lit(1))
    results = outcomes(rows).where("seq > 10")
    missing = match_results(rows, results).where(F.col("error") == S.MISSING_RESULT_ERROR)
    assert missing.count() == 11
    said = completeness(rows, results.withColumn("batch_id", F.lit(1))).first()
    assert (said["submitted"], said["complete"]) == (1000, False)
