"""Running values and positions against plain Python, with ranges small enough to be crossed."""

import random

from pyspark.sql import functions as F

from tidemark.operators.cursor import backfill_pages, incremental_pages
from tidemark.operators.ordered import positions, running


def _log(seed, rows=600):
    """A third of all rows has one key; order values are gapped and may be negative."""
    r = random.Random(seed)
    seqs = r.sample(range(-500, 5000), rows)
    return [(0 if r.random() < 1 / 3 else r.randrange(1, 40), s, r.randrange(100) if r.random() < 0.8 else None) for s in seqs]


def _expected(rows, step):
    seen, out = {}, {}
    for key, seq, value in sorted(rows, key=lambda x: x[1]):
        out[(key, seq)] = seen.get(key)
        seen[key] = step(seen.get(key), value)
    return out


def test_running_max_crosses_ranges(spark):
    rows = _log(1)
    df = spark.createDataFrame(rows, "k BIGINT, seq BIGINT, v BIGINT")
    best = lambda a, b: b if a is None else a if b is None else max(a, b)
    for bits in (2, 5, 40):
        got = running(df, ["k"], "seq", F.col("v"), "max", "prior", bits=bits).collect()
        assert {(r["k"], r["seq"]): r["prior"] for r in got} == _expected(rows, best)
        assert len(got) == len(rows)


def test_running_sum_starts_at_zero(spark):
    rows = _log(2)
    df = spark.createDataFrame(rows, "k BIGINT, seq BIGINT, v BIGINT")
    got = running(df, ["k"], "seq", F.lit(1), "sum", "before", bits=4).collect()
    expected = _expected(rows, lambda a, _: (a or 0) + 1)
    assert {(r["k"], r["seq"]): r["before"] for r in got} == {k: v or 0 for k, v in expected.items()}


def test_running_with_a_start(spark):
    rows = [(1, 5, 3), (1, 9, 1), (2, 7, None), (3, 8, 2)]
    df = spark.createDataFrame(rows, "k BIGINT, seq BIGINT, v BIGINT")
    start = spark.createDataFrame([(1, 2), (2, 9), (8, 1)], "k BIGINT, prior BIGINT")
    for bits in (0, 1, 20):
        got = running(df, ["k"], "seq", F.col("v"), "max", "prior", start, bits=bits).collect()
        assert {(r["k"], r["seq"]): r["prior"] for r in got} == {(1, 5): 2, (1, 9): 3, (2, 7): 9, (3, 8): None}


def test_running_keeps_rows_with_a_null_key(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 6), (1, 3, 7)], "k BIGINT, seq BIGINT, v BIGINT")
    assert running(df, ["k"], "seq", F.col("v"), "max", "prior").count() == 3


def test_positions_of_ids_far_apart(spark):
    r = random.Random(3)
    ids = {r.randrange(-(2**62), 2**62) for _ in range(300)} | set(range(500)) | {2**40 + i for i in range(200)}
    df = spark.createDataFrame([(i,) for i in ids], "id BIGINT")
    got = positions(df, ["id"]).collect()
    assert [x["id"] for x in sorted(got, key=lambda x: x["position"])] == sorted(ids)
    assert sorted(x["position"] for x in got) == list(range(len(ids)))


def test_pages_of_a_table_where_a_third_of_the_rows_share_a_time(spark):
    r = random.Random(4)
    rows = []
    for i in r.sample(range(10**7), 900):
        second = 0 if r.random() < 1 / 3 else r.randrange(10**6)
        rows.append((i, f"2024-01-01 00:00:00.{second:06d}" if r.random() < 0.5 else f"2024-02-0{1 + second % 9} 00:00:00"))
    df = spark.createDataFrame(rows, "id BIGINT, t STRING").select("id", F.col("t").cast("timestamp_ntz").alias("updated_at"))
    ordered = sorted((x["updated_at"], x["id"]) for x in df.collect())
    pages = [ordered[i : i + 70] for i in range(0, len(ordered), 70)]
    got = {x["page"]: (x["cursor_ts"], x["cursor_id"], x["rows"]) for x in incremental_pages(df, 70).collect()}
    assert got == {n: (*page[-1], len(page)) for n, page in enumerate(pages)}


def test_page_cursors_read_the_table_once_each(spark):
    df = spark.range(0, 10_000, 3)
    ids = [r["id"] for r in df.collect()]
    got = sorted((x["page"], x["cursor_id"], x["rows"]) for x in backfill_pages(df, 500).collect())
    expected = [(n, max(ids[i : i + 500]), len(ids[i : i + 500])) for n, i in enumerate(range(0, len(ids), 500))]
    assert got == expected


def test_running_reads_its_rows_twice(spark, folder):
    rows = spark.read.parquet(f"{folder}/events.parquet")
    plan = running(rows, ["user_id"], "event_id", F.lit(1), "sum", "n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2


def test_sorted_copy_pages_and_removal(spark):
    import os

    from tidemark.operators.ordered import SortedCopy

    rows = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5003).alias("id"))
    copy = SortedCopy(rows, ["id"])
    ids = sorted(r["id"] for r in rows.collect())
    assert copy.size == 5000
    for low, high in [(0, 10), (700, 1900), (4990, 6000), (6000, 7000)]:
        page = copy.page(low, high)
        assert sorted((r["position"], r["id"]) for r in page.collect()) == list(enumerate(ids))[low:high]
    assert "PushedFilters: [IsNotNull(_part)" in copy.page(700, 900)._jdf.queryExecution().executedPlan().toString()
    copy.remove()
    assert not os.path.exists(copy.path)
    empty = SortedCopy(rows.limit(0), ["id"])
    assert empty.size == 0 and empty.page(0, 10).count() == 0
    empty.remove()
