"""Search by terms that the replication keeps: as search over the texts, whatever changed since."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import search
from tidemark.session import new_dir
from tidemark.streaming import replicate as replication, tables as replica
from tidemark.streaming.replicate import commit_batch
from tidemark.streaming.tables import ReplicationTables

AT = datetime(2020, 1, 1)
COLUMNS = "id BIGINT, email STRING, name STRING, payload STRING, version BIGINT, poison BOOLEAN, updated_at TIMESTAMP_NTZ, created_at TIMESTAMP_NTZ, seq BIGINT"
NAMES = ["Ada Löve", "Grace 東京 Hopper", "löve-letters", None, "", "...", "Ada", "the same the same", "a_b 7"]


def rows(spark, given: list[tuple], first: int):
    """(id, name, version, poison) rows, in the order they arrive."""
    made = [(i, f"u{i}@x.org", n, "{}", v, p, AT, AT, first + k) for k, (i, n, v, p) in enumerate(given)]
    return spark.createDataFrame(made, COLUMNS)


QUERIES = [(1, "ada"), (2, "LÖVE"), (3, "東"), (4, ""), (5, " 007 "), (6, "u3@x.org"), (7, "..."), (8, "renamed same"), (9, "nobody"), (10, "a_b"), (11, None)]


@pytest.mark.parametrize("compact_after", [(), (0,), (0, 1), (1, 2)])
def test_equal_to_search_over_the_state(spark, compact_after):
    tables = ReplicationTables(new_dir(spark, "terms"), terms=True)
    start = [(k, NAMES[k % len(NAMES)], 3, k % 11 == 10) for k in range(40)]
    later = [(k, f"renamed {k}", 4, False) for k in range(0, 40, 3)] + [(k, "stale ada", 2, False) for k in range(1, 40, 3)]
    again = [(k, "ada once more", 5, k % 2 == 1) for k in range(0, 12)] + [(100, "new ada", 1, False)] + [(k, "same version", 4, False) for k in (30, 33)]
    queries = spark.createDataFrame(QUERIES, "query_id BIGINT, query STRING")
    mode = ["backfill", "incremental", "incremental"]
    for n, given in enumerate((start, later, again)):
        commit_batch(rows(spark, given, 1000 * n), n, tables, mode[n])
        if n in compact_after:
            tables.compact(spark)
        terms = tables.search_terms(spark, search.asked_for(queries))
        found = search.search_many_terms(terms, queries, 7)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, search.search_many(tables.state(spark), queries, 7).collect())), n
    plan = terms._jdf.queryExecution().executedPlan().toString()
    assert "name#" not in plan and "split(" not in plan  # texts are not read


def test_terms_of_a_batch_that_is_not_done_do_not_count(spark, monkeypatch):
    tables = ReplicationTables(new_dir(spark, "terms"), terms=True)
    commit_batch(rows(spark, [(1, "one", 1, False)], 0), 0, tables, "backfill")
    monkeypatch.setattr(replication, "publish", lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        commit_batch(rows(spark, [(1, "two", 2, False)], 1), 1, tables, "backfill")
    words = lambda: sorted(r["term"] for r in tables.search_terms(spark).where("kind = 'word'").collect())
    assert words() == ["one"]
    monkeypatch.undo()
    commit_batch(rows(spark, [(1, "two", 2, False)], 1), 1, tables, "backfill")
    assert words() == ["two"]


def test_few_queries_reach_the_reader(spark):
    queries = spark.createDataFrame([(1, "ada"), (2, "9")], "query_id BIGINT, query STRING")
    tables = ReplicationTables(new_dir(spark, "terms"), terms=True)
    commit_batch(rows(spark, [(9, "ada", 1, False)], 0), 0, tables, "backfill")
    tables.compact(spark)
    plan = tables.search_terms(spark, search.asked_for(queries)).where(F.col("kind") == "word")._jdf.queryExecution().executedPlan().toString()
    assert "In(term, [" in plan
    many = spark.range(search.MOST + 5).select(F.col("id").alias("query_id"), F.concat(F.lit("w"), "id").alias("query"))
    assert search.asked_for(many) is None


def test_compact_joins_terms_only_where_rows_were_replaced(spark, monkeypatch):
    joined = []
    plain = replica._without_older
    monkeypatch.setattr(replica, "_without_older", lambda *given: joined.append(1) or plain(*given))
    tables = ReplicationTables(new_dir(spark, "terms"), terms=True)
    commit_batch(rows(spark, [(k, "ada", 1, False) for k in range(5)], 0), 0, tables, "backfill")
    tables.compact(spark)
    assert not joined
    commit_batch(rows(spark, [(3, "grace", 2, False), (4, "stale", 0, False)], 10), 1, tables, "backfill")
    tables.compact(spark)
    assert joined
    queries = spark.createDataFrame([(1, "ada"), (2, "grace"), (3, "stale")], "query_id BIGINT, query STRING")
    found = search.search_many_terms(tables.search_terms(spark, search.asked_for(queries)), queries).collect()
    assert sorted((r["query_id"], r["id"]) for r in found) == [(1, 0), (1, 1), (1, 2), (1, 4), (2, 3)]
