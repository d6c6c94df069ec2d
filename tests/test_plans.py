"""What the plans must look like for large tables."""

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tidemark import catalog
from tidemark.operators import cursor, consume, upsert
from tidemark.plans import reconcile
from tidemark.sources import bindings as B
from tidemark.sources.tables import read_table

BATCH = [name for name in catalog.QUERIES if not name.startswith(("stream_", "sync_"))]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def source(spark):
    """The orders as records with plain columns, so that filters on them can be pushed."""
    return read_table(spark, SMALL, "orders").select(
        F.col("o_orderkey").alias("id"), F.lit("e").alias("email"), F.lit("n").alias("name"), F.lit("{}").alias("payload"),
        F.lit(1).alias("version"), F.lit(False).alias("poison"), F.col("o_orderdate").alias("updated_at"), F.col("o_orderdate").alias("created_at"),
    )


def test_pages_push_their_cursor_and_sort_no_more_than_a_page(spark):
    page = plan(cursor.backfill_page(source(spark), 700))
    assert "GreaterThan(o_orderkey,700)" in page and "TakeOrderedAndProject" in page
    page = plan(cursor.incremental_page(source(spark), "1996-09-17 00:00:00", 700))
    assert "GreaterThanOrEqual(o_orderdate,1996-09-17T00:00)" in page and "Or(GreaterThan" in page
    assert "TakeOrderedAndProject" in page and "Exchange" not in page


def test_a_stored_cursor_is_pushed_too(spark):
    found = B.checkpoints(spark)
    assert f"GreaterThan(o_orderkey,{B.CHECKPOINT_ID})" in plan(cursor.rows_after_checkpoint(source(spark), found, "backfill"))
    assert "GreaterThanOrEqual(o_orderdate," in plan(cursor.rows_after_checkpoint(source(spark), found, "incremental"))


def test_state_cuts_to_one_row_per_key_before_the_shuffle(spark):
    text = plan(upsert.upsert(None, B.changes_unordered(spark, SMALL)))
    assert text.count("WindowGroupLimit") == 2
    assert text.count("Exchange") == 1


def test_consumer_hashes_and_combines_first(spark):
    text = plan(consume.consumed_events(B.deliveries(B.changes_unordered(spark, SMALL))))
    assert "SortAggregate" not in text and text.count("HashAggregate") == 2 and text.count("Exchange") == 1


def test_reconcile_shuffles_ids_versions_and_hashes_only(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(reconcile.by_key(B.records(spark, SMALL), B.sink(B.records(spark, SMALL))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and text.count("Exchange") == 2


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_products(spark, name):
    text = plan(catalog.QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "MapInPandas" not in text
