"""A table that changes in place as a stream: what is read, from where, and against a sync of the same table."""

from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import synth
from tidemark import schema as S
from tidemark.functions.times import utc
from tidemark.session import new_dir
from tidemark.sources import bindings as B
from tidemark.sources.changing import ChangedRowsReader, changed_rows, groups_of, micros
from tidemark.streaming.replicate import replicate
from tidemark.streaming.sync import sync
from tidemark.streaming.tables import ReplicationTables


def test_equals_a_sync_of_the_same_table(spark, tables, folder):
    source, path = B.records(spark, folder), new_dir(spark, "changing")
    other = ReplicationTables(new_dir(spark, "sync"))
    changed = synth.bump(source, utc("2003-01-01 00:00:00"), 30).drop("bumped")
    read = []
    for now in (source, changed, changed):
        now.repartition(3).write.mode("overwrite").parquet(path)
        query = replicate(changed_rows(spark, path, rows_per_partition=400), tables, S.INCREMENTAL)
        query.awaitTermination()
        read.append(sum(p["numInputRows"] for p in query.recentProgress))
        sync(now, other, S.INCREMENTAL, datetime(1900, 1, 1))
    assert read == [source.count(), 30, 0]  # it goes on from its checkpoint
    seen = lambda t: sorted(t.state(spark).select(*S.RECORD_COLUMNS).collect())
    assert seen(tables) == seen(other)
    assert tables.feed(spark).count() == other.feed(spark).count()
    assert tables.checkpoints(spark).collect() == other.checkpoints(spark).collect()


def rows_read(reader: ChangedRowsReader, start: dict, end: dict) -> list[tuple]:
    parts = reader.partitions(start, end)
    return sorted((r["updated_at"], r["id"]) for p in parts for b in reader.read(p) for r in b.to_pylist())


def written(path, rows: list[tuple], group: int = 4, statistics: bool = True) -> str:
    """(updated_at, id) rows as a file with small row groups."""
    columns = {"id": [r[1] for r in rows], "updated_at": [r[0] for r in rows]}
    types = {"id": pa.int64(), "version": pa.int64(), "poison": pa.bool_(), "updated_at": pa.timestamp("us"), "created_at": pa.timestamp("us")}
    arrays = {c: pa.array(columns.get(c, [None] * len(rows)), types.get(c, pa.string())) for c in S.RECORD_COLUMNS}
    pq.write_table(pa.table(arrays), path, row_group_size=group, write_statistics=statistics)
    return str(path)


def test_every_key_is_read_once(tmp_path):
    day = lambda n: datetime(2020, 1, 1 + n)
    rows = [(day(n // 5), n * 7 % 23) for n in range(23)] + [(None, 99), (day(2), None), (None, None)]
    keys = sorted(r for r in rows if None not in r)
    for number, statistics in enumerate((True, False)):
        reader = ChangedRowsReader(written(tmp_path / f"{number}.parquet", rows, 4, statistics), None, 6)
        first, last = reader.initialOffset(), reader.latestOffset()
        assert (last["updated_at"], last["id"]) == (micros(keys[-1][0]), keys[-1][1])
        assert rows_read(reader, first, last) == keys
        assert reader.partitions(last, last) == []
        for cut in range(1, len(keys), 4):
            offset = {"updated_at": micros(keys[cut - 1][0]), "id": keys[cut - 1][1]}
            assert rows_read(reader, first, offset) == keys[:cut]
            assert rows_read(reader, offset, last) == keys[cut:]


def test_groups_out_of_range_are_not_read(tmp_path):
    rows = [(datetime(2020, 1, 1 + n), n) for n in range(24)]
    reader = ChangedRowsReader(written(tmp_path / "t.parquet", rows), None, 4)
    start = {"updated_at": micros(datetime(2020, 1, 18)), "id": 17}
    parts = reader.partitions(start, reader.latestOffset())
    assert len(groups_of(str(tmp_path / "t.parquet"))) == 6
    assert [p.groups for p in parts] == [[(str(tmp_path / "t.parquet"), 4)], [(str(tmp_path / "t.parquet"), 5)]]


def test_empty_table_and_first_time(tmp_path):
    reader = ChangedRowsReader(written(tmp_path / "e.parquet", []), None, 4)
    assert reader.latestOffset() == reader.initialOffset() and reader.partitions(reader.initialOffset(), reader.latestOffset()) == []
    rows = [(datetime(2020, 1, 1 + n), n) for n in range(9)]
    reader = ChangedRowsReader(written(tmp_path / "s.parquet", rows), "2020-01-05T00:00:00", 4)
    assert rows_read(reader, reader.initialOffset(), reader.latestOffset()) == rows[4:]
