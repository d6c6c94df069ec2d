"""A table that changes in place as a stream: a Python data source whose offset is ``(updated_at, id)``.

The table is a folder of Parquet files (or one file) that its owner rewrites: rows are updated, not appended, so no
file is new, and what is new lies past the offset. Register the source and read it:

    spark.dataSource.register(ChangedRows)
    rows = spark.readStream.format("changed_rows").load("/shared/records.parquet")

The newest key is found in the files' footers; of rows, only the ids at the newest time are looked at. A batch is planned from
the footers too: row groups whose times can't lie between the offsets are left out, the others are dealt into
partitions of ``rowsPerPartition`` rows at most (or one group), so that a task reads its groups once, keeps the rows between the offsets and
hands them on as Arrow batches. Nothing but footers and offsets passes through the driver.

``since`` (an ISO time) is where a new query starts; default: before all rows. Rows with a null id or time lie past no offset.
``seq`` is the row's time in microseconds: of two versions of a record the one changed later arrived later. A
row that changes between a batch's plan and its reading belongs to the next batch; a batch that is tried
again may then lack it, and the state comes out the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemark import schema as S

ROWS_PER_PARTITION = 1_000_000
_LOWEST = -(2**63)
_EPOCH = datetime(1970, 1, 1)
_TIME = pa.timestamp("us")
_SCHEMA = pa.schema(
    [("id", pa.int64()), *((c, pa.string()) for c in ("email", "name", "payload")), ("version", pa.int64()), ("poison", pa.bool_()),
     ("updated_at", _TIME), ("created_at", _TIME), ("seq", pa.int64())]
)

Key = tuple[int, int]  #: microseconds since 1970, id


def micros(at: datetime) -> int:
    return (at - _EPOCH) // timedelta(microseconds=1)


def _offset(key: Key) -> dict:
    return {"updated_at": key[0], "id": key[1]}


def _key(offset: dict) -> Key:
    return int(offset["updated_at"]), int(offset["id"])


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def files_of(path: str) -> list[str]:
    """The Parquet files of a table, without those a writer keeps for itself."""
    store, inner = _open(path)
    if store.get_file_info(inner).type == pafs.FileType.File:
        return [inner]
    found = store.get_file_info(pafs.FileSelector(inner, recursive=True, allow_not_found=True))
    hidden = lambda p: any(part[:1] in "._" for part in p[len(inner) :].strip("/").split("/"))
    return sorted(f.path for f in found if f.type == pafs.FileType.File and not hidden(f.path))


@dataclass(frozen=True)
class Group:
    """A row group: where it is, how many rows it has, and the first and last time in it if its footer says."""

    file: str
    number: int
    rows: int
    low: int | None
    high: int | None

    def may_hold(self, start: Key, end: Key) -> bool:
        return self.low is None or (self.low <= end[0] and self.high >= start[0])


def _groups_of(store: pafs.FileSystem, file: str) -> list[Group]:
    with store.open_input_file(file) as source:
        footer = pq.read_metadata(source)
    column = next(k for k in range(footer.num_columns) if footer.schema.column(k).name == "updated_at")
    found = []
    for number in range(footer.num_row_groups):
        group = footer.row_group(number)
        said = group.column(column).statistics
        known = said is not None and said.has_min_max
        ends = [micros(pa.scalar(v, _TIME).as_py()) for v in (said.min, said.max)] if known else [None, None]
        found.append(Group(file, number, group.num_rows, *ends))
    return found


def groups_of(path: str) -> list[Group]:
    store, _ = _open(path)
    with ThreadPoolExecutor(16) as pool:
        return [g for of_file in pool.map(lambda f: _groups_of(store, f), files_of(path)) for g in of_file]


@dataclass
class Part(InputPartition):
    """Row groups, and the keys between which rows are wanted: past ``start``, up to ``end``."""

    groups: list[tuple[str, int]]
    start: Key
    end: Key


def _time(at: int) -> pa.Scalar:
    return pa.scalar(at, pa.int64()).cast(_TIME)


def between(batch: pa.RecordBatch, start: Key, end: Key) -> pa.RecordBatch:
    at, number = batch.column("updated_at").cast(_TIME), batch.column("id")

    def past(key: Key) -> pa.Array:
        later = pc.greater(at, _time(key[0]))
        return pc.or_kleene(later, pc.and_kleene(pc.equal(at, _time(key[0])), pc.greater(number, key[1])))

    inside = pc.and_kleene(past(start), pc.invert(past(end)))
    return batch.filter(pc.and_kleene(inside, number.is_valid()))  # a null time is neither


class ChangedRowsReader(DataSourceStreamReader):
    def __init__(self, path: str, since: str | None, rows_per_partition: int) -> None:
        self.path, self.since, self.rows_per_partition = path, since, rows_per_partition

    def initialOffset(self) -> dict:
        return _offset((micros(datetime.fromisoformat(self.since)) if self.since else _LOWEST, _LOWEST))

    def latestOffset(self) -> dict:
        groups = groups_of(self.path)
        if any(g.low is None and g.rows for g in groups):  # no statistics, or a group of null times
            unknown = [g for g in groups if g.low is None]
            highs = [micros(h) for g in unknown if (h := pc.max(self._column(g, "updated_at").cast(_TIME)).as_py()) is not None]
        else:
            unknown, highs = [], []
        highs += [g.high for g in groups if g.high is not None]
        if not highs:
            return self.initialOffset()
        newest = max(highs)
        best = _LOWEST
        for group in groups:
            if group.low is None or group.high == newest:
                at = self._column(group, "updated_at").cast(_TIME)
                top = pc.max(self._column(group, "id").filter(pc.equal(at, _time(newest)))).as_py()
                best = best if top is None else max(best, top)
        return _offset(max((newest, best), _key(self.initialOffset())))

    def _column(self, group: Group, name: str) -> pa.ChunkedArray:
        store, _ = _open(self.path)
        with store.open_input_file(group.file) as source:
            return pq.ParquetFile(source).read_row_group(group.number, columns=[name]).column(name)

    def partitions(self, start: dict, end: dict) -> list[Part]:
        low, high = _key(start), _key(end)
        if low >= high:
            return []
        parts, held, size = [], [], 0
        for group in groups_of(self.path):
            if not group.may_hold(low, high):
                continue
            if held and size + group.rows > self.rows_per_partition:
                parts.append(Part(held, low, high))
                held, size = [], 0
            held.append((group.file, group.number))
            size += group.rows
        return parts + ([Part(held, low, high)] if held else [])

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        store, _ = _open(self.path)
        columns = list(S.RECORD_COLUMNS)
        for file, number in partition.groups:
            with store.open_input_file(file) as source:
                for batch in pq.ParquetFile(source).iter_batches(row_groups=[number], columns=columns):
                    kept = between(batch, partition.start, partition.end)
                    arrays = [kept.column(f.name).cast(f.type) for f in _SCHEMA if f.name != "seq"]
                    seq = kept.column("updated_at").cast(_TIME).cast(pa.int64())
                    if kept.num_rows:
                        yield pa.RecordBatch.from_arrays([*arrays, seq], schema=_SCHEMA)


class ChangedRows(DataSource):
    """``format("changed_rows")``: options ``path``, ``since``, ``rowsPerPartition``."""

    @classmethod
    def name(cls) -> str:
        return "changed_rows"

    def schema(self) -> str:
        return f"{S.RECORDS}, seq BIGINT"

    def streamReader(self, schema) -> ChangedRowsReader:
        rows = int(self.options.get("rowsPerPartition", ROWS_PER_PARTITION))
        return ChangedRowsReader(self.options["path"], self.options.get("since"), rows)


def changed_rows(spark, path: str, since: datetime | None = None, rows_per_partition: int = ROWS_PER_PARTITION):
    """The table at ``path`` as a stream of its rows past the offset, for ``replicate``."""
    spark.dataSource.register(ChangedRows)
    reader = spark.readStream.format("changed_rows").option("rowsPerPartition", rows_per_partition)
    return (reader if since is None else reader.option("since", since.isoformat())).load(path)
