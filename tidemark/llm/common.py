"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import new_dir

#: The ASCII characters that part words, as a regular expression's character class holds them.
SPACES = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the folder all executors share: computed once, safe when executors go."""
    path = new_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def batches(schema: pa.Schema, rows: Iterator[tuple], size: int = 1000) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of ``size`` at most."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(schema, held)
            held = []
    if held:
        yield _batch(schema, held)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def values(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of record batches as tuples, a few hundred at a time as Python objects."""
    for batch in stream:
        for start in range(0, batch.num_rows, 256):
            yield from zip(*(c.to_pylist() for c in batch.slice(start, 256).columns))
