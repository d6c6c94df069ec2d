"""Reading a source table: files, a database, or files as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark import schema as S


#: By default a file a week older than the newest one seen is skipped without a word.
NEVER_TOO_OLD = "36500d"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream_table(spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """A Parquet table as a stream of its files.

    The last letter is written as a glob: the stream source then takes a table that is one file
    as well as one that is a folder of files.
    """
    path = f"{folder}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFileAge", NEVER_TOO_OLD)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def id_ranges(lowest: int, highest: int, parts: int) -> list[str]:
    """``parts`` predicates that together cover every id once, nulls and outliers included."""
    parts = max(1, min(parts, highest - lowest + 1))
    cuts = [lowest + (highest - lowest + 1) * i // parts for i in range(1, parts)]
    if not cuts:
        return ["1 = 1"]
    between = [f"id >= {low} AND id < {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"id < {cuts[0]} OR id IS NULL", *between, f"id >= {cuts[-1]}"]


def read_database(
    spark: SparkSession, url: str, table: str, lowest: int, highest: int, parts: int, **options: str
) -> DataFrame:
    """A database table read over parallel connections, one id range each.

    Column pruning, filters and limits on the result reach the database. Needs its JDBC driver on
    the classpath, given as ``driver=...``.
    """
    return spark.read.jdbc(
        url, table, predicates=id_ranges(lowest, highest, parts), properties=options
    ).select(*S.RECORD_COLUMNS)
