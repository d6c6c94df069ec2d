"""The folders a replication writes, one subfolder per mode and batch, and how to read them.

A batch's folders are overwritten when the batch runs again, and a batch counts once its row in
the batch log is there, so a redo leaves what a clean run would have.

Batches of a mode are numbered on from the last one, whoever writes them; the start row says whose
batch it is, so that a redo finds its number and nobody gets another one's. One writer per mode at
a time. Batches lie in generations of ``GENERATION``; after ``compact``, only generations that have
batches past the snapshot are looked at, so that what a batch reads does not grow with history.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark import schema as S
from tidemark.functions.documents import event_id, event_json, routing_key
from tidemark.functions.times import utc
from tidemark.operators import dead_letters
from tidemark.operators.upsert import current_state
from tidemark.session import remove, subfolders

PARTITIONS = ", mode STRING, batch_id BIGINT"
ROW_LOG = S.RECORDS + ", seq BIGINT, error STRING, emitted_at TIMESTAMP_NTZ" + PARTITIONS
DOCUMENT_LOG = S.RECORDS + ", seq BIGINT" + PARTITIONS
ENTRY_LOG = S.DEAD_LETTERS.replace("batch_id STRING, ", "") + PARTITIONS
MARK_LOG = "id BIGINT, replayed_at TIMESTAMP_NTZ" + PARTITIONS
TERM_LOG = "kind STRING, term STRING, id BIGINT, version BIGINT, seq BIGINT" + PARTITIONS
REPLACED_LOG = "id BIGINT, version BIGINT, seq BIGINT" + PARTITIONS
START_LOG = "started_at TIMESTAMP_NTZ, owner STRING, number BIGINT" + PARTITIONS
SNAPSHOT_LOG = "snapshot BIGINT, mode STRING, last_batch BIGINT"
NEWEST = ("version", "seq", "batch_id", "mode")  # seq is given by the source; the order of files is not
GENERATION = 64


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class Batch:
    """A batch's number in its mode, when it was first tried, whether it is done, and whether it was tried before."""

    batch_id: int
    started_at: datetime
    done: bool
    tried: bool


def _columns(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


def _named(names: list[str], prefix: str) -> list[str]:
    """What follows the prefix; a job that writes keeps files of its own beside."""
    return [n.removeprefix(prefix) for n in names if n.startswith(prefix)]


@dataclass(frozen=True)
class ReplicationTables:
    """``terms``: whether each batch also writes the words, names, addresses and ids its rows are found by."""

    root: str
    generation: int = GENERATION
    terms: bool = False

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def batch_path(self, table: str, mode: str, batch_id: int) -> str:
        return f"{self.root}/{table}/mode={mode}/generation={batch_id // self.generation}/batch_id={batch_id}"

    def write_batch(self, rows: DataFrame, table: str, mode: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(self.batch_path(table, mode, batch_id))

    def write_batches(self, rows: DataFrame, table: str, mode: str, batch_ids: list[int]) -> None:
        """Write several batches in one job, by the rows' ``batch_id``; what earlier tries left of them goes first."""
        spark, base = rows.sparkSession, f"{self.path(table)}/mode={mode}"
        self.remove_batches(spark, table, mode, batch_ids)
        placed = rows.withColumn("generation", F.floor(F.col("batch_id") / self.generation).cast("bigint"))
        placed.write.mode("append").partitionBy("generation", "batch_id").parquet(base)

    def remove_batches(self, spark: SparkSession, table: str, mode: str, batch_ids: list[int]) -> None:
        for batch_id in batch_ids:
            path = self.batch_path(table, mode, batch_id)
            if subfolders(spark, path):
                remove(spark, path)

    def read_batches(self, spark: SparkSession, table: str, mode: str, batch_ids: list[int], schema: str) -> DataFrame:
        """Some batches of a table with their ``mode`` and ``batch_id``, without listing the others."""
        paths = [self.batch_path(table, mode, b) for b in batch_ids]
        return self._read(spark, [p for p in paths if subfolders(spark, p)], schema, self.path(table))

    def read(self, spark: SparkSession, table: str, schema: str) -> DataFrame:
        """A folder of files as one table; empty before the first."""
        return self._read(spark, [self.path(table)] if subfolders(spark, self.path(table)) else [], schema)

    def read_batch(self, spark: SparkSession, table: str, mode: str, batch_id: int, schema: str) -> DataFrame:
        """One batch of a table, without listing the others; empty when it has not been written."""
        path = self.batch_path(table, mode, batch_id)
        return self._read(spark, [path] if subfolders(spark, path) else [], schema)

    def _read(self, spark: SparkSession, paths: list[str], schema: str, base: str | None = None) -> DataFrame:
        if not paths:
            return spark.createDataFrame([], schema)
        reader = spark.read.schema(schema)
        if base is not None:
            reader = reader.option("basePath", base)
        return reader.parquet(*paths).select(*_columns(schema))

    def read_after(self, spark: SparkSession, table: str, schema: str, covered: dict[str, int]) -> DataFrame:
        """A table's batches past those ``covered`` per mode; generations before are not listed."""
        base, paths = self.path(table), []
        for mode in _named(subfolders(spark, base), "mode="):
            first = (covered.get(mode, -1) + 1) // self.generation
            for part in _named(subfolders(spark, f"{base}/mode={mode}"), "generation="):
                if int(part) >= first:
                    paths.append(f"{base}/mode={mode}/generation={part}")
        rows = self._read(spark, paths, schema, base)
        for mode, last in covered.items():
            rows = rows.where((F.col("mode") != mode) | (F.col("batch_id") > last))
        return rows

    # --- snapshots

    def last_snapshot(self, spark: SparkSession) -> tuple[int | None, dict[str, int]]:
        """Which snapshot is the newest, and the batch per mode it goes up to: a row per mode."""
        done = [int(f.removeprefix("snapshot=")) for f in subfolders(spark, self.path("snapshot_log"))]
        if not done:
            return None, {}
        rows = spark.read.schema("mode STRING, last_batch BIGINT").parquet(self.path(f"snapshot_log/snapshot={max(done)}"))
        return max(done), {r["mode"]: r["last_batch"] for r in rows.collect()}

    def _snapshot(self, spark: SparkSession, snapshot: int | None, table: str, schema: str) -> DataFrame:
        path = self.path(f"snapshots/{snapshot}/{table}")
        return self._read(spark, [path] if snapshot is not None and subfolders(spark, path) else [], schema)

    # --- the log

    def batch_log(self, spark: SparkSession) -> DataFrame:
        snapshot, covered = self.last_snapshot(spark)
        recent = self.read_after(spark, "batch_log", S.BATCH_LOG, covered)
        return recent.unionByName(self._snapshot(spark, snapshot, "batch_log", S.BATCH_LOG))

    def begin(self, spark: SparkSession, mode: str, owner: str, number: int) -> tuple[int, datetime, bool]:
        """The batch that is ``owner``'s ``number``, when it was first tried, and whether it is done."""
        batch = self.begin_all(spark, mode, owner, [number])[0]
        return batch.batch_id, batch.started_at, batch.done

    def begin_all(self, spark: SparkSession, mode: str, owner: str, numbers: list[int]) -> list[Batch]:
        """The batches that are ``owner``'s ``numbers``, in that order.

        A redo finds the same as the first try, so it writes the same rows. The log says first what is
        done: a start row stays when its batch is, and goes when a snapshot has taken the batch in.
        """
        _, covered = self.last_snapshot(spark)
        mine = (F.col("owner") == owner) & F.col("number").isin(numbers)
        log = self.batch_log(spark).where((F.col("mode") == mode) & F.col("ok") & mine)
        found = {r["number"]: Batch(r["batch_id"], r["attempted_at"], True, True) for r in log.collect()}
        if len(found) < len(set(numbers)):
            starts = self.read_after(spark, "starts", START_LOG, covered).where(F.col("mode") == mode)
            for r in starts.where(mine).collect():
                found.setdefault(r["number"], Batch(r["batch_id"], r["started_at"], False, True))
            new = [n for n in dict.fromkeys(numbers) if n not in found]
            if new:
                last = starts.agg(F.max("batch_id")).first()[0]
                first, now = 1 + max(covered.get(mode, -1), -1 if last is None else last), utc_now()
                found |= {n: Batch(first + k, now, False, False) for k, n in enumerate(new)}
                rows = spark.range(len(new)).select(
                    utc(now).alias("started_at"),
                    F.lit(owner).alias("owner"),
                    F.element_at(F.array(*[F.lit(n).cast("bigint") for n in new]), F.col("id").cast("int") + 1).alias("number"),
                    (F.col("id") + first).alias("batch_id"),
                )
                self.write_batches(rows.coalesce(1), "starts", mode, [found[n].batch_id for n in new])
        return [found[n] for n in numbers]

    def _committed(self, spark: SparkSession, table: str, schema: str, covered: dict[str, int]) -> DataFrame:
        """A table's batches past those ``covered``, without those not committed: one per mode at most.

        They are left out by partition, so no join touches the rows. The log is listed before the
        rows and the starts after them: a batch whose files are seen half there has its start row
        by then, and no log row yet.
        """
        done = self.read_after(spark, "batch_log", S.BATCH_LOG, covered).where("ok").select("mode", "batch_id")
        rows = self.read_after(spark, table, schema, covered)
        started = self.read_after(spark, "starts", START_LOG, covered).select("mode", "batch_id")
        for batch in started.join(done, ["mode", "batch_id"], "left_anti").collect():
            rows = rows.where((F.col("mode") != batch["mode"]) | (F.col("batch_id") != batch["batch_id"]))
        return rows

    # --- what readers see

    def documents(self, spark: SparkSession, covered: dict[str, int] | None = None) -> DataFrame:
        """Every accepted row of the committed batches."""
        rows = self._committed(spark, "rows", ROW_LOG, covered or {})
        return rows.where(F.col("error").isNull()).select(*_columns(DOCUMENT_LOG))

    def feed(self, spark: SparkSession) -> DataFrame:
        """An event per row of the committed batches, rejected ones included."""
        return feed_of(self._committed(spark, "rows", ROW_LOG, {}))

    def dead_letters(self, spark: SparkSession, only_open: bool = False) -> DataFrame:
        """Entries with their status now; of open ones of the same record, version and sink, the first.

        Two modes that run at once may both reject a row before either sees the other's entry.
        """
        snapshot, covered = self.last_snapshot(spark)
        recent = self._committed(spark, "dead_letters", ENTRY_LOG, covered)
        recent = recent.withColumn("batch_id", F.concat_ws("-", "mode", "batch_id")).select(*_columns(S.DEAD_LETTERS))
        taken = self._snapshot(spark, snapshot, "dead_letters", S.DEAD_LETTERS)
        if only_open:
            taken = taken.where(dead_letters.is_open())  # by partition
        marks = self.read_after(spark, "replay_marks", MARK_LOG, covered)
        folded = dead_letters.fold_status(taken.unionByName(recent), marks).select(*_columns(S.DEAD_LETTERS))
        waiting = dead_letters.is_open()
        first = Window.partitionBy(*dead_letters.OPEN_KEY).orderBy("created_at", "id")
        one_open = folded.where(waiting).withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")
        return one_open if only_open else folded.where(~waiting).unionByName(one_open)

    def checkpoints(self, spark: SparkSession) -> DataFrame:
        """The cursor of the last committed batch of each mode."""
        last = F.max_by(F.struct("cursor_id", "cursor_ts"), "attempt").alias("_at")
        moved = self.batch_log(spark).where(F.col("ok") & (F.col("rows") > 0))
        return moved.groupBy("mode").agg(last).select("mode", "_at.cursor_id", "_at.cursor_ts")

    def state(self, spark: SparkSession) -> DataFrame:
        """One row per id: the newest snapshot, and the batches committed since, merged on read."""
        snapshot, covered = self.last_snapshot(spark)
        rows = self.documents(spark, covered).unionByName(self._snapshot(spark, snapshot, "documents", DOCUMENT_LOG))
        return current_state(rows, order=NEWEST)

    def search_terms(self, spark: SparkSession, asked: Column | None = None) -> DataFrame:
        """``kind, term, id`` of the rows as they are now; ``asked`` is given to the reader.

        Terms were written with their batches; what an id was found by before its newest row does not
        count any more.
        """
        snapshot, covered = self.last_snapshot(spark)
        recent = self._committed(spark, "terms", TERM_LOG, covered)
        return _current_terms(recent, self._snapshot(spark, snapshot, "terms", TERM_LOG), asked).select("kind", "term", "id")

    def compact(self, spark: SparkSession) -> None:
        """Write state, log, dead letters and consumer counts as a new snapshot; reads go on from it.

        The batches are fixed first, so that those committed meanwhile are left for the next
        snapshot, and the snapshot is used only once its log rows are written.
        """
        last, covered = self.last_snapshot(spark)
        log = self.batch_log(spark)
        upto = {r["mode"]: r["b"] for r in log.where("ok").groupBy("mode").agg(F.max("batch_id").alias("b")).collect()}
        if S.REPLAY in upto and not subfolders(spark, self.batch_path("replay_marks", S.REPLAY, upto[S.REPLAY])):
            upto[S.REPLAY] -= 1  # committed, but its marks are still to be written
        if upto == covered:
            return
        snapshot = 0 if last is None else last + 1

        def fixed(rows: DataFrame) -> DataFrame:
            within = F.lit(False)
            for mode, until in upto.items():
                within = within | ((F.col("mode") == mode) & (F.col("batch_id") <= until))
            return rows.where(within)

        def put(rows: DataFrame, table: str, *by: str) -> None:
            rows.write.mode("overwrite").partitionBy(*by).parquet(self.path(f"snapshots/{snapshot}/{table}"))

        taken = fixed(self.documents(spark, covered)).unionByName(self._snapshot(spark, last, "documents", DOCUMENT_LOG))
        put(current_state(taken, order=NEWEST), "documents")
        if self.terms:
            recent = fixed(self._committed(spark, "terms", TERM_LOG, covered))
            before = self._snapshot(spark, last, "terms", TERM_LOG)
            put(_replaced(recent, before), "replaced")  # known first, so that terms are joined only if there are some
            replaced = self._snapshot(spark, snapshot, "replaced", REPLACED_LOG)
            current = before.unionByName(recent)
            if not replaced.isEmpty():
                current = _without_older(current, replaced)
            order = ["term", "kind", F.col("id").desc()]  # a frequent word is cut by id; terms differ early, kinds don't
            put(current.repartitionByRange(*order).sortWithinPartitions(*order), "terms")
        put(fixed(log).coalesce(1), "batch_log")
        ours = F.substring_index("batch_id", "-", 1).alias("mode"), F.substring_index("batch_id", "-", -1).cast("bigint").alias("batch_id")
        entries = self.dead_letters(spark).select(F.struct("*").alias("entry"), *ours)
        put(fixed(entries).select("entry.*"), "dead_letters", "status")
        said = spark.createDataFrame(list(upto.items()), "mode STRING, last_batch BIGINT")
        said.coalesce(1).write.mode("overwrite").parquet(self.path(f"snapshot_log/snapshot={snapshot}"))


def _replaced(recent: DataFrame, taken: DataFrame) -> DataFrame:
    """Newest row of each id that has older ones too, in a snapshot's terms and those of the batches since.

    Only ids that stand in those batches can have changed: their newest row is found from the ids among the terms,
    which are few and narrow, and no text is read.
    """
    version = F.struct(*NEWEST).alias("_newest")
    touched = recent.where("kind = 'id'").select("id", version)
    before = taken.where("kind = 'id'").select("id", version).join(touched.select("id").distinct(), "id", "left_semi")
    newest = touched.unionByName(before).groupBy("id").agg(F.max("_newest").alias("_newest"), F.min("_newest").alias("_oldest"))
    return newest.where("_newest != _oldest").select("id", "_newest.*")


def _without_older(terms: DataFrame, replaced: DataFrame) -> DataFrame:
    newest = replaced.select("id", F.struct(*NEWEST).alias("_newest"))
    kept = F.col("_newest").isNull() | (F.struct(*NEWEST) == F.col("_newest"))
    return terms.join(newest, "id", "left").where(kept).drop("_newest")


def _current_terms(recent: DataFrame, taken: DataFrame, asked: Column | None = None) -> DataFrame:
    """Terms of each id's newest row."""
    rows = taken.unionByName(recent)
    return _without_older(rows if asked is None else rows.where(asked), _replaced(recent, taken))


def feed_of(rows: DataFrame) -> DataFrame:
    """Events of stored rows: typed, and as the key and JSON text that a message sink takes."""
    return rows.select(
        event_id().alias("event_id"),
        F.col("id").alias("record_id"),
        "version",
        "seq",
        routing_key().alias("key"),
        event_json(F.col("emitted_at")).alias("value"),
        F.col("updated_at").alias("changed_at"),
        "mode",
        "batch_id",
    )
