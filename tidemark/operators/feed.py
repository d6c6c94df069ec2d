"""The append-only change feed: one event per row of a batch, rejected rows included."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import schema as S
from tidemark.functions.documents import document, event_id, event_json, routing_key


def feed_messages(rows: DataFrame, emitted_at: Column) -> DataFrame:
    """Key and JSON value of each event, in the shape a message sink takes."""
    return rows.select(routing_key().alias("key"), event_json(emitted_at).alias("value"))


def feed_events(rows: DataFrame, emitted_at: Column) -> DataFrame:
    """The same events as typed columns, with the document nested."""
    return rows.select(
        event_id().alias("event_id"),
        F.col("id").alias("record_id"),
        "version",
        document().alias("document"),
        F.date_format(emitted_at, S.ISO_FORMAT).alias("emitted_at"),
    )


def parsed_messages(messages: DataFrame) -> DataFrame:
    """Messages with the fields of their event beside them, ``_readable``, and the text of those that are not.

    The text is parsed by a generator: what is asked of its fields is not put into the parsing, which
    would then be done once for each field.
    """
    fields = [f"_{c.split()[0]}" for c in S.EVENT.split(", ")]
    parsed = messages.select("*", F.inline(F.array(F.from_json("value", S.EVENT))).alias(*fields))
    readable = reduce(and_, [F.col(f).isNotNull() for f in fields])
    flagged = parsed.withColumn("_readable", readable)
    return flagged.withColumn("value", F.when(~F.col("_readable"), F.col("value")))


def split_messages(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed messages as events, and the messages that cannot be read as one."""
    names = [c.split()[0] for c in S.EVENT.split(", ")]
    given = [c for c in parsed.columns if c != "_readable" and c not in [f"_{n}" for n in names]]
    fields = [F.col(f"_{n}").alias(n) for n in names]
    events = parsed.where("_readable").select(*fields, *[c for c in given if c != "value"])
    return events, parsed.where("NOT _readable").select(*given)


def parse_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split messages into events and those that cannot be read as one, which are kept whole."""
    return split_messages(parsed_messages(messages))


def changes(rows: DataFrame, mode: Column) -> DataFrame:
    """Who changed, to which version, when and by which mode."""
    return rows.select(
        F.col("updated_at").alias("changed_at"),
        F.col("id").alias("record_id"),
        "version",
        mode.alias("mode"),
        *[c for c in ("batch_id", "seq") if c in rows.columns],
    )


def recent_changes(feed: DataFrame, limit: int = S.RECENT_SHOWN) -> DataFrame:
    """The newest changes, last row of the last batch first; no more than are kept."""
    return (
        feed.orderBy(F.col("batch_id").desc(), F.col("seq").desc())
        .limit(min(limit, S.RECENT_KEPT))
        .select("changed_at", "record_id", "version", "mode")
    )
