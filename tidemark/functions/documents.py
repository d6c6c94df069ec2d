"""Document, event and key expressions for a replicated row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import schema as S


def payload_or_empty(payload="payload") -> Column:
    return F.coalesce(F.col(payload), F.lit(S.EMPTY_PAYLOAD))


def payload_object(payload="payload") -> Column:
    """The payload as a JSON value, so that it nests as an object and not as quoted text.

    Text that is not JSON is kept as a JSON string; nothing is lost.
    """
    text = payload_or_empty(payload)
    return F.coalesce(F.try_parse_json(text), text.cast("variant"))


def iso(ts: str) -> Column:
    """ISO-8601 text with milliseconds; the session time zone must be UTC."""
    return F.date_format(F.col(ts), S.ISO_FORMAT)


def document_fields(payload: Column) -> list[Column]:
    return [
        F.col("id"),
        F.col("email"),
        F.col("name"),
        payload.alias("payload"),
        F.col("version"),
        F.coalesce(F.col("poison"), F.lit(False)).alias("poison"),
        iso("updated_at").alias("updated_at"),
        iso("created_at").alias("created_at"),
    ]


def document() -> Column:
    """The sink document of a row as a struct, payload kept as text."""
    return F.struct(*document_fields(payload_or_empty()))


def document_json() -> Column:
    """The sink document of a row as JSON text with a nested payload."""
    return F.to_json(F.struct(*document_fields(payload_object())))


def to_documents(rows: DataFrame, *also: str) -> DataFrame:
    return rows.select(*document_fields(payload_or_empty()), *also)


def event_id(record_id="id", version="version") -> Column:
    return F.concat_ws(S.EVENT_KEY_SEPARATOR, F.col(record_id), F.col(version))


def routing_key(record_id="id") -> Column:
    return F.concat(F.lit(S.ROUTING_PREFIX), F.col(record_id).cast("string"))


def event_json(emitted_at: Column) -> Column:
    """The change-feed message body. ``emitted_at`` is given, so that a redo writes the same text."""
    return F.to_json(
        F.struct(
            event_id().alias("event_id"),
            F.col("id").alias("record_id"),
            F.col("version"),
            F.struct(*document_fields(payload_object())).alias("document"),
            F.date_format(emitted_at, S.ISO_FORMAT).alias("emitted_at"),
        )
    )
