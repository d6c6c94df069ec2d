"""Table layouts and the values that results depend on."""

from __future__ import annotations

from datetime import datetime

RECORDS = (
    "id BIGINT, email STRING, name STRING, payload STRING, version BIGINT, "
    "poison BOOLEAN, updated_at TIMESTAMP_NTZ, created_at TIMESTAMP_NTZ"
)
CHECKPOINTS = "mode STRING, cursor_id BIGINT, cursor_ts TIMESTAMP_NTZ"
DEAD_LETTERS = (
    "id BIGINT, record_id BIGINT, version BIGINT, batch_id STRING, sink STRING, "
    "payload STRING, error STRING, status STRING, created_at TIMESTAMP_NTZ, "
    "replayed_at TIMESTAMP_NTZ"
)
CONSUMED = (
    "event_id STRING, record_id BIGINT, version BIGINT, duplicate_hits BIGINT, "
    "first_seq BIGINT"
)
DOCUMENT = (
    "id BIGINT, email STRING, name STRING, payload STRING, version BIGINT, "
    "poison BOOLEAN, updated_at STRING, created_at STRING"
)
EVENT = "event_id STRING, record_id BIGINT, version BIGINT"
BATCH_LOG = (
    "mode STRING, batch_id BIGINT, attempt BIGINT, attempted_at TIMESTAMP_NTZ, ok BOOLEAN, "
    "rows BIGINT, rejected BIGINT, cursor_id BIGINT, cursor_ts TIMESTAMP_NTZ, read_id BIGINT, "
    "read_ts TIMESTAMP_NTZ, last_seq BIGINT, owner STRING, number BIGINT, since TIMESTAMP_NTZ, error STRING"
)

RECORD_COLUMNS = [c.split()[0] for c in RECORDS.split(", ")]

# Results must carry exactly these.
BACKFILL = "backfill"
INCREMENTAL = "incremental"
REPLAY = "replay"
EPOCH = datetime(1970, 1, 1)
GUARANTEE = "effectively-once"
DEFAULT_SINK = "elasticsearch"
EMPTY_PAYLOAD = "{}"
EVENT_KEY_SEPARATOR = ":"
ROUTING_PREFIX = "record."
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
POISON_ERROR = "fail_processor_exception: poison record rejected by ingest pipeline"
MISSING_RESULT_ERROR = "missing item result"
STATUS_OPEN = "open"
STATUS_REPLAYED = "replayed"
RECENT_KEPT = 200
RECENT_SHOWN = 50
SEARCH_SHOWN = 50
DEAD_LETTERS_SHOWN = 100
BATCH_ROWS = 500
THROUGHPUT_KEPT = "120 seconds"
# End of fixed values.

MODES = (BACKFILL, INCREMENTAL, REPLAY)  # a dead letter's id says in its last two bits which it is from
