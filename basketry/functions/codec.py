"""Wire format of events: one JSON object per message, all fields text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from basketry.schemas import WIRE_EVENT

# Fixed value: ISO-8601 with microseconds and a numeric UTC offset
# (e.g. 2026-01-02T03:04:05.678901+00:00).
ISO_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"

WIRE_FIELDS = [f.name for f in WIRE_EVENT.fields]


def parse_timestamp(text: Column | str) -> Column:
    """ISO-8601 text (with or without fraction / offset) to ``timestamp``.
    Unparseable text gives null instead of failing the job under ANSI mode."""
    col = F.col(text) if isinstance(text, str) else text
    return col.try_cast("timestamp")


def format_iso(ts: Column | str) -> Column:
    """Timestamp to ISO-8601 text in the session zone, microseconds kept."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(col, ISO_TIMESTAMP_FORMAT)


def decode_value(value: Column | str) -> Column:
    """Message payload (binary or string) to a struct of the wire schema.

    Permissive: malformed JSON gives a struct of nulls, numbers or objects in
    a string field come back as their JSON text, extra fields are dropped."""
    col = F.col(value) if isinstance(value, str) else value
    return F.from_json(col.cast("string"), WIRE_EVENT)


def encode_value(
    user_id: Column | str = "user_id",
    product_id: Column | str = "product_id",
    category: Column | str = "category",
    event_type: Column | str = "event_type",
    timestamp: Column | str = "timestamp",
) -> Column:
    """Typed event columns to the JSON text of one message. Nulls are kept
    as ``null`` fields; the timestamp is written with microseconds."""
    cols = [user_id, product_id, category, event_type]
    cols = [F.col(c) if isinstance(c, str) else c for c in cols]
    ts = format_iso(timestamp)
    payload = F.struct(*[c.alias(n) for c, n in zip(cols + [ts], WIRE_FIELDS)])
    return F.to_json(payload, {"ignoreNullFields": "false"})
