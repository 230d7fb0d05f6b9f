"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from basketry.functions.codec import (
    ISO_TIMESTAMP_FORMAT,
    decode_value,
    encode_value,
    format_iso,
    parse_timestamp,
)
from basketry.functions.rates import safe_rate
from basketry.functions.text import padded_id

__all__ = [
    "ISO_TIMESTAMP_FORMAT",
    "decode_value",
    "encode_value",
    "format_iso",
    "padded_id",
    "parse_timestamp",
    "safe_rate",
]
