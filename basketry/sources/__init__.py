"""Readers: raw/processed datasets, catalog CSV, stream sources and the
mapping of the generated test tables to shop events."""

from basketry.sources.files import (
    read_catalog_csv,
    read_csv_report,
    read_parquet_dataset,
    read_raw_events,
)
from basketry.sources.streams import (
    decode_events,
    encode_events,
    event_date,
    kafka_source,
    parquet_event_source,
    text_source,
)

__all__ = [
    "decode_events",
    "encode_events",
    "event_date",
    "kafka_source",
    "parquet_event_source",
    "read_catalog_csv",
    "read_csv_report",
    "read_parquet_dataset",
    "read_raw_events",
    "text_source",
]
