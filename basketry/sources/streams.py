"""Streaming sources of encoded events and their decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.codec import decode_value, encode_value, parse_timestamp
from basketry.schemas import EVENT


def kafka_source(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    extra_options: dict[str, str] | None = None,
) -> DataFrame:
    """Kafka topic as a stream of ``value`` (binary) rows. Needs the Kafka
    connector on the classpath."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    for key, value in (extra_options or {}).items():
        reader = reader.option(key, value)
    return reader.load().select("value")


def text_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Folder of JSON-lines files as a stream of ``value`` (string) rows:
    the same column a Kafka source yields, used for tests and backfills."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.text(path)


def parquet_event_source(spark: SparkSession, path: str, glob: str = "*.parquet",
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """Folder of typed event Parquet files as a stream (already decoded rows
    with the event schema, e.g. a replay of a raw dataset)."""
    reader = spark.readStream.schema(EVENT).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def decode_events(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Message rows to typed events (user_id, product_id, category,
    event_type, timestamp). Malformed messages become rows of nulls and are
    kept; a bad timestamp text becomes null."""
    parsed = messages.select(decode_value(value_col).alias("data")).select("data.*")
    return parsed.withColumn("timestamp", parse_timestamp("timestamp"))


def encode_events(events: DataFrame) -> DataFrame:
    """Typed events to one ``value`` JSON text per event (publishable with
    ``write.format("kafka")``)."""
    return events.select(encode_value().alias("value"))


def event_date(events: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Adds the event-date partition column."""
    return events.withColumn("event_date", F.to_date(F.col(time_col)))
