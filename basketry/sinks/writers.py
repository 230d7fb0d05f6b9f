"""Batch sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header, overwriting ``path``. An empty frame still writes a
    header-only file. ``single_file`` merges to one part file: use it only
    for aggregated, group-cardinality results."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", "true").csv(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """A ``(line_no, line)`` frame (a small report) as one ordered text file."""
    ordered = lines.repartition(1).sortWithinPartitions("line_no").select("line")
    ordered.write.mode("overwrite").text(path)


def write_segments(segments: DataFrame, base_dir: str, as_of: dt.date | str) -> str:
    """User segments of one day under ``user_segments/run_date=YYYY-MM-DD``
    (user-cardinality output: written by all tasks in parallel)."""
    day = as_of.strftime("%Y-%m-%d") if isinstance(as_of, (dt.date, dt.datetime)) else str(as_of)
    path = f"{base_dir.rstrip('/')}/user_segments/run_date={day}"
    write_csv(segments.select("user_id", "segment"), path)
    return path


def write_raw_events(events: DataFrame, path: str, mode: str = "replace_partitions") -> None:
    """Typed events as Parquet partitioned by event date and category, so a
    daily job reads one date folder.

    The default rewrites only the (date, category) folders present in
    ``events`` and keeps the others: re-running a day's ingest after a
    failure or for a backfill neither duplicates nor loses rows. Other modes
    (``append``, ``overwrite``) are Spark's own."""
    out = events if "event_date" in events.columns else events.withColumn("event_date", F.to_date("timestamp"))
    writer = out.write.partitionBy("event_date", "category")
    if mode == "replace_partitions":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    writer.parquet(path)


def publish_events(events: DataFrame, bootstrap_servers: str, topic: str,
                   extra_options: dict[str, str] | None = None) -> None:
    """Typed events as JSON messages (no key) on a Kafka topic; needs the
    Kafka connector on the classpath. Encoding is
    :func:`basketry.sources.streams.encode_events`."""
    from basketry.sources.streams import encode_events

    writer = (encode_events(events).write.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic))
    for key, value in (extra_options or {}).items():
        writer = writer.option(key, value)
    writer.save()
