"""The message folders over events that span many days: files, order and counts."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from basketry.plans.registry import QUERIES
from basketry.sources.testdata import EVENTS_SCHEMA, LEAST_FILES, PART_SCHEMA, _slices, disordered_folder, message_folder, repeated_folder

DAYS = 200


@pytest.fixture()
def long_span(spark, workdir):
    start = dt.datetime(2023, 12, 1)
    rows = [(i, start + dt.timedelta(hours=12 * i), i % 30, "view", 1.0, f'{{"k": {i % 4}}}') for i in range(2 * DAYS)]
    spark.createDataFrame(rows, EVENTS_SCHEMA).write.parquet(f"{workdir}/events.parquet")
    parts = [(k, "n", "b", f"type {k}", 1, 1.0) for k in range(3)]
    spark.createDataFrame(parts, PART_SCHEMA).write.parquet(f"{workdir}/part.parquet")
    return workdir


def _files(folder):
    return [f for f in os.listdir(folder) if f.startswith("part-")]


def test_message_files_follow_the_messages_not_the_folders(spark, long_span):
    # One split a raw file, as in a session with small splits.
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        folders = [message_folder(spark, long_span), disordered_folder(spark, long_span), repeated_folder(spark, long_span)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(_files(folders[0])) <= LEAST_FILES + 2
    assert len(_files(folders[1])) <= 2 * LEAST_FILES
    assert len(_files(folders[2])) <= 3 * LEAST_FILES + 6
    assert spark.read.text(folders[0]).count() == 2 * DAYS


def test_windows_of_a_long_span_are_all_counted(spark, long_span):
    # Two events a day; the windows that end within the five days before the last event stay open, its own included.
    rows = QUERIES["stream_category_metrics"](spark, long_span).collect()
    assert sum(r.total_events for r in rows) == 2 * DAYS - 11
    repeated = QUERIES["stream_repeated_metrics"](spark, long_span).collect()
    assert sorted(map(tuple, repeated)) == sorted(map(tuple, rows))


def test_empty_events_give_an_empty_folder(spark, workdir):
    spark.createDataFrame([], EVENTS_SCHEMA).write.parquet(f"{workdir}/events.parquet")
    spark.createDataFrame([], PART_SCHEMA).write.parquet(f"{workdir}/part.parquet")
    assert spark.read.text(message_folder(spark, workdir, categorized=False)).count() == 0


def test_stream_reads_a_catalog_normalised_once(spark, long_span, monkeypatch):
    from basketry.plans import registry

    seen = []
    enrich = registry.enrich_with_catalog
    monkeypatch.setattr(registry, "enrich_with_catalog", lambda events, catalog: seen.append(catalog) or enrich(events, catalog))
    rows = QUERIES["stream_catalog_enrich"](spark, long_span)
    assert rows.count() == 2 * DAYS
    # A scan: no micro-batch groups the catalog's lines again.
    assert "Aggregate" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
    # One file a micro-batch: about four, whatever the span.
    assert len(_files(message_folder(spark, long_span, categorized=False))) <= 6


def test_many_messages_give_few_micro_batches(spark):
    # 36 million events, 360 times those of sf0.1 over as many days: every state partition of every micro-batch costs the driver 33 KB.
    second = F.lit(1704067200) + F.col("id") % F.lit(30 * 86400)
    parts = _slices(spark.range(36_000_000).select(F.timestamp_seconds(second).alias("timestamp")))
    files = sum(-(-part.count() // per_file) for part, per_file in parts)
    assert LEAST_FILES <= files <= LEAST_FILES + len(parts)
