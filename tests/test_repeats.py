"""Repeated messages count once in the windows; raw keeps them all."""

import json
import os

from basketry import schemas
from basketry.operators.repeats import drop_repeats
from basketry.sources.files import read_csv_report, read_parquet_dataset, read_raw_events
from basketry.sources.streams import text_source
from basketry.streaming.jobs import StreamSettings, layout, run_available_now

EVENT = {"user_id": "U1", "product_id": "P1", "category": "Toys", "event_type": "view"}


def message(minute, micros=0, **other):
    return json.dumps(EVENT | {"timestamp": f"2026-01-01T00:{minute:02d}:00.{micros:06d}+00:00"} | other)


def put(src, n, lines):
    path = f"{src}/{n:03d}.json"
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(path, (1_000_000 + n, 1_000_000 + n))


def run(spark, src, base, drop=True):
    settings = StreamSettings(window="5 minutes", delay="5 minutes", alert_threshold=1, drop_repeats=drop)
    run_available_now(text_source(spark, src, 1), base, settings)
    found = read_parquet_dataset(spark, layout(base)["category_metrics"], schemas.CATEGORY_WINDOW_METRICS).collect()
    return sorted((r.window_start.minute, r.total_events, r.views) for r in found)


def test_repeats_within_and_across_batches_and_restarts(spark, workdir):
    src, base = f"{workdir}/in", f"{workdir}/out"
    os.makedirs(src)
    put(src, 1, [message(1)] * 3 + [message(2), message(1, 1), message(1, user_id="U2"), message(1, user_id=None)])
    put(src, 2, [message(1), message(2), message(6)])  # copies of the batch before
    run(spark, src, base)
    put(src, 3, [message(6), message(1), message(12)])  # copies after a restart
    put(src, 4, [message(1), message(30)])  # a copy behind the watermark
    got = run(spark, src, base)
    # Minute 1 three users' worth and its microsecond neighbour, minute 2.
    assert got == [(0, 5, 5), (5, 1, 1), (10, 1, 1)]
    assert read_raw_events(spark, layout(base)["raw"]).count() == 15
    alerts = read_csv_report(spark, layout(base)["alerts"], schemas.PRODUCT_ALERT).collect()
    assert [(r.window_start.minute, r.event_count) for r in alerts] == [(0, 5)]
    products = read_parquet_dataset(spark, layout(base)["product_metrics"], schemas.PRODUCT_WINDOW_METRICS).collect()
    assert sum(r.total_events for r in products) == 7


def test_without_the_setting_copies_count(spark, workdir):
    src, base = f"{workdir}/in", f"{workdir}/out"
    os.makedirs(src)
    put(src, 1, [message(1)] * 3 + [message(30)])
    assert run(spark, src, base, drop=False) == [(0, 3, 3)]


def test_a_message_repeated_very_often(spark, workdir):
    src, base = f"{workdir}/in", f"{workdir}/out"
    os.makedirs(src)
    for n in range(5):
        put(src, n, [message(1)] * 400 + [message(2, n)])
    put(src, 9, [message(30)])
    assert run(spark, src, base) == [(0, 6, 6)]


def test_batch_form(spark):
    rows = [("U1", "P1", "Toys", "view", "2026-01-01 00:00:00.000001"), ("U1", "P1", "Toys", "view", "2026-01-01 00:00:00.000001"),
            ("U1", "P1", "Toys", "view", "2026-01-01 00:00:00.000002"), ("U1", None, "Toys", "view", "2026-01-01 00:00:00.000001"),
            ("U1", "Toys", None, "view", "2026-01-01 00:00:00.000001"), ("U1", "P1", "Toys", "view", None)]
    df = spark.createDataFrame(rows, "user_id string, product_id string, category string, event_type string, timestamp string")
    got = drop_repeats(df.withColumn("timestamp", df["timestamp"].cast("timestamp")))
    assert got.columns == df.columns and got.count() == 4
