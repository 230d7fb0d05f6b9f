"""Hot products from sketches equal the full count, whatever the sketches hold."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from basketry import schemas
from basketry.operators.hot_products import candidates, hot_products, merge_sketches, product_key, product_sketches, shortfall
from basketry.operators.windows import product_alerts
from basketry.plans.jobs import hot_products_job
from basketry.sources.files import read_parquet_dataset
from basketry.sources.streams import text_source, decode_events
from basketry.streaming.jobs import StreamSettings, await_all, layout, start_product_sketches, start_raw_ingest

WINDOW = "10 minutes"
START = dt.datetime(2026, 1, 1)


@pytest.fixture(scope="module")
def events(spark):
    """Three hours; one product holds a third, hundreds are rare, some keys hold nulls."""
    draw = random.Random(11)
    rows = []
    for i in range(9000):
        second = draw.randrange(3 * 3600)
        kind = draw.random()
        product = "hot" if kind < 0.33 else f"warm{draw.randrange(6)}" if kind < 0.6 else None if kind < 0.65 else f"rare{draw.randrange(400)}"
        rows.append((f"U{i}", product, draw.choice(["Toys", "Games", None]), "view", START + dt.timedelta(seconds=second)))
    return spark.createDataFrame(rows, schemas.EVENT)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize(("tracked", "threshold"), [(16, 40), (16, 8), (64, 20), (4096, 3)])
def test_equals_the_full_count(events, tracked, threshold):
    sketches = product_sketches(events, WINDOW, tracked)
    want = rows(product_alerts(events, WINDOW, threshold))
    assert want and rows(hot_products(sketches, events, WINDOW, threshold, tracked)) == want


def test_both_ways_are_taken(events):
    few = product_sketches(events, WINDOW, 16).select(shortfall().alias("short")).collect()
    many = product_sketches(events, WINDOW, 4096).select(shortfall().alias("short")).collect()
    assert any(r["short"] > 4 for r in few) and all(r["short"] == 0 for r in many)


def test_shortfall_bounds_what_a_sketch_lists(events):
    sketches = product_sketches(events, WINDOW, 16)
    sketches = sketches.unionByName(merge_sketches(sketches, F.lit(START).alias("window_start"), F.lit(None).cast("timestamp").alias("window_end"), tracked=16)
                                    .select("window_start", "window_end", "total_events", "sketch"))
    listed = {(r["window_end"], r["key"]): (r["estimate"], r["short"]) for r in candidates(sketches.withColumn("short", shortfall()), 16).collect()}
    short = {r["window_end"]: r["short"] for r in sketches.select("window_end", shortfall().alias("short")).collect()}
    counts = events.withColumn("key", product_key()).groupBy(F.window("timestamp", WINDOW)["end"].alias("window_end"), "key").count().collect()
    whole = events.withColumn("key", product_key()).groupBy("key").count().collect()
    for end, key, n in [tuple(r) for r in counts] + [(None, *r) for r in whole]:
        if n > 2 * short[end]:
            assert (end, key) in listed
        if (end, key) in listed:
            estimate, own = listed[end, key]
            assert estimate - own <= n <= estimate + own
    merged = [r for r in sketches.collect() if r["window_end"] is None]
    assert merged[0]["total_events"] == 9000


def test_late_rows_in_raw_are_counted(spark, events):
    late = spark.createDataFrame([("L", "rare1", "Toys", "view", START + dt.timedelta(seconds=5))] * 60, schemas.EVENT)
    raw = events.unionByName(late)
    sketches = product_sketches(events, WINDOW, 64)
    got = rows(hot_products(sketches, raw, WINDOW, 40, 64))
    assert got == rows(product_alerts(raw, WINDOW, 40)) and any(r[2] == "rare1" for r in got)


def test_edges(spark, events):
    none = product_sketches(events.limit(0), WINDOW)
    assert hot_products(none, events, WINDOW, 1).collect() == []
    timeless = spark.createDataFrame([("U", "a", "x", "view", None)] * 3, schemas.EVENT)
    assert hot_products(product_sketches(timeless, WINDOW), timeless, WINDOW, 1).collect() == []
    blank = spark.createDataFrame([("U", None, None, "view", START), ("U", "", "{", "view", START), ("U", '"', "\\", "view", START)] * 2, schemas.EVENT)
    assert rows(hot_products(product_sketches(blank, WINDOW), blank, WINDOW, 1)) == rows(product_alerts(blank, WINDOW, 1))


def test_stream_keeps_one_sketch_a_window(spark, workdir, events):
    src, base = f"{workdir}/in", f"{workdir}/out"
    os.makedirs(src)
    ordered = sorted(events.collect(), key=lambda r: r["timestamp"])
    for i in range(8):
        part = ordered[i * len(ordered) // 8 : (i + 1) * len(ordered) // 8]
        path = f"{src}/{i}.json"
        with open(path, "w") as f:
            for r in part:
                f.write(json.dumps({**r.asDict(), "timestamp": r["timestamp"].isoformat() + "+00:00"}) + "\n")
        os.utime(path, (1_000_000 + i, 1_000_000 + i))
    settings = StreamSettings(window=WINDOW, delay="10 minutes", trigger={"availableNow": True})
    stream = decode_events(text_source(spark, src, 1))
    query = start_product_sketches(stream, base, settings, 64, name="sketch-state")
    await_all([query])
    state = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    # Open windows only: those of the last batch and of the delay.
    assert len(state) >= 8 and max(state) <= 6
    await_all([start_raw_ingest(stream, base, settings, name="sketch-raw")])
    until = max(r["timestamp"] for r in ordered) - dt.timedelta(minutes=10)
    want = [r for r in rows(product_alerts(events, WINDOW, 30)) if r[1] <= until]
    assert want and rows(hot_products_job(spark, base, WINDOW, 30, 64)) == want
    assert read_parquet_dataset(spark, layout(base)["product_sketches"], schemas.PRODUCT_SKETCH).count() == len({r[0] for r in rows(product_alerts(events, WINDOW, 0)) if r[1] <= until})
