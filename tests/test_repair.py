"""Repaired windows equal a count of all of raw, however the streams are cut and whichever runs first."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from basketry.operators.windows import category_window_metrics, product_window_metrics
from basketry.sources.files import read_parquet_dataset, read_raw_events
from basketry.sources.streams import decode_events, text_source
from basketry.streaming import repair
from basketry.streaming.jobs import (
    StreamSettings,
    await_all,
    layout,
    start_category_metrics,
    start_product_metrics,
    start_raw_ingest,
)

START = dt.datetime(2026, 1, 1, 23)
SETTINGS = StreamSettings(window="5 minutes", delay="5 minutes", trigger={"availableNow": True})


def line(second, product, category, kind="view"):
    return json.dumps({"user_id": "U1", "product_id": product, "category": category, "event_type": kind,
                       "timestamp": (START + dt.timedelta(seconds=second)).isoformat() + "+00:00"})


def put(src, n, lines):
    os.makedirs(src, exist_ok=True)
    path = f"{src}/{n:03d}.json"
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(path, (1_000_000 + n, 1_000_000 + n))


class Streams:
    def __init__(self, spark, workdir):
        self.spark, self.src, self.base, self.n = spark, f"{workdir}/in", f"{workdir}/out", 0

    def _run(self, starter, files):
        self.n += 1
        events = decode_events(text_source(self.spark, self.src, files))
        await_all([starter(events, self.base, SETTINGS, name=f"r{self.n}-{self.base.rsplit('-', 1)[-1]}")])

    def raw(self, files=1):
        self._run(start_raw_ingest, files)

    def metrics(self, files=1, starter=start_category_metrics):
        self._run(starter, files)

    def mend(self, files=2, output=repair.CATEGORY_METRICS):
        self.n += 1
        await_all([repair.start_window_repair(self.spark, self.base, SETTINGS, output, files, name=f"r{self.n}-{self.base.rsplit('-', 1)[-1]}")])

    def want(self, count=category_window_metrics):
        events = read_raw_events(self.spark, layout(self.base)["raw"]).filter("timestamp is not null")
        last = events.agg(F.max("timestamp")).head()[0]
        rows = count(events, SETTINGS.window).collect()
        return sorted((tuple(r) for r in rows if r.window_end <= last - dt.timedelta(minutes=5)), key=repr)

    def got(self, output=repair.CATEGORY_METRICS):
        return sorted(map(tuple, repair.repaired_metrics(self.spark, self.base, output).collect()), key=repr)


def messages(n_files, seed):
    """Three hours over midnight; a tenth of the rows come much too late, some categories are null, one is hot."""
    draw = random.Random(seed)
    files = [[] for _ in range(n_files)]
    for _ in range(1500):
        second = draw.randrange(3 * 3600)
        due = second * n_files // (3 * 3600)
        at = draw.randrange(due, n_files) if draw.random() < 0.1 else due
        category = draw.choice(["Hot", "Hot", "Hot", "Toys", "Games", None])
        files[at].append(line(second, f"P{draw.randrange(4)}", category, draw.choice(["view", "purchase"])))
    for f in files:
        draw.shuffle(f)
    return files


def test_a_late_row_is_counted_after_all(spark, workdir):
    s = Streams(spark, workdir)
    put(s.src, 1, [line(60, "P1", "Toys"), line(120, "P1", "Toys"), line(1200, "P1", "Toys")])
    put(s.src, 2, [line(1250, "P1", "Toys")])
    put(s.src, 3, [line(90, "P1", "Toys"), line(95, "P1", "Games"), line(1300, "P1", "Toys"), "broken"])
    s.raw(), s.metrics()
    plain = read_parquet_dataset(spark, layout(s.base)["category_metrics"], repair.CATEGORY_METRICS.schema).collect()
    assert [(r.category, r.total_events) for r in plain] == [("Toys", 2)]
    assert s.got() == sorted(map(tuple, plain), key=repr)  # no repairs yet
    s.mend(1)
    assert s.got() == s.want() and [(r[2], r[3]) for r in s.got()] == [("Games", 1), ("Toys", 3)]
    # Nothing new: nothing published twice.
    before = repair.published(spark, s.base)
    s.mend(1)
    assert repair.published(spark, s.base) == before


@pytest.mark.parametrize(("seed", "order"), [(1, "metrics first"), (2, "repair first"), (3, "in turns")])
def test_equals_a_full_count(spark, workdir, seed, order):
    s = Streams(spark, workdir)
    files = messages(8, seed)
    if order == "in turns":  # restarts of all three, each with batches of its own size
        for i, part in enumerate(files):
            put(s.src, i, part)
            if i in (2, 5, 7):
                s.raw(2)
                s.mend(5) if i == 5 else None
                s.metrics(1)
                s.mend(9)
    else:
        for i, part in enumerate(files):
            put(s.src, i, part)
        s.raw(1)
        if order == "metrics first":
            s.metrics(1), s.mend(12)
        else:
            s.mend(7), s.metrics(3)
    plain = read_parquet_dataset(spark, layout(s.base)["category_metrics"], repair.CATEGORY_METRICS.schema).collect()
    want = s.want()
    assert sorted(map(tuple, plain), key=repr) != want  # the window stream did drop rows
    assert s.got() == want and len(want) > 60


def test_product_windows_and_batches_that_run_again(spark, workdir):
    s = Streams(spark, workdir)
    for i, part in enumerate(messages(4, 5)):
        put(s.src, i, part)
    s.raw(1), s.metrics(1, start_product_metrics)
    output = repair.PRODUCT_METRICS
    s.mend(9, output)
    want = s.want(product_window_metrics)
    assert s.got(output) == want
    # The last batch fails before it is committed and runs again; a folder without its mark is never read.
    done = repair.published(spark, s.base, output)
    raw = read_raw_events(spark, layout(s.base)["raw"])
    again = repair.repair_batch(raw, done[-1].batch, s.base, output, SETTINGS.window, SETTINGS.delay)
    assert s.got(output) == want and repair.published(spark, s.base, output) == [*done[:-1], again]
    data = repair._folders(s.base, output)[0]
    wrong = spark.createDataFrame([(START, START, "P0", 99, 9, 9, 99)], output.versioned)
    wrong.write.parquet(f"{data}/unpublished")
    assert s.got(output) == want


def test_only_days_of_touched_windows_are_read(spark, workdir):
    s = Streams(spark, workdir)
    put(s.src, 1, [line(60, "P1", "Toys"), line(2 * 86400, "P1", "Toys")])
    s.raw(1), s.metrics(1)
    put(s.src, 2, [line(70, "P1", "Toys")])
    s.raw(1)
    s.mend(1)
    assert s.got() == s.want()
    held = repair.versions(spark, s.base).collect()
    assert {r.window_start.day for r in held} == {1}
