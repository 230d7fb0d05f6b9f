"""Anomaly alerts: native batch form, keyed-state stream and plain Python agree."""

import datetime as dt
import json
import os
import random
from collections import Counter, defaultdict
from statistics import median

import pytest
from pyspark.sql import functions as F

from basketry import schemas
from basketry.operators.anomalies import AnomalyRule, product_counts, window_anomalies
from basketry.sources.files import read_parquet_dataset
from basketry.sources.streams import decode_events, text_source
from basketry.streaming.anomalies import start_anomaly_alerts
from basketry.streaming.jobs import StreamSettings, await_all, layout

WINDOW, LENGTH = "10 minutes", 600
START = dt.datetime(2026, 1, 1)
RULE = AnomalyRule(history=6, min_history=3, horizon=12, silent=4, sensitivity=2.0, min_spread=1.0, min_baseline=1.0)


def brute(events, rule=RULE, until=None):
    """events: (second, product, category). Rows as (start, end, product, category, kind, count, baseline, spread, windows)."""
    counts = defaultdict(Counter)
    for second, product, category in events:
        if product is not None:
            counts[product, category][second // LENGTH] += 1
    out = []
    for (product, category), own in counts.items():
        windows = sorted(w for w in own if until is None or (w + 1) * LENGTH <= until)

        def base(at, through, windows=windows, own=own):
            held = [own[w] for w in windows if at - rule.horizon <= w < at + through][-rule.history :]
            middle = median(held) if held else 0
            return len(held), float(middle), float(median([abs(c - middle) for c in held])) if held else 0.0

        for i, w in enumerate(windows):
            n, middle, spread = base(w, 0)
            limit = rule.sensitivity * max(spread, rule.min_spread)
            if n >= rule.min_history and abs(own[w] - middle) > limit:
                out.append((w, w + 1, product, category, "spike" if own[w] > middle else "drop", own[w], middle, spread, n))
            n, middle, spread = base(w, 1)
            told = w + 1 + rule.silent
            over = windows[i + 1] >= told if i + 1 < len(windows) else until is not None and told * LENGTH <= until
            if n >= rule.min_history and middle >= rule.min_baseline and over:
                out.append((w + 1, told, product, category, "silence", 0, middle, spread, n))
    return sorted(out, key=repr)


def rows(df):
    number = lambda t: round((t - START).total_seconds()) // LENGTH
    return sorted(((number(r[0]), number(r[1]), *r[2:]) for r in map(tuple, df.collect())), key=repr)


@pytest.fixture(scope="module")
def events():
    """Sixty windows: steady, bursting, fading and returning products; one holds a third of all events."""
    draw = random.Random(7)
    out = []
    for w in range(60):
        at = lambda: w * LENGTH + draw.randrange(LENGTH)  # noqa: E731, B023
        for product, n in (("calm", 3), ("burst", 30 if w in (20, 41) else 4), ("fade", 0 if 25 <= w < 33 or w > 50 else 5),
                           ("rare", int(w % 15 == 0)), ("hot", draw.randint(35, 60) if w != 30 else 2), ("noise", draw.randint(0, 9))):
            out += [(at(), product, "Toys") for _ in range(n)]
        out += [(at(), "calm", "Games") for _ in range(2)] + [(at(), None, "UNKNOWN")]
    return out


def frame(spark, events):
    made = [("U1", p, c, "view", START + dt.timedelta(seconds=s)) for s, p, c in events]
    return spark.createDataFrame(made, schemas.EVENT)


def test_batch_equals_brute_force(spark, events):
    counts = product_counts(frame(spark, events), WINDOW)
    got = rows(window_anomalies(counts, WINDOW, RULE))
    assert got == brute(events)
    assert {r[4] for r in got} == {"spike", "drop", "silence"}
    until = START + dt.timedelta(seconds=58 * LENGTH)
    closed = counts.filter(F.col("window.end") <= F.lit(until))
    assert rows(window_anomalies(closed, WINDOW, RULE, until=F.lit(until))) == brute(events, until=58 * LENGTH)


def test_edges(spark):
    assert window_anomalies(product_counts(frame(spark, []), WINDOW), WINDOW, RULE).collect() == []
    only = frame(spark, [(5, None, "x"), (5, "a", None), (6, "a", None)])
    assert window_anomalies(product_counts(only, WINDOW), WINDOW, RULE).collect() == []
    # A product without a category is a key of its own.
    null_key = [(w * LENGTH, "a", None) for w in range(5)] + [(5 * LENGTH, "a", None)] * 9
    assert rows(window_anomalies(product_counts(frame(spark, null_key), WINDOW), WINDOW, RULE)) == brute(null_key)
    for bad in ({"min_history": 0}, {"history": 3, "min_history": 4}, {"silent": 0}, {"silent": 9, "horizon": 8}):
        with pytest.raises(ValueError):
            AnomalyRule(**bad)


def run(spark, workdir, events, batches, restart_after=None):
    """Events in order of time, dealt to files of unequal size, one file a micro-batch."""
    src, base = f"{workdir}/in", f"{workdir}/out"
    os.makedirs(src)
    settings = StreamSettings(window=WINDOW, delay="20 minutes", trigger={"availableNow": True})
    ordered = sorted(events, key=lambda e: e[0])
    draw = random.Random(batches)
    cuts = [0, *sorted(draw.sample(range(1, len(ordered)), batches - 1)), len(ordered)]

    def start():
        stream = decode_events(text_source(spark, src, 1))
        await_all([start_anomaly_alerts(stream, base, settings, RULE, name=f"anomalies-{batches}-{len(os.listdir(src))}")])

    for i in range(batches):
        part = ordered[cuts[i] : cuts[i + 1]]
        draw.shuffle(part)
        lines = [json.dumps({"user_id": "U1", "product_id": p, "category": c, "event_type": "view",
                             "timestamp": (START + dt.timedelta(seconds=s)).isoformat() + "+00:00"}) for s, p, c in part]
        path = f"{src}/{i:03d}.json"
        with open(path, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(path, (1_000_000 + i, 1_000_000 + i))
        if i == restart_after:
            start()
    start()
    return read_parquet_dataset(spark, layout(base)["anomalies"], schemas.ANOMALY)


@pytest.mark.parametrize(("batches", "restart_after"), [(3, None), (14, 6)])
def test_stream_equals_batch_however_it_is_cut(spark, workdir, events, batches, restart_after):
    until = max(s for s, _, _ in events) - 1200
    found = run(spark, workdir, events, batches, restart_after)
    want = [r for r in brute(events, until=until)]
    assert rows(found) == want and any(r[4] == "silence" and r[2] == "fade" and r[0] > 40 for r in want)


def test_state_ends_with_the_horizon(spark, workdir):
    # Counts older than the horizon are forgotten: the late burst has no baseline.
    early = [(w * LENGTH + 1, "a", "x") for w in range(5)]
    burst = [(40 * LENGTH + i, "a", "x") for i in range(50)]
    others = [(w * LENGTH + 2, "clock", "x") for w in range(60)]
    found = run(spark, workdir, early + burst + others, 12)
    assert rows(found) == brute(early + burst + others, until=59 * LENGTH + 2 - 1200)
    assert not [r for r in rows(found) if r[2] == "a" and r[4] == "spike"]
