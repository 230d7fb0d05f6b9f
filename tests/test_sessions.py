"""Sessions in batch and on a stream against plain Python."""

import datetime as dt
import json
import os
import random

import pytest

from basketry import schemas
from basketry.operators.sessions import user_sessions
from basketry.sources.files import read_parquet_dataset
from basketry.sources.streams import decode_events, text_source
from basketry.streaming.jobs import StreamSettings, await_all, layout, start_user_sessions

START = dt.datetime(2026, 1, 1)
GAP = dt.timedelta(minutes=10)


def brute(events):
    out, by = [], {}
    for user, _, _, kind, at in events:
        if user is not None and at is not None:
            by.setdefault(user, []).append((at, kind))
    for user, own in by.items():
        own.sort()
        held = []
        for at, kind in [*own, (dt.datetime.max, None)]:
            if held and at > held[-1][0] + GAP:
                n = [sum(k == x for _, k in held) for x in ("view", "purchase", "add_to_cart")]
                segment = "Buyer" if n[1] else "Cart_Abandoner" if n[2] else "Window_Shopper" if n[0] else "Unknown"
                out.append((held[0][0], held[-1][0] + GAP, user, len(held), *n, segment))
                held = []
            held.append((at, kind))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def events():
    """A user who never pauses holds a third of the events; gaps of exactly the length; equal times."""
    draw = random.Random(2)
    out = [("bot", "P", "x", "view", START + dt.timedelta(seconds=14 * i)) for i in range(1000)]
    for _ in range(2000):
        kind = draw.choice(["view", "view", "add_to_cart", "purchase", "signup"])
        out.append((f"U{draw.randrange(60)}", "P", "x", kind, START + dt.timedelta(minutes=5 * draw.randrange(48))))
    return out + [(None, "P", "x", "view", START), ("U1", "P", "x", "view", None)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_batch(spark, events):
    assert rows(user_sessions(spark.createDataFrame(events, schemas.EVENT), "10 minutes")) == brute(events)
    assert user_sessions(spark.createDataFrame([], schemas.EVENT)).collect() == []


def test_stream_over_many_batches_and_a_restart(spark, workdir, events):
    src, base = f"{workdir}/in", f"{workdir}/out"
    os.makedirs(src)
    timed = sorted((e for e in events if e[4]), key=lambda e: e[4])
    settings = StreamSettings(delay="30 minutes", trigger={"availableNow": True})

    def start(n):
        await_all([start_user_sessions(decode_events(text_source(spark, src, 1)), base, settings, "10 minutes", name=f"sessions-test-{n}")])

    for i in range(9):
        part = timed[i * len(timed) // 9 : (i + 1) * len(timed) // 9]
        random.Random(i).shuffle(part)
        path = f"{src}/{i}.json"
        with open(path, "w") as f:
            for user, product, category, kind, at in part:
                f.write(json.dumps({"user_id": user, "product_id": product, "category": category, "event_type": kind, "timestamp": at.isoformat() + "+00:00"}) + "\n")
        os.utime(path, (1_000_000 + i, 1_000_000 + i))
        if i == 4:
            start(1)
    start(2)
    until = timed[-1][4] - dt.timedelta(minutes=30)
    want = [s for s in brute(events) if s[1] <= until]
    assert rows(read_parquet_dataset(spark, layout(base)["sessions"], schemas.USER_SESSION)) == want and len(want) > 100
