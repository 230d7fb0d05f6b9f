"""Catalog versions as of an event's time, against plain Python."""

import datetime as dt
import random

import pytest

from basketry import schemas
from basketry.operators.as_of import catalog_as_of

START = dt.datetime(2026, 1, 1)


def brute(events, versions):
    out = []
    for user, product, _, kind, at in events:
        held = [(t, c or "") for p, t, c in versions if p is not None and t is not None and at is not None and p == product and t <= at]
        out.append((user, product, kind, at, (max(held)[1] if held else "") or "UNKNOWN"))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def data():
    """A week; one product holds a third of the events, a third of that in one hour; versions at event times too."""
    draw = random.Random(3)
    events, versions = [], []
    for i in range(3000):
        product = "hot" if i % 3 == 0 else f"P{draw.randrange(20)}" if i % 50 else None
        second = draw.randrange(3600) if i % 9 == 0 else draw.randrange(7 * 86400)
        events.append((f"U{i % 40}", product, "old", "view", START + dt.timedelta(seconds=second)))
    events += events[:30] + [("U1", "hot", "old", "view", None), ("U1", "never", "old", "view", START)]
    for p in ["hot", *[f"P{j}" for j in range(0, 20, 2)]]:
        for n in range(draw.randrange(1, 40)):
            versions.append((p, START + dt.timedelta(seconds=draw.randrange(-86400, 8 * 86400)), None if n % 7 == 3 else f"C{n}"))
    for e in events[:200]:
        versions.append((e[1], e[4], f"at{e[0]}"))
    versions += [("hot", None, "x"), (None, START, "x"), ("unseen", START, "x"), ("hot", START, "A"), ("hot", START, "B")]
    return events, versions


def frames(spark, events, versions):
    return spark.createDataFrame(events, schemas.EVENT), spark.createDataFrame(versions, "product_id string, valid_from timestamp, category string")


@pytest.mark.parametrize(("length", "split"), [("1 day", 1 << 20), ("1 hour", 1 << 20), ("1 day", 20), ("30 days", 100)])
def test_equals_brute_force(spark, data, length, split):
    events, versions = data
    got = catalog_as_of(*frames(spark, events, versions), length, split_rows=split)
    assert got.columns == ["user_id", "product_id", "event_type", "timestamp", "category"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(events, versions)


def test_edges(spark, data):
    events, versions = data
    assert catalog_as_of(*frames(spark, [], versions)).collect() == []
    got = catalog_as_of(*frames(spark, events, []), default=None)
    assert got.count() == len(events) and got.filter("category is not null").isEmpty()
    # Columns with the names used inside.
    e, v = frames(spark, events[:50], versions)
    clash = e.selectExpr("*", "'a' as slice", "'b' as version", "'c' as kind", "'d' as micros", "'e' as salt", "'f' as event")
    found = catalog_as_of(clash, v)
    assert found.select("slice", "version", "kind", "micros", "salt", "event").distinct().count() == 1
    assert sorted(map(tuple, found.select("user_id", "product_id", "event_type", "timestamp", "category").collect()), key=repr) == brute(events[:50], versions)


def test_no_range_join_and_no_python(spark, data):
    plan = catalog_as_of(*frames(spark, *data))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan and "Python" not in plan
