"""Ordered funnel against plain Python; a hot user, equal times, steps over slice borders."""

import datetime as dt
import random

import pytest

from basketry import schemas
from basketry.operators.ordered_funnel import follow_views, ordered_funnel

START = dt.datetime(2026, 1, 1)


def brute(events, horizon):
    by = {}
    for user, product, _, kind, at in events:
        if user is not None and product is not None and at is not None:
            by.setdefault((user, product, kind), []).append(at)
    out = []
    for user, product, category, kind, at in events:
        if kind != "view" or user is None or product is None or at is None:
            continue
        after = lambda kind, t: min((x for x in by.get((user, product, kind), []) if t < x <= at + horizon), default=None)  # noqa: E731, B023
        cart = after("add_to_cart", at)
        out.append((user, product, category, at, cart, cart and after("purchase", cart)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def events():
    draw = random.Random(9)
    out = []
    for i in range(1500):
        user = "bot" if i % 3 == 0 else f"U{draw.randrange(12)}"
        product = "P0" if user == "bot" else f"P{draw.randrange(4)}"
        kind = draw.choice(["view", "view", "add_to_cart", "purchase", "signup"])
        # Times on a coarse grid: many are equal, and many lie on borders of slices.
        out.append((user, product, f"C{draw.randrange(3)}", kind, START + dt.timedelta(minutes=10 * draw.randrange(600))))
    return out + [(None, "P0", "C", "view", START), ("U1", None, "C", "view", START), ("U1", "P1", "C", "view", None), ("U1", "P1", None, "view", START)]


@pytest.mark.parametrize(("text", "horizon"), [("1 hour", dt.timedelta(hours=1)), ("30 minutes", dt.timedelta(minutes=30)), ("40 days", dt.timedelta(days=40))])
def test_equals_brute_force(spark, events, text, horizon):
    df = spark.createDataFrame(events, schemas.EVENT)
    want = brute(events, horizon)
    assert sorted(map(tuple, follow_views(df, text).collect()), key=repr) == want
    assert any(r[5] for r in want) and any(r[4] and not r[5] for r in want)
    got = {r["category"]: r for r in ordered_funnel(df, text).collect()}
    for category, r in got.items():
        own = [w for w in want if w[2] == category]
        assert (r["views"], r["carted"], r["purchased"]) == (len(own), sum(w[4] is not None for w in own), sum(w[5] is not None for w in own))


def test_order_matters(spark):
    t = [START + dt.timedelta(minutes=m) for m in range(6)]
    rows = [("A", "P", "x", "purchase", t[0]), ("A", "P", "x", "add_to_cart", t[1]), ("A", "P", "x", "view", t[2]),
            ("B", "P", "x", "view", t[0]), ("B", "P", "x", "add_to_cart", t[0]), ("B", "P", "x", "purchase", t[1]),
            ("C", "P", "x", "view", t[0]), ("C", "P", "x", "add_to_cart", t[1]), ("C", "P", "x", "purchase", t[2]),
            ("C", "Q", "x", "purchase", t[3])]
    [r] = ordered_funnel(spark.createDataFrame(rows, schemas.EVENT), "1 hour").collect()
    assert tuple(r) == ("x", 3, 1, 1, round(1 / 3, 4), round(1 / 3, 4))
    assert ordered_funnel(spark.createDataFrame([], schemas.EVENT)).collect() == []
