import datetime as dt

from basketry.operators.ranking import top_products, top_products_lines
from basketry.operators.segments import (
    daily_events,
    occurrences,
    render_event_list,
    segment_summary,
    user_event_lists,
    user_segments,
)

SCHEMA = "user_id string, product_id string, category string, event_type string, timestamp timestamp"
DAY = dt.datetime(2026, 1, 2, 10)


def test_segments_first_match_wins(spark):
    rows = [
        ("u1", "p", "a", "purchase", DAY), ("u1", "p", "a", "add_to_cart", DAY),
        ("u2", "p", "a", "add_to_cart", DAY), ("u2", "p", "a", "view", DAY),
        ("u3", "p", "a", "view", DAY),
        ("u4", "p", "a", "signup", DAY),
        (None, "p", "a", "purchase", DAY),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.user_id: r.segment for r in user_segments(df).collect()}
    assert got == {"u1": "Buyer", "u2": "Cart_Abandoner", "u3": "Window_Shopper", "u4": "Unknown"}
    summary = [tuple(r) for r in segment_summary(user_segments(df)).collect()]
    assert sum(n for _, n in summary) == 4


def test_daily_window_is_half_open(spark):
    rows = [
        ("u", "p", "a", "view", dt.datetime(2026, 1, 1, 23, 59, 59)),
        ("u", "p", "a", "view", dt.datetime(2026, 1, 2, 0, 0, 0)),
        ("u", "p", "a", "view", dt.datetime(2026, 1, 2, 23, 59, 59, 999999)),
        ("u", "p", "a", "view", dt.datetime(2026, 1, 3, 0, 0, 0)),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert daily_events(df, "2026-01-02").count() == 2
    assert daily_events(df, dt.date(2026, 1, 2)).count() == 2


def test_event_lists_are_bounded_run_lengths(spark):
    rows = [("u1", "p", "a", t, DAY) for t in ["view", "view", "purchase", "view", "add_to_cart"]]
    df = spark.createDataFrame(rows, SCHEMA)
    out = user_event_lists(df)
    row = out.select(
        render_event_list("event_list").alias("s"),
        occurrences("event_list", "view").alias("v"),
        occurrences("event_list", "signup").alias("x"),
    ).collect()[0]
    assert row.s == "add_to_cart:1,purchase:1,view:3"
    assert (row.v, row.x) == (3, 0)


def test_top_k_ties_and_null_keys(spark):
    rows = []
    for p in ["a", "b", "c", "d"]:
        rows += [("u", p, "x", "view", DAY)] * 2
    rows += [("u", "e", None, "view", DAY)] * 5
    df = spark.createDataFrame(rows, SCHEMA)
    top = top_products(df, k=2).collect()
    assert [(r.rank, r.product_id, r.views) for r in top] == [(1, "a", 2), (2, "b", 2)]


def test_top_products_text_layout(spark):
    rows = [("u", "p1", "x", "view", DAY)] * 3 + [("u", "p2", "y", "view", DAY)]
    df = spark.createDataFrame(rows, SCHEMA)
    lines = [r.line for r in top_products_lines(top_products(df, 5), "2026-01-02").orderBy("line_no").collect()]
    assert lines == [
        "=" * 60, "TOP 5 MOST VIEWED PRODUCTS - 2026-01-02", "=" * 60, "",
        "1. Product ID: p1", "   Category: x", "   Views: 3", "",
        "2. Product ID: p2", "   Category: y", "   Views: 1", "",
    ]
