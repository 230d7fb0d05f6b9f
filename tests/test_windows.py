import datetime as dt

from basketry.operators.windows import category_window_metrics, product_alerts, window_rates

SCHEMA = "user_id string, product_id string, category string, event_type string, timestamp timestamp"


def _t(m, s=0):
    return dt.datetime(2026, 1, 1, 0, m, s)


def test_null_timestamp_is_not_windowed(spark):
    df = spark.createDataFrame([("u", "p", "a", "view", None), ("u", "p", "a", "view", _t(7))], SCHEMA)
    rows = category_window_metrics(df).collect()
    assert len(rows) == 1
    assert rows[0].window_start == _t(5) and rows[0].window_end == _t(10)


def test_literal_counts_count_non_null_types(spark):
    df = spark.createDataFrame(
        [("u", "p", "a", "view", _t(1)), ("u", "p", "a", "purchase", _t(2)), ("u", "p", "a", None, _t(3))], SCHEMA
    )
    intended = category_window_metrics(df).collect()[0]
    literal = category_window_metrics(df, literal_counts=True).collect()[0]
    assert (intended.total_events, intended.purchases, intended.views) == (3, 1, 1)
    assert (literal.total_events, literal.purchases, literal.views) == (3, 2, 2)


def test_alert_threshold_is_strict(spark):
    rows = [("u", "p1", "a", "view", _t(1))] * 3 + [("u", "p2", "a", "view", _t(1))] * 2
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.product_id, r.event_count) for r in product_alerts(df, "5 minutes", threshold=2).collect()}
    assert got == {("p1", 3)}


def test_window_rates(spark):
    df = spark.createDataFrame(
        [("u", "p", "a", "view", _t(1))] * 3 + [("u", "p", "a", "purchase", _t(1))], SCHEMA
    )
    row = window_rates(category_window_metrics(df)).collect()[0]
    assert row.conversion_rate == 0.3333
