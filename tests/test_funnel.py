import datetime as dt

from basketry.operators.funnel import (
    average_rate,
    conversion_report,
    funnel_counts,
    funnel_join_form,
    low_performers,
    top_by_rate,
)
from basketry.schemas import CONVERSION_REPORT

SCHEMA = "user_id string, product_id string, category string, event_type string, timestamp timestamp"
T = dt.datetime(2026, 1, 1, 12)


def _events(spark, spec):
    rows = []
    for cat, etype, n in spec:
        rows += [("u", "p", cat, etype, T)] * n
    return spark.createDataFrame(rows, SCHEMA)


def test_category_without_views_is_absent(spark):
    df = _events(spark, [("a", "view", 2), ("b", "purchase", 1), (None, "view", 3)])
    assert [r.category for r in funnel_counts(df).collect()] == ["a"]
    assert [r.category for r in funnel_join_form(df).collect()] == ["a"]


def test_rates_without_cart_adds(spark):
    df = _events(spark, [("a", "view", 4), ("a", "purchase", 1)])
    row = conversion_report(df).collect()[0]
    assert (row.views, row.purchases, row.cart_adds) == (4, 1, 0)
    assert row.conversion_rate == 0.25 and row.cart_to_purchase_rate == 0.0


def test_report_schema_and_order(spark):
    df = _events(spark, [("a", "view", 4), ("a", "purchase", 1), ("b", "view", 2), ("b", "purchase", 1),
                         ("c", "view", 2), ("c", "purchase", 1)])
    report = conversion_report(df)
    assert [(f.name, f.dataType) for f in report.schema] == [(f.name, f.dataType) for f in CONVERSION_REPORT]
    assert [r.category for r in report.collect()] == ["b", "c", "a"]
    assert [r.category for r in top_by_rate(report, 2).collect()] == ["b", "c"]


def test_join_form_equals_one_pass(spark):
    df = _events(spark, [("a", "view", 3), ("a", "add_to_cart", 2), ("b", "view", 1), ("b", "purchase", 2),
                         ("c", "add_to_cart", 1)])
    one = sorted(tuple(r) for r in funnel_counts(df).collect())
    two = sorted(tuple(r) for r in funnel_join_form(df).select("category", "views", "purchases", "cart_adds").collect())
    assert one == two


def test_rounding_half_up(spark):
    from pyspark.sql import functions as F
    from basketry.functions.rates import safe_rate

    df = spark.createDataFrame([(0.00005,), (0.12345,), (1.00005,)], "x double")
    got = [r.r for r in df.select(safe_rate(F.col("x"), F.lit(1)).alias("r")).collect()]
    assert got == [0.0001, 0.1235, 1.0001]


def test_low_performers_and_empty_average(spark):
    df = _events(spark, [("a", "view", 12), ("b", "view", 20), ("c", "view", 11), ("c", "purchase", 1)])
    report = conversion_report(df)
    assert [r.category for r in low_performers(report).collect()] == ["b", "a"]
    empty = report.limit(0)
    assert average_rate(empty).collect()[0][0] is None
