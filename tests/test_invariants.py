"""Invariants across operators on the generated tables (survey §5.4)."""

from pyspark.sql import functions as F

from basketry.operators import (
    category_conversion,
    category_window_metrics,
    daily_events,
    product_window_metrics,
    segment_summary,
    user_segments,
)
from basketry.sources.testdata import raw_events
from tests.conftest import SF_SMALL


def test_literal_metrics_have_purchases_equal_views(spark):
    m = category_window_metrics(raw_events(spark, SF_SMALL), literal_counts=True)
    assert m.filter(F.col("purchases") != F.col("views")).count() == 0
    assert m.filter(F.col("views") != F.col("total_events")).count() == 0


def test_segment_summary_sums_to_users_of_the_day(spark):
    day = daily_events(raw_events(spark, SF_SMALL), "2024-01-30")
    total = segment_summary(user_segments(day)).agg(F.sum("users")).collect()[0][0]
    assert total == day.select("user_id").distinct().count()


def test_category_roll_up_preserves_product_sums(spark):
    ev = raw_events(spark, SF_SMALL)
    metrics = product_window_metrics(ev)
    report = category_conversion(metrics, ev)
    a = report.agg(F.sum("views"), F.sum("purchases")).collect()[0]
    b = metrics.agg(F.sum("views"), F.sum("purchases")).collect()[0]
    assert tuple(a) == tuple(b)


def test_window_metrics_cover_every_event(spark):
    ev = raw_events(spark, SF_SMALL)
    assert category_window_metrics(ev).agg(F.sum("total_events")).collect()[0][0] == ev.count()


def test_record_counts_predict_the_report_size(spark):
    from basketry.operators import conversion_report, record_counts

    ev = raw_events(spark, SF_SMALL)
    counts = record_counts(ev).collect()[0]
    assert counts.report_groups == conversion_report(ev).count()
    assert counts.loaded_events == ev.count() >= counts.retained_events
