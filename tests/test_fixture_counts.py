"""Row counts published in FIXTURES.md §2 for the generated tables."""

import pytest

from basketry.plans.registry import QUERIES

SCALES = {"0.001": "/root/testdata/sf0.001", "0.01": "/root/testdata/sf0.01", "0.1": "/root/testdata/sf0.1"}

EXPECTED = {
    "shop_events": {"0.001": 1000, "0.01": 10000, "0.1": 100000},
    "window_category_metrics": {"0.001": 987, "0.01": 8879, "0.1": 43314},
    "window_product_alerts": {"0.001": 30, "0.01": 87, "0.1": 3030},
    "funnel_counts": {"0.001": 6, "0.01": 6, "0.1": 6},
    "category_conversion_report": {"0.001": 7, "0.01": 7, "0.1": 7},
    "low_performers": {"0.001": 3, "0.01": 3, "0.1": 3},
    "user_segments": {"0.001": 14, "0.01": 133, "0.1": 1344},
}

SEGMENTS = {
    "0.001": {"Buyer": 7, "Cart_Abandoner": 3, "Window_Shopper": 1, "Unknown": 3},
    "0.01": {"Buyer": 53, "Cart_Abandoner": 33, "Window_Shopper": 27, "Unknown": 20},
    "0.1": {"Buyer": 577, "Cart_Abandoner": 324, "Window_Shopper": 225, "Unknown": 218},
}


@pytest.mark.parametrize("name,scale", [(n, s) for n in EXPECTED for s in SCALES])
def test_row_counts(spark, name, scale):
    assert QUERIES[name](spark, SCALES[scale]).count() == EXPECTED[name][scale]


@pytest.mark.parametrize("scale", list(SCALES))
def test_segment_breakdown(spark, scale):
    got = {r.segment: r.users for r in QUERIES["segment_summary"](spark, SCALES[scale]).collect()}
    assert got == SEGMENTS[scale]


def test_streaming_counts_at_sf001(spark):
    assert QUERIES["stream_category_metrics"](spark, SCALES["0.01"]).count() == 7397
    assert QUERIES["stream_product_alerts"](spark, SCALES["0.01"]).count() == 72
