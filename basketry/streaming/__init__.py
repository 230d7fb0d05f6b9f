"""Structured Streaming jobs built from the batch operators."""

from basketry.streaming.jobs import (
    StreamSettings,
    await_all,
    layout,
    run_available_now,
    start_all,
    start_category_metrics,
    start_product_alerts,
    start_product_metrics,
    start_raw_ingest,
    stop_all,
)

__all__ = [
    "StreamSettings",
    "await_all",
    "layout",
    "run_available_now",
    "start_all",
    "start_category_metrics",
    "start_product_alerts",
    "start_product_metrics",
    "start_raw_ingest",
    "stop_all",
]
