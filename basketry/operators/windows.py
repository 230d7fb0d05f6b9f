"""Tumbling event-time window aggregates (same code for batch and stream).

All aggregates are algebraic counts, so Spark runs them as partial (map-side)
plus final hash aggregation: a hot product or category is reduced to one row
per task before the shuffle, and streaming state per key stays constant size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.rates import safe_rate
from basketry.operators.vocab import PURCHASE, VIEW


def with_watermark(events: DataFrame, delay: str | None, time_col: str = "timestamp") -> DataFrame:
    """Event-time watermark for streaming aggregates (no-op on batch data)."""
    return events.withWatermark(time_col, delay) if delay else events


# Microseconds of the units that a window's length may be given in.
UNITS = {"second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86400 * 10**6}


def window_micros(duration: str) -> int:
    """Length of a window such as ``5 minutes`` in microseconds."""
    number, unit = duration.split()
    return int(number) * UNITS[unit.rstrip("s")]


def _window(time_col: str, duration: str) -> Column:
    return F.window(F.col(time_col), duration)


def _flatten(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *cols,
    )


def category_window_metrics(
    events: DataFrame,
    duration: str = "5 minutes",
    time_col: str = "timestamp",
    literal_counts: bool = False,
) -> DataFrame:
    """Events, purchases and views per (window, category).

    ``literal_counts=True`` reproduces counting a boolean expression with
    ``count``: that counts non-null event types, so purchases = views =
    number of rows with a type. The default counts matching rows."""
    is_purchase = F.col("event_type") == PURCHASE
    is_view = F.col("event_type") == VIEW
    if literal_counts:
        purchases, views = F.count(is_purchase), F.count(is_view)
    else:
        purchases, views = F.count_if(is_purchase), F.count_if(is_view)
    agg = events.groupBy(_window(time_col, duration), F.col("category")).agg(
        F.count(F.lit(1)).alias("total_events"),
        purchases.alias("purchases"),
        views.alias("views"),
    )
    return _flatten(agg, "category", "total_events", "purchases", "views")


def product_alerts(
    events: DataFrame,
    duration: str = "5 minutes",
    threshold: int = 100,
    time_col: str = "timestamp",
) -> DataFrame:
    """(window, product, category) groups with more than ``threshold`` events.

    In a stream the filter applies when a window is emitted; the state holds
    one counter per key until the watermark passes the window end."""
    agg = events.groupBy(_window(time_col, duration), F.col("product_id"), F.col("category")).agg(
        F.count(F.lit(1)).alias("event_count")
    )
    agg = agg.filter(F.col("event_count") > threshold)
    return _flatten(agg, "product_id", "category", "event_count")


def product_window_metrics(
    events: DataFrame,
    duration: str = "5 minutes",
    time_col: str = "timestamp",
) -> DataFrame:
    """Product-grain metrics per window (no ``category`` column, so a later
    join to a product->category map cannot become ambiguous)."""
    agg = events.groupBy(_window(time_col, duration), F.col("product_id")).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(F.col("event_type") == VIEW).alias("views"),
        F.count_if(F.col("event_type") == PURCHASE).alias("purchases"),
    )
    return _flatten(agg, "product_id", "total_events", "views", "purchases")


def window_rates(metrics: DataFrame, scale: int | None = 4) -> DataFrame:
    """Stateless per-row conversion rate over window metrics (valid in
    append mode on a stream)."""
    return metrics.withColumn("conversion_rate", safe_rate("purchases", "views", scale))
