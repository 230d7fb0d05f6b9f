"""Daily per-user activity and segmentation.

Per-user state is three counters (algebraic), never the user's full event
list, so a user holding a third of all rows is reduced map-side like any
other key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.operators.vocab import (
    ADD_TO_CART,
    BUYER,
    CART_ABANDONER,
    PURCHASE,
    UNKNOWN_SEGMENT,
    VIEW,
    WINDOW_SHOPPER,
)


def _as_date(value: dt.date | str | None) -> Column:
    if value is None:
        return F.current_date()
    if isinstance(value, (dt.date, dt.datetime)):
        value = value.strftime("%Y-%m-%d")
    return F.lit(value).cast("date")


def daily_events(events: DataFrame, as_of: dt.date | str | None = None, time_col: str = "timestamp") -> DataFrame:
    """Events with ``as_of <= time < as_of + 1 day`` (session zone).

    ``as_of`` defaults to today. The range is on the raw timestamp column,
    so it is pushed to the Parquet scan; a raw dataset with an
    ``event_date`` partition column is additionally pruned to one folder."""
    day = _as_date(as_of)
    start = day.cast("timestamp")
    end = F.date_add(day, 1).cast("timestamp")
    cond = (F.col(time_col) >= start) & (F.col(time_col) < end)
    if "event_date" in events.columns:
        cond = cond & (F.col("event_date") == day)
    return events.filter(cond)


def user_event_counts(events: DataFrame) -> DataFrame:
    """Purchases, cart adds and views per user (null users dropped)."""
    return (
        events.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.count_if(F.col("event_type") == PURCHASE).alias("purchases"),
            F.count_if(F.col("event_type") == ADD_TO_CART).alias("cart_adds"),
            F.count_if(F.col("event_type") == VIEW).alias("views"),
        )
    )


def classify(purchases: Column | str = "purchases", cart_adds: Column | str = "cart_adds", views: Column | str = "views") -> Column:
    """First match wins: any purchase -> Buyer; else any cart add ->
    Cart_Abandoner; else any view -> Window_Shopper; else Unknown."""
    p = F.col(purchases) if isinstance(purchases, str) else purchases
    c = F.col(cart_adds) if isinstance(cart_adds, str) else cart_adds
    v = F.col(views) if isinstance(views, str) else views
    return (
        F.when(p >= 1, F.lit(BUYER))
        .when(c >= 1, F.lit(CART_ABANDONER))
        .when(v > 0, F.lit(WINDOW_SHOPPER))
        .otherwise(F.lit(UNKNOWN_SEGMENT))
    )


def user_segments(events: DataFrame) -> DataFrame:
    """``user_id, segment`` for every user with at least one event."""
    return user_event_counts(events).select("user_id", classify().alias("segment"))


def segment_summary(segments: DataFrame) -> DataFrame:
    """Users per segment, largest first."""
    return segments.groupBy("segment").agg(F.count(F.lit(1)).alias("users")).orderBy(F.desc("users"), "segment")


def user_event_lists(events: DataFrame) -> DataFrame:
    """Each user's event types as a sorted run-length list
    ``array<struct<event_type, occurrences>>``.

    This is the user's full, ordered list of event types in bounded form:
    its size is the number of distinct types, not the number of events."""
    per_type = (
        events.filter(F.col("user_id").isNotNull())
        .groupBy("user_id", "event_type")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )
    return per_type.groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("event_type", "occurrences"))).alias("event_list")
    )


def occurrences(event_list: Column | str, event_type: str) -> Column:
    """How often ``event_type`` occurs in a run-length event list."""
    arr = F.col(event_list) if isinstance(event_list, str) else event_list
    hits = F.filter(arr, lambda x: x["event_type"] == F.lit(event_type))
    return F.aggregate(hits, F.lit(0).cast("long"), lambda acc, x: acc + x["occurrences"])


def render_event_list(event_list: Column | str) -> Column:
    """Run-length list as text, e.g. ``add_to_cart:1,view:3``."""
    arr = F.col(event_list) if isinstance(event_list, str) else event_list
    parts = F.transform(arr, lambda x: F.concat(F.coalesce(x["event_type"], F.lit("null")), F.lit(":"), x["occurrences"].cast("string")))
    return F.array_join(parts, ",")
