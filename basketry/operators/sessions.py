"""Visits: a user's events with no gap longer than ``gap`` between them.

Spark's session windows: in a batch they are merged from sorted partial
sessions, in a stream they are merging state a user, written once the
watermark has passed their end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.funnel import COUNT_COLUMNS
from basketry.operators.segments import classify


def user_sessions(events: DataFrame, gap: str = "30 minutes", time_col: str = "timestamp") -> DataFrame:
    """``session_start, session_end, user_id, events, views, purchases, cart_adds, segment`` of every session.

    A session ends ``gap`` after its last event; an event at that very instant still belongs to it. Rows without a
    user or a time are left out; events of one instant are counted each. ``segment`` is the daily
    segmentation's rule applied to the session."""
    counts = [F.count_if(F.col("event_type") == kind).alias(name) for name, kind in COUNT_COLUMNS.items()]
    agg = (
        events.filter(F.col("user_id").isNotNull() & F.col(time_col).isNotNull())
        .groupBy(F.session_window(F.col(time_col), gap).alias("session"), F.col("user_id"))
        .agg(F.count(F.lit(1)).alias("events"), *counts)
    )
    return agg.select(
        F.col("session.start").alias("session_start"),
        F.col("session.end").alias("session_end"),
        "user_id",
        "events",
        *COUNT_COLUMNS,
        classify("purchases", "cart_adds", "views").alias("segment"),
    )
