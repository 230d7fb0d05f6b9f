"""Per-group funnel counts and the conversion report.

The funnel is one scan and one aggregation with conditional counts: a
filter on the three funnel types is pushed to the scan, each map task
reduces its rows to one partial row per group, and only those partials are
shuffled. The three-aggregates-and-two-joins form is kept as its own
operator (same result) for comparison.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.rates import safe_rate
from basketry.operators.segments import daily_events
from basketry.operators.vocab import ADD_TO_CART, FUNNEL_TYPES, PURCHASE, VIEW

COUNT_COLUMNS = {"views": VIEW, "purchases": PURCHASE, "cart_adds": ADD_TO_CART}


def _keys_not_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def with_event_date(events: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Adds ``event_date`` (session-zone date of the event) unless present."""
    if "event_date" in events.columns:
        return events
    return events.withColumn("event_date", F.to_date(F.col(time_col)))


def type_counts(events: DataFrame, event_type: str, alias: str, keys: Sequence[str] = ("category",)) -> DataFrame:
    """Count of one event type per group; groups without it are absent."""
    keys = list(keys)
    return (
        events.filter(_keys_not_null(keys) & (F.col("event_type") == event_type))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(alias))
    )


def funnel_counts(events: DataFrame, keys: Sequence[str] = ("category",), require_views: bool = True) -> DataFrame:
    """views, purchases, cart_adds per group in one pass.

    Rows with a null key are dropped; with ``require_views`` a group without
    any view is dropped too (a report that starts from views)."""
    keys = list(keys)
    funnel = (
        events.filter(_keys_not_null(keys) & F.col("event_type").isin(*FUNNEL_TYPES))
        .groupBy(*keys)
        .agg(*[F.count_if(F.col("event_type") == t).alias(name) for name, t in COUNT_COLUMNS.items()])
    )
    if require_views:
        funnel = funnel.filter(F.col("views") > 0)
    return funnel


def funnel_join_form(events: DataFrame, keys: Sequence[str] = ("category",)) -> DataFrame:
    """Same as :func:`funnel_counts`, built as views LEFT JOIN purchases LEFT
    JOIN cart adds on the keys with missing counts filled by 0.

    The three sides are slices of one table of counts in long form, whose
    scan and shuffle they share; a group without a type is absent from its slice."""
    keys = list(keys)
    counts = funnel_counts(events, keys, require_views=False)
    long_form = counts.unpivot(keys, list(COUNT_COLUMNS), "kind", "events").filter(F.col("events") > 0)
    sides = {name: long_form.filter(F.col("kind") == name).select(*keys, F.col("events").alias(name)) for name in COUNT_COLUMNS}
    joined = sides["views"].join(sides["purchases"], keys, "left").join(sides["cart_adds"], keys, "left")
    return joined.fillna(0, subset=["purchases", "cart_adds"])


def with_rates(funnel: DataFrame, scale: int | None = 4) -> DataFrame:
    return funnel.withColumns(
        {
            "conversion_rate": safe_rate("purchases", "views", scale),
            "cart_to_purchase_rate": safe_rate("purchases", "cart_adds", scale),
        }
    )


def conversion_report(
    events: DataFrame,
    keys: Sequence[str] = ("category",),
    as_of: dt.date | str | None = None,
    scale: int | None = 4,
    ordered: bool = True,
) -> DataFrame:
    """Funnel counts with conversion (purchases/views) and cart-to-purchase
    (purchases/cart_adds) rates, best conversion first, ties by key.

    All-time by default; ``as_of`` restricts to one day. Pass
    ``ordered=False`` when the report feeds another aggregate or a top-k:
    the global sort costs a sampling job and a range shuffle that Catalyst
    does not always remove under a later aggregate."""
    keys = list(keys)
    if as_of is not None:
        events = daily_events(events, as_of)
    report = with_rates(funnel_counts(events, keys), scale)
    report = report.select(
        *keys,
        F.col("views").cast("long").alias("views"),
        F.col("purchases").cast("long").alias("purchases"),
        F.col("cart_adds").cast("long").alias("cart_adds"),
        "conversion_rate",
        "cart_to_purchase_rate",
    )
    return report.orderBy(F.desc("conversion_rate"), *keys) if ordered else report


def top_by_rate(report: DataFrame, k: int = 3, keys: Sequence[str] = ("category",), rate: str = "conversion_rate") -> DataFrame:
    """The ``k`` best groups by a rate (a TakeOrderedAndProject: each task
    keeps k rows, the driver merges k x tasks rows)."""
    return report.orderBy(F.desc(rate), *keys).limit(k)


def low_performers(report: DataFrame, min_views: int = 10, k: int = 3, keys: Sequence[str] = ("category",)) -> DataFrame:
    """Most viewed groups with more than ``min_views`` views and no purchase."""
    flagged = report.filter((F.col("views") > min_views) & (F.col("purchases") == 0))
    return flagged.orderBy(F.desc("views"), *keys).limit(k)


def average_rate(report: DataFrame, rate: str = "conversion_rate", scale: int | None = 4) -> DataFrame:
    """Mean rate over groups; null (not an error) for an empty report.

    Rates rounded to ``scale`` digits are summed exactly as decimals and
    divided once, so the mean does not depend on partitioning or summation
    order (a double sum can differ in the last bit between runs)."""
    if scale is None:
        return report.agg(F.avg(rate).alias(f"avg_{rate}"))
    exact_sum = F.sum(F.col(rate).cast(f"decimal(38,{scale})")).cast("double")
    return report.agg((exact_sum / F.count(rate)).alias(f"avg_{rate}"))


def record_counts(events: DataFrame, keys: Sequence[str] = ("category",)) -> DataFrame:
    """Loaded rows, rows kept by the null-key filter and the number of groups
    the report will have (groups with a view), in one pass."""
    keys = list(keys)
    kept = _keys_not_null(keys)
    group = F.struct(*keys) if len(keys) > 1 else F.col(keys[0])
    return events.agg(
        F.count(F.lit(1)).alias("loaded_events"),
        F.count_if(kept).alias("retained_events"),
        F.count_distinct(F.when(kept & (F.col("event_type") == VIEW), group)).alias("report_groups"),
    )


def events_by_date(events: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Event count per event date."""
    return with_event_date(events, time_col).groupBy("event_date").agg(F.count(F.lit(1)).alias("events"))
