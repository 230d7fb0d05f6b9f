"""Event counts at the finest grain, and reports at coarser grains rolled up from them.

One pass over the events gives partial counts by (day, category, product). All
coarser grains are sums of those, so no grain reads the events again and none
multiplies them (``GROUPING SETS`` would hand every event to every grain).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.funnel import COUNT_COLUMNS, with_event_date, with_rates

FINEST = ("event_date", "category", "product_id")
COUNTS = ("events", *COUNT_COLUMNS)


def partial_counts(events: DataFrame) -> DataFrame:
    """``event_date, category, product_id, events, views, purchases, cart_adds``; null keys are groups of their own."""
    counts = [F.count_if(F.col("event_type") == kind).alias(name) for name, kind in COUNT_COLUMNS.items()]
    return with_event_date(events).groupBy(*FINEST).agg(F.count(F.lit(1)).alias("events"), *counts)


def roll_up(partials: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Counts by ``keys`` (any of the finest grain's, in any number)."""
    return partials.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in COUNTS])


def report_grains(partials: DataFrame, grains: Sequence[Sequence[str]]) -> DataFrame:
    """``grain, event_date, category, product_id``, the counts and both rates for every grain in one table.

    ``grain`` names a row's keys (``total`` without any), so a null key and a key that the grain lacks stay apart.
    ``partials`` should be written (:func:`basketry.session.written`): each grain reads them once."""

    def one(keys: Sequence[str]) -> DataFrame:
        rows = roll_up(partials, keys) if keys else roll_up(partials).filter(F.col("events") > 0)
        missing = {k: F.lit(None).cast(partials.schema[k].dataType) for k in FINEST if k not in keys}
        named = rows.withColumns(missing).withColumn("grain", F.lit(",".join(keys) or "total"))
        return with_rates(named.select("grain", *FINEST, *COUNTS))

    return reduce(DataFrame.unionByName, [one(k) for k in grains])


def category_report(partials: DataFrame) -> DataFrame:
    """The conversion report (:func:`basketry.operators.funnel.conversion_report`) from partial counts."""
    rows = roll_up(partials.filter(F.col("category").isNotNull()), ["category"]).filter(F.col("views") > 0)
    return with_rates(rows).drop("events").orderBy(F.desc("conversion_rate"), "category")
