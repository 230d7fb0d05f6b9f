"""Window counts that stray from a product's own robust baseline.

The baseline of a (product, category) at a window is the median of its last
``history`` windows with events, none older than ``horizon`` windows; the
spread is the median distance from that median. Both shrug off single
outliers, so an alert doesn't spoil the baseline that the next window is held
against. Kinds of alert:

* ``spike`` / ``drop``: the count is farther above / below the baseline than
  ``sensitivity`` spreads;
* ``silence``: a product with a baseline of at least ``min_baseline`` has no
  event for ``silent`` windows after its last one.

:func:`window_anomalies` works on closed windows in batch;
:mod:`basketry.streaming.anomalies` gives the same rows from a stream.
"""

from __future__ import annotations

from dataclasses import dataclass
from statistics import median

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.operators.windows import window_micros

KEYS = ("product_id", "category")


@dataclass(frozen=True)
class AnomalyRule:
    """All lengths are numbers of windows."""

    history: int = 24
    min_history: int = 8
    horizon: int = 288
    silent: int = 12
    sensitivity: float = 4.0
    # Least spread: steady products would alert at every change otherwise.
    min_spread: float = 1.0
    min_baseline: float = 1.0

    def __post_init__(self) -> None:
        if not 1 <= self.min_history <= self.history:
            raise ValueError("min_history must be between 1 and history")
        if not 1 <= self.silent <= self.horizon:
            # The state of a key ends with the horizon.
            raise ValueError("silent must be between 1 and horizon")

    def baseline(self, counts: list[int]) -> tuple[float, float] | None:
        """Median and spread of the last counts, or nothing if they are too few."""
        if len(counts) < self.min_history:
            return None
        middle = float(median(counts))
        return middle, float(median([abs(c - middle) for c in counts]))

    def kind(self, count: int, middle: float, spread: float) -> str | None:
        limit = self.sensitivity * max(spread, self.min_spread)
        return "spike" if count - middle > limit else "drop" if middle - count > limit else None


def _median(values: Column) -> Column:
    ordered, n = F.array_sort(values), F.size(values)
    low, high = F.floor((n - 1) / 2).cast("int"), F.floor(n / 2).cast("int")
    return (F.get(ordered, low) + F.get(ordered, high)) / F.lit(2.0)


def product_counts(events: DataFrame, window: str = "5 minutes", time_col: str = "timestamp") -> DataFrame:
    """Events per (window, product, category), of events that concern a product.

    ``window`` keeps its event-time column, so that a stateful operator can follow in a stream."""
    return (
        events.filter(F.col("product_id").isNotNull())
        .groupBy(F.window(F.col(time_col), window).alias("window"), *KEYS)
        .agg(F.count(F.lit(1)).alias("event_count"))
    )


def window_anomalies(counts: DataFrame, window: str, rule: AnomalyRule = AnomalyRule(), until=None) -> DataFrame:
    """``window_start, window_end, product_id, category, kind, event_count, baseline, spread, windows``.

    ``counts`` are closed windows (:func:`product_counts`). A silence is told once it has ended
    or lasted up to ``until`` (a timestamp column or literal; without it, only ended ones are).
    Native window functions over (product, category): their rows are windows, not events."""
    length = window_micros(window)
    start = F.unix_micros("window.start")
    rows = counts.select(start.alias("start"), *KEYS, "event_count")
    by_key = Window.partitionBy(*KEYS).orderBy("start")
    past = by_key.rangeBetween(-rule.horizon * length, -1)
    through = by_key.rangeBetween(-rule.horizon * length, 0)

    def last(frame) -> Column:
        held = F.collect_list("event_count").over(frame)
        return F.slice(held, F.greatest(F.size(held) - rule.history, F.lit(0)) + 1, rule.history)

    rows = rows.select("*", last(past).alias("past"), last(through).alias("through"), F.lead("start").over(by_key).alias("following"))
    for name in ("past", "through"):
        middle = F.col(f"{name}_middle")
        rows = rows.withColumn(f"{name}_middle", _median(F.col(name)))
        rows = rows.withColumn(f"{name}_spread", _median(F.zip_with(name, F.array_repeat(middle, F.size(name)), lambda c, m: F.abs(c - m))))
    change = F.col("event_count") - F.col("past_middle")
    limit = F.lit(rule.sensitivity) * F.greatest(F.col("past_spread"), F.lit(rule.min_spread))
    level = F.when(
        (F.size("past") >= rule.min_history) & (F.abs(change) > limit),
        F.struct(
            F.col("start"),
            (F.col("start") + length).alias("end"),
            F.when(change > 0, "spike").otherwise("drop").alias("kind"),
            F.col("event_count"),
            F.col("past_middle").alias("baseline"),
            F.col("past_spread").alias("spread"),
            F.size("past").alias("windows"),
        ),
    )
    end = F.col("start") + length
    told = end + rule.silent * length
    over = F.lit(False) if until is None else told <= F.unix_micros(F.lit(until) if isinstance(until, str) else until)
    silence = F.when(
        (F.size("through") >= rule.min_history)
        & (F.col("through_middle") >= rule.min_baseline)
        & F.when(F.col("following").isNull(), over).otherwise(F.col("following") >= told),
        F.struct(
            end.alias("start"),
            told.alias("end"),
            F.lit("silence").alias("kind"),
            F.lit(0).cast("long").alias("event_count"),
            F.col("through_middle").alias("baseline"),
            F.col("through_spread").alias("spread"),
            F.size("through").alias("windows"),
        ),
    )
    found = rows.select(*KEYS, F.explode(F.filter(F.array(level, silence), lambda x: x.isNotNull())).alias("a"))
    return anomaly_columns(found.select(*KEYS, "a.*"))


def anomaly_columns(found: DataFrame) -> DataFrame:
    """Alerts with ``start`` and ``end`` in microseconds as result rows."""
    return found.select(
        F.timestamp_micros("start").alias("window_start"),
        F.timestamp_micros("end").alias("window_end"),
        *KEYS,
        "kind",
        "event_count",
        "baseline",
        "spread",
        "windows",
    )
