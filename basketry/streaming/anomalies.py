"""Anomaly alerts on a stream: keyed state with event-time timers.

The window counts are a native streaming aggregate (pre-aggregated on the map
side: a hot product sends one row a task), so only closed windows reach the
keyed operator, one row a (window, product, category). That operator keeps the
last few counts of a key, judges a window against them, and sets two timers on
the key's last window: one that tells a silence, one that ends the state. So
the state holds the products of the last ``horizon`` windows and no others.

Rows don't depend on how the stream falls into micro-batches: windows of a batch
are taken in order of time, a silence is told by its timer or by the window
that ends it (whichever comes first), and what a timer ends could no longer
enter a baseline.

Needs the RocksDB state store (set for the query while it starts).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from basketry.operators.anomalies import KEYS, AnomalyRule, anomaly_columns, product_counts
from basketry.operators.windows import window_micros
from basketry.session import ROCKSDB_PROVIDER, STATE_STORE_PROVIDER_KEY, ship_package
from basketry.streaming.jobs import StreamSettings, layout, start_output, timed_events

_FOUND = "product_id string, category string, start long, end long, kind string, event_count long, baseline double, spread double, windows int"


class AnomalyProcessor(StatefulProcessor):
    """Baseline and alerts of one (product, category); times are microseconds."""

    def __init__(self, rule: AnomalyRule, length: int) -> None:
        self.rule, self.length = rule, length

    def init(self, handle) -> None:
        self.handle = handle
        # Last windows with their counts, and whether the silence after them has been told.
        self.past = handle.getValueState("past", "starts array<long>, counts array<long>, told boolean")

    def _timers(self, last: int) -> tuple[int, int]:
        """Milliseconds of the silence and of the end of the state after a last window."""
        end = last + self.length
        return (end + self.rule.silent * self.length) // 1000, (end + self.rule.horizon * self.length) // 1000

    def _baseline(self, starts: list[int], counts: list[int], at: int) -> tuple[int, tuple[float, float] | None]:
        held = [c for s, c in zip(starts, counts) if s >= at - self.rule.horizon * self.length]
        return len(held), self.rule.baseline(held)

    def _row(self, key, start: int, end: int, kind: str, count: int, base: tuple[float, float], windows: int) -> Row:
        return Row(product_id=key[0], category=key[1], start=start, end=end, kind=kind, event_count=count,
                   baseline=base[0], spread=base[1], windows=windows)

    def _silence(self, key, starts: list[int], counts: list[int]) -> Iterator[Row]:
        n, base = self._baseline(starts, counts, starts[-1])
        if base and base[0] >= self.rule.min_baseline:
            end = starts[-1] + self.length
            yield self._row(key, end, end + self.rule.silent * self.length, "silence", 0, base, n)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        starts, counts, told = [], [], False
        if self.past.exists():
            held = self.past.get()
            starts, counts, told = list(held[0]), list(held[1]), held[2]
            for timer in self._timers(starts[-1]):
                self.handle.deleteTimer(timer)
        for start, count in sorted((r["start"], r["event_count"]) for r in rows):
            if starts and not told and start >= starts[-1] + (1 + self.rule.silent) * self.length:
                yield from self._silence(key, starts, counts)
            n, base = self._baseline(starts, counts, start)
            kind = base and self.rule.kind(count, *base)
            if kind:
                yield self._row(key, start, start + self.length, kind, count, base, n)
            starts = [*starts, start][-self.rule.history :]
            counts = [*counts, count][-self.rule.history :]
            told = False
        self.past.update((starts, counts, told))
        for timer in self._timers(starts[-1]):
            self.handle.registerTimer(timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.past.exists():
            return
        held = self.past.get()
        starts, counts, told = list(held[0]), list(held[1]), held[2]
        if not told:
            yield from self._silence(key, starts, counts)
        if expiredTimerInfo.getExpiryTimeInMs() >= self._timers(starts[-1])[1]:
            self.past.clear()
        else:
            self.past.update((starts, counts, True))

    def close(self) -> None:
        pass


def stream_anomalies(events: DataFrame, window: str, rule: AnomalyRule = AnomalyRule()) -> DataFrame:
    """Alerts of a stream of events that has a watermark; the rows of
    :func:`basketry.operators.anomalies.window_anomalies` over the windows it has closed."""
    ship_package(events.sparkSession)
    counts = product_counts(events, window).withColumn("start", F.unix_micros("window.start"))
    found = counts.groupBy(*KEYS).transformWithState(
        statefulProcessor=AnomalyProcessor(rule, window_micros(window)),
        outputStructType=_FOUND,
        outputMode="append",
        timeMode="eventTime",
    )
    return anomaly_columns(found)


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB (a query takes the setting over when it starts)."""
    before = spark.conf.get(STATE_STORE_PROVIDER_KEY, None)
    spark.conf.set(STATE_STORE_PROVIDER_KEY, ROCKSDB_PROVIDER)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE_PROVIDER_KEY)
        else:
            spark.conf.set(STATE_STORE_PROVIDER_KEY, before)


def start_anomaly_alerts(events: DataFrame, base_dir: str, settings: StreamSettings, rule: AnomalyRule = AnomalyRule(),
                         name: str = "anomalies") -> StreamingQuery:
    """Spikes, drops and silences of products as Parquet rows (windows of ``settings.alert_window`` or ``settings.window``)."""
    paths = layout(base_dir)
    found = stream_anomalies(timed_events(events, settings), settings.alert_window or settings.window, rule)
    with rocksdb_state(events.sparkSession):
        return start_output(found, "parquet", paths["anomalies"], f"{paths['checkpoints']}/anomalies", name, settings.trigger)
