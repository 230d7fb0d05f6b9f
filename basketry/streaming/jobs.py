"""The event stream's outputs: raw dataset, category window metrics,
product window metrics and hot-product alerts.

Each output is its own streaming query with its own checkpoint (restart
resumes exactly where the last committed batch ended; file sinks are
exactly-once through ``_spark_metadata``). Window outputs use append mode:
a window is written once, when the watermark passes its end, and rows later
than the watermark are dropped from the aggregates (they stay in raw, which
has no watermark).

State per window key is a few counters, merged from map-side partial
aggregates. For very many keys per window start the session with
``build_session(rocksdb_state_store=True)`` (RocksDB state store provider) so
state lives off-heap and checkpoints incrementally.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketry.operators.catalog import enrich_with_catalog
from basketry.operators.hot_products import TRACKED, product_sketches
from basketry.operators.repeats import drop_repeats
from basketry.operators.sessions import user_sessions
from basketry.operators.windows import (
    category_window_metrics,
    product_alerts,
    product_window_metrics,
    window_rates,
    with_watermark,
)
from basketry.sources.streams import decode_events, event_date


@dataclass
class StreamSettings:
    window: str = "5 minutes"
    delay: str = "5 minutes"
    alert_window: str | None = None  # defaults to ``window``
    alert_threshold: int = 100
    literal_counts: bool = False
    # ``None`` = Spark's default micro-batch trigger; e.g.
    # ``{"processingTime": "10 seconds"}`` or ``{"availableNow": True}``.
    trigger: dict | None = None
    # Writers per (event_date, category) folder in each micro-batch of the
    # raw sink. ``None`` writes from the input tasks directly (no shuffle;
    # up to tasks x folders files per batch). A number shuffles each batch
    # by (date, category, salt): at most that many files per folder, and a
    # hot category is spread over that many writers.
    raw_writers: int | None = None
    # Add the windowed conversion rate (purchases / views, 4 digits) to the
    # category metrics output (a stateless projection, valid in append mode).
    with_rates: bool = False
    # Count repeated messages once in the windowed outputs (raw keeps them
    # all). Costs a state entry an event for the length of the delay.
    drop_repeats: bool = False


def layout(base_dir: str) -> dict[str, str]:
    """Output folders below one base folder on shared storage."""
    base = base_dir.rstrip("/")
    return {
        "raw": f"{base}/raw",
        "category_metrics": f"{base}/processed/category_metrics",
        "product_metrics": f"{base}/processed/product_metrics",
        "alerts": f"{base}/alerts",
        "anomalies": f"{base}/processed/anomalies",
        "product_sketches": f"{base}/processed/product_sketches",
        "sessions": f"{base}/processed/sessions",
        "checkpoints": f"{base}/checkpoints",
    }


def start_output(df: DataFrame, fmt: str, path: str, checkpoint: str, name: str, trigger: dict | None,
           partition_by: tuple[str, ...] = (), options: dict | None = None) -> StreamingQuery:
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .queryName(name)
    )
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def timed_events(events: DataFrame, settings: StreamSettings) -> DataFrame:
    """Events with the watermark, and without repeats if the settings say so."""
    timed = with_watermark(events, settings.delay)
    return drop_repeats(timed) if settings.drop_repeats else timed


def start_raw_ingest(events: DataFrame, base_dir: str, settings: StreamSettings, name: str = "raw") -> StreamingQuery:
    """Every decoded event (late and malformed ones included) as Parquet
    partitioned by event date and category."""
    paths = layout(base_dir)
    rows = event_date(events)
    if settings.raw_writers:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(settings.raw_writers))
        rows = rows.repartition(F.col("event_date"), F.col("category"), salt)
    return start_output(rows, "parquet", paths["raw"], f"{paths['checkpoints']}/raw", name,
                  settings.trigger, partition_by=("event_date", "category"))


def start_category_metrics(events: DataFrame, base_dir: str, settings: StreamSettings,
                           name: str = "category_metrics") -> StreamingQuery:
    paths = layout(base_dir)
    metrics = category_window_metrics(timed_events(events, settings), settings.window,
                                      literal_counts=settings.literal_counts)
    if settings.with_rates:
        metrics = window_rates(metrics)
    return start_output(metrics, "parquet", paths["category_metrics"], f"{paths['checkpoints']}/category_metrics",
                  name, settings.trigger)


def start_product_metrics(events: DataFrame, base_dir: str, settings: StreamSettings,
                          name: str = "product_metrics") -> StreamingQuery:
    paths = layout(base_dir)
    metrics = product_window_metrics(timed_events(events, settings), settings.window)
    return start_output(metrics, "parquet", paths["product_metrics"], f"{paths['checkpoints']}/product_metrics",
                  name, settings.trigger)


def start_product_alerts(events: DataFrame, base_dir: str, settings: StreamSettings,
                         name: str = "alerts") -> StreamingQuery:
    paths = layout(base_dir)
    alerts = product_alerts(timed_events(events, settings), settings.alert_window or settings.window,
                            settings.alert_threshold)
    return start_output(alerts, "csv", paths["alerts"], f"{paths['checkpoints']}/alerts", name, settings.trigger,
                  options={"header": "true"})


def start_product_sketches(events: DataFrame, base_dir: str, settings: StreamSettings, tracked: int = TRACKED,
                           name: str = "product_sketches") -> StreamingQuery:
    """One heavy-hitter sketch a window (see :mod:`basketry.operators.hot_products`): state of fixed size,
    however many products; ``hot_products_job`` reports from it and raw."""
    paths = layout(base_dir)
    sketches = product_sketches(timed_events(events, settings), settings.alert_window or settings.window, tracked)
    return start_output(sketches, "parquet", paths["product_sketches"], f"{paths['checkpoints']}/product_sketches",
                        name, settings.trigger)


def start_user_sessions(events: DataFrame, base_dir: str, settings: StreamSettings, gap: str = "30 minutes",
                        name: str = "sessions") -> StreamingQuery:
    """Users' sessions, each written once when the watermark has passed its end."""
    paths = layout(base_dir)
    return start_output(user_sessions(timed_events(events, settings), gap), "parquet", paths["sessions"],
                        f"{paths['checkpoints']}/sessions", name, settings.trigger)


def start_all(messages: DataFrame, base_dir: str, settings: StreamSettings | None = None,
              catalog: DataFrame | None = None, name_prefix: str = "") -> list[StreamingQuery]:
    """Decode a message stream (``value`` column) and start all four
    outputs. With a ``catalog`` the category is looked up per event
    (stream-static join) instead of taken from the message."""
    settings = settings or StreamSettings()
    events = decode_events(messages)
    if catalog is not None:
        events = enrich_with_catalog(events, catalog)
    return [
        start_raw_ingest(events, base_dir, settings, f"{name_prefix}raw"),
        start_category_metrics(events, base_dir, settings, f"{name_prefix}category_metrics"),
        start_product_metrics(events, base_dir, settings, f"{name_prefix}product_metrics"),
        start_product_alerts(events, base_dir, settings, f"{name_prefix}alerts"),
    ]


def await_all(queries: list[StreamingQuery], timeout: float | None = None) -> None:
    """Wait for every query (e.g. ``availableNow`` runs) and surface errors."""
    for q in queries:
        if timeout is None:
            q.awaitTermination()
        else:
            q.awaitTermination(timeout)
        if q.exception() is not None:
            raise q.exception()


def stop_all(queries: list[StreamingQuery]) -> None:
    """Stop queries (never the session, which the caller owns)."""
    for q in queries:
        if q.isActive:
            q.stop()


def run_available_now(messages: DataFrame, base_dir: str, settings: StreamSettings | None = None,
                      catalog: DataFrame | None = None) -> dict[str, str]:
    """Process everything available now through all outputs, then return
    the output folders."""
    settings = settings or StreamSettings()
    settings = StreamSettings(**{**settings.__dict__, "trigger": {"availableNow": True}})
    queries = start_all(messages, base_dir, settings, catalog)
    try:
        await_all(queries)
    finally:
        stop_all(queries)
    return layout(base_dir)
