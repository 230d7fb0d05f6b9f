"""The registered query set: one ``(spark, sf_dir) -> DataFrame`` callable
per operator, run over the whole generated tables (mapped to shop events by
:mod:`basketry.sources.testdata`).

Parameters that differ from the operators' defaults, and why:

* reports for "a day" use ``AS_OF`` = 2024-01-30, the last day of data at
  every scale;
* alerts use 1-day windows and ``> 5`` events: with 5-minute windows and the
  default threshold of 100 the test data never alerts;
* low performers run at (product, day) grain with ``views > 1``: at category
  grain no category lacks purchases.

Timestamps are returned as ``timestamp_ntz`` (UTC wall clock) and dates as
ISO text (see ``_portable``) so they compare directly with zone-less SQL
engines and their client libraries.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampType

from basketry import schemas
from basketry.functions.codec import format_iso, parse_timestamp
from basketry.operators import (
    average_rate,
    category_conversion_of_events,
    category_window_metrics,
    conversion_report,
    daily_events,
    enrich_with_catalog,
    events_by_date,
    funnel_counts,
    funnel_join_form,
    low_performers,
    normalize_catalog,
    occurrences,
    product_alerts,
    product_category_map,
    product_views,
    product_window_metrics,
    record_counts,
    render_event_list,
    segment_summary,
    top_by_rate,
    top_products,
    top_products_lines,
    type_counts,
    union_event_sets,
    user_event_counts,
    user_event_lists,
    user_segments,
    validate_report,
    window_rates,
    with_event_date,
)
from basketry.operators.anomalies import AnomalyRule, product_counts, window_anomalies
from basketry.operators.as_of import catalog_as_of
from basketry.operators.grains import partial_counts, report_grains
from basketry.operators.hot_products import hot_products, product_sketches
from basketry.operators.ordered_funnel import follow_views, ordered_funnel
from basketry.operators.sessions import user_sessions
from basketry.operators.vocab import ADD_TO_CART, PURCHASE, VIEW
from basketry.plans.incremental import incremental_report_job
from basketry.session import fresh_dir, written
from basketry.sinks.writers import write_csv, write_raw_events
from basketry.sources.files import (
    read_catalog_csv,
    read_csv_report,
    read_parquet_dataset,
    read_raw_events,
    read_report_text,
)
from basketry.sources.streams import decode_events, encode_events, text_source
from basketry.plans import jobs
from basketry.sources.testdata import (
    SLICE_SPAN,
    catalog_versions,
    derived_table,
    disordered_folder,
    message_folder,
    part_catalog_rows,
    raw_events,
    repeated_folder,
    read_part_table,
    shop_events,
    uncategorized_events,
)
from basketry.streaming.anomalies import start_anomaly_alerts
from basketry.streaming.jobs import (
    StreamSettings,
    await_all,
    layout,
    run_available_now,
    start_category_metrics,
    start_product_alerts,
    start_product_metrics,
    start_product_sketches,
    start_raw_ingest,
    start_user_sessions,
    stop_all,
)
from basketry.streaming.repair import repaired_metrics, start_window_repair

# Fixed parameters of the registered queries.
AS_OF = "2024-01-30"
QUIET_DAY = "2031-01-01"
UNION_CUTOFF = "2024-01-16"
ALERT_WINDOW = "1 day"
ALERT_THRESHOLD = 5
METRICS_WINDOW = "5 minutes"
# A user sees a product again within days, not minutes.
FUNNEL_HORIZON = "10 days"
# Users come by a few times a day here.
SESSION_GAP = "6 hours"
REPORT_GRAINS = (("event_date", "category"), ("event_date",), ("category",), ("product_id",), ())
HOT_TRACKED = 64
# Raw has many small files here.
REPAIR_FILES = 400
# A few events a product and day: short baselines of days.
ANOMALY_RULE = AnomalyRule(history=8, min_history=4, horizon=15, silent=3, sensitivity=2.0, min_spread=0.5, min_baseline=1.0)
# Messages are in no order inside a slice of event time, and a micro-batch may
# end anywhere in a slice.
WATERMARK_DELAY = SLICE_SPAN
# Few, so that the test tables give several micro-batches (the messages
# without a category lie in fewer files).
FILES_PER_TRIGGER, FEW_FILES_PER_TRIGGER = 6, 1
TOP_K = 5
LOW_PERFORMER_MIN_VIEWS = 1

Query = Callable[[SparkSession, str], DataFrame]


def _portable(df: DataFrame) -> DataFrame:
    """Result columns in a client-neutral form: timestamps as
    ``timestamp_ntz`` (UTC wall clock) and dates as ISO ``yyyy-MM-dd`` text,
    so a comparison does not depend on how a client library maps SQL DATE."""

    def convert(f):
        if isinstance(f.dataType, TimestampType):
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, DateType):
            return F.col(f.name).cast("string").alias(f.name)
        return F.col(f.name)

    return df.select(*[convert(f) for f in df.schema.fields])


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Reports read the raw dataset ingested once from the tables (partitioned
    # by event_date and category), as they would read the stream's output.
    return raw_events(spark, sf_dir)


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_events(_events(spark, sf_dir), AS_OF)


# --- batch report (funnel) -------------------------------------------------

def q_shop_events(spark, sf_dir):
    # The ingest mapping itself, computed from the tables.
    return _portable(shop_events(spark, sf_dir))


def q_record_counts(spark, sf_dir):
    return record_counts(_events(spark, sf_dir))


def q_events_by_date(spark, sf_dir):
    return _portable(events_by_date(_events(spark, sf_dir)))


def q_event_union(spark, sf_dir):
    # Older events as written before the category column existed, newer ones
    # with it: a union by name leaves category null for the older set.
    # The date predicates prune folders, so each date is opened once.
    ev = _events(spark, sf_dir)
    cutoff, day = F.lit(UNION_CUTOFF).cast("timestamp"), F.lit(UNION_CUTOFF).cast("date")
    older = ev.filter((F.col("event_date") < day) & (F.col("timestamp") < cutoff)).drop("category", "event_date")
    newer = ev.filter((F.col("event_date") >= day) & (F.col("timestamp") >= cutoff)).drop("event_date")
    return _portable(union_event_sets([older, newer]))


def q_views_by_category(spark, sf_dir):
    return type_counts(_events(spark, sf_dir), VIEW, "views")


def q_purchases_by_category(spark, sf_dir):
    return type_counts(_events(spark, sf_dir), PURCHASE, "purchases")


def q_cart_adds_by_category(spark, sf_dir):
    return type_counts(_events(spark, sf_dir), ADD_TO_CART, "cart_adds")


def q_funnel_counts(spark, sf_dir):
    return funnel_counts(_events(spark, sf_dir))


def q_funnel_join_form(spark, sf_dir):
    return funnel_join_form(_events(spark, sf_dir))


def q_conversion_report(spark, sf_dir):
    return conversion_report(_events(spark, sf_dir))


def q_avg_conversion_rate(spark, sf_dir):
    return average_rate(conversion_report(_events(spark, sf_dir), ordered=False))


def q_top_categories(spark, sf_dir):
    return top_by_rate(conversion_report(_events(spark, sf_dir), ordered=False), k=3)


def q_low_performers(spark, sf_dir):
    keys = ("product_id", "event_date")
    report = conversion_report(with_event_date(_events(spark, sf_dir)), keys=keys, ordered=False)
    return _portable(low_performers(report, min_views=LOW_PERFORMER_MIN_VIEWS, k=3, keys=keys))


def q_report_csv_roundtrip(spark, sf_dir):
    path = fresh_dir(spark, "conversion_report")
    write_csv(conversion_report(_events(spark, sf_dir)), path, single_file=True)
    return read_csv_report(spark, path)


def q_report_validation(spark, sf_dir):
    path = fresh_dir(spark, "conversion_report")
    write_csv(conversion_report(_events(spark, sf_dir)), path, single_file=True)
    return validate_report(read_report_text(spark, path), schemas.CONVERSION_REPORT)


# --- daily segmentation and ranking ---------------------------------------

def q_daily_events(spark, sf_dir):
    return _portable(_daily(spark, sf_dir).drop("event_date"))


def q_user_event_lists(spark, sf_dir):
    lists = user_event_lists(_daily(spark, sf_dir))
    return lists.select(
        "user_id",
        render_event_list("event_list").alias("event_list"),
        occurrences("event_list", PURCHASE).alias("purchases"),
        occurrences("event_list", ADD_TO_CART).alias("cart_adds"),
        occurrences("event_list", VIEW).alias("views"),
    )


def q_user_event_counts(spark, sf_dir):
    return user_event_counts(_daily(spark, sf_dir))


def q_user_segments(spark, sf_dir):
    return user_segments(_daily(spark, sf_dir))


def q_segment_summary(spark, sf_dir):
    return segment_summary(user_segments(_daily(spark, sf_dir)))


def q_product_views(spark, sf_dir):
    return product_views(_daily(spark, sf_dir))


def q_top_products(spark, sf_dir):
    return top_products(_daily(spark, sf_dir), TOP_K)


def q_top_products_lines(spark, sf_dir):
    return top_products_lines(top_products(_daily(spark, sf_dir), TOP_K), AS_OF, TOP_K)


# --- window aggregates (batch) ---------------------------------------------

def q_window_category_metrics(spark, sf_dir):
    return _portable(category_window_metrics(_events(spark, sf_dir), METRICS_WINDOW))


def q_window_category_metrics_literal(spark, sf_dir):
    return _portable(category_window_metrics(_events(spark, sf_dir), METRICS_WINDOW, literal_counts=True))


def q_window_product_alerts(spark, sf_dir):
    return _portable(product_alerts(_events(spark, sf_dir), ALERT_WINDOW, ALERT_THRESHOLD))


def q_window_product_metrics(spark, sf_dir):
    return _portable(product_window_metrics(_events(spark, sf_dir), METRICS_WINDOW))


def q_window_anomalies(spark, sf_dir):
    counts = product_counts(_events(spark, sf_dir), ALERT_WINDOW)
    return _portable(window_anomalies(counts, ALERT_WINDOW, ANOMALY_RULE))


def q_window_category_rates(spark, sf_dir):
    return _portable(window_rates(category_window_metrics(_events(spark, sf_dir), METRICS_WINDOW)))


# --- catalog and category roll-up ------------------------------------------

def q_product_category_map(spark, sf_dir):
    return product_category_map(_events(spark, sf_dir))


def q_category_conversion_report(spark, sf_dir):
    return category_conversion_of_events(_events(spark, sf_dir))


def _write_catalog_csv(spark: SparkSession, lines: DataFrame, path: str | None = None) -> str:
    path = path or fresh_dir(spark, "catalog")
    (lines.write.mode("overwrite").option("header", "true")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(path))
    return path


def q_catalog_normalize(spark, sf_dir):
    # The whole part table as a hand-kept catalog: ids lower-case and padded
    # with blanks, categories padded, columns in another order, and every
    # seventh product listed earlier with its brand instead of its type.
    # Normalising restores ids and keeps each product's last line.
    part = read_part_table(spark, sf_dir)

    def lines(rows, category):
        return rows.select(
            F.concat(F.lit(" "), F.col(category), F.lit(" ")).alias("category"),
            F.col("p_brand").alias("note"),
            F.concat(F.lit(" "), F.format_string("p%04d", "p_partkey"), F.lit(" ")).alias("product_id"),
        )

    # Lines stand in the order of file names: the earlier listing first.
    path = fresh_dir(spark, "catalog")
    _write_catalog_csv(spark, lines(part.filter(F.col("p_partkey") % 7 == 0), "p_brand"), f"{path}/part=1")
    _write_catalog_csv(spark, lines(part, "p_type"), f"{path}/part=2")
    return normalize_catalog(read_catalog_csv(spark, path))


def q_catalog_enrich(spark, sf_dir):
    path = _write_catalog_csv(spark, part_catalog_rows(spark, sf_dir).drop("line_order"))
    catalog = normalize_catalog(read_catalog_csv(spark, path))
    return _portable(enrich_with_catalog(uncategorized_events(spark, sf_dir), catalog))


# --- codec -----------------------------------------------------------------

def q_event_json_encode(spark, sf_dir):
    return encode_events(_events(spark, sf_dir))


def q_event_json_decode(spark, sf_dir):
    messages = encode_events(_events(spark, sf_dir)).select(F.col("value").cast("binary").alias("value"))
    return _portable(decode_events(messages))


def q_timestamp_parse(spark, sf_dir):
    text = _events(spark, sf_dir).select(format_iso("timestamp").alias("timestamp_text"))
    return _portable(text.select("timestamp_text", parse_timestamp("timestamp_text").alias("timestamp")))


# --- streaming ---------------------------------------------------------------

def _run_stream(starter, events: DataFrame, base: str, settings: StreamSettings) -> None:
    # Active query names must be unique in a session; the base folder is.
    query = starter(events, base, settings, name=f"{starter.__name__}-{base.rsplit('-', 1)[-1]}")
    try:
        await_all([query])
    finally:
        stop_all([query])


def _stream_events(spark: SparkSession, sf_dir: str, categorized: bool = True) -> DataFrame:
    limit = FILES_PER_TRIGGER if categorized else FEW_FILES_PER_TRIGGER
    return decode_events(text_source(spark, message_folder(spark, sf_dir, categorized), limit))


def _disordered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_events(text_source(spark, disordered_folder(spark, sf_dir), FILES_PER_TRIGGER))


_AVAILABLE_NOW = StreamSettings(
    window=METRICS_WINDOW,
    delay=WATERMARK_DELAY,
    alert_window=ALERT_WINDOW,
    alert_threshold=ALERT_THRESHOLD,
    trigger={"availableNow": True},
)


def _raw_columns(raw: DataFrame) -> DataFrame:
    return _portable(raw.select("user_id", "product_id", "event_type", "timestamp", "event_date", "category"))


def q_stream_raw_ingest(spark, sf_dir):
    base = fresh_dir(spark, "stream")
    _run_stream(start_raw_ingest, _stream_events(spark, sf_dir), base, _AVAILABLE_NOW)
    return _raw_columns(read_raw_events(spark, layout(base)["raw"], missing_ok=False))


def q_stream_category_metrics(spark, sf_dir):
    base = fresh_dir(spark, "stream")
    _run_stream(start_category_metrics, _stream_events(spark, sf_dir), base, _AVAILABLE_NOW)
    return _portable(read_parquet_dataset(spark, layout(base)["category_metrics"], schemas.CATEGORY_WINDOW_METRICS))


def q_stream_category_rates(spark, sf_dir):
    base = fresh_dir(spark, "stream")
    settings = StreamSettings(**{**_AVAILABLE_NOW.__dict__, "with_rates": True})
    _run_stream(start_category_metrics, _stream_events(spark, sf_dir), base, settings)
    return _portable(read_parquet_dataset(spark, layout(base)["category_metrics"], schemas.CATEGORY_WINDOW_RATES))


def q_stream_product_alerts(spark, sf_dir):
    base = fresh_dir(spark, "stream")
    _run_stream(start_product_alerts, _stream_events(spark, sf_dir), base, _AVAILABLE_NOW)
    return _portable(read_csv_report(spark, layout(base)["alerts"], schemas.PRODUCT_ALERT))


def q_stream_product_metrics(spark, sf_dir):
    base = fresh_dir(spark, "stream")
    _run_stream(start_product_metrics, _stream_events(spark, sf_dir), base, _AVAILABLE_NOW)
    return _portable(read_parquet_dataset(spark, layout(base)["product_metrics"], schemas.PRODUCT_WINDOW_METRICS))


def q_stream_anomaly_alerts(spark, sf_dir):
    base = fresh_dir(spark, "stream")

    def start(events, base_dir, settings, name):
        return start_anomaly_alerts(events, base_dir, settings, ANOMALY_RULE, name)

    _run_stream(start, _stream_events(spark, sf_dir), base, _AVAILABLE_NOW)
    return _portable(read_parquet_dataset(spark, layout(base)["anomalies"], schemas.ANOMALY))


def q_catalog_as_of(spark, sf_dir):
    return _portable(catalog_as_of(uncategorized_events(spark, sf_dir), catalog_versions(spark, sf_dir)))


def q_ordered_funnel(spark, sf_dir):
    return ordered_funnel(_events(spark, sf_dir), FUNNEL_HORIZON)


def q_follow_views(spark, sf_dir):
    return _portable(follow_views(_events(spark, sf_dir), FUNNEL_HORIZON))


def q_user_sessions(spark, sf_dir):
    return _portable(user_sessions(_events(spark, sf_dir), SESSION_GAP))


def q_stream_user_sessions(spark, sf_dir):
    base = fresh_dir(spark, "stream")

    def start(events, base_dir, settings, name):
        return start_user_sessions(events, base_dir, settings, SESSION_GAP, name)

    _run_stream(start, _stream_events(spark, sf_dir), base, _AVAILABLE_NOW)
    return _portable(read_parquet_dataset(spark, layout(base)["sessions"], schemas.USER_SESSION))


def q_report_grains(spark, sf_dir):
    return _portable(report_grains(written(partial_counts(_events(spark, sf_dir)), "partials"), REPORT_GRAINS))


def q_incremental_report(spark, sf_dir):
    # Raw grows in three steps: older days, newer days, and rows that change older days.
    base, events = fresh_dir(spark, "incremental"), _events(spark, sf_dir)
    cutoff, late = F.lit(UNION_CUTOFF).cast("timestamp"), F.col("user_id").like("%7")
    for part in ((F.col("timestamp") < cutoff) & ~late, F.col("timestamp") >= cutoff, (F.col("timestamp") < cutoff) & late):
        write_raw_events(events.filter(part), layout(base)["raw"], mode="append")
        report = incremental_report_job(spark, base)
    return report


def q_hot_products(spark, sf_dir):
    # Few counters: some days are counted from candidates, some whole.
    events = _events(spark, sf_dir)
    sketches = product_sketches(events, ALERT_WINDOW, HOT_TRACKED)
    return _portable(hot_products(sketches, events, ALERT_WINDOW, ALERT_THRESHOLD, HOT_TRACKED, date_col="event_date"))


def q_stream_hot_products(spark, sf_dir):
    base = fresh_dir(spark, "stream")

    def start(events, base_dir, settings, name):
        return start_product_sketches(events, base_dir, settings, HOT_TRACKED, name)

    _run_stream(start, _stream_events(spark, sf_dir), base, _AVAILABLE_NOW)
    _run_stream(start_raw_ingest, _stream_events(spark, sf_dir), base, _AVAILABLE_NOW)
    return _portable(jobs.hot_products_job(spark, base, ALERT_WINDOW, ALERT_THRESHOLD, HOT_TRACKED))


def q_stream_repaired_metrics(spark, sf_dir):
    # Late copies that the window stream dropped are counted after all.
    base = fresh_dir(spark, "stream")
    _run_stream(start_raw_ingest, _disordered_events(spark, sf_dir), base, _AVAILABLE_NOW)
    _run_stream(start_category_metrics, _disordered_events(spark, sf_dir), base, _AVAILABLE_NOW)
    repair = start_window_repair(spark, base, _AVAILABLE_NOW, max_files_per_trigger=REPAIR_FILES, name=f"repair-{base.rsplit('-', 1)[-1]}")
    try:
        await_all([repair])
    finally:
        stop_all([repair])
    return _portable(repaired_metrics(spark, base))


def q_stream_repeated_metrics(spark, sf_dir):
    # Messages sent two and three times count once.
    base = fresh_dir(spark, "stream")
    events = decode_events(text_source(spark, repeated_folder(spark, sf_dir), FILES_PER_TRIGGER))
    settings = StreamSettings(**{**_AVAILABLE_NOW.__dict__, "drop_repeats": True})
    _run_stream(start_category_metrics, events, base, settings)
    return _portable(read_parquet_dataset(spark, layout(base)["category_metrics"], schemas.CATEGORY_WINDOW_METRICS))


def q_stream_disordered_raw(spark, sf_dir):
    # Late copies, unreadable times and broken messages all reach raw.
    base = fresh_dir(spark, "stream")
    _run_stream(start_raw_ingest, _disordered_events(spark, sf_dir), base, _AVAILABLE_NOW)
    return _raw_columns(read_raw_events(spark, layout(base)["raw"], missing_ok=False))


def q_stream_disordered_metrics(spark, sf_dir):
    # The windows are as if nothing had been late, broken or without a time.
    base = fresh_dir(spark, "stream")
    _run_stream(start_category_metrics, _disordered_events(spark, sf_dir), base, _AVAILABLE_NOW)
    return _portable(read_parquet_dataset(spark, layout(base)["category_metrics"], schemas.CATEGORY_WINDOW_METRICS))


def q_stream_restarted_ingest(spark, sf_dir):
    # Stopped between batches, then started again on its checkpoint: every message once.
    base, messages = fresh_dir(spark, "stream"), _stream_events(spark, sf_dir)
    settings = StreamSettings(**{**_AVAILABLE_NOW.__dict__, "trigger": {"processingTime": "0 seconds"}})
    query = start_raw_ingest(messages, base, settings, name=f"first-run-{base.rsplit('-', 1)[-1]}")
    deadline = time.monotonic() + 120
    try:
        while query.exception() is None and time.monotonic() < deadline:
            if sum(p["numInputRows"] > 0 for p in query.recentProgress) >= 2:
                break
            time.sleep(0.1)
    finally:
        stop_all([query])
    _run_stream(start_raw_ingest, messages, base, _AVAILABLE_NOW)
    return _raw_columns(read_raw_events(spark, layout(base)["raw"], missing_ok=False))


def q_stream_catalog_enrich(spark, sf_dir):
    # Messages without a category; the stream looks it up in the catalog
    # (stream-static join) before writing raw. Every micro-batch reads the
    # catalog again: it is normalised once, before.
    base = fresh_dir(spark, "stream")
    catalog = written(normalize_catalog(part_catalog_rows(spark, sf_dir)), "catalog")
    events = enrich_with_catalog(_stream_events(spark, sf_dir, categorized=False), catalog)
    _run_stream(start_raw_ingest, events, base, _AVAILABLE_NOW)
    return _raw_columns(read_raw_events(spark, layout(base)["raw"], missing_ok=False))


def _stream_outputs(spark: SparkSession, sf_dir: str) -> str:
    """Base folder holding every stream output over the message folder,
    produced once per input signature (like the other derived tables)."""

    def write(base: str) -> None:
        run_available_now(text_source(spark, message_folder(spark, sf_dir), FILES_PER_TRIGGER), base, _AVAILABLE_NOW)

    return derived_table(spark, sf_dir, "stream-outputs", write)


# The jobs read the shared stream outputs and write each run's reports to a
# new folder.

def q_job_conversion_report(spark, sf_dir):
    base = _stream_outputs(spark, sf_dir)
    return jobs.conversion_report_job(spark, base, reports_to=fresh_dir(spark, "reports"))["report"]


def q_job_segment_summary(spark, sf_dir):
    base = _stream_outputs(spark, sf_dir)
    return jobs.user_segmentation_job(spark, base, AS_OF, reports_to=fresh_dir(spark, "reports"))


def q_job_top_products(spark, sf_dir):
    base = _stream_outputs(spark, sf_dir)
    return jobs.top_products_job(spark, base, AS_OF, TOP_K, reports_to=fresh_dir(spark, "reports"))


def q_job_category_conversion(spark, sf_dir):
    base = _stream_outputs(spark, sf_dir)
    return jobs.category_conversion_job(spark, base, reports_to=fresh_dir(spark, "reports"))


def q_tolerant_scan(spark, sf_dir):
    # Raw with a file that is no Parquet: skipped, its neighbours are read.
    path = fresh_dir(spark, "damaged")
    write_raw_events(_events(spark, sf_dir), path, mode="overwrite")
    junk = spark.range(1).select(F.lit("no parquet").alias("value"))
    junk.coalesce(1).write.text(f"{path}/event_date={AS_OF}/category=DAMAGED")
    return _portable(events_by_date(read_raw_events(spark, path, tolerant=True, missing_ok=False).filter("timestamp is not null")))


def q_missing_input_report(spark, sf_dir):
    # Nothing has been ingested below the second folder: its report is empty, and typed like the first.
    reports = [("raw", _events(spark, sf_dir)), ("missing", read_raw_events(spark, f"{fresh_dir(spark, 'nowhere')}/raw"))]
    return reduce(DataFrame.unionByName, [conversion_report(e, ordered=False).withColumn("source", F.lit(name)) for name, e in reports])


def q_quiet_day_jobs(spark, sf_dir):
    # A day without events ends quietly, with no rows and no files in place of a report.
    base, found = _stream_outputs(spark, sf_dir), []
    for day in (AS_OF, QUIET_DAY):
        to = fresh_dir(spark, "reports")
        segments = jobs.user_segmentation_job(spark, base, day, reports_to=to).select("segment", "users")
        lines = jobs.top_products_job(spark, base, day, TOP_K, reports_to=to).agg(F.count(F.lit(1)).alias("users"))
        both = segments.unionByName(lines.select(F.lit("report lines").alias("segment"), "users"))
        found.append(both.withColumn("day", F.lit(day)))
    return found[0].unionByName(found[1])


def q_segments_today(spark, sf_dir):
    # The last day of data moved to today: the jobs' default day.
    days = F.datediff(F.current_date(), F.lit(AS_OF).cast("date"))
    moved = _events(spark, sf_dir).drop("event_date").withColumn("timestamp", F.col("timestamp") + F.make_dt_interval(days=days))
    return user_segments(daily_events(moved))


def q_output_audit(spark, sf_dir):
    # Audit the stream outputs the job queries read. How many files and bytes
    # they take depends on the writers; that there are some does not.
    audit = jobs.output_audit_job(spark, _stream_outputs(spark, sf_dir))
    has_files = ((F.col("files") > 0) & (F.col("bytes") > 0)).alias("has_files")
    return _portable(audit.select("dataset", "rows", has_files, "first_time", "last_time", "null_key_rows"))


def _in_utc(fn: Query) -> Query:
    """The data's timestamps are UTC wall-clock times; event dates, day
    boundaries and the ``timestamp_ntz`` output assume a UTC session."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


_QUERIES: dict[str, Query] = {
    "shop_events": q_shop_events,
    "record_counts": q_record_counts,
    "events_by_date": q_events_by_date,
    "event_union": q_event_union,
    "views_by_category": q_views_by_category,
    "purchases_by_category": q_purchases_by_category,
    "cart_adds_by_category": q_cart_adds_by_category,
    "funnel_counts": q_funnel_counts,
    "funnel_join_form": q_funnel_join_form,
    "conversion_report": q_conversion_report,
    "avg_conversion_rate": q_avg_conversion_rate,
    "top_categories": q_top_categories,
    "low_performers": q_low_performers,
    "report_csv_roundtrip": q_report_csv_roundtrip,
    "daily_events": q_daily_events,
    "user_event_lists": q_user_event_lists,
    "user_event_counts": q_user_event_counts,
    "user_segments": q_user_segments,
    "segment_summary": q_segment_summary,
    "product_views": q_product_views,
    "top_products": q_top_products,
    "top_products_lines": q_top_products_lines,
    "window_category_metrics": q_window_category_metrics,
    "window_category_metrics_literal": q_window_category_metrics_literal,
    "window_product_alerts": q_window_product_alerts,
    "window_product_metrics": q_window_product_metrics,
    "window_category_rates": q_window_category_rates,
    "window_anomalies": q_window_anomalies,
    "hot_products": q_hot_products,
    "user_sessions": q_user_sessions,
    "report_grains": q_report_grains,
    "incremental_report": q_incremental_report,
    "catalog_as_of": q_catalog_as_of,
    "ordered_funnel": q_ordered_funnel,
    "follow_views": q_follow_views,
    "product_category_map": q_product_category_map,
    "category_conversion_report": q_category_conversion_report,
    "catalog_normalize": q_catalog_normalize,
    "catalog_enrich": q_catalog_enrich,
    "event_json_encode": q_event_json_encode,
    "event_json_decode": q_event_json_decode,
    "timestamp_parse": q_timestamp_parse,
    "stream_raw_ingest": q_stream_raw_ingest,
    "stream_category_metrics": q_stream_category_metrics,
    "stream_category_rates": q_stream_category_rates,
    "stream_product_alerts": q_stream_product_alerts,
    "stream_product_metrics": q_stream_product_metrics,
    "stream_anomaly_alerts": q_stream_anomaly_alerts,
    "stream_hot_products": q_stream_hot_products,
    "stream_repeated_metrics": q_stream_repeated_metrics,
    "stream_user_sessions": q_stream_user_sessions,
    "stream_repaired_metrics": q_stream_repaired_metrics,
    "stream_catalog_enrich": q_stream_catalog_enrich,
    "stream_disordered_raw": q_stream_disordered_raw,
    "stream_disordered_metrics": q_stream_disordered_metrics,
    "output_audit": q_output_audit,
    "job_conversion_report": q_job_conversion_report,
    "job_segment_summary": q_job_segment_summary,
    "job_top_products": q_job_top_products,
    "job_category_conversion": q_job_category_conversion,
    "report_validation": q_report_validation,
    "stream_restarted_ingest": q_stream_restarted_ingest,
    "tolerant_scan": q_tolerant_scan,
    "missing_input_report": q_missing_input_report,
    "job_quiet_day": q_quiet_day_jobs,
    "segments_today": q_segments_today,
}

QUERIES: dict[str, Query] = {name: _in_utc(fn) for name, fn in _QUERIES.items()}
