"""End-to-end batch jobs over the datasets the stream writes.

Layout below one ``base_dir`` on shared storage (see
:func:`basketry.streaming.jobs.layout`)::

    raw/event_date=.../category=.../*.parquet     ingest stream
    processed/category_metrics, processed/product_metrics
    alerts/                                        CSV with header
    reports/conversion_rate_report/                one CSV
    reports/category_conversion/                   one CSV
    reports/user_segments/run_date=YYYY-MM-DD/     CSV
    reports/top_products/run_date=YYYY-MM-DD/      text

Each job is lazy up to its writes; small results (a report with one row per
category) are read back from what was written instead of being recomputed
from the raw scan for every follow-up figure.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import schemas
from basketry.operators.audit import combine_audits, dataset_audit, validate_report
from basketry.operators.catalog import category_conversion, normalize_catalog
from basketry.operators.hot_products import TRACKED, hot_products
from basketry.operators.funnel import average_rate, conversion_report, low_performers, top_by_rate
from basketry.operators.ranking import top_products, top_products_lines
from basketry.operators.segments import daily_events, segment_summary, user_segments
from basketry.sinks.writers import write_csv, write_lines, write_segments
from basketry.sources.files import (
    read_catalog_csv,
    read_csv_report,
    read_parquet_dataset,
    read_raw_events,
    read_report_text,
)
from basketry.streaming.jobs import layout


def _day(as_of: dt.date | str | None) -> str:
    if as_of is None:
        return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d")
    return as_of.strftime("%Y-%m-%d") if isinstance(as_of, (dt.date, dt.datetime)) else str(as_of)


def reports_dir(base_dir: str, reports_to: str | None = None) -> str:
    """``reports_to`` if given (e.g. one folder per run), else ``<base>/reports``."""
    return (reports_to or f"{base_dir.rstrip('/')}/reports").rstrip("/")


def conversion_report_job(spark: SparkSession, base_dir: str, as_of: dt.date | str | None = None,
                          min_views: int = 10, reports_to: str | None = None) -> dict[str, DataFrame]:
    """Category conversion report (all-time, or one day with ``as_of``)
    written as one CSV; returns the report, its mean rate, the top 3 and the
    low performers, all over the written report. No raw data yet gives a
    header-only report."""
    raw = read_raw_events(spark, layout(base_dir)["raw"])
    path = f"{reports_dir(base_dir, reports_to)}/conversion_rate_report"
    write_csv(conversion_report(raw, as_of=as_of), path, single_file=True)
    report = read_csv_report(spark, path)
    return {
        "report": report,
        "average": average_rate(report),
        "top": top_by_rate(report, 3),
        "low_performers": low_performers(report, min_views=min_views, k=3),
    }


def validate_report_job(spark: SparkSession, base_dir: str, reports_to: str | None = None) -> DataFrame:
    """Checks over the conversion report as it stands (one row per check). A
    report that was never written is an error."""
    path = f"{reports_dir(base_dir, reports_to)}/conversion_rate_report"
    return validate_report(read_report_text(spark, path), schemas.CONVERSION_REPORT)


def user_segmentation_job(spark: SparkSession, base_dir: str, as_of: dt.date | str | None = None,
                          reports_to: str | None = None, tolerant: bool = False) -> DataFrame:
    """Segments of the users active on ``as_of`` (default today, UTC),
    written per run date; returns the segment summary. ``tolerant`` skips
    unreadable raw files instead of failing. A day without events leaves what
    was written for it alone and returns an empty summary."""
    day = _day(as_of)
    events = daily_events(read_raw_events(spark, layout(base_dir)["raw"], tolerant), day)
    if events.isEmpty():
        return segment_summary(spark.createDataFrame([], schemas.USER_SEGMENT))
    path = write_segments(user_segments(events), reports_dir(base_dir, reports_to), day)
    return segment_summary(read_csv_report(spark, path, schemas.USER_SEGMENT))


def top_products_job(spark: SparkSession, base_dir: str, as_of: dt.date | str | None = None, k: int = 5,
                     reports_to: str | None = None, tolerant: bool = False) -> DataFrame:
    """The ``k`` most viewed products of ``as_of`` as a text report; returns
    the report's lines (``line_no, line``) as they were written. ``tolerant``
    skips unreadable raw files instead of failing. A day without events
    leaves what was written for it alone and returns no lines."""
    day = _day(as_of)
    events = daily_events(read_raw_events(spark, layout(base_dir)["raw"], tolerant), day)
    if events.isEmpty():
        return spark.createDataFrame([], "line_no int, line string")
    path = f"{reports_dir(base_dir, reports_to)}/top_products/run_date={day}"
    write_lines(top_products_lines(top_products(events, k), day, k), path)
    # One small file, read by one task in order.
    return spark.read.text(path).select((F.monotonically_increasing_id() + 1).cast("int").alias("line_no"), F.col("value").alias("line"))


def category_conversion_job(spark: SparkSession, base_dir: str, reports_to: str | None = None) -> DataFrame:
    """Product-grain stream metrics rolled up to categories, one CSV."""
    paths = layout(base_dir)
    metrics = read_parquet_dataset(spark, paths["product_metrics"], schemas.PRODUCT_WINDOW_METRICS)
    report = category_conversion(metrics, read_raw_events(spark, paths["raw"]))
    out = f"{reports_dir(base_dir, reports_to)}/category_conversion"
    write_csv(report, out, single_file=True)
    return read_csv_report(spark, out, schemas.CATEGORY_CONVERSION)


def hot_products_job(spark: SparkSession, base_dir: str, window: str = "5 minutes", threshold: int = 100,
                     tracked: int = TRACKED) -> DataFrame:
    """Groups with more than ``threshold`` events, counted exactly in raw, from the stream's window sketches
    (``window`` and ``tracked`` as the stream had them). No sketches yet gives an empty result."""
    paths = layout(base_dir)
    sketches = read_parquet_dataset(spark, paths["product_sketches"], schemas.PRODUCT_SKETCH)
    return hot_products(sketches, read_raw_events(spark, paths["raw"]), window, threshold, tracked, date_col="event_date")


def catalog_job(spark: SparkSession, catalog_csv: str, base_dir: str) -> DataFrame:
    """Normalised catalog (one row per product) stored as Parquet, each time
    as a new version below ``<base>/catalog``, so a stream that reads the
    current one isn't disturbed; it takes up the new one when restarted."""
    version = f"v{dt.datetime.now(dt.timezone.utc):%Y%m%d%H%M%S%f}"
    out = f"{base_dir.rstrip('/')}/catalog/{version}"
    normalize_catalog(read_catalog_csv(spark, catalog_csv)).write.parquet(out)
    return spark.read.schema(schemas.CATALOG).parquet(out)


def latest_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version below ``path`` (a catalog folder), or
    ``path`` itself if it has none."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory() and s.getPath().getName().startswith("v"))
    done = [n for n in names if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return spark.read.schema(schemas.CATALOG).parquet(f"{path.rstrip('/')}/{done[-1]}" if done else path)


def output_audit_job(spark: SparkSession, base_dir: str) -> DataFrame:
    """Rows, files, bytes, time range and null keys of each stream output.
    A missing output folder is an error (the stream has not produced it)."""
    paths = layout(base_dir)
    for key in ("raw", "category_metrics", "product_metrics", "alerts"):
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(paths[key])
        if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            raise FileNotFoundError(paths[key])
    return combine_audits([
        dataset_audit("raw", read_raw_events(spark, paths["raw"]), "timestamp",
                      ("user_id", "product_id", "category", "event_type", "timestamp")),
        dataset_audit("category_metrics",
                      read_parquet_dataset(spark, paths["category_metrics"], schemas.CATEGORY_WINDOW_METRICS),
                      "window_start", ("category",)),
        dataset_audit("product_metrics",
                      read_parquet_dataset(spark, paths["product_metrics"], schemas.PRODUCT_WINDOW_METRICS),
                      "window_start", ("product_id",)),
        dataset_audit("alerts", read_csv_report(spark, paths["alerts"], schemas.PRODUCT_ALERT),
                      "window_start", ("product_id", "category")),
    ])
