"""Shop events derived from the generated test tables.

``events(event_id, ts, user_id, event_type, value, props)`` and
``part(p_partkey, p_type, ...)`` map to shop events as follows:

* ``user_id``    = ``U`` + user number zero-padded to 4 digits
* ``product_id`` = ``P`` + ``props.k`` zero-padded to 4 digits; null for
  ``signup`` and ``error`` events, which concern no product
* ``category``   = catalog lookup of the product in the whole ``part`` table,
  ``UNKNOWN`` when absent (so for events without a product); the catalog
  category is ``upper(trim(p_type))``
* ``event_type`` = ``click`` becomes ``add_to_cart``, others unchanged
* ``timestamp``  = ``ts`` read as a zone-aware timestamp (session zone UTC),
  which is what event-time watermarks require
"""

from __future__ import annotations

import functools
import hashlib
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.text import padded_id
from basketry.operators.catalog import enrich_with_catalog, normalize_catalog
from basketry.operators.vocab import ADD_TO_CART
from basketry.session import fresh_dir, shared_dir
from basketry.sinks.writers import write_raw_events
from basketry.sources.files import read_raw_events
from basketry.sources.streams import encode_events

# Fixed values of the mapping.
CLICK = "click"
NO_PRODUCT_TYPES = ("signup", "error")

# Messages are appended in slices of event time, oldest first, as a topic
# would receive them; inside a slice they are in no order, so a stream over
# them needs a watermark delay of one slice. Slices are counted from the
# origin, over whatever time the events span.
SLICE_ORIGIN, SLICE_DAYS = "2024-01-01", 5
SLICE_SPAN = f"{SLICE_DAYS} days"
# A message file has this many messages, fewer where the events would not fill
# the least number of files: a stream's micro-batches are counted in files, so
# their number must follow the messages and not the folders or splits that the
# events come in. Messages without a category come in fewer and larger files.
MESSAGES_PER_FILE, MESSAGES_PER_FILE_UNCATEGORIZED = 1_000_000, 1_500_000
LEAST_FILES, LEAST_FILES_UNCATEGORIZED = 40, 4
# Disturbances of the disordered messages, by the user's id: copies of old
# events that arrive after all slices, events with an unreadable time, and
# messages that are no JSON.
LATE_USERS, LATE_BEFORE = "%7", "2024-01-16"
TIMELESS_USERS = "%03"
BROKEN_USERS = "%11"
# Events that a producer sends again, at once and after the next slice.
REPEATED_USERS = "%3"

EVENTS_SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
PART_SCHEMA = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    # ``ts`` is stored without a zone; reading it as ``timestamp`` keeps the
    # same wall-clock value under a UTC session and lets range filters on it
    # reach the Parquet scan.
    return spark.read.schema(EVENTS_SCHEMA).parquet(table_path(sf_dir, "events"))


def read_part_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(PART_SCHEMA).parquet(table_path(sf_dir, "part"))


def uncategorized_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shop events before the catalog lookup (no ``category``)."""
    e = read_events_table(spark, sf_dir)
    k = F.get_json_object("props", "$.k").try_cast("long")
    event_type = F.when(F.col("event_type") == CLICK, F.lit(ADD_TO_CART)).otherwise(F.col("event_type"))
    return e.select(
        padded_id("U", "user_id").alias("user_id"),
        F.when(~F.col("event_type").isin(*NO_PRODUCT_TYPES), padded_id("P", k)).alias("product_id"),
        event_type.alias("event_type"),
        F.col("ts").alias("timestamp"),
    )


def part_catalog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog lines ``(product_id, category, line_order)`` from ``part``."""
    return read_part_table(spark, sf_dir).select(
        padded_id("P", "p_partkey").alias("product_id"),
        F.upper(F.col("p_type")).alias("category"),
        F.col("p_partkey").alias("line_order"),
    )


def part_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised catalog, one row per product."""
    return normalize_catalog(part_catalog_rows(spark, sf_dir))


def catalog_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog with a history, ``product_id, valid_from, category``: every product is listed at some minute
    from 2024-01-04 on by its brand and ten days later by its type; every fifth goes without a category after six more."""
    part = read_part_table(spark, sf_dir)
    first = F.lit("2024-01-04").cast("timestamp") + F.make_dt_interval(mins=(F.col("p_partkey") * 37 % 5000).cast("int"))
    id_ = padded_id("P", "p_partkey").alias("product_id")
    listed = part.select(id_, first.alias("valid_from"), F.upper("p_brand").alias("category"))
    typed = part.select(id_, (first + F.make_dt_interval(days=F.lit(10))).alias("valid_from"), F.upper("p_type").alias("category"))
    dropped = part.filter(F.col("p_partkey") % 5 == 0)
    gone = dropped.select(id_, (first + F.make_dt_interval(days=F.lit(16))).alias("valid_from"), F.lit(None).cast("string").alias("category"))
    return listed.unionByName(typed).unionByName(gone)


def shop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_id, product_id, category, event_type, timestamp``."""
    events = uncategorized_events(spark, sf_dir)
    enriched = enrich_with_catalog(events, part_catalog(spark, sf_dir))
    return enriched.select("user_id", "product_id", "category", "event_type", "timestamp")


# Keeps concurrent callers in one process from writing a table twice.
_WRITE_LOCK = threading.RLock()


@functools.lru_cache(maxsize=1)
def _code_version() -> str:
    """Digest of the package's code, so a table derived by older code (a
    different mapping, window rule or stream job) is never reused."""
    import pathlib

    root = pathlib.Path(__file__).resolve().parent.parent
    h = hashlib.sha1()
    for path in sorted(root.rglob("*.py")):
        h.update(path.relative_to(root).as_posix().encode())
        h.update(path.read_bytes())
    return h.hexdigest()[:12]


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _signature(spark: SparkSession, sf_dir: str) -> str:
    """Identity of the input tables (path, total bytes, file count and
    modification time, through the Hadoop file system so any storage scheme
    works) and of the package's code."""
    parts = [sf_dir.rstrip("/"), _code_version()]
    for name in ("events", "part"):
        p, fs = _hadoop_fs(spark, table_path(sf_dir, name))
        if fs.exists(p):
            summary = fs.getContentSummary(p)
            mtime = fs.getFileStatus(p).getModificationTime()
            parts.append(f"{name}:{summary.getLength()}:{summary.getFileCount()}:{mtime}")
    return hashlib.sha1("|".join(parts).encode()).hexdigest()[:16]


def _committed(spark: SparkSession, path: str) -> bool:
    marker, fs = _hadoop_fs(spark, f"{path}/_SUCCESS")
    return bool(fs.exists(marker))


def mark_committed(spark: SparkSession, path: str) -> None:
    """Write the ``_SUCCESS`` marker for a folder filled by several jobs."""
    marker, fs = _hadoop_fs(spark, f"{path}/_SUCCESS")
    fs.create(marker, True).close()


def _published(spark: SparkSession, pointer: str) -> str | None:
    """The folder a pointer file names, if that folder is (still) complete."""
    p, fs = _hadoop_fs(spark, pointer)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        path = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()
    return path if path and _committed(spark, path) else None


def _publish(spark: SparkSession, pointer: str, path: str) -> None:
    p, fs = _hadoop_fs(spark, pointer)
    out = fs.create(p, True)
    try:
        out.write(bytearray(path.encode()))
    finally:
        out.close()


def derived_table(spark: SparkSession, sf_dir: str, kind: str, write, refresh: bool = False) -> str:
    """Path of a table derived from the test tables, written into the shared
    folder by ``write(path)`` and found again by its signature.

    Each write goes to a new folder; a small pointer file, written last,
    names it, so readers only ever see complete folders and two processes
    that derive the same table don't disturb each other (the later pointer
    stays). A folder that has gone, or was never completed, is derived
    anew. ``refresh`` writes a new copy in any case."""
    pointer = f"{shared_dir(spark)}/{kind}-{_signature(spark, sf_dir)}.path"
    with _WRITE_LOCK:
        path = None if refresh else _published(spark, pointer)
        if path is None:
            path = fresh_dir(spark, kind)
            write(path)
            mark_committed(spark, path)
            _publish(spark, pointer, path)
    return path


def raw_dataset(spark: SparkSession, sf_dir: str, refresh: bool = False) -> str:
    """Path of the raw event dataset ingested from the test tables.

    The batch counterpart of the ingest stream: shop events written once as
    Parquet partitioned by ``event_date`` and ``category`` into the shared
    folder, then reused by every report.
    """

    def write(path: str) -> None:
        events = shop_events(spark, sf_dir).withColumn("event_date", F.to_date("timestamp"))
        # Rebalance lets AQE size the output files and split a hot
        # (date, category) partition over several writers.
        write_raw_events(events.hint("rebalance", "event_date", "category"), path, mode="overwrite")

    return derived_table(spark, sf_dir, "raw", write, refresh)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingested raw dataset with shop-event columns first and the
    ``event_date`` partition column kept for pruning."""
    raw = read_raw_events(spark, raw_dataset(spark, sf_dir), missing_ok=False)
    return raw.select("user_id", "product_id", "category", "event_type", "timestamp", "event_date")


def _slices(events: DataFrame, most: int = MESSAGES_PER_FILE, least_files: int = LEAST_FILES) -> list[tuple[DataFrame, int]]:
    """Events by slice of event time, oldest first, each with the messages
    that a file of it has.

    Neighbouring slices that fit into one file together are taken as one: a
    file is never divided among micro-batches. No events give one empty slice."""
    day = F.col("event_date") if "event_date" in events.columns else F.to_date("timestamp")
    origin = F.lit(SLICE_ORIGIN).cast("date")
    number = F.floor(F.datediff(day, origin) / SLICE_DAYS)
    counted = events.filter(day.isNotNull()).groupBy(number.alias("slice")).agg(F.count(F.lit(1)).alias("rows")).orderBy("slice").collect()
    per_file = max(1, min(most, sum(r["rows"] for r in counted) // least_files))
    spans: list[list[int]] = []
    for r in counted:
        if spans and spans[-1][2] + r["rows"] <= per_file:
            spans[-1][1:] = [r["slice"], spans[-1][2] + r["rows"]]
        else:
            spans.append([r["slice"], r["slice"], r["rows"]])

    def start(slice_: int) -> Column:
        return F.date_add(origin, SLICE_DAYS * slice_)

    parts = [(events.filter((day >= start(first)) & (day < start(last + 1))), per_file) for first, last, _ in spans]
    return parts or [(events.filter(F.lit(False)), per_file)]


def _append_messages(messages: DataFrame, path: str, per_file: int) -> None:
    """Append a frame of message texts to a folder in as few files as ``per_file`` allows."""
    messages.coalesce(max(1, -(-messages.count() // per_file))).write.mode("append").text(path)


def message_folder(spark: SparkSession, sf_dir: str, categorized: bool = True, refresh: bool = False) -> str:
    """Folder of JSON-lines messages, one per event: the retained topic the
    streaming queries consume (a file-source stand-in for Kafka), appended
    slice by slice. Without ``categorized`` the messages carry a null
    category, for streams that look it up in the catalog."""

    def write(path: str) -> None:
        if categorized:
            slices = _slices(raw_events(spark, sf_dir))
        else:
            events = uncategorized_events(spark, sf_dir).withColumn("category", F.lit(None).cast("string"))
            slices = _slices(events, MESSAGES_PER_FILE_UNCATEGORIZED, LEAST_FILES_UNCATEGORIZED)
        for part, per_file in slices:
            _append_messages(encode_events(part), path, per_file)

    kind = "messages" if categorized else "messages-uncategorized"
    return derived_table(spark, sf_dir, kind, write, refresh)


def late_copies(events: DataFrame) -> DataFrame:
    """The old events that the disordered messages bring again, too late."""
    return events.filter(F.col("user_id").like(LATE_USERS) & (F.col("timestamp") < F.lit(LATE_BEFORE).cast("timestamp")))


def disordered_folder(spark: SparkSession, sf_dir: str) -> str:
    """The messages of :func:`message_folder` with disturbances derived from
    the events: next to the first slice messages with an unreadable time
    and messages that are no JSON, and after the last slice copies of
    events whose windows are long closed."""

    def write(path: str) -> None:
        events = raw_events(spark, sf_dir)
        slices = _slices(events)
        per_file = slices[0][1]
        timeless = F.regexp_replace("value", '"timestamp":"[^"]*"', '"timestamp":"soon"').alias("value")
        _append_messages(encode_events(events.filter(F.col("user_id").like(TIMELESS_USERS))).select(timeless), path, per_file)
        broken = events.filter(F.col("user_id").like(BROKEN_USERS))
        _append_messages(broken.select(F.concat(F.lit("{broken "), "user_id").alias("value")), path, per_file)
        for part, _ in slices:
            _append_messages(encode_events(part), path, per_file)
        _append_messages(encode_events(late_copies(events)), path, per_file)

    return derived_table(spark, sf_dir, "messages-disordered", write)


def repeated_folder(spark: SparkSession, sf_dir: str) -> str:
    """The messages of :func:`message_folder` as a producer with retries sends
    them: some events stand twice in their slice and once more after the next."""

    def write(path: str) -> None:
        before = None
        for part, per_file in _slices(raw_events(spark, sf_dir)):
            again = part.filter(F.col("user_id").like(REPEATED_USERS))
            for rows in (part, again, before):
                if rows is not None:
                    _append_messages(encode_events(rows), path, per_file)
            before = again

    return derived_table(spark, sf_dir, "messages-repeated", write)
