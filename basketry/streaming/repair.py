"""Repair of windows that were written before all their events had come.

A window output is written once, when the watermark passes its end; rows that
come later are dropped from it but stay in raw. The repair is a stream over
raw: it finds the windows that late rows touch, counts these windows anew from raw,
and publishes the changed ones as a version numbered by the batch. Readers take the
newest version of a window, and the written one where there is none.

* **Which windows.** A row is taken for late if its window ends at or before the latest
  event time seen, its own batch included, minus the delay. The window stream drops only rows that were
  behind an earlier, lower watermark, so every dropped row is among them, however either stream is cut
  into batches and whichever runs ahead. Windows that were counted rightly come out unchanged and aren't written.
* **Exactly once.** A batch writes its rows into a folder of its own and then publishes it by creating one
  empty file, whose name holds the batch number, the latest event time and the folder. A batch that runs
  again after a failure publishes a newer folder under its number, counted from no less of raw.
* **Cost.** Raw is read for the days of the touched windows only, with the touched windows on a
  checked broadcast; the counts are partial sums, so a hot category or product costs one row a task.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from basketry import schemas
from basketry.operators.windows import category_window_metrics, product_window_metrics, window_micros
from basketry.session import written
from basketry.sources.files import read_parquet_dataset, read_raw_events
from basketry.streaming.jobs import StreamSettings, layout

#: Touched windows (counted, times a width in bytes) that are broadcast at most.
TOUCHED_BYTES, TOUCHED_WIDTH = 32 << 20, 96


@dataclass(frozen=True)
class WindowOutput:
    """A window output that can be repaired."""

    name: str
    key: str
    schema: StructType
    count: Callable[[DataFrame, str], DataFrame]

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def versioned(self) -> StructType:
        return StructType([*self.schema.fields, StructField("version", LongType())])


CATEGORY_METRICS = WindowOutput("category_metrics", "category", schemas.CATEGORY_WINDOW_METRICS, category_window_metrics)
PRODUCT_METRICS = WindowOutput("product_metrics", "product_id", schemas.PRODUCT_WINDOW_METRICS, product_window_metrics)


def _folders(base_dir: str, output: WindowOutput) -> tuple[str, str]:
    root = f"{base_dir.rstrip('/')}/processed/{output.name}_repairs"
    return f"{root}/data", f"{root}/published"


@dataclass(frozen=True)
class Published:
    """One published batch: ``latest`` is the latest event time seen up to it in microseconds, ``folder`` may be empty."""

    batch: int
    latest: int
    folder: str


def published(spark: SparkSession, base_dir: str, output: WindowOutput = CATEGORY_METRICS) -> list[Published]:
    """The published batches in order, of a batch that ran again the last one only."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(_folders(base_dir, output)[1])
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found: dict[int, tuple[int, Published]] = {}
    for status in fs.listStatus(root):
        batch, latest, attempt, folder = status.getPath().getName().split("_")
        known = found.get(int(batch))
        if known is None or int(attempt) > known[0]:
            found[int(batch)] = int(attempt), Published(int(batch), int(latest), "" if folder == "none" else folder)
    return [found[batch][1] for batch in sorted(found)]


def _publish(spark: SparkSession, base_dir: str, output: WindowOutput, entry: Published) -> None:
    jvm = spark.sparkContext._jvm
    root = _folders(base_dir, output)[1]
    earlier = [p for p in _attempts(spark, root) if p[0] == entry.batch]
    name = f"{entry.batch}_{entry.latest}_{len(earlier)}_{entry.folder or 'none'}"
    path = jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, False).close()


def _attempts(spark: SparkSession, root: str) -> list[tuple[int, int]]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return [(int(n[0]), int(n[2])) for n in (s.getPath().getName().split("_") for s in fs.listStatus(path))]


def versions(spark: SparkSession, base_dir: str, output: WindowOutput = CATEGORY_METRICS, before: int | None = None) -> DataFrame:
    """All published rows with the ``version`` (batch) they belong to, of batches below ``before`` if given."""
    data = _folders(base_dir, output)[0]
    held = [f"{data}/{p.folder}" for p in published(spark, base_dir, output) if p.folder and (before is None or p.batch < before)]
    if not held:
        return spark.createDataFrame([], output.versioned)
    return spark.read.schema(output.versioned).parquet(*held)


def repaired_metrics(spark: SparkSession, base_dir: str, output: WindowOutput = CATEGORY_METRICS, before: int | None = None,
                     starts: tuple | None = None) -> DataFrame:
    """The output as readers should see it: the newest version of each window and key.

    One aggregation over windows (not events). ``before`` leaves out versions from a batch on; ``starts``
    (first and last window start) reaches the scans."""
    plain = read_parquet_dataset(spark, layout(base_dir)[output.name], output.schema)
    rows = plain.withColumn("version", F.lit(-1).cast("long")).unionByName(versions(spark, base_dir, output, before))
    if starts:
        rows = rows.filter(F.col("window_start").between(*starts))
    keys = ["window_start", "window_end", output.key]
    values = [c for c in output.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "version").alias("newest"))
    return newest.select(*keys, "newest.*").select(*output.columns)


def repair_batch(batch: DataFrame, batch_id: int, base_dir: str, output: WindowOutput, window: str, delay: str) -> Published:
    """Count the windows anew that late rows of ``batch`` (rows of raw) touch, and publish those that changed."""
    spark = batch.sparkSession
    earlier = [p.latest for p in published(spark, base_dir, output) if p.batch < batch_id]
    timed = batch.filter(F.col("timestamp").isNotNull()).withColumn("window", F.window("timestamp", window))
    ends = timed.groupBy("window", output.key).agg(F.max(F.unix_micros("timestamp")).alias("latest"))
    ends = written(ends.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), output.key, "latest"), "touched")
    latest = max([*earlier, ends.agg(F.max("latest")).head()[0] or 0], default=0)
    touched = ends.filter(F.unix_micros("window_end") <= latest - window_micros(delay)).drop("latest")
    n = touched.count()
    folder = ""
    if n:
        touched = F.broadcast(touched) if n * TOUCHED_WIDTH <= TOUCHED_BYTES else touched
        # Each day of a touched window, from start to end: a day a row, they prune raw's folders.
        days = touched.select(F.explode(F.sequence(F.to_date("window_start"), F.to_date("window_end"))).alias("day")).distinct()
        raw = read_raw_events(spark, layout(base_dir)["raw"], missing_ok=False)
        raw = raw.filter(F.col("event_date").isin([r["day"] for r in days.collect()]))
        own = F.window("timestamp", window)
        rows = raw.filter(F.col("timestamp").isNotNull()).withColumn("start", own["start"]).alias("r")
        same = (F.col("r.start") == F.col("t.window_start")) & F.col(f"r.{output.key}").eqNullSafe(F.col(f"t.{output.key}"))
        rows = rows.join(touched.alias("t"), same, "left_semi").drop("start")
        counted = output.count(rows, window).select(*output.columns)
        starts = tuple(touched.agg(F.min("window_start"), F.max("window_start")).head())
        current = repaired_metrics(spark, base_dir, output, batch_id, tuple(F.lit(t) for t in starts))
        changed = written(counted.exceptAll(current.join(touched, ["window_start", "window_end"], "left_semi")), "repairs")
        if not changed.isEmpty():
            folder = uuid.uuid4().hex
            changed.withColumn("version", F.lit(batch_id).cast("long")).write.parquet(f"{_folders(base_dir, output)[0]}/{folder}")
    entry = Published(batch_id, latest, folder)
    _publish(spark, base_dir, output, entry)
    return entry


def start_window_repair(spark: SparkSession, base_dir: str, settings: StreamSettings, output: WindowOutput = CATEGORY_METRICS,
                        max_files_per_trigger: int | None = None, name: str = "repair") -> StreamingQuery:
    """Repair one window output from the raw output below ``base_dir``, which must exist.

    ``settings`` are those of the window output (window and delay)."""
    paths = layout(base_dir)
    reader = spark.readStream.schema(schemas.RAW_EVENT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))

    def repair(batch: DataFrame, batch_id: int) -> None:
        repair_batch(batch, batch_id, base_dir, output, settings.window, settings.delay)

    writer = reader.parquet(paths["raw"]).writeStream.foreachBatch(repair).queryName(name)
    writer = writer.option("checkpointLocation", f"{paths['checkpoints']}/{output.name}_repairs")
    if settings.trigger:
        writer = writer.trigger(**settings.trigger)
    return writer.start()
