"""Reports that read only what is new in raw.

Raw's days are counted once into partial counts (:mod:`basketry.operators.grains`) kept below
``<base>/partials``. A manifest says, for every day, which files of raw its counts were
made from and in which folder they lie. An update compares that with the files
raw has now, counts the days that differ (late rows change a day) and publishes a new manifest;
reports add up the partial counts.

Files of raw are never changed in place (writers give new names), so a day's
file names tell whether it has changed. A manifest is published by creating one empty file
that names it, after all it refers to has been written: readers see the old
state or the new one, and an update that fails leaves nothing but unused folders. One
update runs at a time.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from basketry.operators.grains import COUNTS, category_report, partial_counts
from basketry.sources.files import read_raw_events
from basketry.streaming.jobs import layout

PARTIAL = StructType([
    StructField("event_date", DateType()),
    StructField("category", StringType()),
    StructField("product_id", StringType()),
    *[StructField(c, LongType()) for c in COUNTS],
])
#: The day of rows without one, as folders name it.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
_DAY = re.compile(r"/event_date=([^/]+)/")


@dataclass(frozen=True)
class Manifest:
    """``days``: day -> (digest of its raw files, folder of its counts)."""

    number: int
    days: dict[str, tuple[str, str]]


def _root(base_dir: str) -> str:
    return f"{base_dir.rstrip('/')}/partials"


def raw_days(raw: DataFrame) -> dict[str, str]:
    """Digest of the file names of every day of raw (names only; no data is read)."""
    files: dict[str, list[str]] = defaultdict(list)
    for path in raw.inputFiles():
        day = _DAY.search(path)
        if day is None:
            raise ValueError(f"raw is not partitioned by event_date: {path}")
        files[day[1]].append(path[day.start():])
    return {day: hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest() for day, names in files.items()}


def current_manifest(spark: SparkSession, base_dir: str) -> Manifest:
    """The newest published manifest; one without days if there is none yet."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{_root(base_dir)}/published")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    if not names:
        return Manifest(0, {})
    number, name = max((int(n), name) for n, name in (x.split("_") for x in names))
    rows = spark.read.schema("day string, files string, folder string").parquet(f"{_root(base_dir)}/manifests/{name}").collect()
    return Manifest(number, {r["day"]: (r["files"], r["folder"]) for r in rows})


def update_partials(spark: SparkSession, base_dir: str) -> list[str]:
    """Count the days of raw that are new or have changed; returns them (none: nothing is written)."""
    raw = read_raw_events(spark, layout(base_dir)["raw"])
    known, now = current_manifest(spark, base_dir), raw_days(raw)
    changed = sorted(day for day, files in now.items() if known.days.get(day, ("",))[0] != files)
    if not changed and known.days.keys() == now.keys():
        return []
    folder = uuid.uuid4().hex
    if changed:
        dated = [d for d in changed if d != NO_DAY]
        wanted = F.col("event_date").isin([F.lit(d).cast("date") for d in dated]) if dated else F.lit(False)
        if NO_DAY in changed:
            wanted = wanted | F.col("event_date").isNull()
        # The partition filter opens the changed days' folders only; one task or a few a day write its counts.
        counts = partial_counts(raw.filter(wanted)).withColumn("day", F.coalesce(F.col("event_date").cast("string"), F.lit(NO_DAY)))
        counts.hint("rebalance", "day").write.partitionBy("day").parquet(f"{_root(base_dir)}/data/{folder}")
    days = {day: (files, folder if day in changed else known.days[day][1]) for day, files in now.items()}
    name = uuid.uuid4().hex
    rows = spark.createDataFrame([(d, *x) for d, x in days.items()], "day string, files string, folder string")
    rows.coalesce(1).write.parquet(f"{_root(base_dir)}/manifests/{name}")
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{_root(base_dir)}/published/{known.number + 1}_{name}")
    marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(marker, False).close()
    return changed


def stored_partials(spark: SparkSession, base_dir: str) -> DataFrame:
    """The partial counts of all days in the newest manifest."""
    days = current_manifest(spark, base_dir).days
    paths = [f"{_root(base_dir)}/data/{folder}/day={day}" for day, (_, folder) in days.items()]
    return spark.read.schema(PARTIAL).parquet(*paths) if paths else spark.createDataFrame([], PARTIAL)


def incremental_report_job(spark: SparkSession, base_dir: str) -> DataFrame:
    """The conversion report of all of raw, reading only days that have changed since the last run."""
    update_partials(spark, base_dir)
    return category_report(stored_partials(spark, base_dir))
