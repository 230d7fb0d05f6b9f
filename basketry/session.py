"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Timestamps are read and written in UTC so
# that day boundaries and window starts do not depend on the machine zone.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def scale_conf(
    input_bytes: int, total_cores: int, split_bytes: int = 256 << 20, shuffle_bytes: int | None = None
) -> dict[str, str]:
    """Partition sizing for a scan of ``input_bytes`` on ``total_cores``.

    Scan splits of ``split_bytes`` (256 MB: a few hundred MB per task keeps
    decoded batches well inside an executor core's memory share and the
    task count manageable: ~400k splits for 100 TB). Shuffle partitions follow
    what is shuffled, not what is scanned: ``shuffle_bytes`` (by default a
    hundredth of the input, as every aggregate here sends partial counts) in
    pieces of 256 MB, but three per core so that all cores work. AQE
    then coalesces small partitions towards 128 MB and splits skewed ones. A
    stream's state has its own setting (``state_partitions`` of
    :func:`build_session`), as its number of stores is fixed for life."""
    shuffled = input_bytes // 100 if shuffle_bytes is None else shuffle_bytes
    shuffle = max(3 * total_cores, -(-shuffled // (256 << 20)), 1)
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
    }


STATE_STORE_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    master: str | None = None,
    app_name: str = "basketry",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    rocksdb_state_store: bool = False,
    state_partitions: int | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the settings the operators assume.

    ``master`` is only set when given: on a cluster the launcher decides it.
    ``shuffle_partitions`` should be sized so one partition fits an executor
    core's memory at the target scale; AQE coalesces small ones at run time.
    ``rocksdb_state_store`` keeps streaming state in RocksDB (off-heap,
    incremental checkpoints) instead of executor heap maps: use it when the
    number of (window, key) groups per batch is large. It applies to new
    checkpoints only. ``state_partitions`` is the number of state stores (and
    shuffle partitions) of a stream session: about one to three a core, fixed
    with the first checkpoint; it goes before ``shuffle_partitions``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if rocksdb_state_store:
        conf[STATE_STORE_PROVIDER_KEY] = ROCKSDB_PROVIDER
    conf.update(extra_conf or {})
    if state_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(state_partitions)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # Applies to an existing session too (getOrCreate may return one).
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers of ``spark`` this package (once an application).

    Operators with Python workers are pickled by module name; on a cluster, or
    with a driver started in another folder, the workers could not import
    them otherwise."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="basketry-"), f"{os.path.basename(root)}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                out.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """Root folder for job outputs, stream checkpoints and lineage cuts.

    Uses the cluster's ``spark.checkpoint.dir`` (shared storage). Only in
    local mode, where one process runs every task, a fresh local folder
    stands in for it; on a cluster without the setting this is an error, as
    each executor would write to a disk of its own.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="basketry-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` through a new Parquet folder below :func:`shared_dir`: computed once, however often it is read."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused sub-folder of :func:`shared_dir` for one run."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
