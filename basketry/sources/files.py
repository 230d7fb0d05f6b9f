"""Batch readers with fixed schemas."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketry.schemas import CONVERSION_REPORT, RAW_EVENT

# Error classes meaning "there is no data yet" (missing folder; folder with
# nothing to read). Anything else is a real failure and is re-raised.
NO_DATA_ERRORS = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_parquet_dataset(
    spark: SparkSession,
    path: str,
    schema: StructType,
    tolerant: bool = False,
    recursive: bool = False,
    missing_ok: bool = True,
) -> DataFrame:
    """Parquet dataset with an explicit schema.

    Reading the dataset root keeps hive partition columns and, for a
    streaming sink, lists only committed files (``_spark_metadata``).
    ``tolerant`` skips unreadable files (their rows are lost, so it is opt-in;
    the default fails on a corrupt file); ``recursive`` reads every parquet
    file below ``path`` regardless of folder names (partition columns are
    then not derived). A missing path gives an empty typed frame, or with
    ``missing_ok=False`` the error it is (for data known to have been written)."""
    reader = spark.read.schema(schema).option("ignoreCorruptFiles", str(tolerant).lower())
    if recursive:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    try:
        return reader.parquet(path)
    except AnalysisException as err:
        if missing_ok and err.getCondition() in NO_DATA_ERRORS:
            return _empty(spark, schema)
        raise


def read_raw_events(spark: SparkSession, path: str, tolerant: bool = False, missing_ok: bool = True) -> DataFrame:
    """The raw event dataset (partitioned by ``event_date`` and ``category``)."""
    return read_parquet_dataset(spark, path, RAW_EVENT, tolerant=tolerant, missing_ok=missing_ok)


def read_catalog_csv(spark: SparkSession, path: str) -> DataFrame:
    """Product catalog CSV as ``product_id, category, line_order``.

    Columns are found by their header names, in any order and among others;
    a header without both names, and a missing catalog, are errors.
    ``line_order`` orders lines as they stand in the files (by file path, then
    place), so that "the last line wins" needs no column for it."""
    lines = spark.read.option("header", "true").csv(path)
    missing = {"product_id", "category"} - set(lines.columns)
    if missing:
        raise ValueError(f"the catalog {path} has no column {', '.join(sorted(missing))}: {lines.columns}")
    # Lines of one block of a file are read by one task, in order.
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return lines.select("product_id", "category", place.alias("line_order"))


def read_report_text(spark: SparkSession, path: str) -> DataFrame:
    """A CSV report as it stands: the header's names, every value as text."""
    return spark.read.option("header", "true").csv(path)


def read_csv_report(spark: SparkSession, path: str, schema: StructType = CONVERSION_REPORT) -> DataFrame:
    """A CSV report written with a header; missing folder -> empty frame."""
    try:
        return spark.read.schema(schema).option("header", "true").csv(path)
    except AnalysisException as err:
        if err.getCondition() in NO_DATA_ERRORS:
            return _empty(spark, schema)
        raise
