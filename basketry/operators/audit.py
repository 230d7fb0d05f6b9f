"""Checks over the datasets the jobs write, as Spark jobs returning rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketry.functions.rates import safe_rate


def dataset_audit(
    name: str,
    data: DataFrame,
    time_col: str | None = "window_start",
    key_cols: Sequence[str] = (),
) -> DataFrame:
    """One row describing a file-based dataset: rows, files, bytes, first and
    last event time and rows with a null key.

    ``data`` must come from a file source (it uses the hidden ``_metadata``
    column). Aggregation is two-level: per file on the executors, then over
    the per-file rows, so no single task sees more than one file's summary."""
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key_cols]) if key_cols else F.lit(False)
    ts = F.col(time_col) if time_col else F.lit(None).cast("timestamp")
    per_file = data.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        ts.alias("_ts"),
        null_key.alias("_null_key"),
    ).groupBy("file_path", "file_size").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("_ts").alias("first_time"),
        F.max("_ts").alias("last_time"),
        F.count_if("_null_key").alias("null_key_rows"),
    )
    return per_file.agg(
        F.lit(name).alias("dataset"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"),
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("file_size"), F.lit(0)).cast("long").alias("bytes"),
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
        F.coalesce(F.sum("null_key_rows"), F.lit(0)).cast("long").alias("null_key_rows"),
    )


def combine_audits(audits: Sequence[DataFrame]) -> DataFrame:
    """Audit rows of several datasets in one frame, in the given order."""
    return reduce(lambda a, b: a.unionByName(b), audits)


def validate_report(report: DataFrame, expected: StructType, scale: int | None = 4) -> DataFrame:
    """Validation of a conversion report as ``(check, failures, passed)``.

    ``report`` is the report as it was written, every value text (see
    :func:`basketry.sources.files.read_report_text`). Checks: the header's
    names and their order, values that don't read as the expected type, at
    least one row, no negative count, no null or duplicate category, both
    rates equal to rates recomputed from the counts (within 1e-9). Columns
    that the header lacks count as null. One aggregation pass."""
    header_failures = 0 if report.columns == expected.fieldNames() else 1
    held = set(report.columns)
    text = [F.col(f.name) if f.name in held else F.lit(None).cast("string") for f in expected]
    typed = [c.try_cast(f.dataType) for c, f in zip(text, expected)]
    unreadable = reduce(lambda a, b: a + b, [(c.isNotNull() & t.isNull()).cast("int") for c, t in zip(text, typed)])
    values = report.select(*[t.alias(f.name) for t, f in zip(typed, expected)], unreadable.alias("_unreadable"))
    negative = (F.col("views") < 0) | (F.col("purchases") < 0) | (F.col("cart_adds") < 0)
    bad_conv = F.abs(F.col("conversion_rate") - safe_rate("purchases", "views", scale)) > 1e-9
    bad_cart = F.abs(F.col("cart_to_purchase_rate") - safe_rate("purchases", "cart_adds", scale)) > 1e-9
    stats = values.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("_unreadable"), F.lit(0)).alias("unreadable_values"),
        F.count_if(negative).alias("negative_counts"),
        F.count_if(F.col("category").isNull()).alias("null_category"),
        (F.count("category") - F.count_distinct("category")).alias("duplicate_category"),
        F.count_if(F.coalesce(bad_conv, F.lit(True))).alias("conversion_rate_mismatch"),
        F.count_if(F.coalesce(bad_cart, F.lit(True))).alias("cart_rate_mismatch"),
    )
    checks = stats.select(
        F.lit(header_failures).cast("long").alias("schema_matches"),
        F.when(F.col("rows") > 0, 0).otherwise(1).cast("long").alias("has_rows"),
        "unreadable_values",
        "negative_counts",
        "null_category",
        "duplicate_category",
        "conversion_rate_mismatch",
        "cart_rate_mismatch",
    )
    names = checks.columns
    rows = checks.unpivot([], names, "check", "failures")
    return rows.select("check", F.col("failures").cast("long").alias("failures"), (F.col("failures") == 0).alias("passed"))
