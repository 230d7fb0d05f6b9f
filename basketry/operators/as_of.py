"""Catalog lookup as of an event's time.

A catalog keeps versions of a product's category, each valid from a time on. An
event takes the last version at or before its time. No range join: events and versions are
put in one order of time and the last version seen is carried forward.

That order is made within (product, slice of time), so that a product with a
third of all events is spread over its slices. What holds at the start of a slice
is carried in from the versions alone: one row for each (product, slice)
with events. Slices that still hold too many events are split further by a salt, with their few
version rows repeated for each part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.operators.vocab import UNKNOWN_CATEGORY
from basketry.operators.windows import window_micros
from basketry.session import written

#: Events of a (product, slice) that one task may order; the counted list of greater ones is broadcast up to this many bytes.
SPLIT_ROWS, SPLIT_BYTES, SPLIT_WIDTH = 1 << 20, 32 << 20, 64


def catalog_as_of(
    events: DataFrame,
    versions: DataFrame,
    slice_length: str = "1 day",
    time_col: str = "timestamp",
    default: str | None = UNKNOWN_CATEGORY,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """``events`` with the ``category`` of ``versions`` (``product_id, valid_from, category``) as of their time.

    A version counts from its own instant on, until the product's next one; of versions of one
    instant the greatest category is taken. Events before their product's first version, of other
    products, without a product or without a time get ``default``, as do events of a version without a
    category. Versions without a product or time are left out. Repeated events stay as they are; a
    ``category`` that events already have is replaced."""
    length = window_micros(slice_length)
    columns = [c for c in events.columns if c != "category"]
    # The event's own columns travel as one, whatever their names.
    known = events.select(F.struct(*columns).alias("event"), "product_id", F.unix_micros(time_col).alias("micros"))
    known = known.withColumn("slice", F.floor(F.col("micros") / length).cast("long"))
    lookup = F.col("product_id").isNotNull() & F.col("micros").isNotNull()

    steps = versions.filter(F.col("product_id").isNotNull() & F.col("valid_from").isNotNull())
    steps = steps.groupBy("product_id", F.unix_micros("valid_from").alias("micros")).agg(F.array_max(F.collect_set("category")).alias("category"))
    steps = steps.select("product_id", "micros", F.struct("category").alias("version"))

    # What a (product, slice) starts with: by product, its versions and slices in order (no events).
    pairs = written(known.filter(lookup).groupBy("product_id", "slice").agg(F.count(F.lit(1)).alias("n")), "as-of-slices")
    marks = pairs.select("product_id", (F.col("slice") * length).alias("micros"), F.lit(None).cast("struct<category:string>").alias("version"),
                         F.lit(1).alias("kind"), "slice")
    marks = marks.unionByName(steps.select("product_id", "micros", "version", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("slice")))
    before = Window.partitionBy("product_id").orderBy("micros", "kind").rowsBetween(Window.unboundedPreceding, 0)
    carried = marks.withColumn("version", F.last("version", ignorenulls=True).over(before)).filter("kind = 1")
    carried = carried.filter("version is not null").select("product_id", "slice", "micros", "version", F.lit(0).alias("kind"))
    inside = steps.withColumn("slice", F.floor(F.col("micros") / length).cast("long")).join(pairs.select("product_id", "slice"), ["product_id", "slice"], "left_semi")
    entries = carried.unionByName(inside.select("product_id", "slice", "micros", "version", F.lit(1).alias("kind")))

    # Crowded slices: their number is at most the events over ``split_rows``.
    crowded = pairs.filter(F.col("n") > split_rows).select("product_id", "slice", F.ceil(F.col("n") / split_rows).cast("int").alias("parts"))
    n_crowded = crowded.count()
    rows = known.filter(lookup).withColumn("kind", F.lit(2)).withColumn("version", F.lit(None).cast("struct<category:string>"))
    if n_crowded:
        if n_crowded * SPLIT_WIDTH <= SPLIT_BYTES:
            crowded = F.broadcast(crowded)
        parts = F.coalesce("parts", F.lit(1))
        salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), parts)
        rows = rows.join(crowded, ["product_id", "slice"], "left").withColumn("salt", salt.cast("int")).drop("parts")
        entries = entries.join(crowded, ["product_id", "slice"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    else:
        rows, entries = rows.withColumn("salt", F.lit(0)), entries.withColumn("salt", F.lit(0))
    held = Window.partitionBy("product_id", "slice", "salt").orderBy("micros", "kind").rowsBetween(Window.unboundedPreceding, 0)
    merged = rows.unionByName(entries, allowMissingColumns=True).withColumn("version", F.last("version", ignorenulls=True).over(held))
    found = merged.filter("kind = 2").select("event.*", F.coalesce("version.category", F.lit(default)).alias("category"))
    others = known.filter(~lookup).select("event.*", F.lit(default).cast("string").alias("category"))
    return found.unionByName(others)
