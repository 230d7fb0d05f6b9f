"""Repeated messages: producers send an event again when an answer is lost.

An event is told by a fingerprint of all its fields (128 bits). In a stream the
fingerprints are kept until the watermark passes their event by the delay: a
later copy is behind the watermark and is dropped as late, so the state is
bounded and no copy is ever counted. The raw output has no use for this: it keeps
every message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("user_id", "product_id", "category", "event_type")


def event_fingerprint(time_col: str = "timestamp") -> Column:
    """Hex text that two events share exactly if all their fields are equal (null equals null only)."""
    fields = F.struct(*FIELDS, F.unix_micros(time_col).alias("micros"))
    return F.md5(F.to_json(fields).cast("binary"))


def drop_repeats(events: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """One of each set of equal events. A stream needs a watermark on ``time_col``.

    Events without a time are left out: no window has them, and no watermark could end their state."""
    marked = events.filter(F.col(time_col).isNotNull()).withColumn("fingerprint", event_fingerprint(time_col))
    if events.isStreaming:
        return marked.dropDuplicatesWithinWatermark(["fingerprint"]).drop("fingerprint")
    return marked.dropDuplicates(["fingerprint"]).drop("fingerprint")
