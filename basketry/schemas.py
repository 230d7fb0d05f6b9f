"""Fixed schemas of the event data model.

Every reader passes one of these explicitly: no inference at run time, so a
missing or empty input still yields a typed (possibly empty) frame.
"""

from pyspark.sql.types import (
    BinaryType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# One JSON message on the wire: every field is text.
WIRE_EVENT = _struct(
    ("user_id", StringType()),
    ("product_id", StringType()),
    ("category", StringType()),
    ("event_type", StringType()),
    ("timestamp", StringType()),
)

# Decoded, typed event.
EVENT = _struct(
    ("user_id", StringType()),
    ("product_id", StringType()),
    ("category", StringType()),
    ("event_type", StringType()),
    ("timestamp", TimestampType()),
)

# The raw dataset as written by the ingest stream (partitioned by
# event_date and category; partition columns come last when read back).
RAW_EVENT = _struct(
    ("user_id", StringType()),
    ("product_id", StringType()),
    ("event_type", StringType()),
    ("timestamp", TimestampType()),
    ("event_date", DateType()),
    ("category", StringType()),
)

CATEGORY_WINDOW_METRICS = _struct(
    ("window_start", TimestampType()),
    ("window_end", TimestampType()),
    ("category", StringType()),
    ("total_events", LongType()),
    ("purchases", LongType()),
    ("views", LongType()),
)

CATEGORY_WINDOW_RATES = StructType(
    CATEGORY_WINDOW_METRICS.fields + [StructField("conversion_rate", DoubleType(), True)]
)

PRODUCT_ALERT = _struct(
    ("window_start", TimestampType()),
    ("window_end", TimestampType()),
    ("product_id", StringType()),
    ("category", StringType()),
    ("event_count", LongType()),
)

USER_SESSION = _struct(
    ("session_start", TimestampType()),
    ("session_end", TimestampType()),
    ("user_id", StringType()),
    ("events", LongType()),
    ("views", LongType()),
    ("purchases", LongType()),
    ("cart_adds", LongType()),
    ("segment", StringType()),
)

PRODUCT_SKETCH = _struct(
    ("window_start", TimestampType()),
    ("window_end", TimestampType()),
    ("total_events", LongType()),
    ("sketch", _struct(
        ("sketch", BinaryType()),
        ("maxItemsTracked", IntegerType()),
        ("itemDataType", StringType()),
        ("itemDataTypeDDL", StringType()),
    )),
)

ANOMALY = _struct(
    ("window_start", TimestampType()),
    ("window_end", TimestampType()),
    ("product_id", StringType()),
    ("category", StringType()),
    ("kind", StringType()),
    ("event_count", LongType()),
    ("baseline", DoubleType()),
    ("spread", DoubleType()),
    ("windows", IntegerType()),
)

PRODUCT_WINDOW_METRICS = _struct(
    ("window_start", TimestampType()),
    ("window_end", TimestampType()),
    ("product_id", StringType()),
    ("total_events", LongType()),
    ("views", LongType()),
    ("purchases", LongType()),
)

CATALOG = _struct(
    ("product_id", StringType()),
    ("category", StringType()),
)

CONVERSION_REPORT = _struct(
    ("category", StringType()),
    ("views", LongType()),
    ("purchases", LongType()),
    ("cart_adds", LongType()),
    ("conversion_rate", DoubleType()),
    ("cart_to_purchase_rate", DoubleType()),
)

CATEGORY_CONVERSION = _struct(
    ("category", StringType()),
    ("views", LongType()),
    ("purchases", LongType()),
    ("conversion_rate", DoubleType()),
)

USER_SEGMENT = _struct(
    ("user_id", StringType()),
    ("segment", StringType()),
)
