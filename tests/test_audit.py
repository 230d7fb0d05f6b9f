import datetime as dt

from pyspark.sql import functions as F

from basketry import schemas
from basketry.operators.audit import dataset_audit, validate_report
from basketry.operators.funnel import conversion_report
from basketry.sinks.writers import write_raw_events
from basketry.sources.files import read_raw_events

SCHEMA = "user_id string, product_id string, category string, event_type string, timestamp timestamp"


def test_dataset_audit_counts_rows_files_and_null_keys(spark, workdir):
    rows = [("u", "p", "a", "view", dt.datetime(2026, 1, 1, 1)), ("u", "p", "b", "view", dt.datetime(2026, 1, 2, 1)),
            (None, None, None, None, None)]
    write_raw_events(spark.createDataFrame(rows, SCHEMA), f"{workdir}/raw")
    raw = read_raw_events(spark, f"{workdir}/raw")
    audit = dataset_audit("raw", raw, "timestamp", ("user_id",)).collect()[0]
    assert (audit.rows, audit.null_key_rows) == (3, 1)
    assert audit.files >= 3 and audit.bytes > 0
    assert audit.first_time == dt.datetime(2026, 1, 1, 1) and audit.last_time == dt.datetime(2026, 1, 2, 1)


def test_validate_report_flags_problems(spark):
    events = spark.createDataFrame(
        [("u", "p", "a", "view", dt.datetime(2026, 1, 1))] * 2 + [("u", "p", "a", "purchase", dt.datetime(2026, 1, 1))],
        SCHEMA,
    )
    good = conversion_report(events)
    good = good.select(*[F.col(c).cast("string").alias(c) for c in good.columns])  # as it reads from the file
    assert all(r.passed for r in validate_report(good, schemas.CONVERSION_REPORT).collect())
    bad = good.unionByName(good).withColumn("conversion_rate", F.lit("0.9"))
    failed = {r.check: r.failures for r in validate_report(bad, schemas.CONVERSION_REPORT).collect() if not r.passed}
    assert failed == {"duplicate_category": 1, "conversion_rate_mismatch": 2}
