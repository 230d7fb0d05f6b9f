import datetime as dt
import glob
import os

from basketry.schemas import CONVERSION_REPORT, RAW_EVENT
from basketry.sinks.writers import write_csv, write_raw_events
from basketry.sources.files import read_csv_report, read_parquet_dataset, read_raw_events

SCHEMA = "user_id string, product_id string, category string, event_type string, timestamp timestamp"


def test_missing_and_empty_inputs_give_typed_empty_frames(spark, workdir):
    missing = read_raw_events(spark, f"{workdir}/nope")
    assert missing.schema == RAW_EVENT and missing.count() == 0
    os.makedirs(f"{workdir}/empty")
    assert read_raw_events(spark, f"{workdir}/empty").count() == 0


def test_empty_report_writes_header_only_csv(spark, workdir):
    write_csv(spark.createDataFrame([], CONVERSION_REPORT), f"{workdir}/report", single_file=True)
    parts = glob.glob(f"{workdir}/report/part-*.csv")
    assert len(parts) == 1
    assert open(parts[0]).read().strip() == ",".join(CONVERSION_REPORT.fieldNames())
    assert read_csv_report(spark, f"{workdir}/report").count() == 0


def test_null_category_partition_round_trip(spark, workdir):
    df = spark.createDataFrame(
        [("u", "p", "a", "view", dt.datetime(2026, 1, 1)), ("u", "p", None, "view", dt.datetime(2026, 1, 1))], SCHEMA
    )
    write_raw_events(df, f"{workdir}/raw")
    assert any("__HIVE_DEFAULT_PARTITION__" in p for p in glob.glob(f"{workdir}/raw/*/*"))
    back = read_raw_events(spark, f"{workdir}/raw")
    assert sorted((r.category or "") for r in back.collect()) == ["", "a"]


def test_corrupt_file_is_skipped_by_tolerant_scan(spark, workdir):
    df = spark.createDataFrame([("u", "p", "a", "view", dt.datetime(2026, 1, 1))], SCHEMA)
    df.write.parquet(f"{workdir}/flat")
    with open(f"{workdir}/flat/junk.parquet", "wb") as f:
        f.write(b"not a parquet file")
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(SCHEMA)
    assert read_parquet_dataset(spark, f"{workdir}/flat", schema, tolerant=True).count() == 1


def test_corrupt_file_fails_the_default_scan(spark, workdir):
    import pytest
    from pyspark.sql.types import StructType

    df = spark.createDataFrame([("u", "p", "a", "view", dt.datetime(2026, 1, 1))], SCHEMA)
    df.write.parquet(f"{workdir}/flat")
    with open(f"{workdir}/flat/junk.parquet", "wb") as f:
        f.write(b"not a parquet file")
    with pytest.raises(Exception):
        read_parquet_dataset(spark, f"{workdir}/flat", StructType.fromDDL(SCHEMA)).count()


def test_replacing_one_day_keeps_the_others(spark, workdir):
    day1 = [("u1", "p", "a", "view", dt.datetime(2026, 1, 1, 10))] * 2
    day2 = [("u2", "p", "a", "view", dt.datetime(2026, 1, 2, 10))] * 3
    write_raw_events(spark.createDataFrame(day1 + day2, SCHEMA), f"{workdir}/raw")
    rerun = [("u3", "p", "a", "purchase", dt.datetime(2026, 1, 2, 11))]
    write_raw_events(spark.createDataFrame(rerun, SCHEMA), f"{workdir}/raw", mode="replace_partitions")
    got = sorted((str(r.event_date), r.user_id) for r in read_raw_events(spark, f"{workdir}/raw").collect())
    assert got == [("2026-01-01", "u1"), ("2026-01-01", "u1"), ("2026-01-02", "u3")]
