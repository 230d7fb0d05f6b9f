import datetime as dt
import os

import pytest
from pyspark.sql.types import StructType

from basketry.plans import jobs
from basketry.sinks.writers import write_raw_events
from basketry.sources.files import read_parquet_dataset
from basketry.sources.streams import parquet_event_source
from basketry.streaming.jobs import StreamSettings, await_all, layout, start_raw_ingest, stop_all

SCHEMA = "user_id string, product_id string, category string, event_type string, timestamp timestamp"


def test_recursive_scan_reads_nested_files_without_partition_columns(spark, workdir):
    df = spark.createDataFrame([("u", "p", "a", "view", dt.datetime(2026, 1, 1))], SCHEMA)
    write_raw_events(df, f"{workdir}/raw")
    flat_schema = StructType.fromDDL("user_id string, product_id string, event_type string, timestamp timestamp")
    flat = read_parquet_dataset(spark, f"{workdir}/raw", flat_schema, recursive=True)
    assert flat.count() == 1 and "category" not in flat.columns


def test_conversion_job_without_data_writes_header_only_report(spark, workdir):
    out = jobs.conversion_report_job(spark, workdir)
    assert out["report"].count() == 0
    assert out["average"].collect()[0][0] is None
    files = [f for f in os.listdir(f"{workdir}/reports/conversion_rate_report") if f.endswith(".csv")]
    assert len(files) == 1


def test_typed_parquet_stream_source(spark, workdir):
    src = f"{workdir}/typed"
    spark.createDataFrame([("u", "p", "a", "view", dt.datetime(2026, 1, 1))], SCHEMA).write.parquet(src)
    settings = StreamSettings(trigger={"availableNow": True})
    q = start_raw_ingest(parquet_event_source(spark, src), f"{workdir}/out", settings)
    try:
        await_all([q])
    finally:
        stop_all([q])
    assert spark.read.parquet(layout(f"{workdir}/out")["raw"]).count() == 1


def test_cli_runs_a_job(spark, workdir):
    from basketry.__main__ import main

    assert main(["conversion-report", "--base-dir", workdir]) == 0
    assert main(["validate-report", "--base-dir", workdir]) == 1  # empty report: has_rows fails


def test_cli_stream_then_audit(spark, workdir):
    import json as _json

    from basketry.__main__ import main

    src = f"{workdir}/in"
    os.makedirs(src)
    with open(f"{src}/m.json", "w") as f:
        for minute in (1, 2, 20):
            f.write(_json.dumps({"user_id": "U1", "product_id": "P1", "category": "Toys", "event_type": "view",
                                 "timestamp": f"2026-01-01T00:{minute:02d}:00+00:00"}) + "\n")
    assert main(["stream", "--base-dir", f"{workdir}/out", "--text-dir", src, "--available-now",
                 "--raw-writers", "2", "--rates", "--max-files-per-trigger", "5"]) == 0
    metrics = spark.read.parquet(f"{workdir}/out/processed/category_metrics")
    assert "conversion_rate" in metrics.columns and metrics.count() == 1
    assert main(["audit", "--base-dir", f"{workdir}/out"]) == 0
    with pytest.raises(SystemExit):
        main(["stream", "--base-dir", f"{workdir}/out2", "--kafka", "broker:9092"])


def test_other_read_errors_are_not_swallowed(spark):
    from basketry.schemas import RAW_EVENT

    with pytest.raises(Exception):
        read_parquet_dataset(spark, "nosuchscheme://bucket/raw", RAW_EVENT).count()


def test_daily_jobs_on_a_day_without_events(spark, workdir):
    rows = [("u", "p", "a", "view", dt.datetime(2026, 1, 1, 10))]
    write_raw_events(spark.createDataFrame(rows, SCHEMA), f"{workdir}/raw")
    assert jobs.user_segmentation_job(spark, workdir, "2030-01-01").count() == 0
    assert jobs.top_products_job(spark, workdir, "2030-01-01").count() == 0
    assert not os.path.exists(f"{workdir}/reports")  # nothing to write, nothing written


def test_daily_jobs_without_input_leave_the_day_alone(spark, workdir):
    rows = [("u", "p", "a", "view", dt.datetime(2026, 1, 1, 10))]
    write_raw_events(spark.createDataFrame(rows, SCHEMA), f"{workdir}/raw")
    jobs.user_segmentation_job(spark, workdir, "2026-01-01", reports_to=f"{workdir}/out")
    jobs.top_products_job(spark, workdir, "2026-01-01", reports_to=f"{workdir}/out")

    def written():
        return {f"{d}/{f}": os.path.getmtime(f"{d}/{f}") for d, _, names in os.walk(f"{workdir}/out") for f in names}

    before = written()
    assert before
    # The same day again, with a base folder that does not exist.
    assert jobs.user_segmentation_job(spark, f"{workdir}/nowhere", "2026-01-01", reports_to=f"{workdir}/out").count() == 0
    assert jobs.top_products_job(spark, f"{workdir}/nowhere", "2026-01-01", reports_to=f"{workdir}/out").count() == 0
    assert written() == before


def test_a_vanished_derived_table_is_derived_anew(spark, workdir, monkeypatch):
    import shutil

    from basketry.sources import testdata

    made = []

    def write(path):
        made.append(path)
        spark.range(3).write.mode("overwrite").parquet(path)

    kind = f"vanish-{os.path.basename(workdir)}"
    sf = "/root/testdata/sf0.001"
    first = testdata.derived_table(spark, sf, kind, write)
    assert testdata.derived_table(spark, sf, kind, write) == first and made == [first]
    shutil.rmtree(first.removeprefix("file:"))
    second = testdata.derived_table(spark, sf, kind, write)
    assert made == [first, second] and spark.read.parquet(second).count() == 3


def test_two_writers_of_one_derived_table_do_not_share_a_folder(spark, workdir, monkeypatch):
    from basketry.sources import testdata

    sf, kind, made = "/root/testdata/sf0.001", f"twice-{os.path.basename(workdir)}", []

    def write(path):
        made.append(path)
        spark.range(2).write.mode("overwrite").parquet(path)

    with monkeypatch.context() as m:  # as two processes that both found nothing
        m.setattr(testdata, "_published", lambda *_: None)
        paths = [testdata.derived_table(spark, sf, kind, write) for _ in range(2)]
    assert len(set(paths)) == 2 and all(spark.read.parquet(p).count() == 2 for p in paths)
    assert testdata.derived_table(spark, sf, kind, write) == paths[1] and made == paths


def test_reads_of_written_data_are_strict(spark, workdir):
    from pyspark.errors import AnalysisException

    from basketry.sources.files import read_raw_events

    with pytest.raises(AnalysisException):
        read_raw_events(spark, f"{workdir}/gone", missing_ok=False)


def test_published_messages_are_the_encoded_events(spark, monkeypatch):
    """The connector is not here: the frame handed to the writer is checked."""
    import json

    from pyspark.sql import DataFrameWriter

    from basketry.sinks.writers import publish_events

    seen = {}

    def save(self, *_, **__):
        seen["rows"] = [json.loads(r.value) for r in seen["df"].collect()]

    real = DataFrameWriter.format

    def fmt(self, source):
        seen["format"], seen["df"] = source, self._df
        return real(self, source)

    monkeypatch.setattr(DataFrameWriter, "format", fmt)
    monkeypatch.setattr(DataFrameWriter, "save", save)
    rows = [("u1", "p", None, "view", dt.datetime(2026, 1, 1, 10))]
    publish_events(spark.createDataFrame(rows, SCHEMA), "host:9092", "shop", {"kafka.acks": "all"})
    assert seen["format"] == "kafka" and seen["df"].columns == ["value"]
    assert seen["rows"][0]["user_id"] == "u1" and seen["rows"][0]["category"] is None
