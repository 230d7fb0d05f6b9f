"""Append-mode window emission, late rows and restart, driven through a
folder of JSON-lines files (the Kafka stand-in). Each round starts the
queries with ``availableNow`` on the same checkpoints, i.e. a restart."""

import json
import os

from basketry import schemas
from basketry.sources.files import read_csv_report, read_parquet_dataset, read_raw_events
from basketry.sources.streams import text_source
from basketry.streaming.jobs import StreamSettings, layout, run_available_now


def _event(minute, second=0, product="P0001", etype="view"):
    return json.dumps({
        "user_id": "U0001", "product_id": product, "category": "Toys", "event_type": etype,
        "timestamp": f"2026-01-01T00:{minute:02d}:{second:02d}+00:00",
    })


def _round(spark, src, base, n, lines):
    with open(os.path.join(src, f"batch-{n:03d}.json"), "w") as f:
        f.write("\n".join(lines) + "\n")
    settings = StreamSettings(window="5 minutes", delay="5 minutes", alert_threshold=1)
    return run_available_now(text_source(spark, src), base, settings)


def _metrics(spark, base):
    return read_parquet_dataset(spark, layout(base)["category_metrics"], schemas.CATEGORY_WINDOW_METRICS).collect()


def test_window_closes_on_watermark_and_late_rows_drop(spark, workdir):
    src, base = f"{workdir}/in", f"{workdir}/out"
    os.makedirs(src)
    _round(spark, src, base, 1, [_event(1), _event(2), _event(6)])
    assert _metrics(spark, base) == []
    _round(spark, src, base, 2, [_event(9, 59)])
    assert _metrics(spark, base) == []
    _round(spark, src, base, 3, [_event(10, 0)])
    rows = _metrics(spark, base)
    assert [(r.window_start.minute, r.total_events, r.views) for r in rows] == [(0, 2, 2)]
    alerts = read_csv_report(spark, layout(base)["alerts"], schemas.PRODUCT_ALERT).collect()
    assert [(r.window_start.minute, r.event_count) for r in alerts] == [(0, 2)]

    # 00:03 is behind the watermark (00:05): dropped from aggregates, kept in raw.
    _round(spark, src, base, 4, [_event(3), _event(30)])
    rows = _metrics(spark, base)
    assert sorted((r.window_start.minute, r.total_events) for r in rows) == [(0, 2), (5, 2), (10, 1)]
    raw = read_raw_events(spark, layout(base)["raw"])
    assert raw.count() == 7


def test_restart_without_new_data_writes_nothing_twice(spark, workdir):
    src, base = f"{workdir}/in", f"{workdir}/out"
    os.makedirs(src)
    _round(spark, src, base, 1, [_event(1), _event(20)])
    first = sorted(tuple(r) for r in read_raw_events(spark, layout(base)["raw"]).collect())
    settings = StreamSettings(window="5 minutes", delay="5 minutes")
    run_available_now(text_source(spark, src), base, settings)
    again = sorted(tuple(r) for r in read_raw_events(spark, layout(base)["raw"]).collect())
    assert first == again and len(again) == 2
    assert len(_metrics(spark, base)) == 1


def test_malformed_messages_reach_raw_with_null_partition(spark, workdir):
    src, base = f"{workdir}/in", f"{workdir}/out"
    os.makedirs(src)
    _round(spark, src, base, 1, ["garbage", _event(1)])
    raw = read_raw_events(spark, layout(base)["raw"]).collect()
    assert len(raw) == 2
    assert sum(1 for r in raw if r.user_id is None and r.category is None) == 1


def test_raw_writers_bound_files_per_folder(spark, workdir):
    import glob

    src, base = f"{workdir}/in", f"{workdir}/out"
    os.makedirs(src)
    with open(os.path.join(src, "batch-001.json"), "w") as f:
        f.write("\n".join(_event(m % 60, s) for m in range(20) for s in range(10)) + "\n")
    settings = StreamSettings(raw_writers=2)
    run_available_now(text_source(spark, src), base, settings)
    folders = glob.glob(f"{layout(base)['raw']}/event_date=*/category=*")
    assert folders and all(len(glob.glob(f"{d}/*.parquet")) <= 2 for d in folders)
    assert read_raw_events(spark, layout(base)["raw"]).count() == 200


def test_windowed_stream_on_rocksdb_state(spark, workdir):
    from basketry.session import ROCKSDB_PROVIDER, STATE_STORE_PROVIDER_KEY

    before = spark.conf.get(STATE_STORE_PROVIDER_KEY, None)
    spark.conf.set(STATE_STORE_PROVIDER_KEY, ROCKSDB_PROVIDER)
    try:
        src, base = f"{workdir}/in", f"{workdir}/out"
        os.makedirs(src)
        _round(spark, src, base, 1, [_event(1), _event(2), _event(12)])
        rows = _metrics(spark, base)
        assert [(r.window_start.minute, r.total_events) for r in rows] == [(0, 2)]
    finally:
        if before:
            spark.conf.set(STATE_STORE_PROVIDER_KEY, before)
        else:
            spark.conf.unset(STATE_STORE_PROVIDER_KEY)


def test_continuous_trigger_runs_all_outputs_and_stops_cleanly(spark, workdir):
    import time

    from basketry.streaming.jobs import start_all, stop_all

    src, base = f"{workdir}/in", f"{workdir}/out"
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write("\n".join([_event(1), _event(2), _event(30)]) + "\n")
    settings = StreamSettings(trigger={"processingTime": "1 second"})
    queries = start_all(text_source(spark, src), base, settings, name_prefix="live-")
    try:
        # Every query has processed the file; the stateful ones have also run
        # the follow-up batch that emits windows closed by the watermark.
        deadline = time.time() + 120
        names = {q.name: q for q in queries}

        def done(name, batch):
            p = names[name].lastProgress
            return p is not None and p["batchId"] >= batch

        while time.time() < deadline:
            if done("live-raw", 0) and done("live-category_metrics", 1) and done("live-product_metrics", 1):
                break
            time.sleep(0.5)
        assert all(q.isActive for q in queries)
    finally:
        stop_all(queries)
    assert not any(q.isActive for q in queries)
    assert not spark.sparkContext._jsc.sc().isStopped()
    assert read_raw_events(spark, layout(base)["raw"]).count() == 3
    assert [(r.window_start.minute, r.total_events) for r in _metrics(spark, base)] == [(0, 2)]


def test_salted_catalog_lookup_on_a_stream(spark, workdir):
    from basketry.operators.catalog import enrich_with_catalog, normalize_catalog
    from basketry.sources.streams import decode_events
    from basketry.streaming.jobs import await_all, start_raw_ingest, stop_all

    src, base = f"{workdir}/in", f"{workdir}/out"
    os.makedirs(src)
    lines = [_event(m % 60, product="P0001") for m in range(30)] + [_event(1, product="P0002"), _event(2, product="P0009")]
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write("\n".join(lines) + "\n")
    catalog = normalize_catalog(spark.createDataFrame([("P0001", "Toys", 1), ("P0002", "Home", 2)],
                                                      "product_id string, category string, line_order long"))
    events = enrich_with_catalog(decode_events(text_source(spark, src)), catalog, max_broadcast_bytes=0)
    q = start_raw_ingest(events, base, StreamSettings(trigger={"availableNow": True}), name="salted")
    try:
        await_all([q])
    finally:
        stop_all([q])
    got = {}
    for r in read_raw_events(spark, layout(base)["raw"]).collect():
        got[(r.product_id, r.category)] = got.get((r.product_id, r.category), 0) + 1
    assert got == {("P0001", "Toys"): 30, ("P0002", "Home"): 1, ("P0009", "UNKNOWN"): 1}


def test_stream_aggregation_is_partial_before_the_state_store(spark, workdir, capsys):
    from basketry.sources.streams import decode_events
    from basketry.streaming.jobs import await_all, start_category_metrics, stop_all

    src = f"{workdir}/in"
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write("\n".join([_event(1), _event(12)]) + "\n")
    q = start_category_metrics(decode_events(text_source(spark, src)), f"{workdir}/out",
                               StreamSettings(trigger={"availableNow": True}), name="explain")
    try:
        await_all([q])
        capsys.readouterr()
        q.explain()
        plan = capsys.readouterr().out
    finally:
        stop_all([q])
    assert plan.index("StateStoreSave") < plan.index("partial_count")  # partial is below the state store
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_registered_streams_run_over_many_batches_and_drop_what_is_planned(spark, workdir):
    """The disordered messages at sf0.001: at least five micro-batches, and
    the watermark drops exactly the windows of the late copies."""
    from pyspark.sql import functions as F

    from basketry.plans import registry
    from basketry.sources.testdata import late_copies, raw_events
    from basketry.streaming.jobs import await_all, start_category_metrics, stop_all
    from tests.conftest import SF_SMALL

    q = start_category_metrics(registry._disordered_events(spark, SF_SMALL), f"{workdir}/out", registry._AVAILABLE_NOW, name="disordered")
    try:
        await_all([q])
        progress = list(q.recentProgress)
    finally:
        stop_all([q])
    assert len([p for p in progress if p["numInputRows"] > 0]) >= 5
    dropped = sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])
    late = late_copies(raw_events(spark, SF_SMALL))
    windows = late.groupBy(F.window("timestamp", registry.METRICS_WINDOW), "category").count().count()
    # A window counts once for each batch that brings late rows of it.
    assert 0 < windows <= dropped <= late.count()
