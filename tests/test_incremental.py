"""Partial counts a day with a manifest: only changed days are read again; grains add up."""

import datetime as dt
import os

import pytest

from basketry import schemas
from basketry.operators.funnel import conversion_report
from basketry.operators.grains import partial_counts, report_grains, roll_up
from basketry.plans import incremental
from basketry.sinks.writers import write_raw_events
from basketry.sources.files import read_raw_events
from basketry.streaming.jobs import layout


def events(spark, day, n, category="Toys", product="P1"):
    at = None if day is None else dt.datetime(2026, 1, day)
    rows = [(f"U{i}", product, category, ("view", "view", "add_to_cart", "purchase")[i % 4], at and at + dt.timedelta(minutes=i)) for i in range(n)]
    return spark.createDataFrame(rows, schemas.EVENT)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def check(spark, base):
    raw = read_raw_events(spark, layout(base)["raw"])
    assert rows(incremental.category_report(incremental.stored_partials(spark, base))) == rows(conversion_report(raw))
    assert rows(incremental.stored_partials(spark, base)) == rows(partial_counts(raw))


def test_only_changed_days_are_counted(spark, workdir):
    base = f"{workdir}/shop"
    raw = layout(base)["raw"]
    assert incremental.update_partials(spark, base) == []  # no raw yet
    write_raw_events(events(spark, 1, 9).unionByName(events(spark, 2, 5, "Games")), raw, "append")
    assert incremental.update_partials(spark, base) == ["2026-01-01", "2026-01-02"]
    check(spark, base)
    assert incremental.update_partials(spark, base) == []
    # A new day, late rows of an old one, and rows without a time or category.
    write_raw_events(events(spark, 3, 4, None), raw, "append")
    write_raw_events(events(spark, 1, 3, "Games", None), raw, "append")
    write_raw_events(events(spark, None, 2), raw, "append")
    before = incremental.current_manifest(spark, base)
    assert incremental.update_partials(spark, base) == ["2026-01-01", "2026-01-03", incremental.NO_DAY]
    after = incremental.current_manifest(spark, base)
    assert after.days["2026-01-02"] == before.days["2026-01-02"] and after.number == before.number + 1
    check(spark, base)
    # A day rewritten as a whole, and one that has gone.
    write_raw_events(events(spark, 2, 8), raw)
    check_days = incremental.update_partials(spark, base)
    assert "2026-01-02" in check_days
    check(spark, base)
    keep = read_raw_events(spark, raw).filter("event_date <> '2026-01-03'")
    kept = [tuple(r) for r in keep.select("user_id", "product_id", "category", "event_type", "timestamp").collect()]
    write_raw_events(spark.createDataFrame(kept, schemas.EVENT), raw, "overwrite")
    incremental.update_partials(spark, base)
    assert "2026-01-03" not in incremental.current_manifest(spark, base).days
    check(spark, base)


def test_changed_days_alone_are_opened(spark, workdir, monkeypatch):
    base = f"{workdir}/shop"
    for day in (1, 2, 3):
        write_raw_events(events(spark, day, 6), layout(base)["raw"], "append")
    incremental.update_partials(spark, base)
    write_raw_events(events(spark, 2, 6), layout(base)["raw"], "append")
    opened = []
    monkeypatch.setattr(incremental, "partial_counts", lambda df: opened.append(df) or partial_counts(df))
    incremental.update_partials(spark, base)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = opened[0]._jdf.queryExecution().explainString(mode)
    assert "event_date" in plan.split("PartitionFilters:")[1].split("\n")[0]
    assert opened[0].select("event_date").distinct().count() == 1


def test_a_failed_update_changes_nothing(spark, workdir, monkeypatch):
    base = f"{workdir}/shop"
    write_raw_events(events(spark, 1, 6), layout(base)["raw"], "append")
    incremental.update_partials(spark, base)
    before = rows(incremental.stored_partials(spark, base))
    write_raw_events(events(spark, 1, 6), layout(base)["raw"], "append")

    def fail(df):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(incremental, "partial_counts", fail)
        with pytest.raises(RuntimeError):
            incremental.update_partials(spark, base)
    # Counts written, manifest not: still the old state.
    os.makedirs(f"{base}/partials/manifests/unpublished")
    assert rows(incremental.stored_partials(spark, base)) == before
    assert incremental.update_partials(spark, base) == ["2026-01-01"]
    check(spark, base)


def test_grains(spark):
    df = events(spark, 1, 9).unionByName(events(spark, 2, 5, None)).unionByName(events(spark, 2, 7, "Games", None))
    partials = partial_counts(df)
    got = {tuple(r)[:4]: (r["events"], r["views"]) for r in report_grains(partials, [("category",), ("event_date", "category"), ()]).collect()}
    first, second = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    assert got == {
        ("category", None, "Toys", None): (9, 5), ("category", None, None, None): (5, 3), ("category", None, "Games", None): (7, 4),
        ("event_date,category", first, "Toys", None): (9, 5), ("event_date,category", second, None, None): (5, 3),
        ("event_date,category", second, "Games", None): (7, 4), ("total", None, None, None): (21, 12),
    }
    assert rows(roll_up(partials, ["product_id"]).select("product_id", "events")) == [("P1", 14), (None, 7)]
    assert report_grains(partial_counts(df.limit(0)), [(), ("category",)]).collect() == []
