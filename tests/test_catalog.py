import datetime as dt

from pyspark.sql import functions as F

import pytest

from basketry.operators.catalog import (
    MAX_BROADCAST_BYTES,
    category_conversion,
    category_conversion_of_events,
    enrich_with_catalog,
    fits_broadcast,
    normalize_catalog,
    planned_bytes,
    product_category_map,
)
from basketry.operators.windows import product_window_metrics
from basketry.sources.files import read_catalog_csv

SCHEMA = "user_id string, product_id string, category string, event_type string, timestamp timestamp"
LINES = "product_id string, category string, line_order long"
T = dt.datetime(2026, 1, 1)


def _catalog_file(workdir, name, text):
    import os

    os.makedirs(f"{workdir}/csv", exist_ok=True)
    with open(f"{workdir}/csv/{name}", "w") as f:
        f.write(text)
    return f"{workdir}/csv"


def test_catalog_columns_by_header_name_and_last_line_wins(spark, workdir):
    # As a hand-kept file: other column order, an extra column, ids listed twice.
    path = _catalog_file(workdir, "a.csv", "category,note,product_id\nToys,x,P1\nBooks,y, p1 \nHome,z,P2\n")
    got = {r.product_id: r.category for r in normalize_catalog(read_catalog_csv(spark, path)).collect()}
    assert got == {"P1": "Books", "P2": "Home"}


def test_last_line_wins_in_a_file_of_many_blocks(spark, workdir):
    lines = "".join(f"P{i % 50},c{i:05d}\n" for i in range(4000))
    path = _catalog_file(workdir, "a.csv", "product_id,category\n" + lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        catalog = read_catalog_csv(spark, path)
        assert catalog.rdd.getNumPartitions() > 3
        got = {r.product_id: r.category for r in normalize_catalog(catalog).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {f"P{k}": f"c{max(i for i in range(4000) if i % 50 == k):05d}" for k in range(50)}


def test_catalog_without_the_columns_is_refused(spark, workdir):
    with pytest.raises(ValueError, match="category"):
        read_catalog_csv(spark, _catalog_file(workdir, "a.csv", "product_id,kind\nP1,Toys\n"))


def test_normalize_last_line_wins(spark):
    cat = spark.createDataFrame([(" p0001 ", "Home ", 1), ("P0001", "Toys", 2), ("p0002", " Sports", 3)],
                                "product_id string, category string, line_no long")
    got = {r.product_id: r.category for r in normalize_catalog(cat, "line_no").collect()}
    assert got == {"P0001": "Toys", "P0002": "Sports"}


def test_enrich_defaults_to_unknown_and_never_duplicates(spark):
    events = spark.createDataFrame([("u", "P0001", "stale", "view", T), ("u", "P0009", None, "view", T)], SCHEMA)
    cat = normalize_catalog(spark.createDataFrame([("P0001", "Toys", 2), ("P0001", "Home", 1)], LINES))
    out = enrich_with_catalog(events, cat)
    assert out.columns == events.columns
    assert sorted((r.product_id, r.category) for r in out.collect()) == [("P0001", "Toys"), ("P0009", "UNKNOWN")]


def _executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_form_follows_the_planned_bytes(spark, workdir):
    spark.createDataFrame([("P%04d" % i, "c", i) for i in range(5)], LINES).write.parquet(f"{workdir}/cat")
    cat = normalize_catalog(spark.read.parquet(f"{workdir}/cat"))
    events = spark.createDataFrame([("u", "P0001", None, "view", T)], SCHEMA)
    assert planned_bytes(cat) > 0 and fits_broadcast(cat) and not fits_broadcast(cat, 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = _executed(enrich_with_catalog(events, cat))
        large = _executed(enrich_with_catalog(events, cat, max_broadcast_bytes=0))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in small and "_salt" not in small
    assert "BroadcastHashJoin" not in large and "_salt" in large


def test_the_decision_runs_nothing(spark, workdir):
    spark.range(1000).selectExpr("id AS product_id", "id AS category").write.parquet(f"{workdir}/dim")
    dim = spark.read.parquet(f"{workdir}/dim")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    assert fits_broadcast(dim) and planned_bytes(dim) < MAX_BROADCAST_BYTES
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def test_category_report_in_one_pass_equals_the_rolled_up_windows(spark):
    rows = [("u", f"p{i % 40}" if i % 11 else None, f"c{i % 7}" if i % 5 else None, ["view", "purchase", "add_to_cart"][i % 3], T if i % 13 else None) for i in range(800)]
    events = spark.createDataFrame(rows, SCHEMA)
    want = category_conversion(product_window_metrics(events), events).collect()
    assert sorted(map(tuple, category_conversion_of_events(events).collect()), key=str) == sorted(map(tuple, want), key=str)
    assert None in {r.category for r in want}


def test_category_map_is_a_hash_aggregate_over_many_products(spark, workdir):
    """Over 1,000 products no event-scale aggregate falls back to sorting."""
    spark.range(60000).selectExpr("concat('p', id % 5000) AS product_id", "concat('c', id % 3) AS category").write.parquet(f"{workdir}/ev")
    events = spark.read.parquet(f"{workdir}/ev")
    df = product_category_map(events)
    assert df.count() == 5000 and {r.category for r in df.collect()} == {"c2"}
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # Distinct pairs in hash aggregates with fixed state; only those pairs are compared.
    assert "ObjectHashAggregate" not in plan
    assert "HashAggregate(keys=[product_id" in plan and plan.rindex("HashAggregate(keys=[product_id") > plan.rindex("SortAggregate")
    node = df._jdf.queryExecution().executedPlan()
    assert _fallbacks(node) == 0


def _fallbacks(node) -> int:
    """Sum of the plan's "sort fallback" metrics."""
    total, stack = 0, [node]
    while stack:
        n = stack.pop()
        name = n.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            stack.append(n.executedPlan())
        elif "QueryStage" in name:
            stack.append(n.plan())
        metrics = n.metrics()
        if metrics.contains("numTasksFallBacked"):
            total += metrics.apply("numTasksFallBacked").value()
        children = n.children()
        stack += [children.apply(i) for i in range(children.size())]
    return total


def test_category_conversion_keeps_unmapped_group_and_ignores_metric_category(spark):
    raw = spark.createDataFrame([("u", "p1", "a", "view", T), ("u", "p1", None, "view", T)], SCHEMA)
    metrics = spark.createDataFrame(
        [("p1", "zzz", 10, 2), ("p1", "zzz", 5, 1), ("p2", "zzz", 4, 0)],
        "product_id string, category string, views long, purchases long",
    )
    got = {r.category: (r.views, r.purchases, r.conversion_rate) for r in category_conversion(metrics, raw).collect()}
    assert got == {"a": (15, 3, 0.2), None: (4, 0, 0.0)}


def test_salted_lookup_equals_broadcast_lookup_under_skew(spark):
    hot = [("u%d" % i, "P0001", None, "view", T) for i in range(300)]
    cold = [("u%d" % i, "P%04d" % (i % 7), None, "view", T) for i in range(100)]
    events = spark.createDataFrame(hot + cold, SCHEMA)
    cat = normalize_catalog(spark.createDataFrame([("P%04d" % i, "c%d" % (i % 3), i) for i in range(5)], LINES))
    small = enrich_with_catalog(events, cat)
    salted = enrich_with_catalog(events, cat, max_broadcast_bytes=0)
    assert "_salt" in salted._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, salted.collect()))
    # the hot product is spread over several salt buckets
    from basketry.operators.catalog import SALT_BUCKETS
    hot_rows = events.filter("product_id = 'P0001'")
    buckets = hot_rows.select(F.pmod(F.xxhash64(*events.drop("category").columns), F.lit(SALT_BUCKETS)).alias("s"))
    assert buckets.distinct().count() > 1
