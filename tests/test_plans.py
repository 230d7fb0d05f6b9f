"""Physical-plan properties the design relies on."""

import re

import pytest

from basketry.plans.registry import QUERIES
from tests.conftest import SF_SMALL

BATCH = [n for n in QUERIES if not n.startswith("stream_") and n != "output_audit"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", BATCH)
def test_no_python_in_plans(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas"):
        assert marker not in plan


def test_funnel_is_one_scan_with_pushed_type_filter(spark):
    text = _formatted(QUERIES["funnel_counts"](spark, SF_SMALL))
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) == 1
    pushed = [line for line in text.splitlines() if line.startswith("PushedFilters")]
    assert len(pushed) == 1 and "In(event_type" in pushed[0]


def test_daily_queries_prune_date_partitions(spark):
    text = _formatted(QUERIES["user_segments"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(event_date" in text
    assert "event_date" in text.split("PartitionFilters:")[1].split("\n")[0]


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(QUERIES["top_categories"](spark, SF_SMALL))


def test_catalog_lookup_is_broadcast(spark):
    assert "BroadcastHashJoin" in _plan(QUERIES["shop_events"](spark, SF_SMALL))


def test_scan_reads_only_needed_columns(spark):
    text = _formatted(QUERIES["segment_summary"](spark, SF_SMALL))
    read_schema = [l for l in text.splitlines() if l.startswith("ReadSchema")][0]
    assert "product_id" not in read_schema and "user_id" in read_schema


def test_average_does_not_sort_the_report(spark):
    df = QUERIES["avg_conversion_rate"](spark, SF_SMALL)
    assert "rangepartitioning" not in _plan(df)


def test_event_union_opens_each_date_once(spark):
    text = _formatted(QUERIES["event_union"](spark, SF_SMALL))
    filters = [line for line in text.splitlines() if line.startswith("PartitionFilters")]
    assert len(filters) == 2 and all("event_date" in f for f in filters)


def test_join_form_scans_once(spark):
    df = QUERIES["funnel_join_form"](spark, SF_SMALL)
    df.collect()
    assert _plan(df).split("Initial Plan")[0].count("FileScan parquet") == 1


# A catalog (a dimension) and the few (product, category) pairs of the roll-up
# are reduced by the greatest text, which Spark sorts; everything over events
# is a hash aggregate.
SORTED_DIMENSIONS = ("shop_events", "catalog_normalize", "catalog_enrich", "product_category_map", "category_conversion_report", "job_category_conversion")


@pytest.mark.parametrize("name", [n for n in BATCH if n not in SORTED_DIMENSIONS])
def test_event_scale_aggregates_are_hash_based(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    df._jdf.collectAsList()
    assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()
