"""Every registered query against its DuckDB SQL on the smallest tables."""

import importlib.util
import os
import re

import pytest

from basketry.plans.oracle import ORACLE_SQL
from basketry.plans.registry import QUERIES
from tests.conftest import SF_SMALL

_spec = importlib.util.spec_from_file_location(
    "oracle_check", os.path.join(os.path.dirname(os.path.dirname(__file__)), "scripts", "oracle_check.py")
)
oracle_check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(oracle_check)


@pytest.fixture(scope="module")
def results(spark):
    return {name: (ok, msg) for name, ok, msg in oracle_check.compare(spark, SF_SMALL, list(QUERIES))}


def test_every_query_has_an_oracle(results):
    assert set(QUERIES) == set(ORACLE_SQL) == set(results)


def test_the_entry_module_holds_them():
    import __spark_entry__ as contract

    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE_SQL) <= set(contract.oracle_sql())


def test_a_missing_oracle_fails_the_comparison(spark, monkeypatch):
    monkeypatch.setattr(oracle_check.contract, "oracle_sql", dict)
    ((_, ok, _),) = oracle_check.compare(spark, SF_SMALL, ["events_by_date"])
    assert not ok


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(results, name):
    ok, msg = results[name]
    assert ok, msg


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_result_columns_are_explicit_aliases(results, name):
    cols = oracle_check.COLUMNS[name]
    assert all(re.fullmatch(r"[a-z][a-z0-9_]*", c) for c in cols), cols
    assert len(cols) == len(set(cols))


def test_entry_runs(spark):
    import __spark_entry__ as contract

    df = contract.entry(spark)
    assert df.columns == ["category", "views", "purchases", "cart_adds", "conversion_rate", "cart_to_purchase_rate"]
    assert df.count() == 6


def test_queries_pin_utc_in_a_foreign_zone_session(spark):
    import __spark_entry__ as contract

    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        rows = contract.queries()["events_by_date"](spark, SF_SMALL).collect()
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        assert len(rows) == 30
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
