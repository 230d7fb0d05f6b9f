"""The composite jobs end to end on the smallest tables: stream ingest into
a base folder, then every batch job over what the stream wrote."""

import glob
import os

import pytest

from basketry.plans import jobs
from basketry.plans.registry import _AVAILABLE_NOW
from basketry.sources.streams import encode_events, text_source
from basketry.sources.testdata import shop_events
from basketry.streaming.jobs import run_available_now
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def base(spark):
    from basketry.session import fresh_dir

    base_dir = fresh_dir(spark, "jobs")
    messages = f"{base_dir}/messages"
    encode_events(shop_events(spark, SF_SMALL)).write.text(messages)
    run_available_now(text_source(spark, messages), base_dir, _AVAILABLE_NOW)
    return base_dir


def test_conversion_report_and_validation(spark, base):
    out = jobs.conversion_report_job(spark, base)
    report = out["report"].collect()
    assert len(report) == 6  # events without a product are no views
    assert [r.conversion_rate for r in report] == sorted((r.conversion_rate for r in report), reverse=True)
    assert out["average"].collect()[0][0] is not None
    assert len(out["top"].collect()) == 3
    assert all(r.passed for r in jobs.validate_report_job(spark, base).collect())
    assert len(glob.glob(f"{base}/reports/conversion_rate_report/part-*.csv")) == 1


def test_daily_jobs(spark, base):
    summary = {r.segment: r.users for r in jobs.user_segmentation_job(spark, base, "2024-01-30").collect()}
    assert summary == {"Buyer": 7, "Cart_Abandoner": 3, "Window_Shopper": 1, "Unknown": 3}
    lines = jobs.top_products_job(spark, base, "2024-01-30").orderBy("line_no").collect()
    text = open(glob.glob(f"{base}/reports/top_products/run_date=2024-01-30/part-*")[0]).read().splitlines()
    assert [r.line for r in lines] == text and [r.line_no for r in lines] == list(range(1, len(text) + 1))
    assert text[1] == "TOP 5 MOST VIEWED PRODUCTS - 2024-01-30" and text[4].startswith("1. Product ID: ")


def test_category_conversion_and_audit(spark, base):
    report = jobs.category_conversion_job(spark, base).collect()
    assert sum(r.views for r in report) > 0
    audit = {r.dataset: r for r in jobs.output_audit_job(spark, base).collect()}
    signups = shop_events(spark, SF_SMALL).filter("product_id IS NULL").count()
    assert audit["raw"].rows == 1000 and audit["raw"].null_key_rows == signups > 0
    files = glob.glob(f"{base}/raw/*/*/*.parquet")
    assert (audit["raw"].files, audit["raw"].bytes) == (len(files), sum(map(os.path.getsize, files)))
    assert audit["category_metrics"].rows > 0 and audit["category_metrics"].files > 0


def test_audit_of_missing_output_fails(spark, workdir):
    with pytest.raises(FileNotFoundError):
        jobs.output_audit_job(spark, workdir)


def test_catalog_job_normalises_a_csv_catalog(spark, workdir):
    os.makedirs(f"{workdir}/csv")
    with open(f"{workdir}/csv/catalog.csv", "w") as f:
        f.write("product_id,category\n p0001 ,Home \nP0001,Toys\np0002, Sports\n")
    out = jobs.catalog_job(spark, f"{workdir}/csv", workdir)
    assert sorted(tuple(r) for r in out.collect()) == [("P0001", "Toys"), ("P0002", "Sports")]
    # A new version lies beside the old one, which stays readable.
    with open(f"{workdir}/csv/catalog.csv", "w") as f:
        f.write("category,product_id\nBooks,P0001\n")
    jobs.catalog_job(spark, f"{workdir}/csv", workdir)
    assert out.count() == 2
    assert [tuple(r) for r in jobs.latest_catalog(spark, f"{workdir}/catalog").collect()] == [("P0001", "Books")]


def test_a_wrong_header_fails_the_validation(spark, workdir):
    path = f"{workdir}/reports/conversion_rate_report"
    os.makedirs(path)
    with open(f"{path}/part-0.csv", "w") as f:
        f.write("wrong,names,here,x,y,z\nToys,10,2,3,0.2,0.6667\n")
    failed = {r.check for r in jobs.validate_report_job(spark, workdir).collect() if not r.passed}
    assert "schema_matches" in failed
    with open(f"{path}/part-0.csv", "w") as f:
        f.write("category,views,purchases,cart_adds,conversion_rate,cart_to_purchase_rate\nToys,ten,2,3,0.2,0.6667\n")
    failed = {r.check for r in jobs.validate_report_job(spark, workdir).collect() if not r.passed}
    assert "unreadable_values" in failed and "schema_matches" not in failed
