"""The end-to-end batch job: success, and the two aborts before anything is loaded."""

import os

import pytest

from civicspark.operators.quality import ValidationError
from civicspark.plans.batch import BatchSettings, EmptySourceError, run_batch, run_batch_from_pages
from civicspark.sinks.snapshots import current_snapshot
from civicspark.sources.fixture import requests_raw
from civicspark.sources.landed import land_pages, page_texts
from tests.conftest import SF_SMALL


def test_batch_runs_every_stage(spark, tmp_dir):
    settings = BatchSettings(out_dir=tmp_dir, start_date="1995-01-01", end_date="2001-12-31")
    summary = {r["stage"]: r["n_rows"] for r in run_batch(spark, requests_raw(spark, SF_SMALL), settings).collect()}
    assert summary["clean"] == summary["fact_311_requests"] > 0
    assert summary["raw"] >= summary["clean"]
    assert summary["report:monthly_volume_trend"] > 0
    for name in ["avg_response_time_by_borough", "data_quality_null_rates"]:
        assert os.path.isfile(os.path.join(tmp_dir, "reports", f"{name}.csv"))
    assert spark.table(settings.table_name).count() == summary["clean"]


def test_batch_over_pages_keeps_the_versions_asked_for(spark, tmp_dir):
    raw = requests_raw(spark, SF_SMALL)
    land_pages(page_texts(raw), f"{tmp_dir}/pages")
    settings = BatchSettings(out_dir=f"{tmp_dir}/out", start_date="1995-01-01", end_date="2001-12-31", table_name="requests_of_pages_test", keep_versions=1)
    first = {r["stage"]: r["n_rows"] for r in run_batch_from_pages(spark, f"{tmp_dir}/pages", settings).collect()}
    again = {r["stage"]: r["n_rows"] for r in run_batch_from_pages(spark, f"{tmp_dir}/pages", settings).collect()}
    assert first == again and first["clean"] > 0
    assert first["raw"] == raw.where("created_date >= '1995' AND created_date < '2002'").count()
    assert current_snapshot(spark, f"{tmp_dir}/out/clean").version == 2 and len(os.listdir(f"{tmp_dir}/out/clean/data")) == 1
    assert spark.table(settings.table_name).count() == first["clean"]


def test_batch_aborts_on_empty_source(spark, tmp_dir):
    settings = BatchSettings(out_dir=tmp_dir, start_date="1980-01-01", end_date="1980-12-31")
    with pytest.raises(EmptySourceError):
        run_batch(spark, requests_raw(spark, SF_SMALL), settings)
    assert not os.path.exists(os.path.join(tmp_dir, "clean"))


def test_batch_aborts_on_failed_validation_before_loading(spark, tmp_dir):
    # Without a date range, rows with an unparseable creation time reach the
    # checks, and a created_date null rate above 0 fails them.
    settings = BatchSettings(out_dir=tmp_dir)
    with pytest.raises(ValidationError, match="created_date"):
        run_batch(spark, requests_raw(spark, SF_SMALL), settings)
    assert not os.path.exists(os.path.join(tmp_dir, "clean"))
    assert not os.path.exists(os.path.join(tmp_dir, "analytics"))


def test_batch_rejects_bad_page_size(spark, tmp_dir):
    with pytest.raises(ValueError, match="batch_size"):
        run_batch(spark, requests_raw(spark, SF_SMALL), BatchSettings(out_dir=tmp_dir, batch_size=5000))


def test_batch_rejects_a_source_without_values(spark, tmp_dir):
    # Every required column is empty: cleaning drops them all and the schema check fails.
    source = spark.createDataFrame([(None, None), (None, None)], "unique_key string, created_date string")
    with pytest.raises(ValidationError, match="Missing required columns"):
        run_batch(spark, source, BatchSettings(out_dir=tmp_dir))


def test_batch_leaves_no_scratch_tables(spark, tmp_dir):
    from civicspark.session import scratch_root

    root = scratch_root(spark).replace("file:", "") + "/civicspark"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    settings = BatchSettings(out_dir=tmp_dir, start_date="1995-01-01", end_date="2001-12-31")
    summary = run_batch(spark, requests_raw(spark, SF_SMALL), settings).collect()
    after = set(os.listdir(root)) if os.path.isdir(root) else set()
    assert len(summary) == 13
    assert after - before == set()  # stage, ranking, hot-key and staging tables all removed
