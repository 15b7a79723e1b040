"""Driver contract: entry, registry and oracle agree (checked at sf0.001 against DuckDB)."""

import os

import pytest

import __spark_entry__ as E
from civicspark import queries as Q
from tests.conftest import SF_SMALL
from tests.oracle_check import assert_matches_oracle


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["complaint_type", "n_requests"]
    assert len(rows) == 20


def test_every_request_query_has_oracle_sql():
    assert set(Q.queries()) == set(Q.oracle_sql())
    assert set(Q.queries()) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query_matches_oracle(spark, name):
    assert_matches_oracle(spark, SF_SMALL, name)


FORCED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "civicspark.broadcastRows": "0",
    "civicspark.hotSlots": "20",
}


def test_large_data_paths_match_oracle(spark, tmp_dir):
    """Clean + star built with no broadcast joins and hot-key split lookups give the oracle's tables."""
    from civicspark.plans.clean import clean_requests
    from civicspark.plans.star import build_star_schema
    from civicspark.schema import RAW_COLUMNS
    from civicspark.sinks.files import save_parquet
    from civicspark.sources.files import read_star
    from civicspark.sources.fixture import requests_raw

    before = {k: spark.conf.get(k, None) for k in FORCED}
    for k, v in FORCED.items():
        spark.conf.set(k, v)
    try:
        clean_dir = os.path.join(tmp_dir, "clean")
        save_parquet(clean_requests(requests_raw(spark, SF_SMALL), RAW_COLUMNS), clean_dir)
        star_dir = os.path.join(tmp_dir, "star")
        build_star_schema(spark, clean_dir, star_dir)
        star = read_star(spark, star_dir)
        assert_matches_oracle(spark, SF_SMALL, "clean_requests", spark.read.parquet(clean_dir))
        assert_matches_oracle(spark, SF_SMALL, "dim_location", star["dim_location"])
        assert_matches_oracle(spark, SF_SMALL, "fact_requests", Q._fact_attributes(star))
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
