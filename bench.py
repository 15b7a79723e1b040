"""Benchmark: the batch job's stages at $BENCH_SF_DIR on local[$BENCH_CPUS].

Stages timed (warm, median of $BENCH_RUNS runs):
  raw       derive requests_raw from the driver tables and land it as Parquet
  clean     cleaning job L1 (stats + imputation + de-duplication), written
  checks    quality report V7
  star      star-schema job D6 (4 dimensions + fact), written
  r_*       each of the six reports, collected
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import threading
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrameWriter  # noqa: E402

from civicspark.operators.quality import quality_report  # noqa: E402
from civicspark.operators.reports import all_reports  # noqa: E402
from civicspark.plans.clean import clean_requests  # noqa: E402
from civicspark.plans.star import build_star_schema  # noqa: E402
from civicspark.schema import RAW_COLUMNS  # noqa: E402
from civicspark.session import build_session, scratch_path  # noqa: E402
from civicspark.sinks.files import save_parquet  # noqa: E402
from civicspark.sources.files import read_star  # noqa: E402
from civicspark.sources.fixture import requests_raw  # noqa: E402

SHORT = {
    "avg_response_time_by_borough": "r1_borough",
    "top_20_complaint_types": "r2_top_types",
    "top_agencies_by_volume": "r3_top_agencies",
    "monthly_volume_trend": "r4_monthly",
    "slowest_complaints_by_avg_time": "r5_slowest",
    "data_quality_null_rates": "r6_null_rates",
}


_written = threading.Lock(), [0]


def _count_writes() -> None:
    """Count the Parquet tables that any code writes from now on."""
    lock, n = _written
    write = DataFrameWriter.parquet

    def counted(self, *args, **kwargs):
        with lock:
            n[0] += 1
        return write(self, *args, **kwargs)

    DataFrameWriter.parquet = counted


class _Timer:
    """Wall time, Spark jobs (via a job group) and Parquet tables written, by named stage."""

    def __init__(self, spark, run: int):
        self.sc = spark.sparkContext
        self.run = run
        self.seconds: dict[str, float] = {}
        self.jobs: dict[str, int] = {}
        self.writes: dict[str, int] = {}

    def __call__(self, name: str, fn):
        group = f"bench-{self.run}-{name}"
        before = _written[1][0]
        self.sc.setJobGroup(group, name)
        start = time.perf_counter()
        out = fn()
        self.seconds[name] = time.perf_counter() - start
        self.jobs[name] = len(self.sc.statusTracker().getJobIdsForGroup(group))
        self.writes[name] = _written[1][0] - before
        return out


def one_run(spark, sf_dir: str, run: int) -> _Timer:
    t = _Timer(spark, run)

    raw_path = scratch_path(spark, "bench-raw")
    # Landed like pages: bounded records per file, so the clean job reads the
    # raw table with more than one task per input file.
    t("raw", lambda: requests_raw(spark, sf_dir).write.option("maxRecordsPerFile", 20_000).parquet(raw_path))
    raw = spark.read.parquet(raw_path)

    clean_path = scratch_path(spark, "bench-clean")
    t("clean", lambda: save_parquet(clean_requests(raw, RAW_COLUMNS), clean_path))
    clean = spark.read.parquet(clean_path)

    t("checks", lambda: quality_report(clean).collect())

    star_dir = scratch_path(spark, "bench-star")
    t("star", lambda: build_star_schema(spark, clean_path, star_dir))

    for name, df in all_reports(read_star(spark, star_dir)).items():
        t(SHORT[name], df.collect)
    return t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    extra = dict(kv.split("=", 1) for kv in os.environ.get("BENCH_CONF", "").split(",") if "=" in kv)
    spark = build_session(
        master=f"local[{cpus}]", app_name="civicspark-bench", shuffle_partitions=max(cpus, 2), extra=extra
    )

    _count_writes()
    one_run(spark, sf_dir, 0)  # warm-up: JIT, file listing caches
    samples = [one_run(spark, sf_dir, i + 1) for i in range(runs)]
    per_query = {k: round(statistics.median(s.seconds[k] for s in samples), 3) for k in samples[0].seconds}
    jobs = samples[-1].jobs
    total = round(sum(per_query.values()), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "batch_job_stage_sum_median",
                "value": total,
                "unit": "sec",
                "queries": per_query,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "runs": runs,
                "cpus": cpus,
                "spark_jobs": jobs,
                "tables_written": {k: n for k, n in samples[-1].writes.items() if n},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
