"""Time the batch job's stages over a folded fixture: how seconds grow with rows, beside the same SQL in one DuckDB process.

Usage: python tools/measure_scale.py [sf_dir] [fold ...]
A fold of n holds every request n times under keys of its own; it is written
once to a fresh folder below the session's scratch folder. Every stage runs
twice, the second run counts. Prints one JSON line per fold.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from civicspark import oracle  # noqa: E402
from civicspark.operators.quality import quality_report  # noqa: E402
from civicspark.plans.clean import clean_requests  # noqa: E402
from civicspark.plans.reports import generate_reports  # noqa: E402
from civicspark.plans.star import build_star_schema  # noqa: E402
from civicspark.schema import RAW_COLUMNS  # noqa: E402
from civicspark.session import build_session, scratch_path, scratch_scope  # noqa: E402
from civicspark.sinks.files import save_parquet  # noqa: E402
from civicspark.sources.fixture import requests_raw  # noqa: E402
from tools.measure_baseline import _rest  # noqa: E402

THREADS = int(os.environ.get("BENCH_CPUS", "8"))


def _twice(run) -> float:
    run()
    began = time.perf_counter()
    run()
    return round(time.perf_counter() - began, 2)


def spark_stages(spark, raw_path: str) -> dict[str, float]:
    clean, star, reports = (scratch_path(spark, n) for n in ("clean", "star", "reports"))
    raw = spark.read.parquet(raw_path)
    return {
        "clean": _twice(lambda: save_parquet(clean_requests(raw, RAW_COLUMNS), clean)),
        "checks": _twice(lambda: quality_report(spark.read.parquet(clean)).collect()),
        "star": _twice(lambda: build_star_schema(spark, clean, star)),
        "reports": _twice(lambda: generate_reports(spark, star, reports)),
    }


def duckdb_stages(raw_path: str) -> dict[str, float]:
    con = duckdb.connect()
    con.execute(f"SET threads = {THREADS}")
    con.execute(f"CREATE VIEW requests_raw AS SELECT * FROM read_parquet('{raw_path.removeprefix('file:')}/*.parquet')")

    def star():
        for name in ("dim_agency", "dim_complaint", "dim_location", "dim_date"):
            con.execute(f"CREATE OR REPLACE TABLE {name}_t AS {_rest(name, 'clean')}")
        con.execute(f"CREATE OR REPLACE TABLE fact_t AS {_rest('fact_requests', 'clean')}")

    out = {"clean": _twice(lambda: con.execute(f"CREATE OR REPLACE TABLE clean AS {_rest('clean_requests', 'requests_raw')}"))}
    out["checks"] = _twice(lambda: con.execute(_rest("quality_report", "clean")).fetchall())
    out["star"] = _twice(star)
    out["reports"] = _twice(lambda: [con.execute(_rest(name, "clean")).fetchall() for name in oracle._reports("")])
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    folds = [int(x) for x in sys.argv[2:]] or [1, 10]
    spark = build_session(master=f"local[{THREADS}]", shuffle_partitions=2 * THREADS)
    raw = requests_raw(spark, sf_dir)
    for fold in folds:
        with scratch_scope(spark, "scale"):
            path = scratch_path(spark, "raw")
            folded = raw.withColumn("_fold", F.explode(F.sequence(F.lit(1), F.lit(fold))))
            key = F.concat("unique_key", F.lit("-"), "_fold")
            folded.select(key.alias("unique_key"), *RAW_COLUMNS[1:]).write.parquet(path)
            rows = spark.read.parquet(path).count()
            ours, theirs = spark_stages(spark, path), duckdb_stages(path)
        total = {"spark": round(sum(ours.values()), 2), "duckdb": round(sum(theirs.values()), 2)}
        print(json.dumps({"fold": fold, "rows": rows, "spark": ours, "duckdb": theirs, "sum": total}), flush=True)


if __name__ == "__main__":
    main()
