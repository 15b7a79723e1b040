"""The end-to-end batch job (L2): source -> clean -> checks -> load -> star -> reports.

Stages hand over through written files, as the stages of the job they
reproduce do. The job stops before loading anything if the source is empty or
a quality check fails.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.operators.quality import validate
from civicspark.plans.clean import clean_requests
from civicspark.plans.reports import generate_reports
from civicspark.plans.star import build_star_schema
from civicspark.schema import RAW_COLUMNS
from civicspark.session import scratch_scope
from civicspark.sinks.files import save_raw
from civicspark.sinks.snapshots import commit_snapshot, discard_snapshot, register_snapshot, remove_old_versions, stage_snapshot
from civicspark.sources.landed import read_page_source
from civicspark.sources.paging import check_batch_size, created_between, take_newest

log = logging.getLogger(__name__)


@dataclass
class BatchSettings:
    """What the job needs: limits, column list, output locations."""

    out_dir: str
    start_date: str | None = None
    end_date: str | None = None
    total_limit: int | None = None
    batch_size: int = 1000
    required_columns: list[str] = field(default_factory=lambda: list(RAW_COLUMNS))
    drop_duplicates: bool = True
    table_name: str = "service_requests_clean"
    #: Versions of the clean table that stay readable after a run (None: all).
    keep_versions: int | None = 2

    def path(self, name: str) -> str:
        return f"{self.out_dir.rstrip('/')}/{name}"


class EmptySourceError(RuntimeError):
    """The source returned no rows."""


def run_batch(spark: SparkSession, source: DataFrame, settings: BatchSettings) -> DataFrame:
    """Run every stage; return ``(stage, n_rows)`` for the raw, clean, star and report tables.

    Intermediate tables (the typed stage, which is as large as the raw input,
    ranking and hot-key tables) live in one scratch
    folder that is removed when the run ends, successfully or not. The result
    reads only the job's outputs.
    """
    with scratch_scope(spark, "batch-run"):
        return _run(spark, source, settings)


def run_batch_from_pages(spark: SparkSession, pages_dir: str, settings: BatchSettings) -> DataFrame:
    """:func:`run_batch` over landed page files, read by the stop rules of the paged source.

    All keys of the records are read; the cleaning job picks the required ones.
    """
    return run_batch(spark, read_page_source(spark, pages_dir, settings.batch_size, schema=None), settings)


def _run(spark: SparkSession, source: DataFrame, settings: BatchSettings) -> DataFrame:
    check_batch_size(settings.batch_size)
    raw = take_newest(created_between(source, settings.start_date, settings.end_date), settings.total_limit)
    raw_path = settings.path("raw/requests_raw.parquet")
    save_raw(raw, raw_path)
    raw = spark.read.parquet(raw_path)
    if raw.limit(1).count() == 0:
        raise EmptySourceError("No data fetched - aborting")

    # The clean table is written once, as a snapshot that no reader sees yet,
    # checked there, and then committed; the catalog table lies over the same
    # files. So the job writes its input three times: raw, typed stage, clean.
    clean = clean_requests(raw, settings.required_columns, settings.drop_duplicates)
    root, staged = settings.path("clean"), None
    if clean.columns:  # (a table without columns cannot be written; the checks reject it anyway)
        staged = stage_snapshot(clean, root)
        clean = spark.read.parquet(staged)
    try:
        validate(clean)  # raises ValidationError before anything is loaded
    except Exception:
        if staged is not None:
            discard_snapshot(spark, root, staged)
        raise
    commit_snapshot(spark, root, staged)
    register_snapshot(spark, settings.table_name, root)

    star_dir = settings.path("analytics")
    counts = build_star_schema(spark, staged, star_dir)
    reports = generate_reports(spark, star_dir, settings.path("reports"))

    if settings.keep_versions is not None:
        remove_old_versions(spark, root, settings.keep_versions)

    stages = [("raw", raw), ("clean", clean)]
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("stage"), "n_rows") for name, df in stages]
    star_rows = spark.createDataFrame([(name, n) for name, n in counts.items()], "stage string, n_rows bigint")
    report_rows = [
        spark.read.option("header", True).csv(settings.path(f"reports/{name}.csv"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(f"report:{name}").alias("stage"), "n_rows")
        for name in reports
    ]
    out = parts[0]
    for p in parts[1:] + [star_rows] + report_rows:
        out = out.unionByName(p)
    return out
