"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query starts from the driver tables of ``sf_dir`` (through
``requests_raw``). Expensive shared stages -- the cleaned table and the star
tables -- are written once per session and input folder under the scratch
root and re-read by later queries, as the batch job itself hands them over.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from civicspark import oracle
from civicspark.functions.columns import ISO_LAYOUT
from civicspark.operators import cleaning as K
from civicspark.operators import quality as V
from civicspark.operators import reports as R
from civicspark.operators.colocated import colocated_lookup, save_colocated
from civicspark.operators.joins import lookup
from civicspark.operators.star import FACT_COLUMNS
from civicspark.operators.stats import duplicate_count, exact_medians, median_table, modes
from civicspark.plans.batch import BatchSettings, run_batch, run_batch_from_pages
from civicspark.plans.clean import Stage, clean_requests, impute, stage_requests
from civicspark.plans.reports import generate_reports
from civicspark.plans.star import build_star_schema
from civicspark.schema import RAW_COLUMNS, RAW_SCHEMA
from civicspark.session import materialize, scratch_path
from civicspark.sinks.files import save_parquet, save_raw, save_table, star_row_counts
from civicspark.sinks.months import monthly_counts, read_months, save_by_month
from civicspark.sinks.snapshots import read_snapshot, register_snapshot, stage_snapshot, write_snapshot
from civicspark.sources import fixture, landed, paging
from civicspark.sources.files import load_file, read_dataset, read_pages, read_star
from civicspark.sources.fixture import requests_raw

Query = Callable[[SparkSession, str], DataFrame]

_lock = threading.RLock()
_built: dict[tuple[str, str, str], object] = {}


def _memo(spark: SparkSession, sf_dir: str, what: str, build: Callable[[], object]) -> object:
    """Build a stage once per (application, input folder, stage) and reuse it."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), what)
    with _lock:
        if key not in _built:
            _built[key] = build()
        return _built[key]


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests_raw(spark, sf_dir)


def _selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.select_required(_raw(spark, sf_dir), RAW_COLUMNS)


def _staged(spark: SparkSession, sf_dir: str) -> Stage:
    """Typed, key-filtered rows and their profile (written once by ``stage_requests``)."""
    return _memo(spark, sf_dir, "stage", lambda: stage_requests(_raw(spark, sf_dir), RAW_COLUMNS))


def _stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir).df


def _clean_dir(spark: SparkSession, sf_dir: str) -> str:
    def build() -> str:
        path = scratch_path(spark, "clean")
        st = _staged(spark, sf_dir)
        save_parquet(K.dedup_rows(impute(st.df, st.profile)), path)
        return path

    return _memo(spark, sf_dir, "clean", build)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_clean_dir(spark, sf_dir))


def _star_dir(spark: SparkSession, sf_dir: str) -> str:
    def build() -> str:
        path = scratch_path(spark, "star")
        build_star_schema(spark, _clean_dir(spark, sf_dir), path)
        return path

    return _memo(spark, sf_dir, "star", build)


def _stars(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return read_star(spark, _star_dir(spark, sf_dir))


# -- cleaning steps, cumulative in the job's fixed order ----------------------


def _step(*fns: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _selected(spark, sf_dir)
        for fn in fns:
            df = fn(df)
        return df

    return run


_typing = [K.parse_dates, K.parse_coordinates, K.standardize_borough, K.repair_dates, K.add_response_time]


def _impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = _staged(spark, sf_dir)
    return K.impute_median(st.df, exact_medians(st.df, K.imputation_plan(st.df)["median"]))


def _impute_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = _stage(spark, sf_dir)
    return K.impute_unknown(stage, K.imputation_plan(stage)["unknown"])


def _impute_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = _stage(spark, sf_dir)
    return K.impute_mode(stage, modes(stage, K.imputation_plan(stage)["mode"]))


def _column_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    return median_table(_stage(spark, sf_dir), ["latitude", "longitude", "response_time_hours"])


def _column_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = modes(_stage(spark, sf_dir), ["incident_zip"])
    return spark.createDataFrame([("incident_zip", m["incident_zip"])], "column_name string, mode string")


# -- sources and sinks --------------------------------------------------------


def _date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.created_between(_raw(spark, sf_dir), *oracle.DATE_RANGE)


def _page_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    offset, size = oracle.PAGE
    return paging.page_slice(_raw(spark, sf_dir), offset, size)


def _total_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.take_newest(_raw(spark, sf_dir), oracle.TOTAL_LIMIT)


def _paged_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 1000 appended until the total limit, as the paged source reads."""
    out = None
    for page in paging.pages(_raw(spark, sf_dir), oracle.PAGE[1], oracle.PAGED_LIMIT):
        out = page if out is None else out.unionByName(page)
    return out


def _read_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Land the records as JSON (absent keys for nulls), then read them back.
    path = scratch_path(spark, "pages")
    _raw(spark, sf_dir).write.json(path)
    return read_pages(spark, path, RAW_SCHEMA)


def _page_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages read up to an empty page, up to a short one, and up to a limit."""
    size, empty, short, limit = oracle.SOURCE_PAGES
    texts = materialize(landed.page_texts(_raw(spark, sf_dir), size), "page-texts")
    page = F.col("page")
    gap = texts.withColumn("page", F.when(page < empty, page).otherwise(page + 1))
    gap = gap.unionByName(spark.createDataFrame([(empty, "[]")], "page bigint, value string"))
    first = F.slice(F.try_variant_get(F.parse_json("value"), "$", "array<variant>"), 1, oracle.SHORT_PAGE)
    cut = texts.withColumn("value", F.when(page == short, F.to_json(first)).otherwise(F.col("value")))
    parts = []
    for name, pages, total in (("empty page", gap, None), ("short page", cut, None), ("limit", gap, limit)):
        path = scratch_path(spark, "pages")
        landed.land_pages(pages, path)
        parts.append(landed.read_page_source(spark, path, size, total).select(F.lit(name).alias("source"), "*"))
    return reduce(DataFrame.unionByName, parts)


def _read_pages_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "pages")
    landed.land_pages(landed.page_texts(fixture.requests_more_keys(spark, sf_dir)), path)
    return landed.read_page_source(spark, path, schema=None)


def _hive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "hive")
    _clean(spark, sf_dir).write.partitionBy("borough").parquet(path)
    return read_dataset(spark, path)


def _nested_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files at the root, in a plain folder and below hive folders, beside files of another kind."""
    path, clean = scratch_path(spark, "nested"), _clean(spark, sf_dir)
    b = F.col("borough")
    clean.where(b == "BRONX").write.parquet(path)
    clean.where(b == "QUEENS").write.parquet(f"{path}/older/second")
    clean.where(~b.isin("BRONX", "QUEENS")).write.mode("append").partitionBy("borough").parquet(path)
    clean.select(b).distinct().write.text(f"{path}/notes")
    return read_dataset(spark, path)


def _round_trip_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "rt") + ".parquet"
    save_parquet(_clean(spark, sf_dir), path)
    return load_file(spark, path)


def _csv_round_trip(source: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "rt") + ".csv"
        save_raw(source(spark, sf_dir), path)
        return load_file(spark, path, RAW_SCHEMA, multi_line=True)

    return run


def _two_line_descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).withColumn("descriptor", F.concat("descriptor", F.lit("\nsecond line")))


def _round_trip_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "table")
    name = "requests_clean_round_trip"
    save_table(_clean(spark, sf_dir), name, path)
    return spark.table(name)


def _snapshot_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a table, a write between them that never commits, and the catalog table over the last one."""
    root, clean = scratch_path(spark, "snapshots"), _clean(spark, sf_dir)
    write_snapshot(clean.where("borough = 'BRONX'"), root)
    stage_snapshot(clean.where("borough = 'QUEENS'"), root)
    between = read_snapshot(spark, root)
    write_snapshot(clean, root)
    register_snapshot(spark, "requests_clean_snapshots", root)
    parts = {"first": read_snapshot(spark, root, 1), "after an unfinished write": between, "catalog": spark.table("requests_clean_snapshots")}
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("version"), "*") for name, df in parts.items()])


def _by_month(spark: SparkSession, sf_dir: str) -> str:
    def build() -> str:
        path = scratch_path(spark, "by-month")
        save_by_month(_clean(spark, sf_dir), path)
        return path

    return _memo(spark, sf_dir, "by-month", build)


def _month_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table by month, and one month written again with other agencies."""
    path, (first, last) = scratch_path(spark, "by-month"), oracle.RERUN_MONTH
    save_by_month(_clean(spark, sf_dir), path)
    save_by_month(read_months(spark, path, first, last).withColumn("agency", F.lower("agency")), path)
    return read_months(spark, path)


def _report_lines(spark: SparkSession, reports_dir: str, schemas: dict[str, StructType]) -> DataFrame:
    """The report CSVs of a folder in one table: ``report, label, n_requests, value``."""
    none = F.lit(None)

    def lines(name: str, label: Column, n: Column, value: Column) -> DataFrame:
        csv = load_file(spark, f"{reports_dir}/{name}.csv", schemas[name], multi_line=True)
        return csv.select(F.lit(name).alias("report"), label.alias("label"), n.cast("bigint").alias("n_requests"), value.cast("double").alias("value"))

    n, hours = F.col("n_requests"), F.col("avg_hours")
    parts = [
        lines("avg_response_time_by_borough", F.col("borough"), n, hours),
        lines("top_20_complaint_types", F.col("complaint_type"), n, none),
        lines("top_agencies_by_volume", F.col("agency"), n, none),
        lines("monthly_volume_trend", F.concat_ws("-", "year", "month"), n, none),
        lines("slowest_complaints_by_avg_time", F.col("complaint_type"), n, hours),
    ]
    rates = schemas["data_quality_null_rates"].names
    parts += [lines("data_quality_null_rates", F.lit(c), none, F.col(c)) for c in rates]
    return reduce(DataFrame.unionByName, parts)


def _batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and a total over the values of every table that the batch job leaves behind."""
    out = scratch_path(spark, "batch")
    settings = BatchSettings(out_dir=out, start_date=oracle.BATCH_RANGE[0], end_date=oracle.BATCH_RANGE[1])
    counts = run_batch(spark, _raw(spark, sf_dir), settings)
    star = read_star(spark, f"{out}/analytics")
    fact = _fact_attributes(star)

    def total(stage: str, df: DataFrame, value: Column) -> DataFrame:
        return df.agg(value.cast("double").alias("total")).select(F.lit(stage).alias("stage"), "total")

    def length(c: str) -> Column:
        return F.coalesce(F.length(c), F.lit(0))

    parts = [
        total("raw", spark.read.parquet(f"{out}/raw/requests_raw.parquet"), F.sum(F.length("unique_key"))),
        total("clean", read_snapshot(spark, f"{out}/clean"), F.round(F.sum(F.col("latitude") + F.col("longitude")), 3)),
        total("dim_agency", star["dim_agency"], F.sum(F.col("agency_id") * F.length("agency"))),
        total("dim_complaint", star["dim_complaint"], F.sum(F.col("complaint_id") * F.length("complaint_type"))),
        total("dim_location", star["dim_location"], F.sum(F.col("location_id") * F.length("borough"))),
        total("dim_date", star["dim_date"], F.sum(F.expr("year * 10000 + month * 100 + day + day_of_week"))),
        total("fact_311_requests", fact, F.sum(length("agency") + length("complaint_type") + length("borough"))),
    ]
    schemas = {name: df.schema for name, df in R.all_reports(star).items()}
    lines = _report_lines(spark, f"{out}/reports", schemas).groupBy("report").agg(
        F.round(F.sum(F.coalesce("n_requests", F.lit(0)) + F.coalesce("value", F.lit(0.0))), 2).alias("total"),
        F.count(F.lit(1)).alias("n"),
    )
    reports = lines.select(F.concat(F.lit("report:"), "report").alias("stage"), F.col("n").alias("n_rows"), "total")
    tables = counts.where(~F.col("stage").startswith("report:")).join(reduce(DataFrame.unionByName, parts), "stage")
    return tables.unionByName(reports)


def _batch_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the tables that the batch job leaves behind when it reads landed pages."""
    pages, out = scratch_path(spark, "pages"), scratch_path(spark, "batch")
    landed.land_pages(landed.page_texts(fixture.requests_more_keys(spark, sf_dir)), pages)
    first, last = oracle.BATCH_RANGE
    counts = run_batch_from_pages(spark, pages, BatchSettings(out_dir=out, start_date=first, end_date=last, table_name="requests_clean_from_pages"))
    return counts.where(~F.col("stage").startswith("report:"))


def _reports_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report job writes every report as CSV; all are read back."""
    out = scratch_path(spark, "reports")
    reports = generate_reports(spark, _star_dir(spark, sf_dir), out)
    return _report_lines(spark, out, {name: df.schema for name, df in reports.items()})


def _fact_attributes(star: dict[str, DataFrame]) -> DataFrame:
    """The fact with what its keys stand for in place of the keys."""
    fact = star["fact_311_requests"]
    for name, key in (("dim_agency", "agency_id"), ("dim_complaint", "complaint_id"), ("dim_location", "location_id")):
        fact = fact.join(star[name], key, "left").drop(key)
    return fact


def _fact_unimputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star over rows that still miss descriptors, zips and coordinates."""

    def build() -> str:
        path, star = scratch_path(spark, "unimputed"), scratch_path(spark, "unimputed-star")
        save_parquet(_stage(spark, sf_dir), path)
        build_star_schema(spark, path, star)
        return star

    return _fact_attributes(read_star(spark, _memo(spark, sf_dir, "unimputed-star", build)))


def _null_rates_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.check_null_rates(fixture.requests_nan(spark, sf_dir), oracle.NAN_THRESHOLDS)


def _clean_nan_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "nan") + ".parquet"
    save_raw(fixture.requests_nan(spark, sf_dir), path)
    return clean_requests(load_file(spark, path), RAW_COLUMNS)


def _parse_dates_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    layouts = (ISO_LAYOUT, fixture.US_LAYOUT, fixture.ZULU_LAYOUT)
    return K.parse_dates(fixture.requests_two_layouts(spark, sf_dir), layouts)


def _parse_dates_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.parse_dates_inferred(fixture.requests_two_layouts(spark, sf_dir))


def _fact_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact's location lookup between tables laid out by the location, with some locations hot."""
    star, keys = _stars(spark, sf_dir), (("borough", "incident_zip"), ("latitude", "longitude"))
    tag = uuid.uuid4().hex[:8]
    path = scratch_path(spark, "colocated")
    fact = save_colocated(_clean(spark, sf_dir), f"clean_by_location_{tag}", path, *keys, buckets=16, hot_slots=2000)
    dim = save_colocated(star["dim_location"], f"locations_{tag}", path, *keys, buckets=16, unique=True)
    located = colocated_lookup(spark, fact, dim, ["location_id"])
    with_agency = lookup(located, star["dim_agency"], ["agency"], [], ["agency_id"])
    keyed = lookup(with_agency, star["dim_complaint"], ["complaint_type", "descriptor"], [], ["complaint_id"])
    return _fact_attributes(star | {"fact_311_requests": keyed.select(*FACT_COLUMNS)})


def _report(name: str) -> Query:
    return lambda spark, sf_dir: R.all_reports(_stars(spark, sf_dir))[name]


def _check(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(_clean(spark, sf_dir))


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "requests_raw": _raw,
        "select_required": lambda s, d: K.select_required(fixture.requests_wide(s, d), RAW_COLUMNS),
        "drop_empty_columns": lambda s, d: K.drop_empty_columns(fixture.requests_wide(s, d).drop("note")),
        "rename_columns": lambda s, d: K.normalize_column_names(fixture.requests_odd_names(s, d)),
        "parse_dates": _step(*_typing[:1]),
        "parse_coordinates": _step(*_typing[:2]),
        "standardize_borough": _step(*_typing[:3]),
        "repair_dates": _step(*_typing[:4]),
        "response_time": _step(*_typing[:5]),
        "drop_null_keys": _step(*_typing, K.drop_null_keys),
        "impute_median": _impute_median,
        "impute_unknown": _impute_unknown,
        "impute_mode": _impute_mode,
        "dedup_rows": lambda s, d: K.dedup_rows(impute(_staged(s, d).df, _staged(s, d).profile)),
        "clean_requests": lambda s, d: clean_requests(_raw(s, d), RAW_COLUMNS),
        "clean_nan_source": _clean_nan_source,
        "parse_dates_layouts": _parse_dates_layouts,
        "parse_dates_inferred": _parse_dates_inferred,
        "column_medians": _column_medians,
        "median_two_peaks": lambda s, d: median_table(fixture.two_peaks(s, d), ["x"]),
        "column_modes": _column_modes,
        "raw_key_duplicates": lambda s, d: duplicate_count(_raw(s, d), "unique_key"),
        "dim_agency": lambda s, d: _stars(s, d)["dim_agency"],
        "dim_complaint": lambda s, d: _stars(s, d)["dim_complaint"],
        "dim_location": lambda s, d: _stars(s, d)["dim_location"],
        "dim_date": lambda s, d: _stars(s, d)["dim_date"],
        "fact_requests": lambda s, d: _fact_attributes(_stars(s, d)),
        "fact_unimputed": _fact_unimputed,
        "fact_colocated": _fact_colocated,
        "star_row_counts": lambda s, d: star_row_counts(s, _star_dir(s, d)),
    }
    for name in R.REPORT_NAMES:
        q[name] = _report(name)
    q.update(
        {
            "check_row_count": _check(V.check_row_count),
            "check_required_columns": _check(V.check_required_columns),
            "check_unique_key": _check(V.check_unique_key),
            "check_null_rates": _check(V.check_null_rates),
            "check_date_logic": _check(V.check_date_logic),
            "check_borough_values": _check(V.check_borough_values),
            "quality_report": _check(V.quality_report),
            "quality_report_untreated": lambda s, d: V.quality_report(K.parse_dates(_raw(s, d))),
            "null_rates_nan": _null_rates_nan,
            "unexpected_boroughs": lambda s, d: V.unexpected_boroughs(_raw(s, d)),
            "date_range_filter": _date_range,
            "page_slice": _page_slice,
            "total_limit": _total_limit,
            "paged_read": _paged_read,
            "read_pages": _read_pages,
            "page_source": _page_source,
            "read_pages_union": _read_pages_union,
            "hive_scan": _hive_scan,
            "nested_scan": _nested_scan,
            "round_trip_parquet": _round_trip_parquet,
            "round_trip_csv": _csv_round_trip(_raw),
            "csv_reordered_header": _csv_round_trip(lambda s, d: _raw(s, d).select(*reversed(RAW_COLUMNS))),
            "csv_multiline": _csv_round_trip(_two_line_descriptors),
            "round_trip_table": _round_trip_table,
            "snapshot_versions": _snapshot_versions,
            "month_range_clean": lambda s, d: read_months(s, _by_month(s, d), *oracle.DATE_RANGE),
            "month_rerun": _month_rerun,
            "monthly_layout_counts": lambda s, d: monthly_counts(s, _by_month(s, d)),
            "reports_csv": _reports_csv,
            "batch_summary": _batch_summary,
            "batch_from_pages": _batch_from_pages,
        }
    )
    return q


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top complaint types: fixture -> clean -> complaint dimension -> fact -> report."""
    return queries()["top_20_complaint_types"](spark, sf_dir)
