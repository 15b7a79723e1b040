"""The report job (R7): star tables -> six reports -> one CSV file each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.operators.reports import REPORT_NAMES, all_reports, report_lines
from civicspark.sinks.files import csv_line, write_csv_files
from civicspark.sources.files import read_star

#: What the reports read of each star table; with the schema given no job looks for it in the files.
REPORT_INPUTS = {
    "dim_agency": "agency_id bigint, agency string",
    "dim_complaint": "complaint_id bigint, complaint_type string",
    "dim_location": "location_id bigint, borough string",
    "dim_date": "date date",
    "fact_311_requests": "created_date timestamp_ntz, response_time_hours double, agency_id bigint, complaint_id bigint, location_id bigint",
}

_PCTS = ["pct_created_null", "pct_complaint_fk_null", "pct_agency_fk_null", "pct_location_fk_null"]
_COLUMNS = {
    "avg_response_time_by_borough": ["label AS borough", "avg_hours", "n_requests"],
    "top_20_complaint_types": ["label AS complaint_type", "n_requests"],
    "top_agencies_by_volume": ["label AS agency", "n_requests"],
    "monthly_volume_trend": ["year", "month", "n_requests"],
    "slowest_complaints_by_avg_time": ["label AS complaint_type", "avg_hours", "n_requests"],
    "data_quality_null_rates": [f"pcts[{i}] AS {c}" for i, c in enumerate(_PCTS)],
}


def reports_in_one_pass(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The six reports, sorted, as selections of one plan that scans the fact once."""
    lines = report_lines(star)
    return {name: lines.where(F.col("name") == name).orderBy("_row").selectExpr(*_COLUMNS[name]) for name in REPORT_NAMES}


def generate_reports(spark: SparkSession, star_dir: str, reports_dir: str) -> dict[str, DataFrame]:
    """Write the file ``<reports_dir>/<name>.csv`` for every report and return the reports.

    All five star tables must exist (the error lists the missing ones). One
    plan scans the fact once, sums it by every report's key, and one job
    writes the lines of all reports.
    """
    star = read_star(spark, star_dir, REPORT_INPUTS)
    lines = report_lines(star)
    headers = {name: lines.selectExpr(*_COLUMNS[name]).columns for name in REPORT_NAMES}
    value = F.coalesce(*[F.when(F.col("name") == name, _line_of(lines, name)) for name in REPORT_NAMES])
    root = reports_dir.rstrip("/")
    write_csv_files(lines.select("name", "_row", value.alias("value")), headers, {n: f"{root}/{n}.csv" for n in REPORT_NAMES})
    return all_reports(star)


def _line_of(lines: DataFrame, name: str) -> Column:
    return csv_line(lines, [F.expr(e) for e in _COLUMNS[name]])
