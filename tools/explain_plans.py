"""Write the physical plans of the main stages to docs/PLANS.md.

Usage: python tools/explain_plans.py [sf_dir]
Each stage's plan tree is followed by its scans' ReadSchema and PushedFilters.
The last section repeats the fact lookup and one report with every
large-data path forced (no broadcast joins, hot-key split).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n")
    scans = []
    for block in re.split(r"\n\s*\n", details):
        lines = block.strip().splitlines()
        if lines and "Scan parquet" in lines[0]:
            keep = [lines[0]] + [ln for ln in lines[1:] if ln.startswith(("PartitionFilters", "PushedFilters", "ReadSchema"))]
            scans.append("\n".join(keep))
    text = tree.strip() + ("\n\n" + "\n".join(scans) if scans else "")
    return re.sub(r"#\d+L?", "", text)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from civicspark.operators import cleaning as K
    from civicspark.operators import star as S
    from civicspark.operators.joins import lookup
    from civicspark.operators.quality import quality_report
    from civicspark.operators.colocated import Colocated, colocated_lookup, save_colocated
    from civicspark.operators.reports import all_reports, report_lines
    from civicspark.operators.stats import median_table
    from civicspark.sinks.months import monthly_counts, read_months, save_by_month
    from civicspark.sources.paging import reach
    from civicspark.plans.clean import impute, stage_requests
    from civicspark.plans.star import build_star_schema
    from civicspark.schema import RAW_COLUMNS
    from civicspark.session import build_session, scratch_path
    from civicspark.sinks.files import save_parquet
    from civicspark.sources.files import read_star
    from civicspark.sources.fixture import requests_raw

    spark = build_session()
    raw = requests_raw(spark, sf_dir)
    stage = stage_requests(raw, RAW_COLUMNS)
    clean_path = scratch_path(spark, "plans-clean")
    save_parquet(K.dedup_rows(impute(stage.df, stage.profile)), clean_path)
    clean = spark.read.parquet(clean_path)
    star_dir = scratch_path(spark, "plans-star")
    build_star_schema(spark, clean_path, star_dir)
    star = read_star(spark, star_dir)
    reports = all_reports(star)

    rendered: list[tuple[str, str]] = []

    def add(title: str, df) -> None:
        rendered.append((title, _plan(df)))

    add("requests_raw (fixture from the driver tables)", raw)
    add("clean stage: typed projection F1..P4 (written once, observed)", K.drop_null_keys(K.typed_columns(raw)))
    add("clean: imputation + de-duplication over the staged files", K.dedup_rows(impute(stage.df, stage.profile)))
    add("quality_report (V1-V6 in one aggregate pass)", quality_report(clean))
    raw_path = scratch_path(spark, "plans-raw")
    save_parquet(raw, raw_path)
    landed = spark.read.parquet(raw_path)
    add("page_slice: the rows in reach of ranks 2001 to 3000, the bound pushed into the scan", landed.where(reach(landed, 2000, 3000).condition))
    add("column medians: values read for the middle parts only (dynamic partition pruning)", median_table(clean, ["latitude", "response_time_hours"]))
    by_month = scratch_path(spark, "plans-months")
    save_by_month(clean, by_month)
    add("clean table by month: a date range as partition filters", read_months(spark, by_month, "1996-02-10", "1996-04-05"))
    add("monthly totals from the layout", monthly_counts(spark, by_month))
    add("dim_agency of the dimensions built in one scan (numbered table, offsets as literals)", S.dimensions_in_one_scan(clean)["dim_agency"])
    add("fact lookups (dimension sizes known from their writes)",
        S.fact_requests(clean, star["dim_agency"], star["dim_complaint"], star["dim_location"],
                        dim_rows={"dim_agency": 6, "dim_complaint": 182, "dim_location": 2638}))
    add("all six reports in one pass over the fact", report_lines(star))
    for name, df in reports.items():
        add(f"report {name}", df)

    for k, v in {"spark.sql.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}.items():
        spark.conf.set(k, v)
    add("forced: location lookup with hot-key split, no broadcast of the dimension",
        lookup(clean, star["dim_location"], ["borough", "incident_zip"], ["latitude", "longitude"],
               ["location_id"], broadcast_rows=0, hot_slots=20))
    add("forced: report avg_response_time_by_borough without broadcast", all_reports(star)["avg_response_time_by_borough"])

    keys = (("borough", "incident_zip"), ("latitude", "longitude"))
    fact = save_colocated(clean, "plans_clean_by_location", scratch_path(spark, "plans-bucketed"), *keys, buckets=8)
    dim = save_colocated(star["dim_location"], "plans_locations", scratch_path(spark, "plans-bucketed"), *keys, buckets=8, unique=True)
    cold = Colocated(fact.name, None, fact.eq_keys, fact.nullsafe_keys, fact.buckets)
    add("co-located location lookup (cold keys): no exchange on either side", colocated_lookup(spark, cold, dim, ["location_id"]))

    out = ["# Physical plans", "",
           f"Generated by `tools/explain_plans.py` on `{sf_dir}` (local[8], 8 shuffle partitions, AQE on;",
           "plans are shown before adaptive re-planning). Expression ids are stripped.", ""]
    for title, plan in rendered:
        out += [f"## {title}", "", "```", plan, "```", ""]
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
