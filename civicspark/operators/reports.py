"""Report queries over the star schema.

Reports that group the fact by a dimension attribute first aggregate the fact
by its surrogate key (partial + final hash aggregate: one row per key and map
task crosses the shuffle), then join those per-key totals to the dimension.
The join therefore sees one row per key on each side -- a key that holds a
third of all facts costs one row, and a dimension too big to broadcast is
joined without skew. Sums of counts are exact; averages are recombined from
per-key sums and counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicspark.functions import columns as C
from civicspark.schema import (
    MIN_REQUESTS_FOR_SLOWEST,
    TOP_AGENCIES,
    TOP_COMPLAINT_TYPES,
    TOP_SLOWEST,
)


def _valid_hours() -> F.Column:
    h = F.col("response_time_hours")
    return h.isNotNull() & (h >= F.lit(0.0))


def _per_key(fact: DataFrame, key: str, with_hours: bool) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("_n")]
    if with_hours:
        aggs.append(F.sum("response_time_hours").alias("_sum"))
    return fact.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def avg_response_time_by_borough(fact: DataFrame, location: DataFrame) -> DataFrame:
    """Borough, avg_hours, n_requests; valid response times, known borough."""
    per_loc = _per_key(fact.where(_valid_hours()), "location_id", True)
    return (
        per_loc.join(location.where(F.col("borough").isNotNull()).select("location_id", "borough"), "location_id")
        .groupBy("borough")
        .agg((F.sum("_sum") / F.sum("_n")).alias("_avg"), F.sum("_n").cast("bigint").alias("n_requests"))
        .select("borough", C.round2(F.col("_avg")).alias("avg_hours"), "n_requests")
        .orderBy(F.desc_nulls_last("avg_hours"), F.asc("borough"))
    )


def top_complaint_types(fact: DataFrame, complaint: DataFrame, k: int = TOP_COMPLAINT_TYPES) -> DataFrame:
    """R2: complaint_type, n_requests; the k most frequent types."""
    per_key = _per_key(fact, "complaint_id", False)
    return (
        per_key.join(complaint.select("complaint_id", "complaint_type"), "complaint_id")
        .groupBy("complaint_type")
        .agg(F.sum("_n").cast("bigint").alias("n_requests"))
        .orderBy(F.desc("n_requests"), F.asc_nulls_last("complaint_type"))
        .limit(k)
    )


def top_agencies_by_volume(fact: DataFrame, agency: DataFrame, k: int = TOP_AGENCIES) -> DataFrame:
    """Agency, n_requests; the k busiest agencies."""
    per_key = _per_key(fact, "agency_id", False)
    return (
        per_key.join(agency.select("agency_id", "agency"), "agency_id")
        .groupBy("agency")
        .agg(F.sum("_n").cast("bigint").alias("n_requests"))
        .orderBy(F.desc("n_requests"), F.asc_nulls_last("agency"))
        .limit(k)
    )


def monthly_volume_trend(fact: DataFrame) -> DataFrame:
    """Year, month, n_requests over requests with a creation time."""
    ts = F.col("created_date")
    return (
        fact.where(ts.isNotNull())
        .groupBy(C.year_of(ts).alias("year"), C.month_of(ts).alias("month"))
        .agg(F.count(F.lit(1)).alias("n_requests"))
        .orderBy("year", "month")
    )


def slowest_complaints_by_avg_time(
    fact: DataFrame,
    complaint: DataFrame,
    k: int = TOP_SLOWEST,
    min_requests: int = MIN_REQUESTS_FOR_SLOWEST,
) -> DataFrame:
    """complaint_type, avg_hours, n_requests; types with >= min_requests, slowest k."""
    per_key = _per_key(fact.where(_valid_hours()), "complaint_id", True)
    return (
        per_key.join(complaint.select("complaint_id", "complaint_type"), "complaint_id")
        .groupBy("complaint_type")
        .agg((F.sum("_sum") / F.sum("_n")).alias("_avg"), F.sum("_n").cast("bigint").alias("n_requests"))
        .where(F.col("n_requests") >= F.lit(min_requests))
        .select("complaint_type", C.round2(F.col("_avg")).alias("avg_hours"), "n_requests")
        .orderBy(F.desc_nulls_last("avg_hours"), F.asc_nulls_last("complaint_type"))
        .limit(k)
    )


def data_quality_null_rates(fact: DataFrame) -> DataFrame:
    """Percentage of facts without a creation time or without each key."""
    return fact.agg(
        C.pct_null(F.col("created_date")).alias("pct_created_null"),
        C.pct_null(F.col("complaint_id")).alias("pct_complaint_fk_null"),
        C.pct_null(F.col("agency_id")).alias("pct_agency_fk_null"),
        C.pct_null(F.col("location_id")).alias("pct_location_fk_null"),
    )


# --------------------------------------------------------------------------
# All reports from one pass over the fact.
# --------------------------------------------------------------------------

_LOCATION, _COMPLAINT, _AGENCY, _MONTH, _ALL = range(5)


def fact_sums(fact: DataFrame) -> DataFrame:
    """``(kind, id, year, month, n, n_valid, hours, ...)``: the fact summed by each report's key in one pass.

    GROUPING SETS over location, complaint, agency, month and nothing: one
    scan, one partial aggregate per task, and one row per key and task crosses
    the shuffle.
    """
    ts, hours = F.col("created_date"), F.col("response_time_hours")
    rows = fact.select("location_id", "complaint_id", "agency_id", C.year_of(ts).alias("year"), C.month_of(ts).alias("month"), hours.alias("hours"))
    keys = ["location_id", "complaint_id", "agency_id", "year", "month"]
    sets = [[F.col("location_id")], [F.col("complaint_id")], [F.col("agency_id")], [F.col("year"), F.col("month")], []]
    valid = F.col("hours") >= 0.0
    found = rows.groupingSets(sets, *[F.col(k) for k in keys]).agg(
        F.grouping_id(*keys).alias("set"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(valid).alias("n_valid"),
        F.sum(F.when(valid, F.col("hours"))).alias("hours"),
        *[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in ("year", "complaint_id", "agency_id", "location_id")],
    )
    # grouping_id has a bit for every key that a set leaves out, the first key's highest.
    kind = F.when(F.col("set") == 0b01111, _LOCATION).when(F.col("set") == 0b10111, _COMPLAINT).when(F.col("set") == 0b11011, _AGENCY)
    kind = kind.when(F.col("set") == 0b11100, _MONTH).otherwise(_ALL)
    return found.select(kind.alias("kind"), F.coalesce("location_id", "complaint_id", "agency_id").alias("id"), "*").drop("set", "location_id", "complaint_id", "agency_id")


def _labels(star: dict[str, DataFrame]) -> DataFrame:
    """``(kind, id, label, found)`` of the three dimensions that reports group by."""
    parts = [("dim_location", "location_id", "borough", _LOCATION), ("dim_complaint", "complaint_id", "complaint_type", _COMPLAINT), ("dim_agency", "agency_id", "agency", _AGENCY)]
    tables = [star[t].select(F.lit(k).alias("kind"), F.col(i).alias("id"), F.col(c).alias("label"), F.lit(True).alias("found")) for t, i, c, k in parts]
    return reduce(DataFrame.unionByName, tables)


def report_lines(star: dict[str, DataFrame]) -> DataFrame:
    """``(name, _row, label, year, month, n_requests, avg_hours, pcts)``: the rows of all six reports in their order."""
    sums = fact_sums(star["fact_311_requests"])
    nothing_yet = {c: F.lit(_ALL if c == "kind" else 0) if c in ("kind", "n", "n_valid") or c.startswith("null_") else F.lit(None) for c in sums.columns}
    zero = sums.sparkSession.range(1).select(*[v.cast(sums.schema[c].dataType).alias(c) for c, v in nothing_yet.items()])
    sums = sums.unionByName(zero)  # without facts the totals are a row all the same
    keyed = sums.join(_labels(star), ["kind", "id"], "left")
    known = (F.col("kind") >= _MONTH) | (F.col("found").isNotNull() & ((F.col("kind") != _LOCATION) | F.col("label").isNotNull()))
    by_label = (
        keyed.where(known)
        .groupBy("kind", "label", "year", "month")
        .agg(*[F.sum(c).alias(c) for c in ("n", "n_valid", "hours", "null_year", "null_complaint_id", "null_agency_id", "null_location_id")])
    )

    def pct(column: str) -> F.Column:
        return C.round2(F.try_divide(F.lit(100.0) * F.col(column), F.col("n")))

    hours = C.round2(F.col("hours") / F.col("n_valid"))
    pcts = F.array(*[pct(f"null_{c}") for c in ("year", "complaint_id", "agency_id", "location_id")])
    nothing = F.lit(None).cast("double")

    def line(name: str, n: str, avg: F.Column = nothing, shares: F.Column | None = None) -> F.Column:
        shares = F.lit(None).cast("array<double>") if shares is None else shares
        return F.struct(F.lit(name).alias("name"), F.col(n).cast("bigint").alias("n_requests"), avg.alias("avg_hours"), shares.alias("pcts"))

    kind = F.col("kind")
    names = F.array_compact(
        F.array(
            F.when((kind == _LOCATION) & (F.col("n_valid") > 0), line("avg_response_time_by_borough", "n_valid", hours)),
            F.when(kind == _COMPLAINT, line("top_20_complaint_types", "n")),
            F.when(kind == _AGENCY, line("top_agencies_by_volume", "n")),
            F.when((kind == _MONTH) & F.col("year").isNotNull(), line("monthly_volume_trend", "n")),
            F.when((kind == _COMPLAINT) & (F.col("n_valid") >= MIN_REQUESTS_FOR_SLOWEST), line("slowest_complaints_by_avg_time", "n_valid", hours)),
            F.when(kind == _ALL, line("data_quality_null_rates", "n", shares=pcts)),
        )
    )
    rows = by_label.select("label", "year", "month", F.explode(names).alias("r")).select("r.name", "label", "year", "month", "r.n_requests", "r.avg_hours", "r.pcts")
    limits = {"top_20_complaint_types": TOP_COMPLAINT_TYPES, "top_agencies_by_volume": TOP_AGENCIES, "slowest_complaints_by_avg_time": TOP_SLOWEST}
    # Slowest or busiest first, then by name.
    by_hours = F.when(F.col("name").isin("avg_response_time_by_borough", "slowest_complaints_by_avg_time"), F.col("avg_hours"))
    by_count = F.when(F.col("name").isin("top_20_complaint_types", "top_agencies_by_volume"), F.col("n_requests"))
    order = [by_hours.desc_nulls_last(), by_count.desc_nulls_last(), F.col("year").asc(), F.col("month").asc(), F.col("label").asc_nulls_last()]
    place = F.row_number().over(Window.partitionBy("name").orderBy(*order))
    is_top, allowed = F.col("name").isin(*limits), F.element_at(F.create_map(*[F.lit(x) for kv in limits.items() for x in kv]), F.col("name"))
    # Of a top list, the bound on the place lets every task keep its first rows only; the others have a row per borough or month.
    top = rows.where(is_top).withColumn("_row", place).where(F.col("_row") <= max(limits.values())).where(F.col("_row") <= allowed)
    return top.unionByName(rows.where(~is_top).withColumn("_row", place))


REPORT_NAMES = [
    "avg_response_time_by_borough",
    "top_20_complaint_types",
    "top_agencies_by_volume",
    "monthly_volume_trend",
    "slowest_complaints_by_avg_time",
    "data_quality_null_rates",
]


def all_reports(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The six reports as lazy DataFrames, keyed by report name."""
    fact = star["fact_311_requests"]
    return {
        "avg_response_time_by_borough": avg_response_time_by_borough(fact, star["dim_location"]),
        "top_20_complaint_types": top_complaint_types(fact, star["dim_complaint"]),
        "top_agencies_by_volume": top_agencies_by_volume(fact, star["dim_agency"]),
        "monthly_volume_trend": monthly_volume_trend(fact),
        "slowest_complaints_by_avg_time": slowest_complaints_by_avg_time(fact, star["dim_complaint"]),
        "data_quality_null_rates": data_quality_null_rates(fact),
    }
