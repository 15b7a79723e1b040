"""Star-schema tables over the clean request table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.functions import columns as C
from civicspark.operators.joins import lookup
from civicspark.operators.ranking import dense_rank_ids, numbered_groups


def _non_empty(c: str):
    return F.col(c).isNotNull() & (F.col(c) != F.lit(""))


def dim_agency(clean: DataFrame) -> DataFrame:
    """Distinct non-empty agencies, keyed by their rank (D1 = P5 + G5 + W1)."""
    distinct = clean.where(_non_empty("agency")).select("agency").distinct()
    return dense_rank_ids(distinct, ["agency"], "agency_id")


def dim_complaint(clean: DataFrame) -> DataFrame:
    """Distinct (complaint_type, descriptor) with a non-empty type (D2 = P5 + G5 + W2)."""
    distinct = clean.where(_non_empty("complaint_type")).select("complaint_type", "descriptor").distinct()
    return dense_rank_ids(distinct, ["complaint_type", "descriptor"], "complaint_id")


LOCATION_COLUMNS = ["borough", "incident_zip", "latitude", "longitude"]


def dim_location(clean: DataFrame) -> DataFrame:
    """Distinct location tuples, nulls kept and ranked last (D3 = G5 + W3)."""
    distinct = clean.select(*LOCATION_COLUMNS).distinct()
    return dense_rank_ids(distinct, LOCATION_COLUMNS, "location_id")


def dim_date(clean: DataFrame) -> DataFrame:
    """Distinct calendar parts of the creation dates (D4 = P5 + F9-F11 + G5)."""
    ts = F.col("created_date")
    return (
        clean.where(ts.isNotNull())
        .select(
            C.calendar_date(ts).alias("date"),
            C.year_of(ts).alias("year"),
            C.month_of(ts).alias("month"),
            C.day_of(ts).alias("day"),
            C.weekday_sunday0(ts).alias("day_of_week"),
        )
        .distinct()
    )


def dimensions_in_one_scan(clean: DataFrame) -> dict[str, DataFrame]:
    """All four dimensions (D1-D4) from one scan, one distinct and one numbering.

    Every row gives one tuple per dimension that takes it, tagged with the
    dimension's number; equal tuples meet in one partial and final aggregate,
    and one range numbering ordered by (dimension, tuple) ranks each dimension's
    tuples, nulls last. Rows and keys are those of :func:`dim_agency`,
    :func:`dim_complaint`, :func:`dim_location` and :func:`dim_date`.
    """
    fields = {"agency": "agency", "complaint_type": "complaint_type", "descriptor": "descriptor"} | {c: c for c in LOCATION_COLUMNS}
    types = {f.name: f.dataType for f in clean.schema.fields}
    date = C.calendar_date(F.col("created_date"))

    def tuple_of(table: int, columns: list[str], with_date: bool = False) -> F.Column:
        parts = [F.lit(table).alias("table")]
        parts += [(F.col(c) if c in columns else F.lit(None).cast(types[c])).alias(c) for c in fields]
        parts.append((date if with_date else F.lit(None).cast("date")).alias("date"))
        return F.struct(*parts)

    tuples = F.array(
        F.when(_non_empty("agency"), tuple_of(0, ["agency"])),
        F.when(_non_empty("complaint_type"), tuple_of(1, ["complaint_type", "descriptor"])),
        tuple_of(2, LOCATION_COLUMNS),
        F.when(F.col("created_date").isNotNull(), tuple_of(3, [], with_date=True)),
    )
    tagged = clean.select(F.explode(tuples).alias("t")).where(F.col("t").isNotNull()).select("t.*").distinct()
    order = [F.col(c).asc_nulls_last() for c in [*fields, "date"]]
    found = numbered_groups(tagged, "table", order, "_id")
    ids = {"dim_agency": ("agency_id", ["agency"]), "dim_complaint": ("complaint_id", ["complaint_type", "descriptor"]), "dim_location": ("location_id", LOCATION_COLUMNS)}
    nothing = tagged.where("false").select(F.lit(0).cast("bigint").alias("_id"), *fields, "date")
    out = {}
    for table, (name, (key, columns)) in enumerate(ids.items()):
        out[name] = found.get(table, nothing).select(F.col("_id").alias(key), *columns)
    d = F.col("date").cast("timestamp_ntz")
    out["dim_date"] = found.get(3, nothing).select(
        "date", C.year_of(d).alias("year"), C.month_of(d).alias("month"), C.day_of(d).alias("day"), C.weekday_sunday0(d).alias("day_of_week")
    )
    return out


FACT_COLUMNS = [
    "unique_key",
    "created_date",
    "closed_date",
    "response_time_hours",
    "agency_id",
    "complaint_id",
    "location_id",
]


def fact_requests(
    clean: DataFrame,
    agency: DataFrame,
    complaint: DataFrame,
    location: DataFrame,
    dim_rows: dict[str, int] | None = None,
) -> DataFrame:
    """One fact row per clean row with its three surrogate keys (D5 = J1 + J2 + J3).

    The agency and complaint keys match with plain ``=``, so an empty agency
    or a null descriptor finds no key. The location matches borough and zip
    with ``=`` and the coordinates with IS NOT DISTINCT FROM. ``dim_rows``
    (table name -> rows) lets the lookups decide on broadcasting without
    counting again.
    """
    rows = dim_rows or {}
    base = clean.select(
        "unique_key", "created_date", "closed_date", "response_time_hours",
        "agency", "complaint_type", "descriptor", *LOCATION_COLUMNS,
    )
    with_agency = lookup(base, agency, ["agency"], [], ["agency_id"], dim_rows=rows.get("dim_agency"))
    with_complaint = lookup(
        with_agency, complaint, ["complaint_type", "descriptor"], [], ["complaint_id"],
        dim_rows=rows.get("dim_complaint"),
    )
    with_location = lookup(
        with_complaint, location, ["borough", "incident_zip"], ["latitude", "longitude"], ["location_id"],
        dim_rows=rows.get("dim_location"), keys_from=clean,
    )
    return with_location.select(*FACT_COLUMNS)
