"""The star-schema job (D6): clean dataset -> four dimensions + one fact.

Dimensions are written first and read back, and the fact looks its keys up
in the written files, so the keys in a dimension file and in the fact are the
same by construction. Row counts come from observations on the writes; they
also tell the fact's lookups which dimensions are small enough to broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from civicspark.operators import star as S
from civicspark.schema import FACT_TABLE, RESPONSE_COLUMN, STAR_TABLES
from civicspark.sinks.files import write_star
from civicspark.sources.files import read_dataset

DIMENSIONS = ["dim_agency", "dim_complaint", "dim_location", "dim_date"]


def _require_response(clean: DataFrame) -> None:
    if RESPONSE_COLUMN not in clean.columns:
        raise ValueError(f"star schema needs the column '{RESPONSE_COLUMN}'")


def build_star_schema(spark: SparkSession, clean_dir: str, star_dir: str) -> dict[str, int]:
    """Read the clean dataset, write the star tables, return their row counts.

    The clean table is scanned twice: once for all dimensions, whose distinct
    tuples are numbered together and written side by side, and once for the
    fact, once they are written.
    """
    clean = read_dataset(spark, clean_dir)
    _require_response(clean)
    dims = S.dimensions_in_one_scan(clean)
    counts = write_star(dims, star_dir)
    written = {name: spark.read.schema(dims[name].schema).parquet(f"{star_dir.rstrip('/')}/{name}.parquet") for name in DIMENSIONS}
    fact = S.fact_requests(
        clean, written["dim_agency"], written["dim_complaint"], written["dim_location"], dim_rows=counts
    )
    counts.update(write_star({FACT_TABLE: fact}, star_dir))
    return {t: counts[t] for t in STAR_TABLES}
