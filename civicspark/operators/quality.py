"""Data-quality checks (V1-V7) as result rows, with a strict mode that raises.

Every check yields rows ``(seq, check_name, subject, observed, threshold,
passed)``; ``seq`` is the check's place in the run-all order. In the combined
report every data check shares one aggregate pass: row count, null rates,
date logic, rows outside the borough domain, and the exact distinct key
count behind the duplicate check (planned as a map-side combined group-by on
the key). The schema check reads only the schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark.functions.columns import is_missing
from civicspark.schema import KEY_COLUMN, NULL_THRESHOLDS, REQUIRED_COLUMNS, VALID_BOROUGHS

CHECK_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType(), False),
        T.StructField("check_name", T.StringType(), False),
        T.StructField("subject", T.StringType(), True),
        T.StructField("observed", T.DoubleType(), True),
        T.StructField("threshold", T.DoubleType(), True),
        T.StructField("passed", T.BooleanType(), False),
    ]
)


class ValidationError(Exception):
    """A failed quality check in strict mode."""


def _row(seq: int, name: str, subject: str | None, observed: Column, threshold: float | None, passed: Column) -> Column:
    return F.struct(
        F.lit(seq).cast("bigint").alias("seq"),
        F.lit(name).alias("check_name"),
        F.lit(subject).cast("string").alias("subject"),
        observed.cast("double").alias("observed"),
        F.lit(threshold).cast("double").alias("threshold"),
        passed.alias("passed"),
    )


def _rows(base: DataFrame, structs: list[Column]) -> DataFrame:
    if not structs:
        return base.sparkSession.createDataFrame([], CHECK_SCHEMA)
    return base.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def _empty(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], CHECK_SCHEMA)


# Each aggregate check contributes (aggregate expressions, row structs) so the
# combined report can evaluate all of them in one pass.


def _row_count_parts(min_rows: int) -> tuple[list[Column], list[Column]]:
    n = F.col("_rows")
    return [F.count(F.lit(1)).alias("_rows")], [_row(1, "row_count", None, n, min_rows, n >= F.lit(min_rows))]


def _null_rate_parts(df: DataFrame, thresholds: dict[str, float]) -> tuple[list[Column], list[Column]]:
    aggs, structs = [], []
    for i, (c, limit) in enumerate(thresholds.items()):
        if c not in df.columns:
            continue
        # Null and NaN are missing. No rows -> null rate -> the check passes.
        rate = F.try_divide(F.count_if(is_missing(F.col(c), df.schema[c].dataType)).cast("double"), F.count(F.lit(1)).cast("double"))
        aggs.append(rate.alias(f"_rate{i}"))
        r = F.col(f"_rate{i}")
        structs.append(_row(4, "null_rate", c, r, limit, F.coalesce(~(r > F.lit(limit)), F.lit(True))))
    return aggs, structs


def _date_logic_parts(df: DataFrame) -> tuple[list[Column], list[Column]]:
    if not {"created_date", "closed_date"} <= set(df.columns):
        return [], []
    bad = F.col("_bad_dates")
    return (
        [F.count_if(F.col("closed_date") < F.col("created_date")).alias("_bad_dates")],
        [_row(5, "date_logic", "closed_date", bad, 0.0, bad == F.lit(0))],
    )


def check_row_count(df: DataFrame, min_rows: int = 1) -> DataFrame:
    """V1: at least ``min_rows`` rows."""
    aggs, structs = _row_count_parts(min_rows)
    return _rows(df.agg(*aggs), structs)


def check_required_columns(df: DataFrame, required: list[str] = REQUIRED_COLUMNS) -> DataFrame:
    """V2: one row per required column (read from the schema; no job runs)."""
    present = set(df.columns)
    rows = [(2, "required_column", c, 1.0 if c in present else 0.0, 1.0, c in present) for c in required]
    return df.sparkSession.createDataFrame(rows, CHECK_SCHEMA)


def check_unique_key(df: DataFrame, key: str = KEY_COLUMN) -> DataFrame:
    """V3: no key value occurs twice (null keys count as equal). A missing key column fails."""
    if key not in df.columns:
        return df.sparkSession.createDataFrame([(3, "unique_key", key, None, 0.0, False)], CHECK_SCHEMA)
    aggs, structs = _unique_key_parts(df, key)
    return _rows(df.agg(*aggs), structs)


def check_null_rates(df: DataFrame, thresholds: dict[str, float] = NULL_THRESHOLDS) -> DataFrame:
    """V4: null fraction per listed column at most its limit; absent columns skipped."""
    aggs, structs = _null_rate_parts(df, thresholds)
    return _rows(df.agg(*aggs), structs) if aggs else _empty(df)


def check_date_logic(df: DataFrame) -> DataFrame:
    """V5: no closed_date before created_date (null dates skipped)."""
    aggs, structs = _date_logic_parts(df)
    return _rows(df.agg(*aggs), structs) if aggs else _empty(df)


def unexpected_boroughs(df: DataFrame, allowed: set[str] = VALID_BOROUGHS) -> DataFrame:
    """``(borough, n_rows)`` of every distinct non-null borough outside the allowed set."""
    if "borough" not in df.columns:
        return df.sparkSession.createDataFrame([], "borough string, n_rows bigint")
    bad = df.where(F.col("borough").isNotNull() & ~F.col("borough").isin(sorted(allowed)))
    return bad.groupBy("borough").agg(F.count(F.lit(1)).alias("n_rows"))


def _unique_key_parts(df: DataFrame, key: str) -> tuple[list[Column], list[Column]]:
    """Rows beyond the first per key value (null keys equal) from exact counts.

    rows - distinct non-null keys - (1 if any key is null): the distinct count
    is planned as a group-by on the key with map-side combining, so a hot key
    costs one row per task, and it shares the pass with the other checks.
    """
    if key not in df.columns:
        return [], []
    k = F.col(f"`{key}`")
    aggs = [
        F.count(F.lit(1)).alias("_key_rows"),
        F.count_distinct(k).alias("_key_distinct"),
        F.count_if(k.isNull()).alias("_key_nulls"),
    ]
    d = F.col("_key_rows") - F.col("_key_distinct") - F.when(F.col("_key_nulls") > 0, F.lit(1)).otherwise(F.lit(0))
    return aggs, [_row(3, "unique_key", key, d, 0.0, d == F.lit(0))]


def _borough_parts(df: DataFrame, allowed: set[str]) -> tuple[list[Column], list[Column]]:
    if "borough" not in df.columns:
        return [], []
    b = F.col("borough")
    bad = F.col("_bad_boroughs")
    return (
        [F.count_if(b.isNotNull() & ~b.isin(sorted(allowed))).alias("_bad_boroughs")],
        [_row(6, "borough_values", "borough", bad, 0.0, bad == F.lit(0))],
    )


def check_borough_values(df: DataFrame, allowed: set[str] = VALID_BOROUGHS) -> DataFrame:
    """V6: rows whose non-null borough lies outside the allowed set (must be 0)."""
    aggs, structs = _borough_parts(df, allowed)
    return _rows(df.agg(*aggs), structs) if aggs else _empty(df)


def quality_report(df: DataFrame, min_rows: int = 1) -> DataFrame:
    """V7: every check, in run-all order (seq 1..6), from one aggregate pass."""
    aggs, structs = _row_count_parts(min_rows)
    missing_key = KEY_COLUMN not in df.columns
    for part in (
        _unique_key_parts(df, KEY_COLUMN),
        _null_rate_parts(df, NULL_THRESHOLDS),
        _date_logic_parts(df),
        _borough_parts(df, VALID_BOROUGHS),
    ):
        aggs += part[0]
        structs += part[1]
    out = _rows(df.agg(*aggs), structs).unionByName(check_required_columns(df))
    if missing_key:
        out = out.unionByName(check_unique_key(df))
    return out


#: Unexpected boroughs that an error names.
NAMED_BOROUGHS = 5


def raise_first_failure(report: DataFrame, checked: DataFrame | None = None) -> DataFrame:
    """Strict mode for any check table: raise ``ValidationError`` at its first failure.

    A report has one row per check and listed column, so it is read whole.
    Failed rows of one check are reported together (e.g. every column over
    its null-rate limit in one message). With the ``checked`` rows at hand, an
    error about boroughs names the first few of them.
    """
    rows = sorted(report.collect(), key=lambda r: r["seq"])
    failed = [r for r in rows if not r["passed"]]
    if failed:
        first = failed[0]["seq"]
        group = [r for r in failed if r["seq"] == first]
        values = []
        if checked is not None and group[0]["check_name"] == "borough_values":
            values = [r["borough"] for r in unexpected_boroughs(checked).orderBy("borough").limit(NAMED_BOROUGHS + 1).collect()]
        raise ValidationError(_message(group, values))
    return report


def validate(df: DataFrame, min_rows: int = 1) -> DataFrame:
    """Run all checks in order V1..V6 and raise at the first failure (V7, strict)."""
    return raise_first_failure(quality_report(df, min_rows), df)


# Callers match on the phrases of these messages.
def _message(group: list, values: list[str]) -> str:
    row = group[0]
    name, subject, observed, threshold = row["check_name"], row["subject"], row["observed"], row["threshold"]
    if name == "row_count":
        return f"DataFrame has {int(observed)} rows, expected at least {int(threshold)}."
    if name == "required_column":
        return f"Missing required columns: {[r['subject'] for r in group]}"
    if name == "unique_key":
        if observed is None:
            return f"Key column '{subject}' not found in DataFrame."
        return f"Found {int(observed)} duplicate values in '{subject}'."
    if name == "null_rate":
        items = [f"'{r['subject']}': {r['observed']:.1%} nulls (max {r['threshold']:.1%})" for r in group]
        return f"Null rate violations: {items}"
    if name == "date_logic":
        return f"Found {int(observed)} rows where closed_date is before created_date."
    if name == "borough_values":
        named = f": {sorted(values[:NAMED_BOROUGHS])}" + (" and more" if len(values) > NAMED_BOROUGHS else "") if values else ""
        return f"Unexpected borough values in {int(observed)} rows{named}; unexpected_boroughs() lists them all with their counts"
    return f"Check {name} failed"
