"""Cleaning operators (one DataFrame -> DataFrame step each).

Every step looks at ``df.schema`` when the plan is built, so a column that is
absent costs nothing and no job runs for the check. Only two steps need data
first: dropping columns without values (one aggregate) and imputation (a
statistics row computed by :mod:`civicspark.operators.stats`).
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark.functions import columns as C
from civicspark.schema import (
    CATEGORICAL_UNKNOWN_COLUMNS,
    COORDINATE_PAIRS,
    DATE_COLUMNS,
    KEY_COLUMN,
    LATITUDE_RANGE,
    LONGITUDE_RANGE,
    RESPONSE_COLUMN,
    UNKNOWN,
)

log = logging.getLogger(__name__)

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_FLOATS = (T.FloatType, T.DoubleType)
_TEMPORAL = (T.TimestampType, T.TimestampNTZType, T.DateType)


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def select_required(df: DataFrame, required: list[str] | None) -> DataFrame:
    """Keep the listed columns in list order, skipping absent ones."""
    if required is None:
        return df
    present = set(df.columns)
    return df.select(*[F.col(f"`{c}`") for c in required if c in present])


def nan_columns_as_null(df: DataFrame) -> DataFrame:
    """Null for NaN in every floating column: a missing number has one form from here on."""
    floats = {f.name: C.nan_as_null(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields if isinstance(f.dataType, _FLOATS)}
    return df.withColumns(floats) if floats else df


def count_values(df: DataFrame, name: str) -> Column:
    """Number of rows with a value (neither null nor NaN) in a column."""
    return F.count(C.nan_as_null(F.col(f"`{name}`"), df.schema[name].dataType))


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns without a single value (P2); NaN is none.

    One global aggregate of counts (combinable, so each task sends one row).
    A table with no rows loses every column.
    """
    if not df.columns:
        return df
    counts = df.agg(*[count_values(df, c).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    keep = [c for i, c in enumerate(df.columns) if counts[f"c{i}"] > 0]
    return df.select(*[F.col(f"`{c}`") for c in keep])


def normalize_column_names(df: DataFrame) -> DataFrame:
    """strip, lower-case, spaces -> underscores (P3). Colliding names are rejected."""
    new = [c.strip().lower().replace(" ", "_") for c in df.columns]
    if len(set(new)) != len(new):
        raise ValueError(f"column names collide after normalisation: {new}")
    return df.toDF(*new)


def parse_dates(df: DataFrame, layouts: tuple[str, ...] = (C.ISO_LAYOUT,)) -> DataFrame:
    """created_date / closed_date text -> timestamp_ntz by the declared layouts, bad -> null (F1)."""
    out = df
    for c in DATE_COLUMNS:
        if c in df.columns:
            out = out.withColumn(c, C.parse_timestamp(F.col(c), df.schema[c].dataType, layouts))
    return out


def infer_layouts(df: DataFrame, candidates: tuple[str, ...], columns: list[str] | None = None) -> dict[str, str]:
    """For each date column the layout that parses most of its texts, ties by declared order (F1).

    One combinable aggregate over the date columns alone: a count per column
    and candidate. Columns that are typed already, and those of which no
    candidate parses a value, are left out.
    """
    if not candidates:
        raise ValueError("no layouts to choose from")
    names = [c for c in (columns or DATE_COLUMNS) if c in df.columns and not isinstance(df.schema[c].dataType, _TEMPORAL)]
    if not names:
        return {}
    votes = [F.count(C.parse_timestamp(F.col(c), layouts=(layout,))).alias(f"v{i}_{j}") for i, c in enumerate(names) for j, layout in enumerate(candidates)]
    counted = df.select(*names).agg(*votes).first()
    best = {c: max(range(len(candidates)), key=lambda j: (counted[f"v{i}_{j}"], -j)) for i, c in enumerate(names)}
    return {c: candidates[best[c]] for i, c in enumerate(names) if counted[f"v{i}_{best[c]}"] > 0}


def parse_dates_inferred(df: DataFrame, candidates: tuple[str, ...] = C.KNOWN_LAYOUTS) -> DataFrame:
    """created_date / closed_date by the layout that fits each column best; texts of another layout become null (F1)."""
    chosen = infer_layouts(df, candidates)
    out = df
    for c in DATE_COLUMNS:
        if c in df.columns:
            out = out.withColumn(c, C.parse_timestamp(F.col(c), df.schema[c].dataType, (chosen.get(c, candidates[0]),)))
    return out


def parse_coordinates(df: DataFrame) -> DataFrame:
    """Parse each complete coordinate pair to double and null out-of-range values (F2 + P7)."""
    out = df
    for lat, lon in COORDINATE_PAIRS:
        if lat in df.columns and lon in df.columns:
            # Two projections: the range check reads the parsed value three
            # times, and Catalyst keeps an expensive parse from being inlined
            # into each reference when it stays in its own projection.
            out = out.withColumns({c: C.parse_number(F.col(c), df.schema[c].dataType) for c in (lat, lon)})
            out = out.withColumns(
                {lat: C.within(F.col(lat), *LATITUDE_RANGE), lon: C.within(F.col(lon), *LONGITUDE_RANGE)}
            )
    return out


def standardize_borough(df: DataFrame) -> DataFrame:
    """Map borough spellings to the standard names, unknown -> 'UNKNOWN' (F3)."""
    if "borough" not in df.columns:
        return df
    return df.withColumn("borough", C.standard_borough(F.col("borough")))


def repair_dates(df: DataFrame) -> DataFrame:
    """closed_date before created_date -> null closed_date."""
    if not all(c in df.columns for c in DATE_COLUMNS):
        return df
    return df.withColumn("closed_date", C.repaired_closed(F.col("created_date"), F.col("closed_date")))


def add_response_time(df: DataFrame) -> DataFrame:
    """response_time_hours = closed - created, in hours."""
    if not all(c in df.columns for c in DATE_COLUMNS):
        return df
    return df.withColumn(RESPONSE_COLUMN, C.hours_between(F.col("created_date"), F.col("closed_date")))


def drop_null_keys(df: DataFrame) -> DataFrame:
    """Drop rows without a key."""
    if KEY_COLUMN not in df.columns:
        return df
    return df.where(F.col(KEY_COLUMN).isNotNull())


def typed_columns(df: DataFrame, layouts: tuple[str, ...] = (C.ISO_LAYOUT,), inferred: bool = False) -> DataFrame:
    """Steps F1, F2+P7, F3, P8, F4 in their fixed order: one lazy projection.

    With ``inferred`` one of the layouts is chosen for each date column first (a count over these columns).
    """
    df = parse_dates_inferred(df, layouts) if inferred else parse_dates(df, layouts)
    df = parse_coordinates(df)
    df = standardize_borough(df)
    df = repair_dates(df)
    return add_response_time(df)


# --------------------------------------------------------------------------
# Imputation (F5-F8). The statistics come from ``operators.stats.profile``.
# --------------------------------------------------------------------------


def imputation_plan(df: DataFrame) -> dict[str, list[str]]:
    """Which rule applies to which column, by its type (nothing runs)."""
    plan = {"median": [], "unknown": [], "mode": [], "keep": []}
    for name, dtype in _types(df).items():
        if isinstance(dtype, _TEMPORAL):
            plan["keep"].append(name)  # F8: a missing date stays missing
        elif isinstance(dtype, _NUMERIC):
            plan["median"].append(name)
        elif name in CATEGORICAL_UNKNOWN_COLUMNS:
            plan["unknown"].append(name)
        else:
            plan["mode"].append(name)
    return plan


def impute_median(df: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    """Fill missing numbers (null or NaN) with the column median (F5). A column with no values stays null."""
    fills = {}
    types = _types(df)
    for c, m in medians.items():
        if m is None or c not in types:
            continue
        dtype = types[c]
        if isinstance(dtype, (T.DoubleType, T.FloatType)) or float(m).is_integer():
            fills[c] = F.coalesce(C.nan_as_null(F.col(f"`{c}`"), dtype), F.lit(m).cast(dtype))
        else:
            # A fractional median turns an integral column into a double one.
            fills[c] = F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float(m)))
    return df.withColumns(fills) if fills else df


def impute_unknown(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill the named categorical columns with 'UNKNOWN' (F6)."""
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return df
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(UNKNOWN)) for c in cols})


def impute_mode(df: DataFrame, modes: dict[str, object]) -> DataFrame:
    """Fill other columns with their most frequent value (F7); no value -> unchanged."""
    types = _types(df)
    fills = {
        c: F.coalesce(F.col(f"`{c}`"), F.lit(v).cast(types[c]))
        for c, v in modes.items()
        if v is not None and c in types
    }
    return df.withColumns(fills) if fills else df


def dedup_rows(df: DataFrame) -> DataFrame:
    """Full-row de-duplication, nulls equal.

    Planned as partial + final hash aggregate, so repeated rows collapse on the
    map side before the shuffle even when one row repeats a third of the data.
    """
    return df.dropDuplicates()
