"""The cleaning job (L1): raw requests -> typed, repaired, imputed, de-duplicated.

Plan shape, with the raw source scanned once in the common case:

1. P1 and P3 need only the schema; F1..P4 are one lazy, codegen'd projection,
   with NaN read as null.
2. That projection is written once to the scratch folder. Observations on the
   same write collect the number of values of every raw column (P2) and the
   null count of every typed column (G9) -- no separate scans.
3. Raw columns without a value are dropped (P2) by a projection over the
   written files. Only if such a column takes part in typing (its absence
   changes which steps apply) is step 2 redone without it.
4. Medians and modes read the staged files column-pruned.
5. The result is ``stage -> coalesce(fills) -> distinct``, still lazy.
"""

from __future__ import annotations

import logging
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from civicspark.functions.columns import ISO_LAYOUT
from civicspark.operators import cleaning as K
from civicspark.operators.stats import Profile, exact_medians, modes, profile, profile_exprs, read_profile
from civicspark.schema import COORDINATE_PAIRS, DATE_COLUMNS, KEY_COLUMN, RESPONSE_COLUMN
from civicspark.session import scratch_path

log = logging.getLogger(__name__)


@dataclass
class Stage:
    """Typed, key-filtered rows written to the scratch folder, with their profile."""

    df: DataFrame
    profile: Profile | None
    dropped_keys: int = 0


# Columns that the typing steps read: without one of them other steps apply.
_TYPED_INPUTS = {KEY_COLUMN, "borough", *DATE_COLUMNS, *(c for pair in COORDINATE_PAIRS for c in pair)}


def stage_requests(
    df: DataFrame, required_columns: list[str] | None = None, layouts: tuple[str, ...] = (ISO_LAYOUT,), inferred: bool = False
) -> Stage:
    """P1, P2, P3, F1..P4, written once; P2 and the statistics come from observations."""
    spark = df.sparkSession
    df = K.nan_columns_as_null(K.select_required(df, required_columns))
    raw_cols = list(df.columns)
    if not raw_cols:
        return Stage(df, None)
    seen = Observation(f"raw_values_{uuid.uuid4().hex[:8]}")
    observed = df.observe(
        seen, F.count(F.lit(1)).alias("_rows"), *[K.count_values(df, c).alias(f"_v{i}") for i, c in enumerate(raw_cols)]
    )
    named = K.normalize_column_names(observed)
    staged = K.drop_null_keys(K.typed_columns(named, layouts, inferred))
    stats = Observation(f"stage_profile_{uuid.uuid4().hex[:8]}")
    path = scratch_path(spark, "clean-stage")
    staged.observe(stats, *profile_exprs(staged)).write.parquet(path)

    counts = seen.get
    empty = {new: old for i, (old, new) in enumerate(zip(raw_cols, named.columns, strict=True)) if counts[f"_v{i}"] == 0}
    if empty:
        log.info("Dropping columns without values: %s", sorted(empty.values()))
    if empty.keys() & _TYPED_INPUTS:
        return stage_requests(K.select_required(df, [c for c in raw_cols if c not in empty.values()]), None, layouts, inferred)
    prof = read_profile(stats.get, staged.columns)
    dropped = int(counts["_rows"]) - prof.rows
    if dropped:
        log.info("Dropped %d rows with null unique_key", dropped)
    return Stage(spark.read.schema(staged.schema).parquet(path).drop(*empty), prof, dropped)


def impute(stage: DataFrame, prof: Profile | None = None, impute_response_time: bool = True) -> DataFrame:
    """F5-F8 on the staged rows: statistics first (small jobs), then one projection."""
    plan = K.imputation_plan(stage)
    if prof is None:
        prof = profile(stage)
    nulls = prof.nulls
    median_cols = [c for c in plan["median"] if nulls[c] > 0 and (impute_response_time or c != RESPONSE_COLUMN)]
    unknown_cols = [c for c in plan["unknown"] if nulls[c] > 0]
    mode_cols = [c for c in plan["mode"] if nulls[c] > 0]
    # Medians and modes are independent jobs over the staged files: run them side by side.
    # (inheritable targets keep the caller's job group and other local properties)
    with ThreadPoolExecutor(max_workers=2) as pool:
        inherit = inheritable_thread_target(stage.sparkSession)
        medians = pool.submit(inherit(exact_medians), stage, median_cols)
        most_frequent = pool.submit(inherit(modes), stage, mode_cols)
        out = K.impute_median(stage, medians.result())
        out = K.impute_unknown(out, unknown_cols)
        return K.impute_mode(out, most_frequent.result())


def clean_requests(
    df: DataFrame,
    required_columns: list[str] | None = None,
    drop_duplicates: bool = True,
    impute_response_time: bool = True,
    layouts: tuple[str, ...] = (ISO_LAYOUT,),
    inferred: bool = False,
) -> DataFrame:
    """The whole cleaning job in its fixed order: P1, P2, P3, F1, F2+P7, F3, P8, F4, P4, F5-F8, G12.

    ``impute_response_time=False`` leaves open requests without a response
    time instead of giving them the median. ``layouts`` declares the accepted
    timestamp texts (see ``parse_timestamp``); with ``inferred`` each date column
    gets the one of them that parses most of its texts.
    """
    stage = stage_requests(df, required_columns, layouts, inferred)
    if not stage.df.columns:
        return stage.df
    out = impute(stage.df, stage.profile, impute_response_time)
    return K.dedup_rows(out) if drop_duplicates else out
