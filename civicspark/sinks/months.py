"""The clean table laid out by month of creation.

Files lie in ``created_month=yyyy-MM`` folders. A date range becomes a filter
on the folder name beside the one on the time itself, so a range reads its
months only and a monthly total needs no file of other months. Writing with
dynamic overwrite replaces the months that the rows belong to and leaves the
others as they are, so a month can be run again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark.sources.files import is_missing_path

MONTH = "created_month"
#: Folder of rows without a creation time.
NO_MONTH = "none"


def month_of_creation(column: Column) -> Column:
    """``yyyy-MM`` of a zone-less timestamp, or ``none``."""
    return F.coalesce(F.substring(column.cast("string"), 1, 7), F.lit(NO_MONTH))


def save_by_month(df: DataFrame, path: str, column: str = "created_date", rows_per_file: int = 1_000_000) -> None:
    """Write ``df`` by month; months that it has rows of are replaced, others stay.

    Rows are dealt out by month and a share of the month, as many shares as
    its rows are worth, so a crowded month is written by several tasks and a
    small one is one file.
    """
    if MONTH in df.columns:
        raise ValueError(f"the table has a column '{MONTH}' already")
    placed = df.withColumn(MONTH, month_of_creation(F.col(column)))
    counts = placed.groupBy(MONTH).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).cast("int").alias("_shares"))  # one row a month
    share = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.col("_shares"))
    dealt = placed.join(F.broadcast(counts), MONTH).withColumn("_share", share).drop("_shares")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = dealt.repartition(n, MONTH, "_share").drop("_share")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def months_between(start_date: str | None, end_date: str | None) -> Column:
    """The folders that rows created in a date range lie in."""
    cond = F.lit(True)
    if start_date:
        cond = cond & (F.col(MONTH) >= F.lit(dt.date.fromisoformat(start_date).isoformat()[:7])) & (F.col(MONTH) != F.lit(NO_MONTH))
    if end_date:
        cond = cond & (F.col(MONTH) <= F.lit(dt.date.fromisoformat(end_date).isoformat()[:7]))
    return cond


def read_months(
    spark: SparkSession, path: str, start_date: str | None = None, end_date: str | None = None, column: str = "created_date"
) -> DataFrame:
    """Rows of a table by month, created from ``start_date`` 00:00:00 to ``end_date`` 23:59:59 (S2), without the month column.

    Folders outside the range are not listed as files to read. With a bound,
    rows without a creation time drop out.
    """
    try:
        table = spark.read.option("basePath", path).schema(_with_text_month(spark, path)).parquet(path)
    except AnalysisException as e:
        if is_missing_path(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            raise FileNotFoundError(f"Clean data directory not found, or without Parquet files: {path}") from e
        raise
    ts, cond = F.col(column), months_between(start_date, end_date)
    if start_date:
        cond = cond & (ts >= F.lit(f"{start_date} 00:00:00").cast("timestamp_ntz"))
    if end_date:
        cond = cond & (ts <= F.lit(f"{end_date} 23:59:59").cast("timestamp_ntz"))
    return table.where(cond).drop(MONTH)


def _with_text_month(spark: SparkSession, path: str) -> T.StructType:
    """The table's schema with the month as text, whatever its folder names look like."""
    found = spark.read.option("basePath", path).parquet(path).schema
    return T.StructType([T.StructField(f.name, T.StringType() if f.name == MONTH else f.dataType, f.nullable) for f in found.fields])


def monthly_counts(spark: SparkSession, path: str) -> DataFrame:
    """``year, month, n_requests`` (R4) from the layout: no column is read, rows are counted per folder."""
    table = spark.read.option("basePath", path).schema(_with_text_month(spark, path)).parquet(path)
    counted = table.where(F.col(MONTH) != F.lit(NO_MONTH)).groupBy(MONTH).agg(F.count(F.lit(1)).alias("n_requests"))
    year, month = (F.split_part(F.col(MONTH), F.lit("-"), F.lit(k)).cast("bigint") for k in (1, 2))
    return counted.select(year.alias("year"), month.alias("month"), "n_requests").orderBy("year", "month")
