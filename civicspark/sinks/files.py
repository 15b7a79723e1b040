"""Sinks: raw files, clean Parquet, catalog tables, star tables, report CSVs."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark.session import delete_path
from civicspark.sources.files import read_star


def save_raw(df: DataFrame, path: str) -> None:
    """Write by extension: ``.parquet`` or ``.csv`` (with header), else ValueError."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    suffix = "." + name.rsplit(".", 1)[-1] if "." in name else ""
    if suffix == ".parquet":
        df.write.mode("overwrite").parquet(path)
    elif suffix == ".csv":
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    else:
        raise ValueError(f"Unsupported file format: '{suffix}'. Use .parquet or .csv")


def save_parquet(df: DataFrame, path: str) -> None:
    """Clean Parquet sink: replace whatever was there (S9). An empty table keeps its schema."""
    df.write.mode("overwrite").parquet(path)


def save_table(df: DataFrame, table_name: str, path: str | None = None) -> None:
    """Create or replace a catalog table (S10); the name must be an identifier.

    With ``path`` the table's files live there (an external table in the
    shared folder); without it the session's warehouse holds them.
    """
    if not table_name.isidentifier():
        raise ValueError(f"Invalid table name: '{table_name}'")
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table_name)


def write_star(
    tables: dict[str, DataFrame | Callable[[], DataFrame]], star_dir: str, concurrent: bool = True
) -> dict[str, int]:
    """One Parquet dataset per star table (S11); returns the rows written per table.

    A table may be given as a DataFrame or as a function building it (whose
    own jobs, e.g. a dimension's key ranking, then run in that table's
    thread). The counts are observed during the writes, so no table is read
    twice. Independent tables are written by concurrent jobs, which share the
    cluster's slots instead of waiting for each other's stragglers.
    """

    def write(name: str) -> int:
        table = tables[name]
        df = table() if callable(table) else table
        seen = Observation(f"rows_{name}_{uuid.uuid4().hex[:8]}")
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(
            f"{star_dir.rstrip('/')}/{name}.parquet"
        )
        return int(seen.get["n"])

    names = list(tables)
    if not concurrent or len(names) < 2:
        return {name: write(name) for name in names}
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        target = inheritable_thread_target(_session(tables))(write)
        return dict(zip(names, pool.map(target, names)))


def _session(tables: dict[str, DataFrame | Callable[[], DataFrame]]) -> SparkSession:
    for t in tables.values():
        if isinstance(t, DataFrame):
            return t.sparkSession
    session = SparkSession.getActiveSession()
    if session is None:
        raise RuntimeError("no active Spark session")
    return session


#: How report CSVs are written: quotes inside a field are doubled, empty texts and nulls are empty fields.
CSV_OPTIONS = {"escape": '"', "emptyValue": "", "nullValue": ""}


def plain_number(x: Column) -> Column:
    """A double as text without an exponent and with one decimal at least, ten at most: ``10000000.0``, ``0.25``.

    Infinities, NaN and numbers of 28 digits or more are left to Spark's own form.
    """
    text = F.rtrim(x.try_cast("decimal(38,10)").cast("string"), F.lit("0"))
    return F.coalesce(F.when(text.endswith("."), F.concat(text, F.lit("0"))).otherwise(text), x.cast("string"))


def csv_line(df: DataFrame, columns: list[Column] | None = None) -> Column:
    """Columns of ``df`` (all of them, or expressions over them) as one CSV line, doubles as :func:`plain_number`."""
    columns = [F.col(f"`{c}`") for c in df.columns] if columns is None else columns
    types = [f.dataType for f in df.select(*columns).schema.fields]
    parts = [plain_number(c) if isinstance(t, (T.DoubleType, T.FloatType)) else c for c, t in zip(columns, types, strict=True)]
    return F.to_csv(F.struct(*[p.alias(f"c{i}") for i, p in enumerate(parts)]), CSV_OPTIONS)


def csv_header(columns: list[str]) -> str:
    """The header line: names with a comma, quote or line end are quoted."""
    quoted = ['"' + c.replace('"', '""') + '"' if any(x in c for x in ',"\n\r') else c for c in columns]
    return ",".join(quoted)


def write_report_csv(df: DataFrame, path: str) -> None:
    """A report as one CSV file with header at ``path``.

    Reports are bounded (top-k, one row per month or borough), so a single
    output partition is safe. Their order is made a column before they meet in
    that partition, and sorted there: gathering partitions promises no order.
    The one file is written beside its place and then renamed onto it.
    """
    lines = df.select(csv_line(df).alias("value"), F.monotonically_increasing_id().alias("_row"))
    write_csv_files(lines.select(F.lit("report").alias("name"), "_row", "value"), {"report": df.columns}, {"report": path})


def write_csv_files(lines: DataFrame, headers: dict[str, list[str]], paths: dict[str, str]) -> None:
    """Bounded tables as single CSV files, all by one job.

    ``lines`` is ``(name, _row, value)``, the CSV lines of each table in the
    order of ``_row``; a table without lines gets its header only. Every file
    appears at once, by a rename within its folder's file system.
    """
    spark = lines.sparkSession
    heads = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(csv_header(c)).alias("value")) for n, c in headers.items()]))
    head = spark.range(1).select(heads.alias("h")).select("h.name", F.lit(-1).cast("bigint").alias("_row"), "h.value")
    every = head.unionByName(lines.select("name", F.col("_row").cast("bigint").alias("_row"), "value"))
    parent, slash, _ = next(iter(paths.values())).rstrip("/").rpartition("/")
    folder = f"{parent if slash else '.'}/.writing-{uuid.uuid4().hex[:12]}"
    every.coalesce(1).sortWithinPartitions("name", "_row").select("name", "value").write.partitionBy("name").text(folder)
    try:
        for name, path in paths.items():
            replace_file(spark, one_part(spark, f"{folder}/name={name}"), path)
    finally:
        delete_path(spark, folder)


def one_part(spark: SparkSession, folder: str) -> str:
    """The only data file that Spark wrote to a folder."""
    parts = spark.read.format("binaryFile").load(folder).inputFiles()
    if len(parts) != 1:
        raise OSError(f"{len(parts)} files instead of one in {folder}")
    return parts[0]


def replace_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file onto ``target``; a file there is replaced in the same step, a folder of earlier versions is removed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    src, dst = (jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs = dst.getFileSystem(conf)
    fs.mkdirs(dst.getParent())
    if fs.exists(dst) and fs.getFileStatus(dst).isDirectory():
        fs.delete(dst, True)
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(src), fs.makeQualified(dst), overwrite)


def star_row_counts(spark: SparkSession, star_dir: str) -> DataFrame:
    """(table_name, n_rows) per star table."""
    tables = read_star(spark, star_dir)
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
