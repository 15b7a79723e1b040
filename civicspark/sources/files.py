"""File sources: landed JSON pages, single files, partitioned datasets, star tables."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark.schema import RAW_SCHEMA, STAR_TABLES


def is_missing_path(e: AnalysisException) -> bool:
    """Whether an error says that a path does not exist."""
    cond = (e.getCondition() or "") if hasattr(e, "getCondition") else ""
    return cond == "PATH_NOT_FOUND" or "Path does not exist" in str(e)


def read_pages(
    spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA, multi_line: bool = False
) -> DataFrame:
    """Landed API pages -> one table (S1 + S6).

    Each file (or line) holds a JSON array of records or one record per line;
    a record may lack keys, which come back as null. The explicit schema means
    no inference pass and a stable column set.
    """
    try:
        return spark.read.schema(schema).option("multiLine", multi_line).json(path)
    except AnalysisException as e:
        if is_missing_path(e):
            raise FileNotFoundError(f"File not found: {path}") from e
        raise


def load_file(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """Read a ``.parquet`` or ``.csv`` file/directory.

    CSV columns are found by the header's names, whatever their order, and stay
    text unless a schema is given (no type inference: a zip code keeps its
    leading zeros). With a schema the result has its columns, in its order;
    those the header lacks are null. Files of one directory must agree in their
    header (otherwise reading fails). ``multi_line`` reads quoted line ends, as
    the sinks of this package write them. A missing path raises
    FileNotFoundError, any other extension ValueError.
    """
    suffix = "." + path.rstrip("/").rsplit(".", 1)[-1] if "." in path.rsplit("/", 1)[-1] else ""
    if suffix not in (".parquet", ".csv"):
        raise ValueError(f"Unsupported file format: '{suffix}'. Use .parquet or .csv")
    try:
        if suffix == ".parquet":
            return spark.read.parquet(path)
        reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
        plain = reader.csv(path)
        if schema is None:
            return plain
        wanted = {f.name: f for f in schema.fields}
        found = T.StructType([wanted.get(c, T.StructField(c, T.StringType())) for c in plain.columns])
        typed = reader.option("enforceSchema", False).schema(found).csv(path)
        present = set(plain.columns)
        return typed.select(
            *[F.col(f"`{f.name}`") if f.name in present else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        )
    except AnalysisException as e:
        if is_missing_path(e):
            raise FileNotFoundError(f"File not found: {path}") from e
        raise


def _partition_keys(file: str, root: str) -> tuple[str, ...]:
    """Names of the ``k=v`` folders between ``root`` and a file."""
    inner = file[file.index(root) + len(root) :] if root in file else file
    return tuple(part.partition("=")[0] for part in inner.split("/")[:-1] if "=" in part)


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Every Parquet file below ``path`` as one table (S8), at any depth; other files are passed over.

    ``k=v`` folders become columns (and prune on predicates). Files of several
    layouts, say some at the root and some below hive folders, are read layout
    by layout and put together by column name; columns a layout lacks are null.
    A column with different types in two layouts is an error.
    """
    every = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    try:
        files = [unquote(f) for f in every.load(path).inputFiles()]  # a listing: no file is opened
    except AnalysisException as e:
        if is_missing_path(e):
            raise FileNotFoundError(f"Clean data directory not found, or without Parquet files: {path}") from e
        raise
    if not files:
        raise FileNotFoundError(f"Clean data directory not found, or without Parquet files: {path}")
    root = unquote(path.rstrip("/")).split("://", 1)[-1].removeprefix("file:") + "/"
    layouts: dict[tuple[str, ...], list[str]] = {}
    for f in files:
        layouts.setdefault(_partition_keys(f, root), []).append(f)
    if len(layouts) == 1:
        (keys,) = layouts
        reader = spark.read.option("pathGlobFilter", "*.parquet").option("mergeSchema", True)
        return reader.parquet(path) if keys else reader.option("recursiveFileLookup", True).parquet(path)
    parts = []
    for keys, own in sorted(layouts.items()):
        reader = spark.read.option("mergeSchema", True)
        parts.append(reader.option("basePath", path).parquet(*own) if keys else reader.parquet(*own))
    kinds: dict[str, T.DataType] = {}
    for part in parts:
        for f in part.schema.fields:
            if kinds.setdefault(f.name, f.dataType) != f.dataType:
                raise ValueError(f"Column '{f.name}' has different types below {path}: {kinds[f.name].simpleString()}, {f.dataType.simpleString()}")
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def read_star(spark: SparkSession, star_dir: str, schemas: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The five star tables; every missing one is named in the error.

    ``schemas`` names the columns to read of each table, which then need not be looked up in the files.
    """
    tables, missing = {}, []
    for name in STAR_TABLES:
        try:
            reader = spark.read.schema(schemas[name]) if schemas else spark.read
            tables[name] = reader.parquet(f"{star_dir.rstrip('/')}/{name}.parquet")
        except AnalysisException as e:
            if not is_missing_path(e):
                raise
            missing.append(f"{name}.parquet")
    if missing:
        raise FileNotFoundError(f"Missing analytics files: {missing}. Run the star schema build step first.")
    return tables
