"""Paged source over landed page files, with its stop rules (S1, S5) and the union of record keys.

A page is a JSON array of records. It lies in a file of its own, its number in
the file's path, or with others in a file below a folder ``pages=...``: a
source of very many small pages would else be a file and a folder for each,
whose making, listing and opening takes far longer than their records do
(:func:`land_pages`). Read one after another, pages would end with the first one that
has fewer records than were asked for (an empty one included) or when a total
limit is reached. Here no page waits for another: one pass takes every page's
number and size, the stop is a minimum over short pages, the limit is a prefix
sum over sizes, and only pages that would have been asked for are read. (A file of zero bytes is no
page: Spark's readers pass over it.)

Records are VARIANT values: a page is parsed by Spark's own JSON parser, any
key can be reached without a schema, and the keys of all records come from
``schema_of_variant_agg``, observed while the records are staged.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark.operators.ranking import prefix_sums
from civicspark.schema import MAX_BATCH_SIZE, RAW_COLUMNS, RAW_SCHEMA
from civicspark.session import materialize, scratch_path
from civicspark.sources.files import is_missing_path
from civicspark.sources.paging import check_batch_size, newest_positions, POSITION

#: Where a page's number stands in its path (the last match counts).
PAGE_NUMBER = r".*page[=_-]?(\d+)"
#: Folders of files that hold many pages, each as its number, a tab, its text and a record separator (which no JSON text holds as it is).
BUNDLE, SEPARATOR = "pages", "\x1e"
#: Pages in such a file: of 1000 records, some 10 MB.
PAGES_PER_FILE = 32


class PageError(ValueError):
    """A page that was reached is not an array of records."""


def page_texts(df: DataFrame, batch_size: int = MAX_BATCH_SIZE, column: str = "created_date") -> DataFrame:
    """``(page, value)``: the newest-first pages of ``df``, each a JSON array; null fields are left out of a record.

    The rows are written first: placing them reads them twice, to sample the
    order and to sort, which would else run the joins behind ``df`` twice.
    """
    check_batch_size(batch_size)
    placed = newest_positions(materialize(df, "page-rows", df_schema=True), column)
    page = F.floor((F.col(POSITION) - 1) / batch_size).cast("bigint")
    records = F.sort_array(F.collect_list(F.struct(POSITION, F.struct(*df.columns).alias("record"))))  # batch_size at most
    return placed.groupBy(page.alias("page")).agg(F.to_json(F.transform(records, lambda r: r["record"])).alias("value"))


def land_pages(texts: DataFrame, path: str) -> None:
    """Write ``(page, value)`` rows, :data:`PAGES_PER_FILE` consecutive page numbers per file."""
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.concat(F.coalesce(F.col("page").cast("string"), F.lit("")), F.lit("\t"), F.coalesce("value", F.lit("")))
    bundled = texts.select(text.alias("value"), F.floor(F.col("page") / PAGES_PER_FILE).alias(BUNDLE))
    bundled.repartition(n, BUNDLE).write.mode("overwrite").partitionBy(BUNDLE).option("lineSep", SEPARATOR).text(path)


def _whole_pages(spark: SparkSession, path: str, number: str) -> DataFrame:
    """``(number, file, at, text)``, ``at`` being the place in the file."""
    try:
        files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).where("value <> ''")
    except AnalysisException as e:
        if is_missing_path(e):
            raise FileNotFoundError(f"File not found: {path}") from e
        raise
    file = F.col("_metadata.file_path")
    bundled = F.transform(
        F.filter(F.split("value", SEPARATOR), lambda t: t != ""),
        lambda t: F.struct(F.substring_index(t, "\t", 1).alias("number"), F.substr(t, F.locate("\t", t) + 1).alias("text")),
    )
    alone = F.array(F.struct(F.regexp_extract(file, number, 1).alias("number"), F.col("value").alias("text")))
    pages = F.when(file.rlike(f"/{BUNDLE}=[^/]*/[^/]*$"), bundled).otherwise(alone)
    each = files.select(file.alias("file"), F.posexplode(pages).alias("at", "page"))
    return each.select(F.col("page.number").try_cast("bigint").alias("number"), "file", "at", F.col("page.text").alias("text"))


def _records() -> Column:
    """A page's records; null where it is no array."""
    return F.try_variant_get(F.try_parse_json("text"), "$", "array<variant>")


_ORDER = ["number", "file", "at"]


def _sizes(pages: DataFrame) -> DataFrame:
    is_record = F.forall("records", lambda r: F.try_variant_get(r, "$", "struct<unique_key:variant>").isNotNull())  # any object is
    valid = F.coalesce(F.col("records").isNotNull() & is_record, F.lit(False))
    return pages.withColumn("records", _records()).select(*_ORDER, F.coalesce(F.size("records"), F.lit(0)).alias("n"), valid.alias("valid"))


def page_sizes(spark: SparkSession, path: str, number: str = PAGE_NUMBER) -> DataFrame:
    """``(number, file, at, n, valid)`` of every page; a page is valid if it is an array of objects only."""
    return _sizes(_whole_pages(spark, path, number))


def reached_pages(sizes: DataFrame, batch_size: int, total_limit: int | None = None) -> DataFrame:
    """``(number, file, at, before)``: the pages that reading one after another would have asked for.

    ``before`` counts the records of the pages before. Pages come by number,
    files without one last. A page that was reached and is not an array of
    records raises :class:`PageError`.
    """
    key = F.struct(F.col("number").isNull().alias("unnumbered"), *_ORDER)
    stop = sizes.where((F.col("n") < batch_size) | ~F.col("valid")).agg(F.min(F.struct(key.alias("key"), "valid")).alias("s")).first()["s"]
    reached = sizes
    if stop is not None:
        reached = sizes.where(key <= F.struct(*(F.lit(v).cast(t) for v, t in zip(stop["key"], ("boolean", "bigint", "string", "int"), strict=True))))
    order = [F.col("number").asc_nulls_last(), F.col("file").asc(), F.col("at").asc()]
    placed = prefix_sums(reached, order, "n", "before")
    if total_limit is not None:
        placed = placed.where(F.col("before") < total_limit)
    placed = materialize(placed, "reached-pages", df_schema=True)
    bad = placed.where(~F.col("valid")).first()  # the stop, if it was reached
    if bad is not None:
        raise PageError(f"page {bad['number']} is not an array of records: {bad['file']}")
    return placed.select(*_ORDER, "before")


def page_records(
    spark: SparkSession, path: str, batch_size: int = MAX_BATCH_SIZE, total_limit: int | None = None, number: str = PAGE_NUMBER
) -> DataFrame:
    """``(position, record)``: the records of the source as VARIANT values, 0-based in page order (S1 + S4 + S5)."""
    check_batch_size(batch_size)
    if total_limit is not None and total_limit < 0:
        raise ValueError(f"total_limit must be >= 0, got {total_limit}")
    pages = _whole_pages(spark, path, number)  # one listing serves both reads
    sizes = materialize(_sizes(pages), "page-sizes", df_schema=True)
    reached = reached_pages(sizes, batch_size, total_limit).select(F.col("file").alias("_file"), F.col("at").alias("_at"), "before")
    here = (F.col("file") == F.col("_file")) & (F.col("at") == F.col("_at"))
    # posexplode would have the planner ask beforehand whether a page has records, by parsing it again, pages not reached included.
    texts = pages.join(reached, here).select("before", _records().alias("records"))
    rows = texts.select("before", F.posexplode_outer("records").alias("in_page", "record")).where("in_page IS NOT NULL")
    rows = rows.select((F.col("before") + F.col("in_page")).alias("position"), "record")
    return rows if total_limit is None else rows.where(F.col("position") < total_limit)


def _field(key: str) -> Column:
    """A record's value under ``key`` as text; objects and arrays as JSON. A key with quotes is looked up in the record as a map."""
    if "'" not in key and "\\" not in key:
        return F.variant_get("record", f"$['{key}']", "string")
    return F.element_at(F.col("record").cast("map<string,variant>"), F.lit(key)).cast("string")


def top_level_keys(schema: str | None) -> list[str]:
    """Names of the outermost fields of what ``schema_of_variant_agg`` gives (``OBJECT<a: STRING, `b c`: OBJECT<...>>``)."""
    if not schema or not schema.startswith("OBJECT<"):
        return []
    keys, at, depth, inside = [], len("OBJECT<"), 0, False
    name = True
    while at < len(schema) - 1:
        c = schema[at]
        if name and c == "`":
            end = at + 1
            while schema[end] != "`" or schema[end + 1] == "`":
                end += 2 if schema[end] == "`" else 1
            keys.append(schema[at + 1 : end].replace("``", "`"))
            at, name = end + 1, False
            continue
        if name and c not in " ,":
            end = schema.index(":", at)
            keys.append(schema[at:end])
            at, name = end, False
            continue
        if c == "`":
            inside = not inside
        elif not inside and c in "<(":
            depth += 1
        elif not inside and c in ">)":
            depth -= 1
        elif not inside and depth == 0 and c == ",":
            name = True
        at += 1
    return keys


def read_page_source(
    spark: SparkSession,
    path: str,
    batch_size: int = MAX_BATCH_SIZE,
    total_limit: int | None = None,
    schema: T.StructType | None = RAW_SCHEMA,
    number: str = PAGE_NUMBER,
) -> DataFrame:
    """The table that a paged read of ``path`` gives: fixed columns, or with ``schema=None`` every key of any record.

    Keys that a record lacks are null. Without a schema all columns are text,
    the raw columns first (those that occur), then the others by name; the
    records are staged once, and the keys are observed on that write.
    """
    records = page_records(spark, path, batch_size, total_limit, number)
    if schema is not None:
        return records.select(*(_field(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields))
    staged = scratch_path(spark, "page-records")
    seen = Observation(f"keys_{uuid.uuid4().hex[:8]}")
    records.observe(seen, F.schema_of_variant_agg("record").alias("keys")).write.parquet(staged)
    keys = top_level_keys(seen.get["keys"])
    ordered = [c for c in RAW_COLUMNS if c in keys] + sorted(set(keys) - set(RAW_COLUMNS))
    return spark.read.parquet(staged).select(*(_field(k).alias(k) for k in ordered))
