"""``requests_raw``: dirty service requests derived from the driver tables.

Every order becomes one request; its text fields come from the customer, the
customer's nation and region, the order's earliest line and that line's part.
Deterministic rules on the order key inject the dirt the cleaner must repair
(missing keys, unparseable dates, out-of-range coordinates, empty agencies,
exact duplicate rows). The whole of every input table is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.schema import RAW_COLUMNS



def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _every(k: Column, n: int) -> Column:
    return (k % F.lit(n)) == F.lit(0)


def _iso_text(ts: Column) -> Column:
    """timestamp_ntz -> 'yyyy-MM-ddTHH:mm:ss' (fraction dropped).

    A plain cast of a zone-less timestamp to text never consults the session
    time zone, unlike ``date_format``, which would shift wall times that fall
    into a daylight-saving gap of that zone.
    """
    return F.translate(F.substring(ts.cast("string"), 1, 19), " ", "T")


def _fine_type(kind: Column, size: Column) -> Column:
    """Part type and size class: dozens of types, the largest class of them rare."""
    return F.concat_ws(" ", kind, F.floor(F.sqrt(size.cast("double"))).cast("string"))


def _desk(k: Column) -> Column:
    """Twenty agencies of equal size, so that a cut among them is a tie."""
    return F.concat(F.lit("DESK "), F.lpad((F.floor(k / 3) % F.lit(20)).cast("string"), 2, "0"))


def requests_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw request table: ten string columns, see FIXTURES.md section 3."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_size")

    # Earliest ship date and smallest part per order: a partial aggregate on
    # the map side, so only one row per order and map task is shuffled.
    first_line = (
        _table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_shipdate").alias("ship"), F.min("l_partkey").alias("pk"))
    )

    # nation and region are tiny; the planner broadcasts them on its own size
    # estimate. orders/customer/lineitem/part are joined on their keys.
    src = (
        orders.join(first_line, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(part, F.col("pk") == F.col("p_partkey"), "left")
    )

    k = F.col("o_orderkey")
    u = F.col("o_custkey")
    frac = F.lpad((u % F.lit(1000)).cast("string"), 3, "0")
    borough_by_region = (
        F.when(F.col("r_name") == "AFRICA", F.lit("bx"))
        .when(F.col("r_name") == "AMERICA", F.lit("Kings"))
        .when(F.col("r_name") == "ASIA", F.lit("MN"))
        .when(F.col("r_name") == "EUROPE", F.lit("QUEENS"))
        .when(_every(k, 2), F.lit("Richmond"))
        .otherwise(F.lit("Unspecified"))
    )
    raw = src.select(
        F.when(~_every(k, 997), k.cast("string")).alias("unique_key"),
        F.when(~_every(k, 41), _fine_type(F.col("p_type"), F.col("p_size"))).alias("complaint_type"),
        borough_by_region.alias("borough"),
        F.when(_every(k, 101), F.lit("invalid"))
        .otherwise(_iso_text(F.col("o_orderdate")))
        .alias("created_date"),
        _iso_text(F.col("ship")).alias("closed_date"),
        F.when(_every(k, 53), F.lit(""))
        .when(_every(k, 59), F.lit(None).cast("string"))
        .when(_every(k, 3), _desk(k))
        .otherwise(F.col("c_mktsegment"))
        .alias("agency"),
        F.when(~_every(k, 61), F.col("p_brand")).alias("descriptor"),
        F.when(~_every(k, 37), (F.lit(10000) + F.col("n_nationkey")).cast("string")).alias("incident_zip"),
        F.when(_every(k, 71), F.lit("39.9"))
        .when(_every(k, 73), F.lit("n/a"))
        .otherwise(F.concat(F.lit("40."), frac))
        .alias("latitude"),
        F.when(_every(k, 79), F.lit("-72.5")).otherwise(F.concat(F.lit("-73."), frac)).alias("longitude"),
        # Every 11th order is emitted twice (exact copies), so de-duplication
        # has work to do; one pass over the joined rows, no second join.
        F.explode(F.when(_every(k, 11), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    )
    return raw.select(*RAW_COLUMNS)


ODD_NAMES = {"unique_key": "Unique Key", "created_date": " Created Date", "complaint_type": "COMPLAINT Type "}


def requests_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``requests_raw`` in reverse column order with columns nobody asked for, two of them without a value."""
    raw = requests_raw(spark, sf_dir)
    return raw.select(
        F.lit(None).cast("string").alias("empty_text"),
        *reversed(RAW_COLUMNS),
        F.upper("borough").alias("note"),
        F.lit(float("nan")).alias("nan_number"),
    )


def requests_odd_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``requests_raw`` with capitals, blanks and outer spaces in some column names."""
    return requests_raw(spark, sf_dir).withColumnsRenamed(ODD_NAMES)


def requests_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``requests_raw`` with its coordinates as doubles, NaN where the text is no number."""

    def number(c: str) -> Column:
        return F.coalesce(F.col(c).try_cast("double"), F.lit(float("nan"))).alias(c)

    numbers = {"latitude", "longitude"}
    return requests_raw(spark, sf_dir).select(*[number(c) if c in numbers else F.col(c) for c in RAW_COLUMNS])


US_LAYOUT, ZULU_LAYOUT = "MM/dd/yyyy hh:mm:ss a", "yyyy-MM-dd'T'HH:mm:ssX"


def requests_two_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``requests_raw`` with even days of creation in the US layout and all closing times marked as UTC."""
    c = F.col("created_date")

    def part(at: int, n: int) -> Column:
        return F.substring(c, at, n)

    hour = part(12, 2).try_cast("int")
    us = F.concat(
        part(6, 2), F.lit("/"), part(9, 2), F.lit("/"), part(1, 4), F.lit(" "),
        F.lpad(((hour + 11) % 12 + 1).cast("string"), 2, "0"), part(14, 6), F.when(hour < 12, " AM").otherwise(" PM"),
    )
    even = (F.length(c) == 19) & (part(9, 2).try_cast("int") % 2 == 0)
    raw = requests_raw(spark, sf_dir)
    return raw.withColumn("created_date", F.when(even, us).otherwise(c)).withColumn("closed_date", F.concat("closed_date", F.lit("Z")))


def two_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One number per order: half of them 0, almost half 10, and many values between."""
    k = F.col("o_orderkey")
    x = F.when(k % 20 < 10, F.lit(0.0)).when(k % 20 < 19, F.lit(10.0)).otherwise((k % 997).cast("double") / 100)
    return _table(spark, sf_dir, "orders").select(x.alias("x"))


def requests_more_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``requests_raw`` with keys that only some records have, one of them nested, one with an odd name."""
    key = F.coalesce(F.col("unique_key").try_cast("bigint"), F.lit(0))
    parts = F.struct(F.col("latitude"), F.col("longitude"), F.array("borough").alias("boroughs"))
    return requests_raw(spark, sf_dir).select(
        "*",
        F.when(key % 2 == 0, F.lit("Closed")).when(key % 5 == 0, F.lit("Open")).alias("status"),
        F.when(F.col("borough") == "MN", F.lit("NEW YORK")).alias("city"),
        F.when(key % 7 == 0, parts).alias("location"),
        F.when(key % 11 == 0, F.lit("it's `odd`")).alias("Agency's name"),
    )
