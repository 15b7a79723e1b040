"""Column expressions: all built from ``pyspark.sql.functions``, so they stay
inside whole-stage codegen and never leave the JVM."""

from __future__ import annotations

import datetime as dt
import re
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark.schema import BOROUGH_MAP, UNKNOWN

# Accepted timestamp layouts by default: ISO date, optionally followed by 'T' or
# ' ' and a time with an optional fraction. Anything else (including a bare
# year, which a plain cast would take) parses to null.
ISO_LAYOUT = "iso"
#: Layouts that a column may be found to have, in the order in which ties are decided.
KNOWN_LAYOUTS = (ISO_LAYOUT, "MM/dd/yyyy hh:mm:ss a", "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy", "dd.MM.yyyy HH:mm:ss", "dd.MM.yyyy", "yyyy-MM-dd'T'HH:mm:ssX", "yyyyMMdd")
_TIMESTAMP_TEXT = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:\d{2}(\.\d{1,9})?)?$"

# Plain decimal or scientific notation with surrounding blanks. Suffixes such as
# '1.0d' or words such as 'nan' are not numbers here.
_NUMBER_TEXT = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def is_missing(c: Column, dtype: T.DataType) -> Column:
    """Null, or NaN in a floating column."""
    return c.isNull() | F.isnan(c) if isinstance(dtype, (T.FloatType, T.DoubleType)) else c.isNull()


def nan_as_null(c: Column, dtype: T.DataType) -> Column:
    """A floating column with null for NaN; any other column as it is."""
    return F.when(~F.isnan(c), c) if isinstance(dtype, (T.FloatType, T.DoubleType)) else c


def parse_timestamp(c: Column, dtype: T.DataType | None = None, layouts: tuple[str, ...] = (ISO_LAYOUT,)) -> Column:
    """Text -> timestamp_ntz, bad or missing values -> null (F1).

    ``layouts`` are tried in order: ``iso`` (above), or a datetime pattern such
    as ``MM/dd/yyyy hh:mm:ss a``. A pattern that names a zone (``X``) gives the
    UTC wall time. A column that already is a timestamp or date (``dtype``)
    is not parsed. Nothing here depends on the session time zone.
    """
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return c.cast("timestamp_ntz")
    text = c.cast("string")
    return F.coalesce(*(_parse_layout(text, layout) for layout in layouts))


def _parse_layout(text: Column, layout: str) -> Column:
    if layout == ISO_LAYOUT:
        return F.when(text.rlike(_TIMESTAMP_TEXT), text.try_cast("timestamp_ntz"))
    if not re.search(r"[XxZVzO]", re.sub(r"'[^']*'", "", layout)):  # no zone in the pattern: read the wall time as UTC
        text, layout = F.concat(text, F.lit(" +0000")), f"{layout} xx"
    micros = F.unix_micros(F.try_to_timestamp(text, F.lit(layout)))
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def parse_number(c: Column, dtype: T.DataType | None = None) -> Column:
    """Text -> double, bad or missing values -> null, never NaN (F2).

    An overflowing literal such as 1e999 becomes infinity, as a numeric parse
    of it does; range checks (P7) then null it. A numeric column (``dtype``)
    is only cast.
    """
    if isinstance(dtype, T.NumericType):
        return nan_as_null(c.cast("double"), T.DoubleType())
    text = c.cast("string")
    return F.when(text.rlike(_NUMBER_TEXT), text.try_cast("double"))


def within(c: Column, lo: float, hi: float) -> Column:
    """Keep values in the closed range [lo, hi], otherwise null."""
    return F.when(c.between(F.lit(lo), F.lit(hi)), c)


def standard_borough(c: Column) -> Column:
    """Upper-case then map to the standard borough name; unknown -> 'UNKNOWN' (F3)."""
    mapping = F.create_map(*[F.lit(x) for x in chain.from_iterable(BOROUGH_MAP.items())])
    return F.coalesce(F.element_at(mapping, F.upper(c.cast("string"))), F.lit(UNKNOWN))


def repaired_closed(created: Column, closed: Column) -> Column:
    """Null a closing time that precedes the creation time; keep it otherwise.

    A null creation time never nulls the closing time.
    """
    return F.when(created.isNotNull() & closed.isNotNull() & (closed < created), F.lit(None)).otherwise(closed)


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 of a ``timestamp_ntz`` wall time.

    Built from calendar parts, which a zone-less timestamp has without any
    time zone. (``timestamp_diff`` converts its inputs to zoned timestamps in
    the session zone first, so a wall time inside a daylight-saving gap moves
    and durations across it gain or lose an hour.)
    """
    days = F.date_diff(F.to_date(ts), F.lit(dt.date(1970, 1, 1))).cast("long")
    seconds = (F.hour(ts) * F.lit(3600) + F.minute(ts) * F.lit(60)).cast("long")
    fraction = (F.extract(F.lit("SECOND"), ts) * F.lit(1_000_000)).cast("long")
    return days * F.lit(86_400_000_000) + seconds * F.lit(1_000_000) + fraction


def hours_between(start: Column, end: Column) -> Column:
    """(end - start) in hours as double, null when either side is null."""
    micros = epoch_micros(end) - epoch_micros(start)
    return micros.cast("double") / F.lit(1e6) / F.lit(3600.0)


def calendar_date(ts: Column) -> Column:
    """Timestamp -> date."""
    return F.to_date(ts)


def year_of(ts: Column) -> Column:
    return F.year(ts).cast("bigint")


def month_of(ts: Column) -> Column:
    return F.month(ts).cast("bigint")


def day_of(ts: Column) -> Column:
    return F.dayofmonth(ts).cast("bigint")


def weekday_sunday0(ts: Column) -> Column:
    """Day of week with Sunday = 0 ... Saturday = 6."""
    return (F.dayofweek(ts) - F.lit(1)).cast("bigint")


def round2(x: Column) -> Column:
    """Round to two decimals, half away from zero on the scaled double.

    ``round(x * 100) / 100`` rounds the binary value rather than its shortest
    decimal text, so 1.005 (stored just below) becomes 1.0.
    """
    return F.round(x * F.lit(100.0), 0) / F.lit(100.0)


def pct_null(c: Column) -> Column:
    """Percentage of rows where ``c`` is null, two decimals; null on no rows."""
    nulls = F.sum(F.when(c.isNull(), F.lit(1)).otherwise(F.lit(0)))
    return round2(F.try_divide(F.lit(100.0) * nulls, F.count(F.lit(1))))
