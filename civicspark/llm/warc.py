"""WARC archives: a writer with revisit records and a salvage reader.

Writer. One ``response`` record per page, its block an HTTP response head and
the payload. Pages that repeat a payload become ``revisit`` records that carry
only the head and name the page they refer to. Archives are written by Spark's
text writer (a record is valid UTF-8 and records end in CRLF CRLF), so task
retries and lost executors are handled by its commit protocol, and they land
in any store Spark can write.

Reader. Every record is checked: version line, header syntax, length, the
closing CRLF CRLF, the block and payload digests, and for compressed archives
the gzip member's CRC. When a check fails, the reader searches for the next
gzip member or version line that starts a valid record, reads on from there,
and reports the bytes between as a quarantined gap.

An archive is one row of the ``binaryFile`` source, so a task holds one
archive in memory; the writer sizes its files by ``archive_bytes``.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.session import materialize, tuning

VERSION = b"WARC/1.1"
#: Payloads shorter than this are always written out.
MIN_REVISIT_BYTES = 100
#: Payload bytes per archive, on average, that the writer does not exceed.
ARCHIVE_BYTES = 16 << 20
#: Revisits up to which their list is broadcast.
BROADCAST_REVISITS = 100_000

_CRLF = "\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_DATE = "1970-01-01T00:00:00Z"
_VERSION_LINE = re.compile(rb"WARC/\d\.\d\r?\n")
_GZIP_MAGIC = b"\x1f\x8b\x08"
_START = re.compile(rb"WARC/\d\.\d\r?\n|\x1f\x8b\x08")
_HASHES = ("sha256", "sha1", "md5")
#: Compressed bytes inflated at a time.
_INFLATE = 256


# -- writer -------------------------------------------------------------------


def _header(name: str, value: Column) -> Column:
    """``Name: value`` and a line end, or nothing for a null; control characters become spaces."""
    clean = F.regexp_replace(value.cast("string"), r"[\x00-\x1F\x7F]", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(_CRLF)), F.lit(""))


def mark_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Rows ``(row_key, refers_to)`` of the pages that repeat a payload of ``min_bytes`` or more.

    ``pages`` has ``row_key, page_id, digest, payload_bytes``. Of equal payloads
    the smallest ``page_id`` is written out (all rows that carry that id); a
    null id is never the smallest, and a group of null ids has no revisits.
    """
    long_enough = pages.where(F.col("payload_bytes") >= min_bytes)
    first = long_enough.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    # Written first, the repeated payloads are a plain shuffle beside a hot one (an error page), which AQE can then split.
    first = materialize(first.where((F.col("n") > 1) & F.col("refers_to").isNotNull()).select("digest", "refers_to"), "repeated-payloads")
    repeats = long_enough.join(first, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return repeats.select("row_key", "refers_to").distinct()


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    archive_bytes: int = ARCHIVE_BYTES,
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    compression: str = "none",
) -> None:
    """Write one record per row of ``pages`` below ``path`` (a folder of archives).

    A null payload is empty, a null url or id has no header line. Repeated rows
    are written once each. ``compression`` is ``none`` or ``gzip`` (one member
    per archive). Other columns are ignored; an empty table writes no record.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    digest = F.sha2(payload, 256)
    row_key = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), digest)
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        payload.alias("payload"),
        digest.alias("digest"),
        row_key.alias("row_key"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
    )
    revisits = materialize(mark_revisits(rows.select("row_key", "page_id", "digest", "payload_bytes"), min_revisit_bytes), "revisits")
    # Few revisits reach every task; for more of them the pages are shuffled.
    few = revisits.count() <= tuning(pages.sparkSession, "warcBroadcastRevisits", BROADCAST_REVISITS)
    marked = rows.join(F.broadcast(revisits) if few else revisits, "row_key", "left")
    size = pages.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(payload_col))).alias("total")).first()
    per_archive = max(1, archive_bytes * size["n"] // max(1, size["total"] or 0))
    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    http = F.concat(F.lit(_HTTP), _header("Content-Length", F.col("payload_bytes")), F.lit(_CRLF))
    block = F.concat(http, body)
    record = F.concat(
        F.lit(VERSION.decode() + _CRLF),
        F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit(_CRLF),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))),
        _header("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        _header("WARC-Target-URI", F.col("url")),
        F.lit(f"WARC-Date: {_DATE}{_CRLF}"),
        _header("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2(block, 256))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{_CRLF}")).otherwise(""),
        F.lit(f"Content-Type: application/http; msgtype=response{_CRLF}"),
        _header("Content-Length", F.octet_length(block)),
        F.lit(_CRLF),
        block,
    )
    writer = marked.select(record.alias("value")).write.option("lineSep", _CRLF * 2).option("compression", compression)
    writer.option("maxRecordsPerFile", per_archive).text(path)


# -- salvage reader -----------------------------------------------------------


@dataclass(frozen=True)
class Record:
    """A valid record at ``offset``; ``headers`` have lower-case names."""

    offset: int
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        """The block without its HTTP head, if it has one."""
        if "application/http" in self.headers.get("content-type", "") and b"\r\n\r\n" in self.block:
            return self.block.partition(b"\r\n\r\n")[2]
        return self.block


@dataclass(frozen=True)
class Gap:
    """Quarantined bytes and the check that failed at their start."""

    offset: int
    length: int
    reason: str


class _Invalid(Exception):
    """A check failed."""


def _digest_matches(stated: str, data: bytes) -> bool:
    """False if ``stated`` is a hex sha256, sha1 or md5 of other bytes; other digests are not checked."""
    kind, _, value = stated.partition(":")
    if kind not in _HASHES or not re.fullmatch(r"[0-9a-f]+", value):
        return True
    return hashlib.new(kind, data).hexdigest() == value


def _proven(record: Record) -> bool:
    """Whether the record states a digest that :func:`_parse` has checked."""
    stated = (record.headers.get(f"warc-{part}-digest", "").partition(":") for part in ("block", "payload"))
    return any(kind in _HASHES and re.fullmatch(r"[0-9a-f]+", value) for kind, _, value in stated)


def _parse(data: bytes, at: int, offset: int) -> tuple[Record, int]:
    """The record of ``data`` at ``at`` and where it ends; raises if a check fails."""
    line = _VERSION_LINE.match(data, at)
    if not line:
        raise _Invalid("no version line")
    head_end = data.find(b"\r\n\r\n", line.end() - 2)
    if head_end < 0:
        raise _Invalid("unfinished header")
    headers: dict[str, str] = {}
    for field in data[line.end() : head_end].split(b"\r\n"):
        name, colon, value = field.partition(b":")
        if not colon or not name.strip() or name != name.strip():
            raise _Invalid("malformed header")
        key = name.decode("latin-1").lower()
        if key in headers and key != "warc-concurrent-to":
            raise _Invalid("repeated header")
        headers[key] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not length.isascii() or not length.isdigit():
        raise _Invalid("no length")
    start = head_end + 4
    end = start + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        raise _Invalid("record not closed")
    record = Record(offset, headers, data[start:end])
    if not _digest_matches(headers.get("warc-block-digest", ""), record.block):
        raise _Invalid("block digest")
    if headers.get("warc-type") != "revisit" and not _digest_matches(headers.get("warc-payload-digest", ""), record.payload):
        raise _Invalid("payload digest")
    return record, end + 4


def _member(data: bytes, at: int) -> tuple[bytes, int, str]:
    """What the gzip member at ``at`` inflates to, where it (or what was read of it) ends and what is wrong ('' if nothing).

    Its CRC and size are checked by zlib; of a broken member the part before the damage is returned.
    """
    inflate, plain = zlib.decompressobj(wbits=31), []
    for start in range(at, len(data), _INFLATE):
        try:
            plain.append(inflate.decompress(data[start : start + _INFLATE]))
        except zlib.error as e:
            return b"".join(plain), start + _INFLATE, f"gzip member: {e}"
        if inflate.eof:
            return b"".join(plain), min(start + _INFLATE, len(data)) - len(inflate.unused_data), ""
    return b"".join(plain), len(data), "unfinished gzip member"


def _plain(data: bytes, base: int | None = None) -> Iterator[Record | Gap]:
    """Records and gaps of uncompressed bytes. ``base``: report all offsets as this one (a gzip member's)."""
    at, gap, reason = 0, None, ""
    while at < len(data):
        try:
            record, end = _parse(data, at, at if base is None else base)
        except _Invalid as e:
            if gap is None:
                gap, reason = at, str(e)
            found = _VERSION_LINE.search(data, at + 1)
            at = found.start() if found else len(data)
            continue
        if gap is not None:
            yield Gap(gap if base is None else base, at - gap, reason)
            gap = None
        yield record
        at = end
    if gap is not None:
        yield Gap(gap if base is None else base, len(data) - gap, reason)


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """Every valid record of an archive in order, and the byte gaps between them.

    Plain records and gzip members may stand side by side: after a failed check
    whichever starts first is tried, so a plain record's gzip body costs nothing.
    Gaps of plain archives and of broken gzip members are counted in the
    archive's bytes; a gap inside a sound member has the member's offset and
    the length in uncompressed bytes. A broken member is a gap as a whole, but
    records before its damage are given out when their digest proves them.
    """
    at, gap, reason = 0, None, ""
    given, until = [], 0  # records of a broken member, whose bytes hold them once more if they were stored uncompressed
    while at < len(data):
        found: list[Record | Gap] = []
        if data[at : at + 3] == _GZIP_MAGIC:
            plain, end, wrong = _member(data, at)
            if not wrong and not _VERSION_LINE.search(plain):
                wrong = "no record in gzip member"
            found = list(_plain(plain, at))
            if wrong:  # records before the damage count if their digest proves them whole
                given, until = [x for x in found if isinstance(x, Record) and _proven(x)], end
                yield from given
        else:
            try:
                record, end = _parse(data, at, at)
                if end <= until and any((x.headers, x.block) == (record.headers, record.block) for x in given):
                    raise _Invalid("part of a broken gzip member")
                found, wrong = [record], ""
            except _Invalid as e:
                wrong = str(e)
        if wrong:
            if gap is None:
                gap, reason = at, wrong
            at = _next_start(data, at + 1)
            continue
        if gap is not None:
            yield Gap(gap, at - gap, reason)
            gap = None
        yield from found
        at = end
    if gap is not None:
        yield Gap(gap, len(data) - gap, reason)


def _next_start(data: bytes, at: int) -> int:
    """Where the next version line or gzip member may begin, whichever comes first; the end if there is none."""
    start = _START.search(data, at)
    return start.start() if start else len(data)


_RECORD_SCHEMA = (
    "archive string, offset bigint, kind string, length bigint, reason string, record_id string, refers_to string, "
    "target_uri string, payload_bytes bigint, payload_digest string, stated_digest string, headers map<string,string>, payload binary"
)


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Records and gaps of all archives at ``path``, one row each.

    ``kind`` is the WARC type, or ``gap`` for quarantined bytes, which have
    ``length`` and ``reason``. ``payload_bytes`` and ``payload_digest`` (sha256,
    hex) are of the payload as read; ``payload`` is null unless asked for. An
    empty archive has no rows.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    names = [f.split()[0] for f in _RECORD_SCHEMA.replace("map<string,string>", "map").split(", ")]
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]

    def row(name: str, x: Record | Gap) -> tuple:
        if isinstance(x, Gap):
            return (name, x.offset, "gap", x.length, x.reason, *[None] * 8)
        h, payload = x.headers, x.payload
        return (
            name, x.offset, h.get("warc-type"), len(x.block), None, h.get("warc-record-id"), h.get("warc-refers-to"), h.get("warc-target-uri"),
            len(payload), hashlib.sha256(payload).hexdigest(), h.get("warc-payload-digest"), list(h.items()), payload if with_payload else None,
        )

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                rows, size = [], 0
                for x in salvage(content.as_py()):
                    rows.append(row(name.as_py(), x))
                    size += len(x.block) if with_payload and isinstance(x, Record) else 200
                    if size > 4 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    return files.mapInArrow(run, _RECORD_SCHEMA)


def page_records(records: DataFrame) -> DataFrame:
    """One row per page record: ``page_id, payload_bytes, payload_digest, record_type, refers_to, archive, offset``.

    A revisit takes the length and digest of the payload it stands for from
    the response it refers to (matched on page and stated digest); if that
    record was lost, the length is null and the digest the stated one. Ids that
    are not a page's number are null. The archives are parsed once: the narrow
    rows are written, and revisits are resolved from them.
    """
    def page(c: Column) -> Column:
        return F.nullif(F.regexp_extract(c, r"^<urn:page:(.*)>$", 1), F.lit("")).try_cast("bigint")

    rows = records.where("kind IN ('response', 'revisit')").select(
        page(F.col("record_id")).alias("page_id"), page(F.col("refers_to")).alias("refers_to"), F.col("kind").alias("record_type"),
        "payload_bytes", "payload_digest", F.regexp_replace("stated_digest", "^sha256:", "").alias("stated"), "archive", "offset",
    )
    rows = materialize(rows, "page-records")
    responses = rows.where("record_type = 'response'")
    revisits = rows.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
    # Only pages that a revisit names are looked up; written first, they are a plain shuffle beside a page that many revisit.
    named = revisits.select("refers_to", "stated").distinct()
    known = responses.select(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("stated"), "payload_bytes").distinct()
    known = materialize(known.join(named, ["refers_to", "stated"], "left_semi"), "revisited-pages")
    resolved = revisits.join(known, ["refers_to", "stated"], "left").withColumn("payload_digest", F.col("stated"))
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "offset"]
    return responses.select(cols).unionByName(resolved.select(cols))
