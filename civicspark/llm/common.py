"""Helpers shared by the operators of this package.

Row identity. ``documents`` is keyed by ``doc_id``, but the operators do not
rely on it: rows are matched on ``(doc_id, xxhash64(text))``, so two rows with
one id and different texts stay apart, and rows that repeat both are one
document whose verdict each of them gets.
"""

from __future__ import annotations

import ctypes
import os
import string
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase

#: Name of the second half of the row identity.
TEXT_HASH = "_text_hash"


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def show_package(spark: SparkSession) -> None:
    """Python workers started from now on look for this package where the driver found it.

    On a cluster the package is installed or shipped with ``--py-files``; there the extra path does no harm.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters keep their case.

    The built-in ``lower`` does the same on pure ASCII and is many times
    faster than ``translate``, so it is used wherever bytes equal characters.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, _text_hash, text)`` with null texts read as empty; other columns are left out."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias(TEXT_HASH), text.alias("text"))


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """UTF-8 bytes of a text column (one map-side aggregate)."""
    return int(docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0)


def partitions_for(n_bytes: int, per_partition: int) -> int:
    """How many partitions hold ``n_bytes`` at ``per_partition`` bytes each."""
    return max(1, -(-n_bytes // per_partition))


#: Rows that are worth a task of their own.
ROWS_PER_TASK = 50_000


def few_tasks(df: DataFrame, n_rows: int) -> DataFrame:
    """``df`` read by as many tasks as its ``n_rows`` are worth, if those are fewer than it has shuffle partitions."""
    n = partitions_for(n_rows, ROWS_PER_TASK)
    return df.coalesce(n) if n < int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def byte_slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch into runs of rows holding at most ``limit`` bytes (one row at least)."""
    values = batch.column(batch.schema.get_field_index(column))
    if batch.num_rows == 0:
        return
    ends = np.cumsum(np.diff(np.frombuffer(values.buffers()[1], dtype=np.int32)[values.offset :][: len(values) + 1]))
    start, base = 0, 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start, base = stop, int(ends[stop - 1])


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (multiply and xor-shift rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def pack(**columns) -> bytes:
    """Equal-length arrays as one Arrow IPC message: thousands of small values cross a shuffle as one row."""
    batch = pa.record_batch({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(blob: bytes) -> pa.RecordBatch:
    """The columns that :func:`pack` stored."""
    with pa.ipc.open_stream(blob) as reader:
        return reader.read_next_batch()


def release_memory() -> None:
    """Give freed memory back to the system.

    Python workers live on between stages; what their allocators keep would count beside the next stage's memory.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def releasing(run: Callable) -> Callable:
    """An Arrow map function that releases its worker's memory when a task ends."""

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return inner


@contextmanager
def arrow_batches(spark: SparkSession, n_bytes: int) -> Iterator[None]:
    """Jobs started inside the block hand at most ``n_bytes`` at a time to Python workers (one row at least)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(n_bytes))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Start index of each run of equal values in a sorted array."""
    if len(sorted_values) == 0:
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of texts, A-Z lower-cased, between ASCII white space (space and 9 to 13).

    Returns the distinct words, the words of all texts in a row as indices of
    those, and where each text's words start (one entry more than texts).
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    values = lists.flatten()
    offsets = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists), dtype=np.int64))])
    full = np.asarray(pc.greater(pc.binary_length(values), 0))
    if not full.all():  # white space at an end of a text leaves an empty string there
        offsets = np.concatenate([[0], np.cumsum(full)])[offsets]
        values = values.filter(pa.array(full))
    encoded = values.dictionary_encode()
    return encoded.dictionary, np.asarray(encoded.indices, dtype=np.int64), offsets


def hash_words(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word: its bytes' codes times a random odd number for each place, added up and scrambled."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + n + 1].astype(np.int64)
    size = np.diff(offsets)
    raw = words.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    starts = offsets[:-1] - offsets[0]
    place = np.arange(len(data)) - np.repeat(starts, size)
    weight = mix64(np.arange(1, int(size.max()) + 1, dtype=np.uint64)) | np.uint64(1)
    code = mix64(np.arange(257, 513, dtype=np.uint64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code[data] * weight[place], dtype=np.uint64)])
    return mix64(total[starts + size] - total[starts] + size.astype(np.uint64))


def neutral(docs: DataFrame, *names: str) -> tuple[DataFrame, list[str], Callable[[DataFrame], DataFrame]]:
    """``docs`` with its columns called ``c0, c1, ...``, the new names of ``names``, and the way back.

    The way back takes a frame that has those columns, whatever else it has,
    and gives the columns of ``docs``. In between no column of ``docs`` can
    have the name of one that an operator adds.
    """
    new = [f"c{i}" for i in range(len(docs.columns))]
    at = {c: n for c, n in zip(reversed(docs.columns), reversed(new), strict=True)}
    folded = {c.lower(): n for c, n in at.items()}

    def back(df: DataFrame) -> DataFrame:
        return df.select(*new).toDF(*docs.columns)

    return docs.toDF(*new), [at.get(n) or folded[n.lower()] for n in names], back


def one_row_each(docs: DataFrame, verdict: DataFrame, on: Column, keys: list[str]) -> DataFrame:
    """Rows of ``docs`` matched by ``verdict`` (``keys`` and ``_n_copies``), repeated rows once."""
    joined = docs.join(verdict, on)
    single = joined.where("_n_copies = 1").select(docs.columns)
    return single.unionByName(joined.where("_n_copies > 1").dropDuplicates(keys).select(docs.columns))
