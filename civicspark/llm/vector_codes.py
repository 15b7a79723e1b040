"""Vector code compression: product quantisation whose rounds skip most distances by norm-of-sum bounds.

A vector is cut into equal parts; each part position has a codebook of
entries, and a vector is stored as the index of the nearest entry of every
part. Codebooks are fitted by rounds of assigning and averaging (Lloyd) over
all vectors, in integers, so results are exact and the same in any layout.

Method. The entries of a codebook are dealt into groups. Per vector, part and
group a lower bound of the distance to the group's entries (but the assigned
one) is kept with the round it was computed in, its stamp. All earlier
codebooks are kept, so a bound stamped in round s is lowered in round t by the
greatest *net* displacement ``|entry(t) - entry(s)|`` of its group: the norm of
the sum of the moves, never more than the sum of their norms that bounds
lowered round by round accumulate. A group whose lowered bound exceeds the
distance to the best entry so far cannot hold the nearest one; the others are
scanned again exactly and their bound gets the present stamp. Bounds are
rounded down and displacements up, and only a strictly greater bound skips a
group, so ties still go to the lower index.

Scale. A round is one map that reads the last state (integers, codes, bounds,
stamps) and writes the next, and one aggregation of the entries' sums, to
which a task sends one row per part and entry, however many vectors it has.
Codebooks (entries x dimension) pass through the driver; nothing else does.
The state before is deleted when the next is written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark.llm.common import releasing
from civicspark.operators.joins import lookup
from civicspark.session import delete_path, materialize, scratch_path

#: Components are integers of 1/SCALE.
SCALE = 1024
#: Components beyond this do not fit: squared distances stay below 2**63 in 64 dimensions and more.
LARGEST = 2**27
#: Entries of a group that share one bound.
GROUP = 32
#: Bytes of integer components worked on at a time.
SLICE_BYTES = 8 << 20


@dataclass(frozen=True)
class Compression:
    """Parameters: parts of a vector, entries of a codebook (256 at most), rounds (255 at most: a stamp is a byte)."""

    parts: int = 4
    entries: int = 256
    rounds: int = 4

    def __post_init__(self) -> None:
        if not (self.parts >= 1 and 1 <= self.entries <= 256 and 0 <= self.rounds <= 255):
            raise ValueError("at least one part, 1 to 256 entries, 0 to 255 rounds")


# -- exact distances and bounds, within a task ------------------------------------


def squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances between rows of integers, as int64."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * top * top * max(1, x.shape[1]) < 1 << 53:  # doubles hold every term
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in entries], axis=1)


def groups_of(n_entries: int) -> list[slice]:
    return [slice(at, min(at + GROUP, n_entries)) for at in range(0, n_entries, GROUP)]


def net_moves(history: np.ndarray) -> np.ndarray:
    """``[stamp, part, group]``: how far any entry of the group is now from where it was then, rounded up.

    ``history`` is ``[round, part, entry, position]``, the last round being now.
    """
    apart = np.sqrt((((history[-1][None] - history).astype(np.float64)) ** 2).sum(-1)) * (1 + 1e-9)
    return np.stack([apart[:, :, g].max(-1) for g in groups_of(history.shape[2])], axis=-1)


@dataclass
class Scan:
    """How many (vector, part, group) scans there were, and how many were skipped (for tests and measurements)."""

    scanned: int = 0
    skipped: int = 0


def assign(
    x: np.ndarray, history: np.ndarray, code: np.ndarray, low: np.ndarray, stamp: np.ndarray, seen: Scan | None = None
) -> np.ndarray:
    """Move ``code``, ``low`` and ``stamp`` (changed in place) to the last round of ``history``; squared distances per part.

    ``x`` is ``[vector, part, position]``, ``code`` ``[vector, part]``, ``low``
    and ``stamp`` ``[vector, part, group]``. Before the first round ``low`` is
    negative, which makes every group be scanned, and ``code`` is any entry.
    """
    now, moves = len(history) - 1, net_moves(history)
    found = np.empty(code.shape, np.int64)
    for p in range(x.shape[1]):
        entries, groups = history[now, p], groups_of(history.shape[2])
        part, old = x[:, p], code[:, p].astype(np.int64)
        own = ((part - entries[old]) ** 2).sum(1)
        best, who = own.copy(), old.copy()
        lowered = low[:, p].astype(np.float64) - moves[stamp[:, p], p, np.arange(len(groups))]
        first = np.full(lowered.shape, -1, np.int64)  # of scanned groups: the nearest entry and the two least distances
        least, second = np.zeros(lowered.shape, np.int64), np.zeros(lowered.shape, np.int64)
        for g, of in enumerate(groups):
            rows = np.flatnonzero(~(lowered[:, g] > np.sqrt(best.astype(np.float64)) * (1 + 1e-9)))
            if seen is not None:
                seen.scanned, seen.skipped = seen.scanned + len(rows), seen.skipped + len(x) - len(rows)
            if not len(rows):
                continue
            apart = squares(part[rows], entries[of])
            at = apart.argmin(1)
            nearest = apart[np.arange(len(rows)), at]
            first[rows, g], least[rows, g] = at + of.start, nearest
            if apart.shape[1] > 1:
                apart[np.arange(len(rows)), at] = np.iinfo(np.int64).max
                second[rows, g] = apart.min(1)
            else:
                second[rows, g] = np.iinfo(np.int64).max
            better = (nearest < best[rows]) | ((nearest == best[rows]) & (at + of.start < who[rows]))
            best[rows[better]], who[rows[better]] = nearest[better], at[better] + of.start
        scanned = first >= 0
        bound = np.sqrt(np.where(first == who[:, None], second, least).astype(np.float64))
        # A group that was not scanned keeps bound and stamp, unless it takes back the entry that was assigned before.
        back = ~scanned & (np.arange(len(groups)) == (old // GROUP)[:, None]) & (who != old)[:, None]
        bound = np.where(back, np.minimum(lowered, np.sqrt(own.astype(np.float64))[:, None]), bound)
        fresh = scanned | back
        low[:, p] = np.where(fresh, bound * (1 - 1e-6), low[:, p])
        stamp[:, p] = np.where(fresh, now, stamp[:, p])
        code[:, p], found[:, p] = who, best
    return found


# -- Spark ---------------------------------------------------------------------------


def _usable(vector: Column) -> Column:
    """Not null or empty, every component finite and within the range; NaN sorts above every number."""
    within = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) * SCALE < float(LARGEST)))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & within, F.lit(False))


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label") -> DataFrame:
    """``vec_id, label, x`` of the rows that can be coded; ``x`` holds ``floor(1024 * component)``."""
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    x = F.transform(vec_col, lambda c: F.floor(c.cast("double") * SCALE).cast("int"))
    return vectors.where(_usable(F.col(vec_col))).select(F.col(id_col).alias("vec_id"), label.alias("label"), x.alias("x"))


def _slices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    step = max(1, SLICE_BYTES // (8 * dim))
    for whole in batches:
        for at in range(0, whole.num_rows, step):
            batch = whole.slice(at, step)
            yield batch, np.asarray(batch.column("x").flatten(), dtype=np.int64).reshape(batch.num_rows, -1)


def _packed(column: pa.Array, dtype: str, shape: tuple) -> np.ndarray:
    """Equally long binaries as one array of its own."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(shape).copy()


def _binary(values: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(values).reshape(len(values), -1)
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _advance(history: np.ndarray, dim: int, last: bool) -> Callable:
    """A map from one state to the next; the last one gives codes and errors only."""
    parts, groups = history.shape[1], len(groups_of(history.shape[2]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _slices(batches, dim):
            n = batch.num_rows
            if "code" in batch.schema.names:
                code = _packed(batch.column("code"), "u1", (n, parts))
                low = _packed(batch.column("low"), "<f4", (n, parts, groups))
                stamp = _packed(batch.column("stamp"), "u1", (n, parts, groups))
            else:
                code, stamp = np.zeros((n, parts), np.uint8), np.zeros((n, parts, groups), np.uint8)
                low = np.full((n, parts, groups), -1, np.float32)
            found = assign(x.reshape(n, parts, -1), history, code, low, stamp)
            columns = {c: batch.column(c) for c in ("vec_id", "label")} | {"code": _binary(code)}
            if last:
                yield pa.record_batch(columns | {"error": pa.array(found.sum(1))})
            else:
                yield pa.record_batch(columns | {"x": batch.column("x"), "low": _binary(low), "stamp": _binary(stamp)})

    return releasing(run)


def _entry_sums(dim: int, parts: int, entries: int) -> Callable:
    """A map to one row per part and entry of a task: how many vectors it has, and the sum of each position."""
    width = dim // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries * width), np.int64)
        for batch, x in _slices(batches, dim):
            code = _packed(batch.column("code"), "u1", (batch.num_rows, parts)).astype(np.int64)
            for p in range(parts):
                counts[p] += np.bincount(code[:, p], minlength=entries)
                at = (code[:, p, None] * width + np.arange(width)).ravel()
                of = x[:, p * width : (p + 1) * width].ravel().astype(np.float64)  # exact: a slice sums to less than 2**53
                sums[p] += np.bincount(at, of, entries * width).astype(np.int64)
        part, entry = np.nonzero(counts)
        total = pa.array(list(sums.reshape(parts, entries, width)[part, entry]), pa.list_(pa.int64()))
        yield pa.record_batch({"part": pa.array(part, pa.int32()), "entry": pa.array(entry, pa.int32()), "n": pa.array(counts[part, entry]), "total": total})

    return releasing(run)


def _next_codebooks(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """Every entry replaced by the floor of its vectors' mean; unused ones stay."""
    parts, entries, width = books.shape
    partial = state.select("x", "code").mapInArrow(_entry_sums(parts * width, parts, entries), "part int, entry int, n bigint, total array<bigint>")
    sums = [F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(width)]
    books = books.copy()
    for r in partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect():  # parts x entries rows at most
        books[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    return books


@dataclass(frozen=True)
class Compressed:
    """``codes`` (``vec_id, label, code, error``) and the final codebooks ``[part, entry, position]`` in integers."""

    codes: DataFrame
    codebooks: np.ndarray

    def codebooks_sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    how: Compression | None = None,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str | None = "label",
) -> Compressed:
    """Fit codebooks on all vectors and code each: ``code`` is one byte per part, ``error`` the squared distance.

    Codebooks start as the parts of the vectors with the smallest ids (fewer
    vectors than entries: smaller codebooks). Rows that cannot be coded are
    left out: a null or empty vector, a null or non-finite component, one
    beyond 2**27/1024 either way, and a vector whose length differs from that
    of the smallest id. A length that the parts do not divide is an error. A
    null id is a valid row, after all others in order; rows with equal ids are
    ordered by their vectors; repeated rows are coded each. Other columns,
    whatever their names, are ignored; an empty table gives no codes and
    empty codebooks.
    """
    how = how or Compression()
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, id_col, vec_col, label_col)
    by_id = (F.col("vec_id").asc_nulls_last(), F.col("x"))
    types = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    first = rows.orderBy(*by_id).select("x").first()
    if first is None:
        return Compressed(spark.createDataFrame([], f"{types}, code binary, error bigint"), np.zeros((how.parts, 0, 0), np.int64))
    dim = len(first["x"])
    if dim % how.parts:
        raise ValueError(f"vectors of {dim} components cannot be cut into {how.parts} equal parts")
    rows = rows.where(F.size("x") == dim)
    start = np.array([r["x"] for r in rows.orderBy(*by_id).select("x").limit(how.entries).collect()], np.int64)
    history = start.reshape(1, len(start), how.parts, -1).transpose(0, 2, 1, 3)

    state, path = rows, None
    for _ in range(how.rounds):
        before, path = path, scratch_path(spark, "vector-state")
        state.mapInArrow(_advance(history, dim, last=False), f"{types}, code binary, x array<int>, low binary, stamp binary").write.parquet(path)
        if before is not None:
            delete_path(spark, before)
        state = spark.read.parquet(path)
        history = np.concatenate([history, _next_codebooks(state, history[-1])[None]])
    codes = materialize(state.mapInArrow(_advance(history, dim, last=True), f"{types}, code binary, error bigint"), "vector-codes")
    if path is not None:
        delete_path(spark, path)
    return Compressed(codes, history[-1])


def label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``, the error summed over equal labels (nulls together).

    Labels are added up with partial sums, then looked up: by a broadcast if
    they are few, else with labels that hold many rows split off.
    """
    per_label = materialize(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    return lookup(codes, per_label, [], ["label"], ["label_error"])


def decode(codes: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """``vec_id`` and ``vector``, the entries that the code names, as numbers again."""
    kind = codes.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = _packed(batch.column("code"), "u1", (batch.num_rows, len(codebooks)))
            near = np.concatenate([codebooks[p, code[:, p]] for p in range(len(codebooks))], axis=1) / SCALE
            yield pa.record_batch({"vec_id": batch.column("vec_id"), "vector": pa.array(list(near), pa.list_(pa.float64()))})

    return codes.select("vec_id", "code").mapInArrow(releasing(run), f"vec_id {kind}, vector array<double>")
