"""Near duplicates by circulant MinHash, banding and exact Jaccard checks.

Two permutations make the whole signature. The first scatters a document's
shingles over a universe of positions; the second, ``pi``, is shifted
circularly by one place per coordinate, so coordinate ``k`` of a shingle at
position ``p`` is ``pi[p + k]``. All coordinates of a shingle are thus one
contiguous stretch of one table, and a signature is the minimum of a few
hundred such stretches.

Signatures are cut into bands; documents that agree in a band share a bucket.
Candidates are checked on their full shingle sets, and links are closed to
components. No bucket is ever expanded into all its pairs up front:

1. Documents with equal shingle sets are one class; one of them stands for it.
2. Each bucket compares its members with one leader. Verified links give
   components. While buckets still hold members of different components and
   the last leaders found many links, others are tried.
3. What is left - pairs of one bucket but different components - is checked
   completely, in cells of bounded size that give out links only. So no pair
   that shares a bucket stays undecided.

Shingles are 64-bit hashes of their words; class identity is a 128-bit
fingerprint of the set. With 40 bands of 5 rows a pair at the threshold shares
a bucket with probability 1 - 2e-5.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark.llm.common import TEXT_HASH, arrow_batches, byte_slices, few_tasks, hash_words, keyed, mix64, neutral, one_row_each, release_memory, releasing, runs, split_words
from civicspark.llm.components import connected_components
from civicspark.session import materialize, materialize_counted

#: Words in a shingle.
SHINGLE_WORDS = 5
#: Link when 100 * intersection >= PERCENT * union.
PERCENT = 75
BANDS, ROWS = 40, 5
#: Positions that the first permutation scatters shingles over.
UNIVERSE_BITS = 20
#: Seed of the second permutation.
SEED = 20

SLICE_BYTES = 4 << 20
#: Shingles whose stretches are gathered at a time.
_GATHER = 4096
#: New leaders are tried while they yield this many links per undecided bucket member.
STAR_YIELD = 0.05
#: Shingles on either side of a cell in which pairs across components are compared.
CELL_SHINGLES = 1 << 17
#: Sets on either side, on average: a cell counts common shingles in a matrix of rows by rows.
CELL_ROWS = 4096
_COLUMNS = 2048
#: Bytes handed to a Python worker at a time.
BATCH_BYTES = 16 << 20
#: Rows whose counts are compared with the bound at a time.
_STRIP = 256

_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted, in a row, and where each text's start.

    A text of fewer words than ``width`` has its whole sequence as one
    shingle; a text without words has none.
    """
    words, codes, offsets = split_words(texts)
    h = mix64(hash_words(words))[codes] if len(codes) else np.zeros(0, np.uint64)
    n = np.diff(offsets)

    def chain(first: np.ndarray, length: int) -> np.ndarray:
        acc = np.full(len(first), length, dtype=np.uint64)
        for i in range(length):
            acc = mix64(acc * _STEP + h[first + i])
        return acc

    sets: list[np.ndarray] = []
    full = chain(np.arange(max(0, len(h) - width + 1)), width)
    for i in range(len(n)):
        if n[i] >= width:
            sets.append(np.unique(full[offsets[i] : offsets[i + 1] - width + 1]))
        else:
            sets.append(chain(offsets[i : i + 1], int(n[i])) if n[i] else np.zeros(0, np.uint64))
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)]).astype(np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), starts


@lru_cache(maxsize=2)
def _stretches(length: int) -> np.ndarray:
    """Row ``p`` holds ``pi`` at ``p`` and the ``length - 1`` places after it, round the end."""
    pi = np.random.default_rng(SEED).permutation(1 << UNIVERSE_BITS).astype(np.uint32)
    return sliding_window_view(np.concatenate([pi, pi[:length]]), length)


def signatures(shingles: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Circulant MinHash signatures, one row per set (all ones for an empty set)."""
    table = _stretches(length)
    position = (mix64(shingles ^ _STEP) >> np.uint64(64 - UNIVERSE_BITS)).astype(np.int64)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    out = np.full((len(starts) - 1, length), np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(position), _GATHER):
        own = owner[at : at + _GATHER]
        first = runs(own)
        low = np.minimum.reduceat(table[position[at : at + _GATHER]], first, axis=0)
        out[own[first]] = np.minimum(out[own[first]], low)
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band; keys of different bands differ."""
    cut = signature.reshape(len(signature), bands, rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), cut.shape[:2]).copy()
    for r in range(rows):
        keys = mix64(keys * _STEP + cut[:, :, r])
    return keys.view(np.int64)


def _fingerprints(shingles: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit sums over each set."""

    def total(x: np.ndarray) -> np.ndarray:
        c = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])
        return (c[starts[1:]] - c[starts[:-1]]).view(np.int64)

    return total(mix64(shingles)), total(mix64(shingles * _STEP + np.uint64(1)))


def sign_documents(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(doc_id, _text_hash, n, f1, f2, bands)``; ``docs`` from :func:`common.keyed`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                shingles, starts = shingle_sets(part.column(2))
                keys = band_keys(signatures(shingles, starts, bands * rows), bands, rows)
                f1, f2 = _fingerprints(shingles, starts)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(starts), dtype=np.int32) * bands), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.diff(starts)), pa.array(f1), pa.array(f2), lists],
                    names=["doc_id", TEXT_HASH, "n", "f1", "f2", "bands"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", TEXT_HASH, "text").mapInArrow(
        releasing(run), f"doc_id {id_type}, {TEXT_HASH} bigint, n bigint, f1 bigint, f2 bigint, bands array<bigint>"
    )


def _sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(node, shingles)`` with the sorted set as bytes, for ``nodes (node, rep, rep_hash, n_rows)``.

    Only the row that stands for a class of several rows can be there twice.
    """
    on = F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col(TEXT_HASH) == F.col("rep_hash"))
    texts = docs.join(nodes, on).select("node", "text", (F.col("n_rows") > 1).alias("several"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                shingles, starts = shingle_sets(part.column(1))
                data = [shingles[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(data, pa.binary()), part.column(2)], names=["node", "shingles", "several"])

    sets = materialize(texts.mapInArrow(releasing(run), "node bigint, shingles binary, several boolean"), "shingle-sets")
    several = sets.where("several").dropDuplicates(["node"])
    return sets.where("NOT several").unionByName(several).drop("several")


def jaccard_at_least(x: bytes, y: bytes, percent: int) -> bool:
    """Whether two sorted sets of 64-bit values reach the similarity."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    place = np.searchsorted(b, a)
    common = int((b[np.minimum(place, len(b) - 1)] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough."""
    with_a = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    with_both = with_a.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            good = [jaccard_at_least(p.as_py(), q.as_py(), percent) for p, q in zip(x, y, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return with_both.mapInArrow(releasing(run), "a bigint, b bigint")


def _similar_sizes(n: Column, m: Column, percent: int) -> Column:
    return F.lit(100) * F.least(n, m) >= F.lit(percent) * F.greatest(n, m)


def _cell_links(percent: int):
    """All links of one cell, minors against everyone, one for each minor and component that it reaches."""

    def run(cell: pa.Table) -> pa.Table:
        minor = np.asarray(cell.column("minor"), dtype=bool)
        node, comp, n = (np.asarray(cell.column(c), dtype=np.int64) for c in ("node", "comp", "n"))
        raw = cell.column("shingles").to_pylist()
        x, y = np.flatnonzero(minor), np.flatnonzero(~minor)
        none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        if not len(x) or not len(y):
            return none
        values = [np.frombuffer(b"".join(raw[i] for i in side), np.uint64) for side in (x, y)]
        owners = [np.repeat(np.arange(len(side)), n[side]) for side in (x, y)]
        shared = np.intersect1d(*values)  # other shingles are in no intersection
        exact = np.float32 if int(n.max()) < 1 << 24 else np.float64  # counts of smaller sets are exact in the narrow one
        common, held = np.zeros((len(x), len(y)), exact), []
        for at in range(0, len(shared), _COLUMNS):
            part = shared[at : at + _COLUMNS]
            held = []
            for side, v, own in zip((x, y), values, owners, strict=True):
                place = np.minimum(np.searchsorted(part, v), len(part) - 1)
                has = part[place] == v
                table = np.zeros((len(side), len(part)), np.float32)
                table[own[has], place[has]] = 1
                held.append(table)
            common += held[0] @ held[1].T
        del held, values, owners, raw
        found = []
        for at in range(0, len(x), _STRIP):
            strip = x[at : at + _STRIP]
            # 100 * common >= percent * (n_x + n_y - common), in integers
            close = (100 + percent) * common[at : at + _STRIP].astype(np.int64) >= percent * (n[strip][:, None] + n[y][None, :])
            rows, columns = np.nonzero(close & (comp[strip][:, None] != comp[y][None, :]))
            found.append((rows + at, columns))
        i, j = (np.concatenate(side) for side in zip(*found, strict=True))
        _, once = np.unique(np.stack([i, comp[y][j]]), axis=1, return_index=True)
        del common, close
        release_memory()
        return pa.table({"a": pa.array(node[x][i[once]]), "b": pa.array(node[y][j[once]])})

    return run


def _across(members: DataFrame, n_members: int, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components that share a bucket, completely.

    ``members`` is ``(band, node, n, comp, main)``, ``main`` the bucket's
    largest component. Buckets with one main component are put together, so a
    class that agrees with a cloud of copies in many bands is compared once;
    members of the main component need no comparison among themselves. Clouds
    are cut into cells by the size and number of their sets, and only the links leave a cell.
    """
    cloud = members.groupBy("main", "node").agg(F.max("n").alias("n"), F.max("comp").alias("comp"))
    cloud, n_cloud = materialize_counted(few_tasks(cloud, n_members), "clouds")
    minor = F.col("comp") != F.col("main")
    sides = {"all": F.lit(True), "minors": minor}
    sizes = (F.sum(F.when(of, x).otherwise(0)).alias(f"{c}_{k}") for c, of in sides.items() for k, x in (("n", F.col("n")), ("rows", F.lit(1))))
    blocks = cloud.groupBy("main").agg(*sizes)
    cuts = {c: F.greatest(F.col(f"{c}_n") / F.lit(CELL_SHINGLES), F.col(f"{c}_rows") / F.lit(CELL_ROWS)) for c in sides}
    blocks = blocks.select("main", *(F.ceil(cut).cast("int").alias(c) for c, cut in cuts.items()))
    blocks = materialize(few_tasks(blocks, n_members).where("minors > 0"), "cloud-blocks")
    placed = few_tasks(cloud.join(blocks, "main"), n_cloud)

    def block(count: str, salt: int) -> Column:
        return F.pmod(F.xxhash64(F.col("node"), F.lit(salt)), F.col(count)).cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    cols = ["main", "node", "n", "comp"]
    minors = placed.where(minor).select(*cols, F.lit(True).alias("minor"), block("minors", 1).alias("p"), every("all").alias("q"))
    others = placed.select(*cols, F.lit(False).alias("minor"), block("all", 2).alias("q"), every("minors").alias("p"))
    cells = minors.unionByName(others).join(sets, "node").select("main", "p", "q", "minor", "node", "n", "comp", "shingles")
    return cells.groupBy("main", "p", "q").applyInArrow(_cell_links(percent), "a bigint, b bigint")


def _link(buckets: DataFrame, n_members: int, sets: DataFrame, percent: int) -> DataFrame:
    """``(node, comp)`` of the classes that have a link.

    ``buckets`` is ``(band, node, n, a, a_n)``: the members of shared buckets,
    each beside its bucket's first leader.
    """
    members = buckets.select("band", "node", "n")
    tried = buckets.where((F.col("node") != F.col("a")) & _similar_sizes(F.col("n"), F.col("a_n"), percent))
    links, turn = None, 0
    while True:
        found = _verified(tried.select("a", F.col("node").alias("b")).distinct(), sets, percent)
        found, n_found = materialize_counted(found, "links")
        links = found if links is None else links.unionByName(found)
        comps = connected_components(links)
        turn += 1

        # Buckets that still hold several components, with the largest one and the next leader.
        members = few_tasks(members.join(comps, "node", "left"), n_members).withColumn("comp", F.coalesce("comp", "node"))
        members = materialize(members.select("band", "node", "n", "comp"), "bucket-members")
        one = F.struct(F.xxhash64(F.col("node"), F.lit(turn)).alias("o"), "node", "n", "comp")
        per_comp = few_tasks(members.groupBy("band", "comp").agg(F.count(F.lit(1)).alias("k"), F.min(one).alias("l")), n_members)
        largest = F.max(F.struct("k", (-F.col("comp")).alias("c")))
        bands = per_comp.groupBy("band").agg(F.count(F.lit(1)).alias("comps"), largest.alias("m"), F.min("l").alias("l"))
        bands = bands.where("comps > 1").select(
            "band", (-F.col("m.c")).alias("main"), F.col("l.node").alias("a"), F.col("l.n").alias("a_n"), F.col("l.comp").alias("a_comp")
        )
        bands = materialize(few_tasks(bands, n_members), "undecided-bands")
        members, n_members = materialize_counted(few_tasks(members.join(bands, "band"), n_members), "undecided-members")
        if n_members == 0:
            return comps
        if n_found < STAR_YIELD * n_members:
            break
        tried = members.where((F.col("comp") != F.col("a_comp")) & _similar_sizes(F.col("n"), F.col("a_n"), percent))
        members = members.select("band", "node", "n")
    found, n_found = materialize_counted(_across(members, n_members, sets, percent), "links")
    return connected_components(links.unionByName(found)) if n_found else comps


def _grouped(rows_in: DataFrame, percent: int, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """Written signatures of all rows, and ``(n, f1, f2, _group, component_id)`` of every class of equal sets."""
    signed = materialize(sign_documents(rows_in, bands, rows), "signatures")
    same = ["n", "f1", "f2"]
    classes = signed.where("n > 0").groupBy(*same).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", TEXT_HASH)).alias("r"), F.count(F.lit(1)).alias("n_rows"), F.first("bands").alias("bands")
    )
    classes = materialize(
        classes.select(F.monotonically_increasing_id().alias("node"), *same, F.col("r.doc_id").alias("rep"), F.col(f"r.{TEXT_HASH}").alias("rep_hash"), "n_rows", "bands"),
        "classes",
    )
    members = classes.select("node", "n", F.explode("bands").alias("band"))
    # Written before they are joined, the leaders are a plain shuffle beside a hot bucket, so that AQE can split it.
    leaders = members.groupBy("band").agg(F.count(F.lit(1)).alias("k"), F.min(F.struct("node", "n")).alias("l")).where("k > 1")
    leaders = materialize(leaders.select("band", F.col("l.node").alias("a"), F.col("l.n").alias("a_n")), "leaders")
    buckets, n_members = materialize_counted(members.join(leaders, "band"), "buckets")
    in_buckets = few_tasks(buckets.select("node").distinct(), n_members)
    sets = _sets_of(rows_in, classes.join(in_buckets, "node", "left_semi").select("node", "rep", "rep_hash", "n_rows"))
    comps = _link(buckets, n_members, sets, percent)

    placed = classes.select("node", *same, "rep").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    # Written first, the components are a plain shuffle beside a hot one, so that AQE can split it.
    smallest = materialize(placed.groupBy("comp").agg(F.min("rep").alias("component_id")), "components")
    placed = materialize(placed.join(smallest, "comp").select(*same, F.col("comp").alias("_group"), "component_id"), "class-components")
    return signed, placed


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept`` (and ``_text_hash, _group``).

    Words are split at ASCII white space after lower-casing A-Z; a set holds
    the distinct 5-word shingles, the whole sequence if there are fewer words.
    Without words or text the set is empty and linked with nothing.
    ``component_id`` is the smallest ``doc_id`` reachable over links; a null
    ``doc_id`` is never the smallest. ``_group`` numbers the components that
    have shingles. Rows that repeat id and text share one verdict. Very long
    texts are compared by their whole sets. Other columns are ignored, whatever
    their names; an empty table gives an empty result.
    """
    with arrow_batches(docs.sparkSession, BATCH_BYTES):  # pairs of whole sets are large rows
        signed, placed = _grouped(keyed(docs, id_col, text_col), percent, bands, rows)
    same = ["n", "f1", "f2"]
    out = signed.select("doc_id", TEXT_HASH, *same).join(placed, same, "left")
    empty = F.col("n") == 0
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (empty | F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept"),
        TEXT_HASH,
        "_group",
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names: one of each component, and every document without words.

    A null text has no words; a null id is never the smallest of a component
    that has another. Of rows that repeat id and text one stays. Very long
    texts are compared whole. An empty table gives an empty result.
    """
    plain, (doc_id, text), back = neutral(docs, id_col, text_col)
    kept = near_groups(plain, doc_id, text, percent).where("kept")
    one = kept.where("n_shingles > 0").groupBy("_group", "doc_id").agg(F.min(TEXT_HASH).alias(TEXT_HASH))
    rows = kept.groupBy("doc_id", TEXT_HASH).agg(F.count(F.lit(1)).alias("_n_copies"), F.max("n_shingles").alias("n"))
    r = one.select(F.col("doc_id").alias("_o_id"), F.col(TEXT_HASH).alias("_o_hash"))
    chosen = rows.join(r, F.col("doc_id").eqNullSafe(F.col("_o_id")) & (F.col(TEXT_HASH) == F.col("_o_hash")), "left")
    chosen = chosen.where("n = 0 OR _o_hash IS NOT NULL")
    verdict = chosen.select(
        F.col("doc_id").alias("_k_id"), F.col(TEXT_HASH).alias("_k_hash"), F.when(F.col("n") == 0, 1).otherwise(F.col("_n_copies")).alias("_n_copies")
    )
    on = F.col(doc_id).eqNullSafe(F.col("_k_id")) & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col("_k_hash"))
    return back(one_row_each(plain, verdict, on, ["_k_id", "_k_hash"]))
