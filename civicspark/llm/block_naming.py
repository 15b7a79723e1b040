"""Exact duplicates by deterministic block naming.

Texts are cut into fixed-size blocks. The distinct blocks of the corpus are
sorted and get integer names; then the names of adjacent blocks are paired,
the distinct pairs are sorted and named, and so on until every document is one
name. Two documents end with the same (level, name) exactly if their texts are
equal: unlike a hash, a name is never given to two different contents.

Block contents cross one shuffle, pre-aggregated, to be told apart and named.
Each occurrence then fetches its name by the block's 64-bit hash, which is
checked to be unique among the distinct blocks; blocks whose hash is not are
named and fetched by content instead. Both sides of these joins are plain
shuffles of integers, which AQE splits where one block is held by very many
documents. A document leaves the loop as soon as one name is left, so after
the first level only texts longer than a block move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark.llm.common import TEXT_HASH, ascii_lower, keyed, neutral, one_row_each
from civicspark.session import materialize

#: Bytes in a block.
BLOCK_BYTES = 4096

_KEY = ["doc_id", TEXT_HASH]


def _join_on_key(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on the row identity; a null doc_id equals a null doc_id."""
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in _KEY})
    on = (F.col("doc_id").eqNullSafe(F.col("_r_doc_id"))) & (F.col(TEXT_HASH) == F.col(f"_r_{TEXT_HASH}"))
    return left.join(r, on, how).drop(*(f"_r_{k}" for k in _KEY))


def _named(distinct: DataFrame, cols: list[str]) -> DataFrame:
    """Sorted distinct values with unique integer names.

    The distinct values are hash-dealt already; sorting inside each partition
    and numbering by (partition, position) names them without one global sort.
    """
    return distinct.sortWithinPartitions(*cols).withColumn("name", F.monotonically_increasing_id())


def _block_names(occurrences: DataFrame) -> DataFrame:
    """``(key, pos, last, name)`` of block occurrences ``(key, pos, last, block, h)``."""
    names = _named(occurrences.select("block", "h").distinct(), ["block"]).select("h", "name")
    names = materialize(names, "block-names")
    shared = names.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    cols = [*_KEY, "pos", "last", "name"]
    if shared.isEmpty():
        return occurrences.drop("block").join(names, "h").select(cols)
    shared = materialize(shared, "block-shared-hashes")
    by_content = occurrences.join(shared, "h", "left_semi")
    own = _named(by_content.select("block").distinct(), ["block"])
    own = materialize(own.withColumn("name", -1 - F.col("name")), "block-names-by-content")
    by_hash = occurrences.drop("block").join(shared, "h", "left_anti").join(names, "h")
    return by_hash.select(cols).unionByName(by_content.join(own, "block").select(cols))


def _blocks(docs: DataFrame, block_bytes: int, hash_bits: int) -> DataFrame:
    """``(key, pos, last, block, h)`` for every block; an empty text is one empty block."""
    data = F.encode("text", "utf-8")
    n = F.greatest(F.lit(1), F.ceil(F.octet_length("text") / F.lit(block_bytes)).cast("int"))

    def cut(i: Column) -> Column:
        return F.substring(F.col("data"), i * block_bytes + 1, F.lit(block_bytes))

    return (
        docs.select(*_KEY, data.alias("data"), n.alias("n"))
        .select(*_KEY, (F.col("n") - 1).alias("last"), F.posexplode(F.transform(F.sequence(F.lit(0), F.col("n") - 1), cut)).alias("pos", "block"))
        .withColumn("h", F.shiftrightunsigned(F.xxhash64("block"), 64 - hash_bits))
    )


def name_documents(docs: DataFrame, block_bytes: int = BLOCK_BYTES, hash_bits: int = 64) -> DataFrame:
    """``(doc_id, _text_hash, level, name)``, one row per distinct document of ``docs``.

    ``docs`` comes from :func:`common.keyed` with normalised texts.
    ``hash_bits`` shortens the block hash, to try the path for shared hashes.
    """
    symbols = materialize(_block_names(_blocks(docs, block_bytes, hash_bits)), "block-symbols-0")
    done, level = None, 0
    while True:
        ended = symbols.where("last = 0").select(*_KEY, F.lit(level).alias("level"), "name").distinct()
        done = ended if done is None else done.unionByName(ended)
        going = symbols.where("last > 0")
        if going.isEmpty():
            return done
        # Left and right neighbour of each pair; the odd one out has no right one.
        side = F.col("pos") % 2
        pairs = going.groupBy(*_KEY, (F.col("pos") / 2).cast("int").alias("pos"), (F.col("last") / 2).cast("int").alias("last")).agg(
            F.max(F.when(side == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(side == 1, F.col("name"))), F.lit(-1)).alias("right"),
        )
        pairs = materialize(pairs, f"block-pairs-{level}")
        names = materialize(_named(pairs.select("left", "right").distinct(), ["left", "right"]), f"pair-names-{level}")
        symbols = materialize(pairs.join(names, ["left", "right"]).select(*_KEY, "pos", "last", "name"), f"block-symbols-{level + 1}")
        level += 1


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, hash_bits: int = 64
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256, n_copies``.

    Texts are equal when identical after lower-casing A-Z; a null text is
    empty. Of equal texts the largest ``doc_id`` is ``keep_id`` and ``kept``.
    ``group_size`` counts rows. A null ``doc_id`` is smaller than every other;
    a group of nulls only keeps its nulls. Rows that repeat id and text
    (``n_copies`` of them) share one verdict. Other columns are ignored,
    whatever their names; very long texts are cut into blocks like all others.
    An empty table gives an empty result.
    """
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    normal = keyed(docs.select(F.col(id_col).alias("doc_id"), text.alias("text")))
    identity = materialize(name_documents(normal, block_bytes, hash_bits), "doc-names")
    rows = normal.select(*_KEY, F.sha2("text", 256).alias("text_sha256"))
    named = materialize(_join_on_key(rows, identity), "doc-rows")
    groups = named.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # Written first, the few groups of several rows are a plain shuffle beside a hot group, which AQE can then split.
    several = materialize(groups.where("group_size > 1"), "equal-groups")
    copies = named.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n_copies")).where("n_copies > 1")
    out = _join_on_key(named.join(several, ["level", "name"], "left"), copies, "left")
    single = F.col("group_size").isNull()
    out = out.withColumn("keep_id", F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")))
    return out.select(
        "doc_id",
        "keep_id",
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
        F.coalesce("n_copies", F.lit(1).cast("bigint")).alias("n_copies"),
        F.col(TEXT_HASH),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_groups` keeps, one row of each, with all their columns, whatever their names.

    Rows that repeat id and text differ at most in other columns; any one of
    them stays. A null text is empty; a null id is smaller than every other.
    Very long texts are cut into blocks like all others. An empty table gives
    an empty result.
    """
    plain, (doc_id, text), back = neutral(docs, id_col, text_col)
    groups = exact_groups(plain, doc_id, text, block_bytes).where("kept")
    verdict = groups.groupBy(*_KEY).agg(F.max("n_copies").alias("_n_copies"))
    verdict = verdict.withColumnsRenamed({"doc_id": "_k_id", TEXT_HASH: "_k_hash"})
    low = F.xxhash64(ascii_lower(F.coalesce(F.col(text), F.lit(""))))
    on = F.col(doc_id).eqNullSafe(F.col("_k_id")) & (F.col("_low_hash") == F.col("_k_hash"))
    return back(one_row_each(plain.withColumn("_low_hash", low), verdict, on, ["_k_id", "_k_hash"]))
