"""Benchmark decontamination by a prefix-filtered set join.

Every benchmark item is cut into windows of 13 words. To occur in a document,
a window needs all of its words there, so the prefix that a set join has to
look up is a single word: the window's rarest, by how often the corpus holds
each benchmark word. Document words are probed against those prefix words
only; a match fixes where the window would start, which must lie inside the
document (positional bound) with room for the whole window (length bound), and
is then compared word for word. While the prefix words are few enough to be
broadcast, nothing leaves a task but verified starts. Beyond, a bit map of
their hashes (of a fixed size, so it may be broadcast) rules out almost all
document words first, and a word that is left crosses the shuffle with the
words that a window through it could cover, never with its document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark.llm.common import TEXT_HASH, ascii_lower, keyed, neutral
from civicspark.session import materialize, tuning

#: Words in a window.
WINDOW = 13
#: A document is contaminated when at least one word in this many is hit.
HIT_SHARE = 20

#: Windows (and benchmark words) up to which the small side is broadcast; beyond it the join is a shuffle.
BROADCAST_ROWS = 500_000

#: Bits of the map of prefix words, a multiple of the 32,768 that Spark's bit map functions put together.
MAP_BITS = 1 << 23

#: What lies between words: ASCII other than letters and digits.
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text after lower-casing A-Z; null and empty have none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _SEPARATORS), "")


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """``(window_id, words, len, items)``: distinct windows and the items that hold them."""
    words = words_of(F.col(text_col))
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), words.alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("w") - window))
    cut = items.select("item", "w", F.explode(starts).alias("at")).select("item", F.slice("w", F.col("at") + 1, window).alias("words"))
    grouped = cut.groupBy("words").agg(F.collect_set("item").alias("items"))
    return grouped.select(F.monotonically_increasing_id().alias("window_id"), "words", F.size("words").alias("len"), "items")


def _is_small(df: DataFrame, n: int) -> bool:
    return n <= tuning(df.sparkSession, "decontaminateBroadcastRows", BROADCAST_ROWS)


_PER_BUCKET = 32_768  # bits of one of Spark's bit maps


def _bit(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(MAP_BITS))


def _word_map(probes: DataFrame) -> bytes:
    """One bit for every prefix word's hash; the driver gets ``MAP_BITS`` bits at most, however many words there are."""
    bit = _bit(F.col("word")) + 1  # buckets count from 1
    parts = probes.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    whole = bytearray(MAP_BITS // 8)
    for r in parts.collect():
        at = (r["bucket"] - 1) * _PER_BUCKET // 8
        whole[at : at + len(r["bits"])] = r["bits"]
    return bytes(whole)


def _shuffled_hits(cut: DataFrame, probes: DataFrame, window: int) -> DataFrame:
    """The hits of ``cut`` (``doc_id, _text_hash, words``) when the windows are too many to broadcast."""
    bits = F.lit(_word_map(probes))

    def may_be_prefix(word: Column) -> Column:
        bit = _bit(word)
        byte = F.conv(F.hex(F.substring(bits, (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.floor(byte / F.pow(F.lit(2), bit % 8)) % 2 == 1

    # Of a word that may start a match: its place, the words before it that a window may begin with, and those from it on.
    placed = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("pos"), w.alias("word"))), lambda p: may_be_prefix(p["word"]))
    near = F.transform(
        placed,
        lambda p: F.struct(
            p["pos"].alias("pos"),
            p["word"].alias("word"),
            F.slice("words", F.greatest(p["pos"] - (window - 2), F.lit(1)), F.lit(2 * window - 1)).alias("near"),
        ),
    )
    rows = cut.select("doc_id", TEXT_HASH, F.size("words").alias("n"), F.explode(near).alias("p")).select("doc_id", TEXT_HASH, "n", "p.*")
    start = F.col("pos") - F.col("offset")
    first = F.greatest(F.col("pos") - (window - 1), F.lit(0))  # place of the first word of near
    return (
        rows.join(probes, "word")
        .where((start >= 0) & (start + F.col("len") <= F.col("n")))
        .where(F.slice(F.col("near"), start - first + 1, F.col("len")) == F.col("wanted"))
        .select("doc_id", TEXT_HASH, start.alias("start"), "len", "items")
    )


def window_hits(
    docs: DataFrame, benchmark: DataFrame, item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """``(doc_id, _text_hash, start, len, items)`` for each verified occurrence; ``docs`` from :func:`common.keyed`."""
    windows = materialize(item_windows(benchmark, item_col, item_text_col, window), "item-windows")
    n_windows = windows.count()
    vocabulary = materialize(windows.select(F.explode("words").alias("word")).distinct(), "item-words")
    n_words = vocabulary.count()
    tokens = docs.select(F.explode_outer(words_of(F.col("text"))).alias("word"))
    if _is_small(docs, n_words):
        counts = tokens.join(F.broadcast(vocabulary), "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    else:  # counted before the shuffle join, so that a frequent word is a row a task
        counts = tokens.groupBy("word").agg(F.count(F.lit(1)).alias("n")).join(vocabulary, "word", "left_semi")
    counts = materialize(counts, "item-word-counts")

    # The rarest word of each window, at its first place there.
    placed = windows.select("window_id", F.posexplode("words").alias("offset", "word"))
    ranked = placed.join(counts, "word", "left").groupBy("window_id").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0).cast("bigint")).alias("n"), "word", "offset")).alias("rarest")
    )
    # A word that no document holds rules its windows out.
    prefixes = ranked.where("rarest.n > 0").select("window_id", F.col("rarest.word").alias("word"), F.col("rarest.offset").alias("offset"))
    probes = prefixes.join(windows, "window_id").select("word", "offset", F.col("words").alias("wanted"), "len", "items")
    probes = materialize(probes, "item-probes")

    cut = docs.select("doc_id", TEXT_HASH, words_of(F.col("text")).alias("words"))
    if not _is_small(docs, n_windows):
        return _shuffled_hits(cut, probes, window)
    placed = cut.select("doc_id", TEXT_HASH, "words", F.posexplode_outer("words").alias("pos", "word"))
    start = F.col("pos") - F.col("offset")
    return (
        placed.join(F.broadcast(probes), "word")
        .where((start >= 0) & (start + F.col("len") <= F.size("words")))
        .where(F.slice(F.col("words"), start + 1, F.col("len")) == F.col("wanted"))
        .select("doc_id", TEXT_HASH, start.alias("start"), "len", "items")
    )


def _covered(spans: Column) -> Column:
    """Words covered by an array of ``(start, len)`` sorted by start: a running end and a running sum."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))

    def add(acc: Column, span: Column) -> Column:
        end = span["start"] + span["len"]
        fresh = F.greatest(F.lit(0), end - F.greatest(acc["end"], span["start"]))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + fresh).alias("n"))

    return F.aggregate(spans, zero, add, lambda acc: acc["n"])


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` and ``items``.

    ``items`` lists the ids (as text, sorted) of the items with a window in the
    document; items with a null id hit words but are not listed. Null or empty
    texts have no words; an item without words has no window. Rows that repeat
    id and text get the same verdict each. Very long texts are searched whole.
    Empty tables give no rows, or no hits. Other columns, of both tables and
    whatever their names, are ignored.
    """
    rows = keyed(docs, id_col, text_col)
    words = F.size(words_of(F.col("text"))).cast("bigint")
    nothing = F.lit(None).cast("struct<start:int,len:int,items:array<string>>")
    all_rows = rows.select("doc_id", TEXT_HASH, words.alias("n_words"), nothing.alias("hit"))
    hits = window_hits(rows, benchmark, item_col, item_text_col, window).select(
        "doc_id", TEXT_HASH, F.lit(None).cast("bigint").alias("n_words"), F.struct("start", "len", "items").alias("hit")
    )
    # Verified hits and one row per document meet by key; no join back to the texts.
    merged = all_rows.unionByName(hits).groupBy("doc_id", TEXT_HASH).agg(
        F.max("n_words").alias("n_words"), F.count("n_words").alias("n_rows"), F.collect_set("hit").alias("hits")
    )
    spans = F.array_sort(F.transform("hits", lambda h: F.struct(h["start"].alias("start"), h["len"].alias("len"))))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"]))))
    out = merged.select("doc_id", TEXT_HASH, "n_words", _covered(spans).alias("n_hit"), items.alias("items"), "n_rows")
    return out.select(
        "doc_id",
        TEXT_HASH,
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.lit(HIT_SHARE) * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        "items",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n_rows"))).alias("_copy"),
    ).drop("_copy")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns) -> DataFrame:
    """The rows of ``docs`` that :func:`contamination` leaves, with all their columns, whatever their names.

    A null text has no words and stays; rows with a null id are judged like
    others; repeated rows share a verdict. Very long texts are judged whole.
    An empty table gives an empty result, an empty benchmark drops nothing.
    """
    plain, (doc_id, text), back = neutral(docs, id_col, text_col)
    bad = contamination(plain, benchmark, doc_id, text, **columns).where("contaminated")
    bad = bad.select(F.col("doc_id").alias("_bad_id"), F.col(TEXT_HASH).alias("_bad_hash")).distinct()
    on = F.col(doc_id).eqNullSafe(F.col("_bad_id")) & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col("_bad_hash"))
    return back(plain.join(bad, on, "left_anti"))
