"""Fill-in-middle transformation: a text's middle is moved behind its prefix and suffix.

A text is cut into units (white space and the word behind it; white space at
the end is a unit of its own). Two cut points drawn from the hash of seed and
id part the units into prefix, middle and suffix; half of the texts (by
default) are rearranged so that a left-to-right model learns to fill the
middle in, and the others stay as they are.

Method. Every Arrow batch goes through one ``pyarrow.compute`` pipeline, with
no loop over texts: a separator that no text of the batch holds is put between
units and the texts are split there into list arrays; the lists are flattened
with the index of their parent, units get their ordinal within the parent, the
ordinals are compared with the parent's cut points to select a role's units,
lists are built again from the selected units, and ``binary_join`` makes each
list one piece. The pieces and the markers are joined element by element.

Scale. A map without shuffle. Batches are cut to ``BATCH_BYTES`` of text (a
longer text is a batch of its own), so memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark.llm.common import byte_slices, releasing

#: Text bytes of a batch.
BATCH_BYTES = 2 << 20

#: A unit ends where white space (space, 9 to 13) follows another character.
_UNIT_END = "([^\x20\x09-\x0D])([\x20\x09-\x0D])"


@dataclass(frozen=True)
class FillInMiddle:
    """Parameters: seed of the draws, per cent of texts rearranged, of those per cent suffix-first, and the markers."""

    seed: int = 42
    rate: int = 50
    suffix_first: int = 80
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


def separator(texts: pa.Array) -> str:
    """A character that none of ``texts`` holds: a control character, else the first private one that is free."""
    for code in [30, 31, 28, 29, *range(1, 9), *range(0xE000, 0x110000)]:
        if not pc.any(pc.match_substring(texts, chr(code))).as_py():
            return chr(code)
    raise ValueError("a batch of texts holds every private character")


def units(texts: pa.Array) -> pa.ListArray:
    """The units of each text as a list; an empty text has none."""
    mark = separator(texts)
    lists = pc.split_pattern(pc.replace_substring_regex(texts, _UNIT_END, rf"\1{mark}\2"), mark)
    full = np.asarray(pc.greater(pc.binary_length(texts), 0))
    if full.all():
        return lists
    sizes = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    kept = pc.list_flatten(lists).filter(pa.array(full[np.repeat(np.arange(len(sizes)), sizes)]))
    return pa.ListArray.from_arrays(_offsets(sizes * full), kept)


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())


def pieces(lists: pa.ListArray, low: np.ndarray, high: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Units before ``low``, from ``low`` to ``high`` and from ``high`` on, each joined to one string per list."""
    flat, parent = pc.list_flatten(lists), np.asarray(pc.list_parent_indices(lists))
    sizes = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    ordinal = np.arange(len(flat)) - (np.cumsum(sizes) - sizes)[parent]
    role = (ordinal >= low[parent]).astype(np.int8) + (ordinal >= high[parent])
    joined = []
    for r, counts in enumerate((low, high - low, sizes - high)):
        chosen = flat.filter(pa.array(role == r))
        joined.append(pc.binary_join(pa.ListArray.from_arrays(_offsets(counts), chosen), ""))
    return tuple(joined)


def restore(output: pa.Array, form: pa.Array, how: FillInMiddle) -> pa.Array:
    """The exact texts, rebuilt from outputs and forms alone."""

    def halves(whole: pa.Array, mark: str) -> tuple[pa.Array, pa.Array]:
        split = pc.split_pattern(whole, mark, max_splits=1)
        second = pc.if_else(pc.equal(pc.list_value_length(split), 2), 1, 0)  # rows of other forms may lack the marker
        at = np.asarray(split.offsets)[:-1]
        values = split.values
        return values.take(pa.array(at)), values.take(pa.array(at + np.asarray(second)))

    rest, middle = halves(output, how.middle)
    before_suffix, psm_suffix = halves(rest, how.suffix)
    before_prefix, spm_prefix = halves(rest, how.prefix)
    psm_prefix, spm_suffix = halves(before_suffix, how.prefix)[1], halves(before_prefix, how.suffix)[1]
    is_psm = pc.equal(form, "psm")
    prefix, suffix = pc.if_else(is_psm, psm_prefix, spm_prefix), pc.if_else(is_psm, psm_suffix, spm_suffix)
    return pc.if_else(pc.equal(form, "plain"), output, pc.binary_join_element_wise(prefix, middle, suffix, ""))


def transform(batch: pa.RecordBatch, how: FillInMiddle) -> pa.RecordBatch:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of a batch with ``doc_id, text`` and draws ``h1`` to ``h4``."""
    text = batch.column("text")
    h1, h2, h3, h4 = (np.asarray(batch.column(c), dtype=np.int64) for c in ("h1", "h2", "h3", "h4"))
    lists = units(text)
    n = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    low, high = np.minimum(h1 % (n + 1), h2 % (n + 1)), np.maximum(h1 % (n + 1), h2 % (n + 1))
    prefix, middle, suffix = pieces(lists, low, high)

    marked = np.zeros(len(text), bool)
    for mark in (how.prefix, how.suffix, how.middle):
        marked |= np.asarray(pc.match_substring(text, mark))
    plain = (n == 0) | marked | (h3 % 100 >= how.rate)
    suffix_first = h4 % 100 < how.suffix_first
    form = pc.if_else(pa.array(plain), "plain", pc.if_else(pa.array(suffix_first), "spm", "psm"))

    spm = pc.binary_join_element_wise(how.suffix, suffix, how.prefix, prefix, how.middle, middle, "")
    psm = pc.binary_join_element_wise(how.prefix, prefix, how.suffix, suffix, how.middle, middle, "")
    output = pc.if_else(pa.array(plain), text, pc.if_else(pa.array(suffix_first), spm, psm))

    def chars(piece: pa.Array) -> pa.Array:
        return pc.if_else(pa.array(plain), pa.scalar(None, pa.int64()), pc.cast(pc.utf8_length(piece), pa.int64()))

    columns = {"doc_id": batch.column("doc_id"), "n": pa.array(n), "form": form, "prefix_chars": chars(prefix), "middle_chars": chars(middle), "output": output}
    return pa.record_batch(columns)


def draws(id_col: Column, seed: int) -> list[Column]:
    """``h1`` to ``h4``: the first four 8-digit groups of the hex sha256 of ``seed:id``; a null id counts as no digits."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"h{k + 1}") for k in range(4)]


def fill_in_middle(
    docs: DataFrame,
    how: FillInMiddle | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    restored_col: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    ``n`` counts units; ``form`` is ``plain`` (the text itself), ``psm``
    (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle);
    ``prefix_chars`` and ``middle_chars`` are code points, null if plain. With
    ``restored_col`` that column holds the text rebuilt from output and form.

    A null text is empty, and an empty text is plain; a text that holds a
    marker is plain. A null id draws like an id without digits. Repeated rows
    draw alike, one result each. Other columns, whatever their names, are
    ignored; an empty table gives an empty result. A text may be as long as
    Arrow's strings: some 1 GB with separators and markers.
    """
    how = how or FillInMiddle()
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *draws(F.col(id_col), how.seed))
    schema = f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    if restored_col:
        schema += f", `{restored_col}` string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, "text", BATCH_BYTES):
                out = transform(batch, how)
                if restored_col:
                    out = out.append_column(restored_col, restore(out.column("output"), out.column("form"), how))
                yield out

    return rows.mapInArrow(releasing(run), schema)
