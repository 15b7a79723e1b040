"""BPE encoding and decoding with a pair occurrence index.

Words repeat a lot, so a partition first collects its distinct words. Their
symbols lie in one flat list with links to the neighbours, and an index maps
each mergeable pair to all its positions. The active ranks are taken in
ascending order; a pair's whole position list is merged at once, and only the
lists of the pairs that appear beside a merge are updated. No word is scanned
twice for its next merge.

The vocabulary file is read at the path given, which every executor must see.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from civicspark.llm.common import byte_slices, releasing

#: Distinct words whose encodings a task remembers between batches.
REMEMBERED_WORDS = 300_000
#: Text bytes handled at a time.
SLICE_BYTES = 1 << 20

_NEVER = 1 << 40

# The word pattern and the byte alphabet belong to the vocabulary file's format.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
_PRINTABLE = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next one from 256 on."""
    rest = (b for b in range(256) if b not in _PRINTABLE)
    letters = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


# The parts of a tokenizer file that this module carries out itself.
_CARRIED_OUT = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "decoder": None,
}
_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "byte_fallback": False, "ignore_merges": False}


def _refuse_others(spec: dict) -> None:
    """Raise for a tokenizer file that asks for steps which are not carried out here."""
    other = [part for part, known in _CARRIED_OUT.items() if spec.get(part, known) != known]  # a bare model states none of them
    other += [f"model.{option}" for option, known in _MODEL.items() if spec["model"].get(option, known) != known]
    plain = ("single_word", "lstrip", "rstrip", "normalized")
    other += [f"added token {t['content']}" for t in spec["added_tokens"] if any(t.get(flag) for flag in plain)]
    if other:
        raise ValueError(f"tokenizer file with unsupported parts: {', '.join(other)}")


class PairIndexBpe:
    """A BPE vocabulary with word-end symbols, read from a tokenizer file; files with other steps than these are refused."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        _refuse_others(spec)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.width = size
        #: pair (as one integer) -> rank, and per rank the pair and what it becomes
        self.rank: dict[int, int] = {}
        self.merges: list[tuple[int, int, int]] = []
        for r, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b = vocab[left], vocab[right]
            self.rank[a * size + b] = r
            self.merges.append((a, b, vocab[left + right]))
        letters = byte_alphabet()
        #: symbol of each byte inside a word and at its end; -1 without one
        self.inner = np.array([vocab.get(c, -1) for c in letters])
        self.final = np.array([vocab.get(c + self.end, -1) for c in letters])
        #: ranks of pairs of single symbols, by the symbols' places among themselves
        single = sorted({*self.inner.tolist(), *self.final.tolist()} - {-1})
        self.single = np.full(size, -1)
        self.single[single] = np.arange(len(single))
        self.first_rank = np.array([[self.rank.get(x * size + y, _NEVER) for y in single] for x in single])
        self.split_special = (
            regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        )

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One symbol per byte of all words in a row, the last of a word ending it, and how many each word has."""
        data = [w.encode("utf-8") for w in words]
        n = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
        raw = np.frombuffer(b"".join(data), np.uint8)
        sym = self.inner[raw]
        last = np.cumsum(n) - 1
        sym[last] = self.final[raw[last]]
        if (sym < 0).any():  # bytes outside the vocabulary have no symbol
            n = np.add.reduceat((sym >= 0).astype(np.int64), last - n + 1)
            sym = sym[sym >= 0]
        return sym, n

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words (none empty) in a row, and how many each has."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        symbols, n = self.symbols(words)
        ends = np.cumsum(n)
        starts = ends - n
        some = n > 0
        before, behind = np.arange(-1, len(symbols) - 1), np.arange(1, len(symbols) + 1)
        before[starts[some]] = -1
        behind[ends[some] - 1] = -1
        # The index: every mergeable pair's positions, in order.
        place = np.flatnonzero(behind >= 0)
        at = self.single[symbols]
        found = self.first_rank[at[place], at[place + 1]]
        place, found = place[found < _NEVER], found[found < _NEVER]
        order = np.argsort(found, kind="stable")
        cuts = np.flatnonzero(np.diff(found[order], prepend=-1))
        index = {int(found[order[c]]): part.tolist() for c, part in zip(cuts, np.split(place[order], cuts[1:]), strict=True)} if len(cuts) else {}
        sym, prev, after = symbols.tolist(), before.tolist(), behind.tolist()
        self._merge(index, sym, prev, after)
        merged = np.array(sym)
        alive = merged >= 0
        sizes = np.zeros(len(words), np.int64)
        if some.any():
            sizes[some] = np.add.reduceat(alive.astype(np.int64), starts[some])
        return merged[alive].astype(np.int32), sizes

    def _merge(self, index: dict[int, list[int]], sym: list[int], prev: list[int], after: list[int]) -> None:
        """Take the active ranks in ascending order and merge each one's positions; dead symbols become -1."""
        rank_of, width = self.rank.get, self.width
        active = list(index)
        heapify(active)
        while active:
            r = heappop(active)
            places = index.pop(r, None)
            if places is None:
                continue
            places.sort()
            a, b, merged = self.merges[r]
            left_of, right_of = merged * width, merged
            for k, p in enumerate(places):
                if sym[p] != a:
                    continue
                q = after[p]
                if q < 0 or sym[q] != b:
                    continue
                sym[p], sym[q] = merged, -1
                follower, leader, lower = after[q], prev[p], False
                after[p] = follower
                if follower >= 0:
                    prev[follower] = p
                    new = rank_of(left_of + sym[follower])
                    if new is not None:
                        if new in index:
                            index[new].append(p)
                        else:
                            index[new] = [p]
                            heappush(active, new)
                        lower = new < r
                if leader >= 0:
                    new = rank_of(sym[leader] * width + right_of)
                    if new is not None:
                        if new in index:
                            index[new].append(leader)
                        else:
                            index[new] = [leader]
                            heappush(active, new)
                        lower = lower or new < r
                if lower:  # a lower rank became active: it goes first, then the rest of this list
                    if k + 1 < len(places):
                        index.setdefault(r, []).extend(places[k + 1 :])
                        heappush(active, r)
                    break

    def pieces(self, text: str) -> Iterator[str]:
        """Words and special tokens of a text, in order."""
        if self.split_special is None or not any(s in text for s in self.special):
            yield from words_of(text)
            return
        at = 0
        for m in self.split_special.finditer(text):
            yield from words_of(text[at : m.start()])
            yield m.group()
            at = m.end()
        yield from words_of(text[at:])

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens joined by one space (the format has no decoder); special tokens stay, unknown ids do not."""
        return " ".join(self.tokens[i] for i in ids if 0 <= i < self.width)


def words_of(text: str) -> list[str]:
    """Words of a text after NFC and lower-casing character by character (so a final sigma is as any other)."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return _WORDS.findall(text.lower())


@lru_cache(maxsize=2)
def load(path: str) -> PairIndexBpe:
    return PairIndexBpe(path)


class _WordTable:
    """Words met lately in a task with their ids, as numbers into one flat array.

    Two generations bound its size: when the young one is full, it becomes the
    old one, and words that are met again move over.
    """

    def __init__(self, bpe: PairIndexBpe, remembered: int = REMEMBERED_WORDS):
        self.bpe, self.half = bpe, max(1, remembered // 2)
        self.code: dict[str, int] = {}
        self.flat, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.old: tuple[dict[str, int], np.ndarray, np.ndarray] = (self.code, self.flat, self.sizes)

    def _add(self, words: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        base = len(self.code)
        self.code.update(zip(words, range(base, base + len(words)), strict=True))
        self.flat, self.sizes = np.concatenate([self.flat, flat]), np.concatenate([self.sizes, sizes])

    def _learn(self, words: set[str]) -> None:
        special = self.bpe.special
        known = [w for w in words if w in self.old[0]]
        if known:
            code, flat, sizes = self.old
            at = np.fromiter(map(code.__getitem__, known), dtype=np.int64, count=len(known))
            self._add(known, _gather(flat, np.cumsum(sizes) - sizes, sizes, at)[0], sizes[at])
            words = words.difference(known)
        marks = [w for w in words if w in special]
        self._add(marks, np.array([special[w] for w in marks], np.int32), np.ones(len(marks), np.int64))
        plain = sorted(words.difference(marks))
        self._add(plain, *self.bpe.encode_words(plain))

    def encode(self, docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents in a row, and where each document's ids start."""
        if len(self.code) > self.half:
            self.old = (self.code, self.flat, self.sizes)
            self.code, self.flat, self.sizes = {}, np.zeros(0, np.int32), np.zeros(0, np.int64)
        words = list(chain.from_iterable(docs))
        n_words = np.fromiter(map(len, docs), dtype=np.int64, count=len(docs))
        self._learn(set(words).difference(self.code))
        codes = np.fromiter(map(self.code.__getitem__, words), dtype=np.int64, count=len(words))
        ids, ends = _gather(self.flat, np.cumsum(self.sizes) - self.sizes, self.sizes, codes)
        return ids, np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(n_words)])]


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` numbered ``at`` in a row, and where each ends."""
    size = sizes[at]
    ends = np.cumsum(size)
    return flat[np.repeat(starts[at] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)], ends


def _decoded(tokens: pa.Array, lists: pa.Array) -> pa.Array:
    """The tokens of each list of ids joined by one space; null lists are empty, unknown ids are left out."""
    lists = pc.fill_null(lists, pa.scalar([], lists.type)) if lists.null_count else lists
    flat = np.asarray(lists.flatten())
    starts = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists), dtype=np.int64))])
    known = (flat >= 0) & (flat < len(tokens))
    if not known.all():
        starts, flat = np.concatenate([[0], np.cumsum(known)])[starts], flat[known]
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), tokens.take(pa.array(flat, pa.int32()))), " ")


def encode_documents(
    docs: DataFrame, tokenizer: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None
) -> DataFrame:
    """``docs`` plus ``ids``: the token ids of each whole text.

    A null text is empty and has an empty list. Special tokens that stand in a
    text become their ids, as the tokenizers library does by default; none are
    added. With ``decoded_col``, the ids are decoded again in the same pass.
    Columns already named so are replaced. One Arrow pass, no shuffle; texts
    are worked through in slices of ``SLICE_BYTES`` (a longer text alone).
    """
    new = [T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False)]
    new += [T.StructField(decoded_col, T.StringType(), False)] if decoded_col else []
    kept = [f for f in docs.schema.fields if f.name not in (ids_col, decoded_col)]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _WordTable(load(tokenizer))
        tokens = pa.array(table.bpe.tokens, pa.string())
        for batch in batches:
            for part in byte_slices(batch, text_col, SLICE_BYTES):
                texts = part.column(part.schema.get_field_index(text_col)).to_pylist()
                ids, starts = table.encode([list(table.bpe.pieces(t)) if t else [] for t in texts])
                lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))
                columns = [*(part.column(part.schema.get_field_index(n)) for n in names), lists]
                columns += [_decoded(tokens, lists)] if decoded_col else []
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *(f.name for f in new)])

    return docs.select(*(f"`{n}`" for n in names)).mapInArrow(releasing(run), T.StructType([*kept, *new]))


def decode_documents(docs: DataFrame, tokenizer: str, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """``docs`` plus ``decoded``: the tokens of ``ids`` joined by one space, special tokens included.

    A null or empty list gives an empty text; ids outside the vocabulary are
    skipped. A column already named ``decoded_col`` is replaced.
    """
    kept = [f for f in docs.schema.fields if f.name != decoded_col]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pa.array(load(tokenizer).tokens, pa.string())
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                columns = [part.column(part.schema.get_field_index(n)) for n in names]
                decoded = _decoded(tokens, part.column(part.schema.get_field_index(ids_col)))
                yield pa.RecordBatch.from_arrays([*columns, decoded], names=[*names, decoded_col])

    schema = T.StructType([*kept, T.StructField(decoded_col, T.StringType(), False)])
    return docs.select(*(f"`{n}`" for n in names)).mapInArrow(releasing(run), schema)
