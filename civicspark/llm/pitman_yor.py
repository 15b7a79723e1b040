"""Language-model scores from a hierarchical Pitman-Yor bigram model.

Every word seen before another is the context of a Chinese restaurant whose
customers are the words that followed it; all context restaurants share one
parent, the unigram restaurant, whose base is uniform over the vocabulary and
one unknown word. A customer joins a table of its word or opens a new one,
which sends a customer to the parent. Several chains of seatings are sampled;
their predictive probabilities are averaged into a document's score, from
which :func:`perplexity` follows.

Gibbs sampling (:mod:`civicspark.llm.seating`). Given the parent's
distribution the restaurants are independent, and given an auxiliary Gamma
number per restaurant so are its dishes. One sweep draws, in this order: the
parent's distribution from its seating (a Gamma number per word for its tables,
one more for the tables that nobody sits at, spread evenly over the
vocabulary); every restaurant's Gamma number given its tables; the tables of
every dish from their exact conditional law; then the parent's own Gamma number
and the tables of its words in the same way. Random numbers are hashes of
(pair or word, chain, sweep), so every task that meets a pair draws the same
seating, and a task that runs again draws it once more.

Scale. Documents are dealt into chunks of bounded size, the one shuffle of
the texts; all passes read it again, and the answers of earlier passes too. Chunks send each distinct word and word
pair once, packed, to buckets by hash, which add up the counts and answer in
the order asked. So no word, context or pair meets in one task in more rows
than there are chunks, however frequent it is. Word counts are exact (words
are compared as strings); pairs, and the words whose tables are added up, are
matched on 48 bits of a hash within their bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark.llm.common import hash_words, mix64, pack, partitions_for, runs, split_words, text_bytes, unpack
from civicspark.llm.seating import gammas, seat

#: Text bytes in a chunk, and for each bucket.
CHUNK_BYTES = 8 << 20
#: Chains of seatings that are averaged, and sweeps through all restaurants for each.
CHAINS, SWEEPS = 3, 2
#: Discount and strength of the unigram restaurant and of the context restaurants.
UNIGRAM = (0.6, 1.0)
CONTEXT = (0.8, 1.0)
#: Add-constant of the base score.
BASE_ADD = 0.1

_END, _START = "\n", "\r"  # no word holds white space
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of a hash, after its bucket's bits, that tell words or pairs of a bucket apart.
_KEY_BYTES = 6

_WORDS, _PAIRS, _TOTALS, _TABLES = _KINDS = range(4)
_MESSAGE = "bucket int, chunk int, kind int, data binary"


# -- packed integers ------------------------------------------------------------


def _planes(x: np.ndarray) -> bytes:
    """64-bit integers byte by byte, so that the many zero bytes lie together."""
    return np.ascontiguousarray(x.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplanes(data: bytes, n: int, at: int = 0) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, 8 * n, at).reshape(8, n).T).view("<i8").ravel()


def _key_bytes(hashes: np.ndarray, buckets: int) -> bytes:
    """Sorted hashes of one bucket: the bits that follow the bucket's own, as steps from one to the next, plane by plane."""
    rest = (hashes << np.uint64(_bits(buckets))) >> np.uint64(64 - 8 * _KEY_BYTES)
    rest[1:] -= rest[:-1].copy()
    return np.ascontiguousarray(rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_KEY_BYTES].T).tobytes()


def _keys(data: bytes, n: int, at: int = 0) -> np.ndarray:
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :_KEY_BYTES] = np.frombuffer(data, np.uint8, _KEY_BYTES * n, at).reshape(_KEY_BYTES, n).T
    return np.cumsum(wide.view("<u8").ravel(), dtype=np.uint64)


def _bits(buckets: int) -> int:
    return buckets.bit_length() - 1


# -- one chunk of documents -------------------------------------------------------


def _cuts(sorted_hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's hashes begin: a bucket is one value of the first bits (``buckets`` is a power of two)."""
    first = sorted_hashes >> np.uint64(64 - _bits(buckets)) if buckets > 1 else np.zeros(len(sorted_hashes), np.uint64)
    return np.searchsorted(first, np.arange(buckets + 1, dtype=np.uint64))


def _order(hashes: np.ndarray) -> np.ndarray:
    """The stable sorting order. First bits and index are sorted as one number, several times faster than by argsort."""
    index = np.uint64((1 << max(1, len(hashes)).bit_length()) - 1)
    packed = (hashes & ~index) | np.arange(len(hashes), dtype=np.uint64)
    packed.sort()
    order = (packed & index).astype(np.int64)
    in_order = hashes[order]
    if (in_order[1:] < in_order[:-1]).any():  # hashes that differ in their last bits only
        return np.argsort(hashes, kind="stable")
    return order


class _Chunk:
    """Words and word pairs of a chunk, each distinct one in an order that any task finds again."""

    def __init__(self, docs: pa.Table, buckets: int):
        self.docs, self.buckets = docs, buckets
        texts = docs.column("text").combine_chunks()
        words, codes, offsets = split_words(texts)
        words = pa.concat_arrays([words.cast(pa.string()), pa.array([_END, _START], pa.string())])
        h = hash_words(words)
        order = _order(h)
        if (h[order][1:] == h[order][:-1]).any():  # one hash for several words: those by their text
            order = np.array(sorted(order.tolist(), key=lambda i: (int(h[i]), words[i].as_py())))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.words, self.hash = words.take(pa.array(order)), h[order]
        self.end, self.start = int(place[-2]), int(place[-1])
        self.word_cut = _cuts(self.hash, buckets)

        n = np.diff(offsets)
        self.ends = np.cumsum(n + 1) - 1
        self.starts = self.ends - n
        token = np.empty(len(codes) + len(n), np.int64)
        inner = np.ones(len(token), bool)
        inner[self.ends] = False
        token[inner], token[self.ends] = place[codes], self.end
        before = np.empty(len(token), np.int64)
        before[1:] = token[:-1]
        before[self.starts] = self.start
        self.token = token
        self.learned = np.repeat(~np.asarray(docs.column("held_out").combine_chunks(), dtype=bool), n + 1)

        key = (self.hash * _STEP)[before]
        key += mix64(self.hash)[token]
        key = mix64(key)
        order = _order(key)
        cut = runs(key[order])
        self.pair_of = np.empty(len(order), np.int64)
        self.pair_of[order] = np.repeat(np.arange(len(cut)), np.diff(np.append(cut, len(order))))
        first = order[cut]
        self.pair, self.context, self.word = key[first], before[first], token[first]
        self.pair_cut = _cuts(self.pair, buckets)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each word and pair in the training documents."""
        return (
            np.bincount(self.token[self.learned], minlength=len(self.words)),
            np.bincount(self.pair_of[self.learned], minlength=len(self.pair)),
        )


class _Model:
    """What the buckets have answered, from one chunk's point of view."""

    def __init__(self, chunk: _Chunk, words: np.ndarray, pairs: np.ndarray, total: int, distinct: int):
        self.chunk, self.c_word, self.c_pair, self.total, self.distinct = chunk, words, pairs, total, distinct
        customers = words.copy()
        customers[chunk.start] = words[chunk.end]  # every document starts once
        self.customers = customers

    def drawn_parent(self, state: dict | None, chain: int, of: np.ndarray | slice = slice(None)) -> np.ndarray:
        """The parent's distribution, at some words, drawn from its seating; before the first sweep relative frequencies."""
        uniform = 1.0 / (self.distinct + 1)
        if state is None:
            return (self.c_word[of] + uniform) / (self.total + 1.0)
        _, weights = parent_draws(self._parent_key()[of], state["customers"][chain][of], self.distinct, state["totals"][chain, 3], chain, state["sweep"])
        _, all_t, all_w, _ = state["totals"][chain]
        rest = gammas(_key_of(chain, state["sweep"]), np.array([UNIGRAM[1] + UNIGRAM[0] * all_t]), _seed(_REST, chain, state["sweep"]))[0]
        return (weights + rest * uniform) / (all_w + rest)

    def parent(self, state: dict, chain: int) -> np.ndarray:
        """Unigram probabilities that the parent's seating predicts."""
        discount, strength = UNIGRAM
        c, (all_c, all_t, _, before) = state["customers"][chain], state["totals"][chain]
        t = parent_tables(self._parent_key(), c, self.distinct, before, chain, state["sweep"])
        return (c - discount * t + (strength + discount * all_t) / (self.distinct + 1)) / (strength + all_c)

    def _parent_key(self) -> np.ndarray:
        return self.chunk.hash >> np.uint64(64 - 8 * _KEY_BYTES)

    def tables(self, state: dict | None, chain: int, sweep: int, of: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Tables of each pair, or of those asked for, drawn anew given the state before.

        One customer sits at one table whatever else is drawn, so only the
        contexts and words of pairs with more customers get their numbers.
        """
        discount, strength = CONTEXT
        chunk, customers = self.chunk, self.c_pair[of]
        drawn = np.flatnonzero(customers > 1)
        contexts, context = _distinct(chunk.context[of][drawn], len(chunk.words))
        words, word = _distinct(chunk.word[of][drawn], len(chunk.words))
        n = np.ceil(self.customers[contexts] ** discount) if state is None else state["tables"][chain][contexts]
        x = gammas(chunk.hash[contexts], np.where(n > 0, strength / discount + n, 0.0), _seed(_CONTEXT, chain, sweep))
        weight = discount * x[context] * self.drawn_parent(state, chain, words)[word]
        out = (customers > 0).astype(np.float64)
        out[drawn] = seat(chunk.pair[of][drawn], customers[drawn], weight, discount, _seed(_PAIR, chain, sweep))
        return out


def _distinct(values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers (below ``n``) among ``values``, ascending, and each value's place among them."""
    seen = np.zeros(n, bool)
    seen[values] = True
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[values]


_PAIR, _CONTEXT, _PARENT, _PARENT_GAMMA, _WEIGHT, _REST = range(6)


def _seed(kind: int, chain: int, sweep: int) -> int:
    """A seed of its own for every kind of draw, chain and sweep."""
    return 1 + kind + 6 * (chain + CHAINS * sweep)


def _key_of(chain: int, sweep: int) -> np.ndarray:
    return mix64(np.array([1 + chain + CHAINS * sweep], np.uint64))


def parent_tables(key: np.ndarray, customers: np.ndarray, distinct: int, tables_before: float, chain: int, sweep: int) -> np.ndarray:
    """Tables of the parent's words, given how many it had in all before."""
    discount, strength = UNIGRAM
    x = gammas(_key_of(chain, sweep), np.array([strength / discount + tables_before]), _seed(_PARENT_GAMMA, chain, sweep))[0]
    return seat(key, customers, np.full(len(key), discount * x / (distinct + 1)), discount, _seed(_PARENT, chain, sweep))


def parent_draws(key: np.ndarray, customers: np.ndarray, distinct: int, tables_before: float, chain: int, sweep: int) -> tuple[np.ndarray, np.ndarray]:
    """:func:`parent_tables`, and the Gamma numbers of what sits at them."""
    t = parent_tables(key, customers, distinct, tables_before, chain, sweep)
    return t, gammas(key, customers - UNIGRAM[0] * t, _seed(_WEIGHT, chain, sweep))


# -- passes -------------------------------------------------------------------------


def _messages(rows: list[tuple]) -> pa.Table:
    """Rows ``(bucket, chunk, kind, data)``; the data is compressed behind its length."""
    bucket, chunk, kind, data = zip(*rows, strict=True) if rows else ((), (), (), ())
    data = [len(d).to_bytes(8, "little") + pa.compress(d, codec="zstd", asbytes=True) for d in data]
    return pa.table({"bucket": pa.array(bucket, pa.int32()), "chunk": pa.array(chunk, pa.int32()), "kind": pa.array(kind, pa.int32()), "data": pa.array(data, pa.binary())})


def _rows(table: pa.Table, *kinds: int) -> Iterator[tuple[int, int, int, bytes]]:
    """``(bucket, chunk, kind, data)`` of the kinds, ordered by chunk and bucket."""
    columns = [table.column(c).to_pylist() for c in ("bucket", "chunk", "kind")]
    data = table.column("data")
    for i in sorted((i for i in range(table.num_rows) if columns[2][i] in kinds), key=lambda i: (columns[1][i], columns[0][i])):
        packed = data[i].as_py()
        yield columns[0][i], columns[1][i], columns[2][i], pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)


def _send_counts(buckets: int) -> Callable:
    """Chunk: its distinct words and pairs with their counts in training documents."""

    def run(docs: pa.Table) -> pa.Table:
        chunk, number = _Chunk(docs, buckets), docs.column("chunk")[0].as_py()
        words, pairs = chunk.counts()
        rows = []
        for b in range(buckets):
            w = slice(chunk.word_cut[b], chunk.word_cut[b + 1])
            p = slice(chunk.pair_cut[b], chunk.pair_cut[b + 1])
            if w.stop > w.start:
                rows.append((b, number, _WORDS, pack(word=chunk.words[w], n=words[w])))
            if p.stop > p.start:
                rows.append((b, number, _PAIRS, _key_bytes(chunk.pair[p], buckets) + _planes(pairs[p])))
        return _messages(rows)

    return run


def _add_counts(chunks: int) -> Callable:
    """Bucket: counts over all chunks, answered in the order asked; one chunk owns each pair."""

    def run(table: pa.Table) -> pa.Table:
        bucket, rows = table.column("bucket")[0].as_py(), []
        asked = [(chunk, unpack(data)) for _, chunk, _, data in _rows(table, _WORDS)]
        total = distinct = 0
        if asked:
            word = pa.concat_arrays([batch.column(0) for _, batch in asked]).dictionary_encode()
            index = np.asarray(word.indices, dtype=np.int64)
            count = np.zeros(len(word.dictionary), np.int64)
            np.add.at(count, index, np.concatenate([np.asarray(batch.column(1)) for _, batch in asked]))
            total, distinct, at = int(count.sum()), int((count > 0).sum()), 0
            for chunk, batch in asked:
                rows.append((bucket, chunk, _WORDS, _planes(count[index[at : at + batch.num_rows]])))
                at += batch.num_rows
        rows += [(bucket, chunk, _TOTALS, np.array([total, distinct], "<i8").tobytes()) for chunk in range(chunks)]

        asked = [(chunk, data, len(data) // (_KEY_BYTES + 8)) for _, chunk, _, data in _rows(table, _PAIRS)]
        if asked:
            key = np.concatenate([_keys(data, n) for _, data, n in asked])
            own = np.concatenate([_unplanes(data, n, _KEY_BYTES * n) for _, data, n in asked])
            _, index = np.unique(key, return_inverse=True)
            count = np.zeros(int(index.max()) + 1, np.int64)
            np.add.at(count, index, own)
            seen = np.flatnonzero(own > 0)
            owner = np.zeros(len(key), bool)
            owner[seen[np.unique(index[seen], return_index=True)[1]]] = True
            at = 0
            for chunk, _, n in asked:
                mine = slice(at, at + n)
                rows.append((bucket, chunk, _PAIRS, _planes(count[index[mine]]) + np.packbits(owner[mine]).tobytes()))
                at += n
        return _messages(rows)

    return run


def _model_of(docs: pa.Table, answers: pa.Table, buckets: int) -> tuple[_Model, np.ndarray, dict | None, dict | None]:
    """The chunk's model, which pairs it owns, the state of the last sweep and the one before.

    ``answers`` are those of the counts and of the last sweeps, told apart by :func:`_kind`.
    """
    chunk = _Chunk(docs, buckets)
    words, pairs = np.zeros(len(chunk.words), np.int64), np.zeros(len(chunk.pair), np.int64)
    owner = np.zeros(len(chunk.pair), bool)
    total = distinct = 0
    for b, _, kind, data in _rows(answers, _WORDS, _PAIRS, _TOTALS):
        if kind == _WORDS:
            words[chunk.word_cut[b] : chunk.word_cut[b + 1]] = _unplanes(data, chunk.word_cut[b + 1] - chunk.word_cut[b])
        elif kind == _PAIRS:
            p = slice(chunk.pair_cut[b], chunk.pair_cut[b + 1])
            n = p.stop - p.start
            pairs[p] = _unplanes(data, n)
            owner[p] = np.unpackbits(np.frombuffer(data, np.uint8, (n + 7) // 8, 8 * n), count=n).astype(bool)
        else:
            total, distinct = (x + int(y) for x, y in zip((total, distinct), np.frombuffer(data, "<i8"), strict=True))
    before = state = None
    for sweep in sorted({k // len(_KINDS) - 1 for k in answers.column("kind").to_pylist()} - {-1}):
        before, state = state, _state(len(words), sweep)
        for b, _, kind, data in _rows(answers, _kind(_TABLES, sweep), _kind(_TOTALS, sweep)):
            if kind == _kind(_TOTALS, sweep):
                more = np.frombuffer(data, "<f8").reshape(CHAINS, 4)
                state["totals"][:, :3] += more[:, :3]
                state["totals"][:, 3] = np.maximum(state["totals"][:, 3], more[:, 3])
                continue
            w = slice(chunk.word_cut[b], chunk.word_cut[b + 1])
            state["tables"][:, w], state["customers"][:, w] = _unplanes_of(data, w.stop - w.start)
    return _Model(chunk, words, pairs, total, distinct), owner, state, before


def _kind(kind: int, sweep: int) -> int:
    """The kind of a message of one sweep among those of several."""
    return kind + len(_KINDS) * (sweep + 1)


def _unplanes_of(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Tables and customers of all chains."""
    both = np.stack([_unplanes(data, n, 8 * n * k) for k in range(2 * CHAINS)])
    return both[::2], both[1::2]


def _state(n_words: int, sweep: int) -> dict:
    """Of each chain: tables by context, the parent's customers by word, and the parent's customers, tables, weights and tables before."""
    zeros = np.zeros((CHAINS, n_words), np.int64)
    return {"tables": zeros, "customers": zeros.copy(), "totals": np.zeros((CHAINS, 4)), "sweep": sweep}


def _send_tables(buckets: int, sweep: int) -> Callable:
    """Chunk: draws the tables of the pairs it owns and sends them, by context and by word."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if docs.num_rows == 0:
            return _messages([])
        model, owner, state, _ = _model_of(docs, answers, buckets)
        chunk, number = model.chunk, docs.column("chunk")[0].as_py()
        n = len(chunk.words)
        stats = []
        for c in range(CHAINS):
            t = model.tables(state, c, sweep, owner)
            stats += [np.bincount(chunk.context[owner], t, n).astype(np.int64), np.bincount(chunk.word[owner], t, n).astype(np.int64)]
        # At first the parent has one table per word.
        head = np.array([model.distinct, *([model.distinct] * CHAINS if state is None else state["totals"][:, 1])], "<f8").tobytes()
        rows = []
        for b in range(buckets):
            w = slice(chunk.word_cut[b], chunk.word_cut[b + 1])
            if w.stop > w.start:
                rows.append((b, number, _TABLES, head + _key_bytes(chunk.hash[w], buckets) + b"".join(_planes(s[w]) for s in stats)))
        return _messages(rows)

    return run


def _add_tables(chunks: int, buckets: int, sweep: int) -> Callable:
    """Bucket: tables of each context and the parent's customers, and the totals of the parent's own draws.

    The answers are marked with their sweep, to be read beside earlier ones.
    """
    head = 8 * (1 + CHAINS)

    def run(table: pa.Table) -> pa.Table:
        bucket, rows = table.column("bucket")[0].as_py(), []
        asked = [(chunk, data, (len(data) - head) // (_KEY_BYTES + 16 * CHAINS)) for _, chunk, _, data in _rows(table, _TABLES)]
        totals = np.zeros((CHAINS, 4))
        if asked:
            distinct, *before = np.frombuffer(asked[0][1], "<f8", 1 + CHAINS).tolist()
            word, index = np.unique(np.concatenate([_keys(data, n, head) for _, data, n in asked]), return_inverse=True)
            bits = _bits(buckets)
            first_bits = (word >> np.uint64(bits)) | np.uint64(bucket << (8 * _KEY_BYTES - bits))  # of the whole hash, as chunks have it
            answers: list[list[bytes]] = [[] for _ in asked]
            for c in range(CHAINS):
                for k in range(2):
                    total = np.zeros(len(word), np.int64)
                    np.add.at(total, index, np.concatenate([_unplanes(data, n, head + _KEY_BYTES * n + 8 * n * (2 * c + k)) for _, data, n in asked]))
                    at = 0
                    for answer, (_, _, n) in zip(answers, asked, strict=True):
                        answer.append(_planes(total[index[at : at + n]]))
                        at += n
                t, weights = parent_draws(first_bits, total, int(distinct), before[c], c, sweep)  # every word's customers, on its tables
                totals[c] = total.sum(), t.sum(), weights.sum(), before[c]
            rows += [(bucket, chunk, _kind(_TABLES, sweep), b"".join(a)) for a, (chunk, _, _) in zip(answers, asked, strict=True)]
        rows += [(bucket, chunk, _kind(_TOTALS, sweep), totals.astype("<f8").tobytes()) for chunk in range(chunks)]
        return _messages(rows)

    return run


def _score(buckets: int, sweeps: int) -> Callable:
    """Chunk: averaged predictive probabilities of its documents."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if docs.num_rows == 0:
            return _empty_scores(docs)
        model, _, state, before = _model_of(docs, answers, buckets)
        chunk = model.chunk
        discount, strength = CONTEXT
        customers = model.customers[chunk.context]
        p = np.zeros(len(chunk.pair))
        for c in range(CHAINS):
            t = model.tables(before, c, sweeps - 1)
            fresh = (strength + discount * state["tables"][c][chunk.context]) * model.parent(state, c)[chunk.word]
            p += (model.c_pair - discount * t + fresh) / (strength + customers)
        score = np.log10(p / CHAINS)[chunk.pair_of]
        base = np.log10((model.c_word + BASE_ADD) / (model.total + BASE_ADD * (model.distinct + 1)))[chunk.token]
        known = (model.c_word > 0)[chunk.token]
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "held_out": docs.column("held_out"),
                "n_tokens": pa.array(chunk.ends - chunk.starts + 1, pa.int64()),
                "n_known": pa.array(np.add.reduceat(known.astype(np.int64), chunk.starts), pa.int64()),
                "train_tokens": pa.array(np.full(docs.num_rows, model.total), pa.int64()),
                "base_score": pa.array(np.add.reduceat(base, chunk.starts), pa.float64()),
                "score": pa.array(np.add.reduceat(score, chunk.starts), pa.float64()),
            }
        )

    return run


def _empty_scores(docs: pa.Table) -> pa.Table:
    kinds = {"n_tokens": pa.int64(), "n_known": pa.int64(), "train_tokens": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}
    return pa.table({"doc_id": docs.column("doc_id"), "held_out": docs.column("held_out")} | {k: pa.array([], t) for k, t in kinds.items()})


def held_out_by_crc(doc_id: Column) -> Column:
    """Documents whose crc32 of the id as text is divisible by 10; a null id counts as an empty text (held out)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 10 == 0


def score_documents(
    docs: DataFrame,
    held_out: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    sweeps: int = SWEEPS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    The model learns from the documents that are not ``held_out`` (a boolean
    column; :func:`held_out_by_crc` of the id by default). Words are split at
    ASCII white space after lower-casing A-Z; a document's end is a token.
    A null text is empty and has the end only. Scores are log10 probabilities.
    Repeated rows count and score one by one; a null id is held out by default.
    Very long texts are read whole: a chunk holds one text at least. Other
    columns are ignored, whatever their names; without training documents every word is unknown, and an empty table
    gives an empty result.
    """
    held_out = held_out_by_crc(F.col(id_col)) if held_out is None else F.coalesce(held_out, F.lit(True))
    text = F.coalesce(F.col(text_col), F.lit(""))
    n = partitions_for(text_bytes(docs, text_col), chunk_bytes)
    buckets = 1 << (n - 1).bit_length()
    number = F.pmod(F.xxhash64(F.col(id_col), text), F.lit(n)).cast("int")
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out.alias("held_out"), text.alias("text"), number.alias("chunk"))

    def answered(sent: DataFrame, add: Callable) -> DataFrame:
        return sent.groupBy("bucket").applyInArrow(add, _MESSAGE).repartition(n, "chunk")

    # Texts and answers are dealt out alike and once: a pass reads the exchanges of all earlier answers that it needs.
    chunks = rows.repartition(n, "chunk").groupBy("chunk")
    counts, states = answered(chunks.applyInArrow(_send_counts(buckets), _MESSAGE), _add_counts(n)), []
    for sweep in range(sweeps):
        answers = reduce(DataFrame.union, states[-1:], counts)
        sent = chunks.cogroup(answers.groupBy("chunk")).applyInArrow(_send_tables(buckets, sweep), _MESSAGE)
        states.append(answered(sent, _add_tables(n, buckets, sweep)))
    answers = reduce(DataFrame.union, states[-2:], counts)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return chunks.cogroup(answers.groupBy("chunk")).applyInArrow(_score(buckets, sweeps), schema)


def perplexity(scores: DataFrame) -> DataFrame:
    """Per ``held_out``: tokens, and perplexity of the model and of the base per token."""

    def of(column: str) -> Column:
        return F.pow(F.lit(10.0), -F.sum(column) / F.sum("n_tokens"))

    return scores.groupBy("held_out").agg(F.sum("n_tokens").alias("n_tokens"), of("score").alias("perplexity"), of("base_score").alias("base_perplexity"))
