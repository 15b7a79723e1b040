"""Repeated passages, by anchors and fingerprints in place of a depth-limited radix sort of suffixes.

A byte is removed when a 50-byte string over it also starts in a document with
a smaller id. A radix sort by most significant digits would deal out every
suffix by its leading bytes, pass by pass down to byte 50, and find such strings
as the groups that stay equal. Measured on this library's test documents its
first pass alone would write 3.3 times the input with digits of 8 bytes, after
which four suffixes in five go on, and 10 times with digits of 16 bytes (see
the README); so this module takes the same groups in another way. Passes go
from coarse to fine like those of the sort, and only groups that still hold
two documents go on, but of every 50-byte window one suffix is dealt, and
groups are compared by fingerprints:

1. First digit. Of the 16-byte grams of every 50-byte window the one with the
   least hash is its anchor; equal windows have equal anchors at equal places,
   so it is enough to order the suffixes at anchors, one in 17. Their grams
   are dealt into buckets; a gram that one document holds alone drops out.
2. Second digit: the anchor's whole context, which spans every window it
   anchors. Of equal contexts all but the smallest document's are repeated.
   A gram with a single context is finished.
3. Last digit, for the first holders of contexts that share their gram: the
   single windows, down to the full depth. Windows equal through it are
   repeated in all but the smallest document.

Grams are 64-bit fingerprints, contexts and windows 128-bit ones.

Scale. What a pass deals out are a few bytes per anchor, packed column by
column, one row per slice of text and bucket. Copies inside a slice are
settled there and sent once, so a passage that a third of all documents share
costs a bucket one entry per slice. A gram with very many holders is dealt by
context in pass 2 and by window in pass 3, so its bucket stays small too.
Texts are shuffled once, by document; all passes read that same exchange.
Documents that equal an earlier one byte for byte take no part: they are
removed whole.

Results of a slice travel in the bucket they belong to, so that a task that is
run again on another order of its input stays consistent for every bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.common import byte_slices, mix64, partitions_for, runs, text_bytes
from civicspark.session import materialize

#: Depth of the sort: bytes in a window, and in an anchor's gram.
WINDOW, GRAM = 50, 16
#: Bytes before an anchor that its windows can reach.
REACH = WINDOW - GRAM
#: Text bytes for each bucket, and handled at a time.
BUCKET_BYTES = SLICE_BYTES = 8 << 20
#: Holders of one gram beyond which it is dealt by deeper digits.
HOT_HOLDERS = 4096

_BLOCK = 1 << 19
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASES = (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
#: Bits of a document's key, of a gram within its bucket, and the mark of a hot gram.
_KEY_BITS, _GRAM_BITS, _HOT = 40, 32, np.int64(1) << np.int64(62)

_DEALT = "bucket int, kind int, data binary"
_ENTRY, _DONE, _WINDOW_ENTRY = 0, 1, 2


# -- digits of a slice of text --------------------------------------------------


def _slide(x: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """``op`` over every ``width`` neighbours, by doubling."""
    n = 1
    while 2 * n <= width:
        x = op(x[:-n], x[n:])
        n *= 2
    return op(x[: len(x) - (width - n)], x[width - n :]) if n < width else x


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchor positions (ascending) and gram hashes of concatenated texts that end at ``ends``."""
    places, grams = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    span = WINDOW - GRAM + 1
    for at in range(0, max(0, len(data) - WINDOW + 1), _BLOCK):
        piece = data[at : at + _BLOCK + WINDOW - 1]
        words = np.ndarray((len(piece) + 8,), "<u8", np.concatenate([piece, np.zeros(16, np.uint8)]), strides=(1,))
        n = len(piece) - GRAM + 1
        gram = mix64(words[:n] * _STEP + mix64(words[8 : 8 + n]))
        least = _slide(gram, span, np.minimum)
        for end in ends[np.searchsorted(ends, at, "right") : np.searchsorted(ends, at + len(least) + WINDOW, "left") + 1]:
            least[max(0, end - WINDOW + 1 - at) : max(0, end - at)] = 0  # windows that would cross into the next text
        edge = np.zeros(span - 1, np.uint64)
        chosen = np.flatnonzero((_slide(np.concatenate([edge, least, edge]), span, np.maximum) == gram) & (gram > 0))
        places.append(chosen + at)
        grams.append(gram[chosen])
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(grams)[first]


def contexts(data: np.ndarray, place: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``REACH`` bytes before each place and ``WINDOW`` from it on, zero outside ``left`` and ``right``."""
    padded = np.concatenate([np.zeros(REACH, np.uint8), data, np.zeros(WINDOW, np.uint8)])
    out = np.empty((len(place), REACH + WINDOW), np.uint8)
    for j in range(REACH + WINDOW):
        out[:, j] = np.where((j - REACH >= -left) & (j - REACH < right), padded[place + j], 0)
    return out


def context_prints(context: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    acc = mix64(left.astype(np.uint64) * np.uint64(256) + right.astype(np.uint64))
    for j in range(0, context.shape[1] - 7, 8):
        acc = mix64(acc * _STEP + np.ascontiguousarray(context[:, j : j + 8]).view("<u8").ravel())
    tail = np.zeros((len(context), 8), np.uint8)
    rest = context.shape[1] % 8
    tail[:, :rest] = context[:, context.shape[1] - rest :]
    return mix64(acc * _STEP + tail.view("<u8").ravel())


def window_prints(context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit fingerprints of the window at each of the ``REACH + 1`` starts in each context."""
    byte = mix64(np.arange(1, 257, dtype=np.uint64) * _STEP)[context]
    out = []
    for base in _BASES:
        prefix = np.zeros((len(context), context.shape[1] + 1), np.uint64)
        for j in range(context.shape[1]):
            prefix[:, j + 1] = prefix[:, j] * base + byte[:, j]
        top = np.uint64(pow(int(base), WINDOW, 1 << 64))
        out.append(mix64(prefix[:, WINDOW : WINDOW + REACH + 1] - prefix[:, : REACH + 1] * top))
    return out[0], out[1]


# -- packing --------------------------------------------------------------------

# Column types of the packed rows.
_GRAMS = ("<u4", "<u4", "u1", "<u4")  # gram, key (low, high), holders in the slice
_HELD = ("<i8", "<i8")  # key, gram name
_SPOTS = ("<i8", "<u8", "<i8", "<i8", "<i4", "u1", "u1")  # gram name, context, key, doc, place, left, right
_SPANS = ("<i8", "<i8", "<i4", "<i4")  # key, doc, from, to
_CONTEXTS = ("<i8", "<i8", "<i8", "<i4", "u1", "u1", "V84")  # gram name, key, doc, place, left, right, bytes
_WINDOWS = ("<u8", "<u8", "<i8", "<i8", "<i4")  # window (two), key, doc, place


def _planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte, the first bytes of all, then the second: equal high bytes lie together."""
    if x.dtype.kind == "V":
        return x.tobytes()
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T).tobytes()


def _dealt(rows: list[tuple], bucket: np.ndarray, kind: int, types: tuple, *columns: np.ndarray) -> None:
    """Append one packed row per bucket: the number of entries, then the compressed columns."""
    if len(bucket) == 0:
        return
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    columns = [np.ascontiguousarray(c[order].astype(t, copy=False)) for c, t in zip(columns, types, strict=True)]
    first = runs(bucket)
    for a, b in zip(first, [*first[1:], len(bucket)], strict=True):
        packed = pa.compress(b"".join(_planes(c[a:b]) for c in columns), codec="zstd", asbytes=True)
        rows.append((int(bucket[a]), kind, int(b - a).to_bytes(8, "little") + packed))


def _undealt(table: pa.Table, kind: int, types: tuple) -> list[np.ndarray]:
    """The columns of all packed rows of a kind."""
    types = [np.dtype(t) for t in types]
    size = sum(t.itemsize for t in types)
    parts: list[list[np.ndarray]] = [[np.zeros(0, t)] for t in types]
    for k, data in zip(table.column("kind").to_pylist(), table.column("data"), strict=True):
        if k == kind:
            blob, at = data.as_py(), 0
            n = int.from_bytes(blob[:8], "little")
            buffer = pa.decompress(blob[8:], n * size, codec="zstd")
            for part, t in zip(parts, types, strict=True):
                if t.kind == "V":
                    part.append(np.frombuffer(buffer, t, n, at))
                else:
                    planes = np.frombuffer(buffer, np.uint8, n * t.itemsize, at).reshape(t.itemsize, n)
                    part.append(np.ascontiguousarray(planes.T).view(t).ravel())
                at += n * t.itemsize
    return [np.concatenate(p) for p in parts]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    bucket, kind, data = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.record_batch({"bucket": pa.array(bucket, pa.int32()), "kind": pa.array(kind, pa.int32()), "data": pa.array(data, pa.binary())})


class _Slice:
    """The texts of a run of rows, end to end."""

    def __init__(self, part: pa.RecordBatch, chosen: np.ndarray):
        rows = np.flatnonzero(chosen)
        texts = [t.encode() for t in part.column("text").take(pa.array(rows)).to_pylist()]
        self.rows = rows
        self.starts = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.key = np.asarray(part.column("key").take(pa.array(rows)), dtype=np.int64)
        self.doc = np.asarray(part.column("doc_id").take(pa.array(rows)), dtype=np.int64)

    def owner(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, place, "right") - 1


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from byte_slices(batch, "text", SLICE_BYTES)


def _taking_part(part: pa.RecordBatch) -> np.ndarray:
    return np.asarray(part.column("searched"), dtype=bool)


# -- passes -----------------------------------------------------------------------


def _gram_names(gram: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each gram, and its name: the bucket and 32 more bits of the hash."""
    bucket = ((gram & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int64)
    return bucket, (bucket << _GRAM_BITS) | (gram >> np.uint64(32)).astype(np.int64)


def _deal_grams(buckets: int) -> Callable:
    """Pass 1, map side: each slice's grams with the documents that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            s = _Slice(part, _taking_part(part))
            place, gram = anchors(s.data, s.starts[1:])
            _, name = _gram_names(gram, buckets)
            pairs = np.unique(np.stack([name, s.owner(place)]), axis=1) if len(name) else np.zeros((2, 0), np.int64)
            name, own = pairs[0], pairs[1]
            first = runs(name)
            count = np.diff(np.append(first, len(name)))
            many = np.repeat(count > 1, count)
            rows: list[tuple] = []
            key = s.key[own].astype(np.uint64)
            # Held by several here: settled, one entry for the others. Held by one: the entry asks for an answer.
            key_sent = np.where(count > 1, np.uint64(0), key[first]) if len(first) else key[:0]
            gram_sent = name[first] & ((1 << _GRAM_BITS) - 1)
            _dealt(rows, name[first] >> _GRAM_BITS, _ENTRY, _GRAMS, gram_sent, key_sent & np.uint64(0xFFFFFFFF), key_sent >> np.uint64(32), count)
            _dealt(rows, name[many] >> _GRAM_BITS, _DONE, _HELD, key[many].astype(np.int64), name[many])
            yield _batch(rows)

    return run


def _shared_grams(hot: int) -> Callable:
    """Pass 1, bucket side: ``(key, name)`` of every document's grams that another one holds too."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        gram, low, high, count = _undealt(table, _ENTRY, _GRAMS)
        key = low.astype(np.int64) | (high.astype(np.int64) << 32)
        order = np.argsort(gram, kind="stable")
        gram, key, count = gram[order], key[order], count[order].astype(np.int64)
        first = runs(gram)
        holders = np.add.reduceat(count, first) if len(first) else count
        each = np.repeat(holders, np.diff(np.append(first, len(gram))))
        name = (np.int64(bucket) << _GRAM_BITS) | gram.astype(np.int64)
        asks = (each > 1) & (count == 1)
        done_key, done_name = _undealt(table, _DONE, _HELD)
        keys = np.concatenate([key[asks], done_key])
        names = np.concatenate([name[asks], done_name])
        hot_names = name[first][holders > hot] if len(first) else name
        names = np.where(np.isin(names, hot_names), names | _HOT, names)
        return pa.table({"key": pa.array(keys, pa.int64()), "name": pa.array(names, pa.int64())})

    return run


def _deal_contexts(buckets: int) -> Callable:
    """Pass 2, map side: the contexts of the anchors whose gram is shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            held = part.column("names")
            some = np.asarray(held.is_valid(), dtype=bool) & _taking_part(part)
            if not some.any():
                continue
            s = _Slice(part, some)
            place, gram = anchors(s.data, s.starts[1:])
            own = s.owner(place)
            _, name = _gram_names(gram, buckets)
            bounds = np.searchsorted(own, np.arange(len(s.rows) + 1))
            keep, hot = np.zeros(len(place), bool), np.zeros(len(place), bool)
            for i, row in enumerate(s.rows):
                mine = np.asarray(held[int(row)].values)
                span = slice(bounds[i], bounds[i + 1])
                is_hot = np.isin(name[span], mine[mine >= _HOT] & ~_HOT)
                keep[span] = is_hot | np.isin(name[span], mine)
                hot[span] = is_hot
            place, own, name, hot = place[keep], own[keep], name[keep], hot[keep]
            left = np.minimum(REACH, place - s.starts[own])
            right = np.minimum(WINDOW, s.starts[own + 1] - place)
            fits = left + right >= WINDOW
            place, own, name, hot, left, right = (x[fits] for x in (place, own, name, hot, left, right))
            mark = context_prints(contexts(s.data, place, left, right), left, right)
            bucket = np.where(hot, (mix64(mark ^ name.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64), name >> _GRAM_BITS)
            name = np.where(hot, name | _HOT, name)
            at = place - s.starts[own]
            rows: list[tuple] = []
            later = _later(s.doc[own], name, mark)
            first = ~later
            _dealt(rows, bucket[first], _ENTRY, _SPOTS, *(x[first] for x in (name, mark, s.key[own], s.doc[own], at, left, right)))
            _dealt(rows, bucket[later], _DONE, _SPANS, *(x[later] for x in (s.key[own], s.doc[own], at - left, at + right)))
            yield _batch(rows)

    return run


def _later(doc: np.ndarray, *group: np.ndarray) -> np.ndarray:
    """Rows whose group holds a smaller document."""
    if len(doc) == 0:
        return np.zeros(0, bool)
    order = np.lexsort((doc, *group))
    new = np.zeros(len(doc), bool)
    new[0] = True
    for g in group:
        x = g[order]
        new[1:] |= x[1:] != x[:-1]
    least = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    out = np.zeros(len(doc), bool)
    out[order] = doc[order] > least
    return out


_EVENTS = "key bigint, kind int, doc bigint, x int, y int, name bigint"


def _judge_contexts(table: pa.Table) -> pa.Table:
    """Pass 2, bucket side: repeated contexts as spans; first holders of contested grams are asked for windows."""
    name, mark, key, doc, place, left, right = _undealt(table, _ENTRY, _SPOTS)
    later = _later(doc, name, mark)
    # Contested: the gram has several contexts and several documents. Of a hot gram this bucket sees a part only.
    order = np.argsort(name, kind="stable")
    first = runs(name[order])
    size = np.diff(np.append(first, len(name)))

    def varies(x: np.ndarray) -> np.ndarray:
        y = x[order]
        return np.repeat(np.maximum.reduceat(y, first) != np.minimum.reduceat(y, first), size) if len(first) else np.zeros(0, bool)

    contested = np.zeros(len(name), bool)
    contested[order] = (varies(mark) & varies(doc)) | (name[order] >= _HOT)
    ask = ~later & contested
    done = _undealt(table, _DONE, _SPANS)
    from_, to = place - left, place + right
    columns = [
        (key[later], key[ask], done[0]),
        (np.full(later.sum(), _DONE), np.full(ask.sum(), _ENTRY), np.full(len(done[0]), _DONE)),
        (doc[later], doc[ask], done[1]),
        (from_[later], place[ask], done[2]),
        (to[later], place[ask], done[3]),
        (np.zeros(later.sum()), name[ask], np.zeros(len(done[0]))),
    ]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
    names = ["key", "kind", "doc", "x", "y", "name"]
    return pa.table({n: pa.array(np.concatenate(c).astype(t.to_pandas_dtype()), t) for n, c, t in zip(names, columns, types, strict=True)})


def _merged(spans: np.ndarray) -> np.ndarray:
    """Overlapping or touching ``(from, to)`` rows as maximal ones."""
    if len(spans) == 0:
        return spans.reshape(0, 2)
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    first = np.flatnonzero(new)
    return np.stack([spans[first, 0], reach[np.append(first[1:], len(spans)) - 1]], axis=1)


def _struct_list(column: pa.Array, row: int) -> dict[str, np.ndarray] | None:
    value = column[row]
    if not value.is_valid:
        return None
    flat = value.values
    return {f.name: np.asarray(flat.field(i), dtype=np.int64) for i, f in enumerate(flat.type)}


def _deal_windows(buckets: int) -> Callable:
    """Pass 3, map side: contexts that are contested, and the windows of hot ones; known spans ride along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            events = part.column("events")
            s = _Slice(part, np.asarray(events.is_valid(), dtype=bool) & _taking_part(part))
            rows: list[tuple] = []
            asked: list[list[np.ndarray]] = [[], [], []]
            known: list[list[np.ndarray]] = [[], [], []]
            for i, row in enumerate(s.rows):
                e = _struct_list(events, int(row))
                mine = e["doc"] == s.doc[i]
                q, d = mine & (e["kind"] == _ENTRY), mine & (e["kind"] == _DONE)
                for to, x in zip(asked, (np.full(q.sum(), i), e["x"][q], e["name"][q]), strict=True):
                    to.append(x)
                spans = _merged(np.stack([e["x"][d], e["y"][d]], axis=1))
                for to, x in zip(known, (np.full(len(spans), i), spans[:, 0], spans[:, 1]), strict=True):
                    to.append(x)
            own, a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in known)
            _dealt(rows, s.key[own] % buckets, _DONE, _SPANS, s.key[own], s.doc[own], a, b)
            own, at, name = (np.concatenate([np.zeros(0, np.int64), *x]) for x in asked)
            place = s.starts[own] + at
            left, right = np.minimum(REACH, at), np.minimum(WINDOW, s.starts[own + 1] - place)
            hot = name >= _HOT
            cold = ~hot
            context = contexts(s.data, place[cold], left[cold], right[cold])
            _dealt(
                rows, name[cold] >> _GRAM_BITS, _ENTRY, _CONTEXTS,
                name[cold], s.key[own[cold]], s.doc[own[cold]], at[cold], left[cold], right[cold], context.view("V84").ravel(),
            )
            if hot.any():
                w1, w2 = window_prints(contexts(s.data, place[hot], left[hot], right[hot]))
                i, o = np.nonzero(_whole(left[hot], right[hot]))
                own_w, start = own[hot][i], at[hot][i] - REACH + o
                _, once = np.unique(np.stack([own_w, start]), axis=1, return_index=True)
                w1, w2, own_w, start = w1[i, o][once], w2[i, o][once], own_w[once], start[once]
                bucket = (w1 % np.uint64(buckets)).astype(np.int64)
                later = _later(s.doc[own_w], w1, w2)
                first = ~later
                _dealt(rows, bucket[first], _WINDOW_ENTRY, _WINDOWS, *(x[first] for x in (w1, w2, s.key[own_w], s.doc[own_w], start)))
                own_l, start_l = own_w[later], start[later]
                _dealt(rows, bucket[later], _DONE, _SPANS, s.key[own_l], s.doc[own_l], start_l, start_l + WINDOW)
            yield _batch(rows)

    return run


def _whole(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which of the ``REACH + 1`` windows of each context lie inside its text; window ``o`` starts ``REACH - o`` before the anchor."""
    before = REACH - np.arange(REACH + 1)
    return (before[None, :] <= left[:, None]) & (WINDOW - before[None, :] <= right[:, None])


def _judge_windows(table: pa.Table) -> pa.Table:
    """Pass 3, bucket side: all repeated spans of this bucket."""
    key, doc, from_, to = (list(x) for x in zip(_undealt(table, _DONE, _SPANS), strict=True))
    name, c_key, c_doc, place, left, right, raw = _undealt(table, _ENTRY, _CONTEXTS)
    order = np.argsort(name, kind="stable")
    # Whole groups at a time, so that the window table stays small.
    first = runs(name[order])
    cuts = [0]
    for a in [*first[1:].tolist(), len(name)]:
        if a - cuts[-1] >= 4096 or a == len(name):
            cuts.append(a)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        pick = order[a:b]
        w1, w2 = window_prints(np.ascontiguousarray(raw[pick]).view(np.uint8).reshape(len(pick), REACH + WINDOW))
        i, o = np.nonzero(_whole(left[pick].astype(np.int64), right[pick].astype(np.int64)))
        later = _later(c_doc[pick][i], w1[i, o], w2[i, o], name[pick][i])
        i, o = i[later], o[later]
        # Neighbouring windows of one context make one span.
        new = np.ones(len(i), bool)
        new[1:] = (i[1:] != i[:-1]) | (o[1:] != o[:-1] + 1)
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(i)) - 1 if len(head) else head
        own = pick[i[head]]
        key.append(c_key[own])
        doc.append(c_doc[own])
        from_.append(place[own] - REACH + o[head])
        to.append(place[own] - REACH + o[tail] + WINDOW)
    w1, w2, w_key, w_doc, start = _undealt(table, _WINDOW_ENTRY, _WINDOWS)
    later = _later(w_doc, w1, w2)
    key.append(w_key[later])
    doc.append(w_doc[later])
    from_.append(start[later])
    to.append(start[later] + WINDOW)
    out = {"key": (key, np.int64), "doc": (doc, np.int64), "x": (from_, np.int32), "y": (to, np.int32)}
    return pa.table({n: np.concatenate([np.zeros(0, t), *x]).astype(t) for n, (x, t) in out.items()})


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the spans out of each text."""
    for part in _slices(batches):
        texts, events = part.column("text").to_pylist(), part.column("events")
        ids, copies = part.column("doc_id").to_pylist(), part.column("copied").to_pylist()
        n_bytes, removed, spans, digest, kept_bytes = [], [], [], [], []
        for i, (text, doc, copied) in enumerate(zip(texts, ids, copies, strict=True)):
            data = text.encode()
            e = _struct_list(events, i) if doc is not None else None
            cut = np.zeros((0, 2), np.int64)
            if copied and len(data) >= WINDOW:
                cut = np.array([[0, len(data)]])
            elif e is not None:
                mine = e["doc"] == doc
                cut = _merged(np.stack([e["x"][mine], e["y"][mine]], axis=1))
            edges = [0, *cut.ravel().tolist(), len(data)]
            rest = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            n_bytes.append(len(data))
            removed.append(len(data) - len(rest))
            spans.append([{"from": int(a), "to": int(b)} for a, b in cut])
            digest.append(hashlib.sha256(rest).hexdigest())
            kept_bytes.append(rest)
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))), pa.array(digest, pa.string()), pa.array(kept_bytes, pa.binary()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256", "kept"],
        )


def _copies(docs: DataFrame) -> DataFrame:
    """``(key, copies)``: documents that equal one with a smaller id, listed by key."""
    narrow = docs.where("doc_id IS NOT NULL").select("doc_id", "key", F.sha2("text", 256).alias("digest"))
    least = narrow.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    least = materialize(least.select("digest", "least"), "equal-texts")
    copies = narrow.join(least, "digest").where("doc_id > least")
    return materialize(copies.groupBy("key").agg(F.collect_set("doc_id").alias("copies")), "copies")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES, hot_holders: int = HOT_HOLDERS
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, spans, kept_sha256, kept``.

    ``doc_id`` is an integer. ``spans`` are the maximal removed runs as
    ``(from, to)`` byte positions of the UTF-8 text and ``kept`` the bytes that
    stay (a cut may fall inside a character). A null text is empty; texts under
    50 bytes keep everything. A null ``doc_id`` is neither smaller nor larger
    than another: such rows lose nothing and remove nothing. Rows with one id
    do not remove each other's text. Other columns are ignored; an empty table
    gives an empty result.
    """
    buckets = partitions_for(text_bytes(docs, text_col), bucket_bytes)
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.shiftrightunsigned(F.xxhash64(F.col(id_col), text), 64 - _KEY_BITS)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), key.alias("key"), text.alias("text"))
    # Left joins throughout, so that all passes read one and the same exchange of the texts.
    marked = rows.join(_copies(rows), "key", "left")
    copied = F.coalesce(F.array_contains("copies", F.col("doc_id")), F.lit(False))
    marked = marked.select("key", "doc_id", "text", copied.alias("copied"))
    marked = marked.withColumn("searched", ~F.col("copied") & F.col("doc_id").isNotNull())

    grams = marked.mapInArrow(_deal_grams(buckets), _DEALT)
    shared = grams.groupBy("bucket").applyInArrow(_shared_grams(hot_holders), "key bigint, name bigint")
    shared = shared.groupBy("key").agg(F.collect_list("name").alias("names"))

    spots = marked.join(shared, "key", "left").mapInArrow(_deal_contexts(buckets), _DEALT)
    events = spots.groupBy("bucket").applyInArrow(_judge_contexts, _EVENTS)
    events = events.groupBy("key").agg(F.collect_list(F.struct("kind", "doc", "x", "y", "name")).alias("events"))

    windows = marked.join(events, "key", "left").mapInArrow(_deal_windows(buckets), _DEALT)
    spans = windows.groupBy("bucket").applyInArrow(_judge_windows, "key bigint, doc bigint, x int, y int")
    spans = spans.groupBy("key").agg(F.collect_list(F.struct("doc", "x", "y")).alias("events"))
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<from:int,to:int>>, kept_sha256 string, kept binary"
    return marked.join(spans, "key", "left").mapInArrow(_finish, schema)
