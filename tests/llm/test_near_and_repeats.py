"""Circulant MinHash, components and repeated passages against plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from civicspark.llm import circulant_minhash as M
from civicspark.llm import suffix_radix
from civicspark.llm.components import connected_components
from tests.llm.frames import WHITE_WORDS, corpus, documents, low, prose


def _shingles(text):
    w = WHITE_WORDS.findall(low(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _components(rows):
    """By all pairs: ``doc_id -> (set size, smallest id reachable)``."""
    sets = {i: _shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y) and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i)) for i in sets}


def _chained_copies():
    """Copies that drift: each is close to the one before, the ends are far apart; and a wide cloud of near copies."""
    rnd = random.Random(4)
    words, rows = prose(70, 200).split(), []
    for i in range(12):
        rows.append((1000 + i, " ".join(words)))
        for _ in range(3):
            words[rnd.randrange(len(words))] = f"w{rnd.randrange(10**6)}"
    base = prose(71, 120).split()
    for i in range(25):
        copy = list(base)
        for _ in range(i % 4):
            copy[rnd.randrange(len(copy))] = f"v{rnd.randrange(10**6)}"
        rows.append((2000 + i, " ".join(copy)))
    return rows


@pytest.mark.parametrize("star_yield, cell", [(0.05, 1 << 18), (1e-9, 1 << 18), (1e9, 300)])
def test_near_groups(spark, monkeypatch, star_yield, cell):
    monkeypatch.setattr(M, "STAR_YIELD", star_yield)  # leaders as long as they find a link; one round of leaders only
    monkeypatch.setattr(M, "CELL_SHINGLES", cell)
    rows = corpus() + _chained_copies()
    got = M.near_groups(documents(spark, rows)).collect()
    want = _components(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert len(got) == len(rows) and all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert sum(not r["kept"] for r in got) > 30


def test_cells_of_many_short_sets_are_bounded_in_rows(spark, monkeypatch):
    """Lines that differ in the last of ten words share bands but are not linked (Jaccard 5/7)."""
    real = M._cell_links

    def bounded(percent):
        run = real(percent)

        def checked(cell):
            if cell.num_rows > 400:
                raise ValueError(f"a cell of {cell.num_rows} rows")
            return run(cell)

        return checked

    monkeypatch.setattr(M, "_cell_links", bounded)
    monkeypatch.setattr(M, "CELL_ROWS", 100, raising=False)
    rows = [(i, f"one two three four five six seven eight nine end{i}") for i in range(600)]
    got = M.near_groups(documents(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {i: (6, i) for i, _ in rows}


def test_near_groups_null_ids_and_repeated_rows(spark):
    a, b = prose(1, 50), prose(2, 50)
    rows = [(None, a), (7, a), (7, a), (7, b), (9, b + " more"), (None, prose(3, 40)), (11, None), (11, None)]
    got = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in M.near_groups(documents(spark, rows)).collect())
    assert got == Counter({(None, 7, False): 1, (7, 7, True): 3, (9, 7, False): 1, (None, None, True): 1, (11, 11, True): 2})
    docs = documents(spark, rows)
    left = M.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == Counter([(7, a), (7, b), (None, rows[5][1]), (11, None), (11, None)])


def test_near_groups_of_nothing_and_of_strangers(spark):
    assert M.near_groups(documents(spark, [])).count() == 0
    assert {r["component_id"] for r in M.near_groups(documents(spark, [(1, prose(1, 9)), (2, prose(2, 9)), (3, "")])).collect()} == {1, 2, 3}


def test_signature_is_one_permutation_shifted_round():
    shingles, starts = M.shingle_sets(pa.array([prose(1, 50), "", "one two", prose(2, 3000)]))
    sig = M.signatures(shingles, starts, 16)
    pi = M._stretches(16)[:, 0]
    size = 1 << M.UNIVERSE_BITS
    at = (M.mix64(shingles ^ M._STEP) >> np.uint64(64 - M.UNIVERSE_BITS)).astype(np.int64)
    for d in range(4):
        p = at[starts[d] : starts[d + 1]]
        want = [min(int(pi[(x + k) % size]) for x in p) if len(p) else 2**32 - 1 for k in range(16)]
        assert sig[d].tolist() == want
    assert sorted(pi[:size].tolist()) == list(range(size))


def test_signatures_estimate_similarity():
    words = prose(5, 600).split()
    other = words[:500] + prose(6, 100).split()
    x, y = _shingles(" ".join(words)), _shingles(" ".join(other))
    sig = M.signatures(*M.shingle_sets(pa.array([" ".join(words), " ".join(other)])), 512)
    assert abs((sig[0] == sig[1]).mean() - len(x & y) / len(x | y)) < 0.08


def test_components_of_a_chain_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["comp"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200, 202: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def _repeats(rows):
    """By definition, from a table of every 50-byte string's smallest document."""
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        b = (t or "").encode()
        for p in range(len(b) - 49):
            first.setdefault(b[p : p + 50], i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49 if i is not None else 0):
            if first[b[p : p + 50]] < i:
                gone[p : p + 50] = b"\1" * 50
        n_spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), n_spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def _few_letters(seed, n):
    rnd = random.Random(seed)
    return "".join(rnd.choice("ab") if rnd.random() < 0.1 else "a" for _ in range(n))


@pytest.mark.parametrize("bucket_bytes, hot_holders", [(8 << 20, 4096), (20_000, 4096), (20_000, 2), (500, 0)])
def test_repeats(spark, bucket_bytes, hot_holders):
    rows = corpus(40) + [(500 + i, _few_letters(i, 400)) for i in range(12)]
    rows += [(600, "x" * 49), (601, "x" * 50), (602, "x" * 120), (603, "x" * 51), (604, "é" * 60), (605, "a" + "é" * 60)]
    got = suffix_radix.remove_repeats(documents(spark, rows), bucket_bytes=bucket_bytes, hot_holders=hot_holders)
    got = got.collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in got) == _repeats(rows)
    assert all(hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] for r in got)


def test_repeats_null_ids_and_repeated_rows(spark):
    a, b = prose(1, 40), prose(2, 40)
    rows = [(None, a), (4, a), (4, a), (4, b), (6, b + a), (None, b), (2, "short"), (2, "short"), (8, None)]
    got = suffix_radix.remove_repeats(documents(spark, rows)).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in got) == _repeats(rows)
    assert suffix_radix.remove_repeats(documents(spark, [])).count() == 0
