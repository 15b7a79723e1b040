"""Vector code compression against plain Python."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civicspark.llm import queries
from civicspark.llm import vector_codes as V
from tests.conftest import SF_SMALL
from tests.oracle_check import assert_matches_oracle

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, code int, low string, stamp int, error string, n int, part string"


def _frame(spark, rows, partitions=4):
    return spark.createDataFrame([(*r, "c", 1, "l", 2, "e", 3, None) for r in rows], SCHEMA).repartition(partitions)


def _nearest(x, entries):
    return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(entries))


def _plain_python(rows, parts, k, rounds):
    """Codes, errors and codebooks by comparing everything with everything, every round."""
    kept = [(i, [math.floor(1024 * float(np.float32(c))) for c in v], lab) for i, v, lab in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[r[1][p * width : (p + 1) * width] for r in kept] for p in range(parts)]
    books = [c[:k] for c in cut]
    for _ in range(rounds):
        for p in range(parts):
            members = [[] for _ in books[p]]
            for x in cut[p]:
                members[_nearest(x, books[p])[1]].append(x)
            books[p] = [[sum(c) // len(m) for c in zip(*m, strict=True)] if m else e for m, e in zip(members, books[p], strict=True)]
    out = []
    for n, (i, _, lab) in enumerate(kept):
        near = [_nearest(cut[p][n], books[p]) for p in range(parts)]
        out.append((i, lab, bytes(e for _, e in near), sum(d for d, _ in near)))
    return out, books


def _vectors(n, dim, seed, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.3, (6, dim))
    return [(int(i), [float(c) for c in np.float32(centres[i % 6] + rng.normal(0, spread, dim))], None if i % 7 == 0 else int(i % 3)) for i in rng.permutation(n)]


def _odd(dim):
    nan, inf = float("nan"), float("inf")
    zero = [0.0] * dim
    rows = [(900, None, 1), (901, [nan] + zero[1:], 1), (902, [inf] + zero[1:], 1), (903, [None] + zero[1:], 1), (904, [], 1), (905, zero[1:] + [-inf], 1)]
    return rows + [(5, [0.001] * dim, 2)] * 3 + [(None, [-0.0005] * dim, None)] * 2 + [(906, zero, None)] * 2


@pytest.mark.parametrize(("parts", "k", "rounds", "dim"), [(4, 40, 4, 8), (2, 33, 3, 6), (1, 70, 2, 3), (4, 256, 1, 4), (2, 5, 0, 4)])
def test_codes_are_those_of_plain_python(spark, parts, k, rounds, dim):
    rows = _vectors(150, dim, k) + _odd(dim)
    got = V.compress(_frame(spark, rows), V.Compression(parts, k, rounds))
    want, books = _plain_python(rows, parts, k, rounds)
    key = lambda r: (r[0] is None, r[0] or 0, repr(r))
    assert got.codebooks.tolist() == books
    assert sorted(((r["vec_id"], r["label"], bytes(r["code"]), r["error"]) for r in got.codes.collect()), key=key) == sorted(want, key=key)
    summed = {}
    for _, lab, _, e in want:
        summed[lab] = summed.get(lab, 0) + e
    assert {(r["label"], r["label_error"]) for r in V.label_errors(got.codes).collect()} == set(summed.items())
    assert V.label_errors(got.codes).count() == len(want)


def test_bounds_skip_scans_and_change_nothing():
    rng = np.random.default_rng(4)
    centres = rng.integers(-900, 900, (64, 2, 8))
    x = centres[rng.integers(0, 64, 3000)] + rng.integers(-60, 60, (3000, 2, 8))
    history = x[:64].transpose(1, 0, 2)[None]
    code, stamp = np.zeros((3000, 2), np.uint8), np.zeros((3000, 2, 2), np.uint8)
    low, seen = np.full((3000, 2, 2), -1, np.float32), V.Scan()
    for _ in range(8):
        found = V.assign(x, history, code, low, stamp, seen)
        for p in range(2):
            apart = ((x[:, p, None] - history[-1, p][None]) ** 2).sum(-1)
            assert (code[:, p] == apart.argmin(1)).all() and (found[:, p] == apart.min(1)).all()
            for g, of in enumerate(V.groups_of(64)):  # a bound, lowered by the net move since its stamp, holds for every other entry
                inside = np.where(np.arange(of.start, of.stop) == code[:, p, None], np.inf, np.sqrt(apart[:, of]))
                assert (low[:, p, g] - V.net_moves(history)[stamp[:, p, g], p, g] <= inside.min(1) + 1e-9).all()
        books = history[-1].copy()
        for p in range(2):
            for e in range(64):
                if (code[:, p] == e).any():
                    books[p, e] = x[code[:, p] == e, p].sum(0) // (code[:, p] == e).sum()
        history = np.concatenate([history, books[None]])
    assert seen.skipped > seen.scanned / 4
    assert len(np.unique(stamp)) > 2  # bounds of several rounds are in use
    summed = np.stack([np.sqrt(((np.diff(history[s:], axis=0)) ** 2).sum(-1)).sum(0) for s in range(len(history))])
    assert (V.net_moves(history) <= np.stack([summed[:, :, g].max(-1) for g in V.groups_of(64)], -1) * (1 + 1e-6)).all()


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 70), st.sampled_from([3, 40, 2**26]))
def test_any_history_gives_the_nearest_entry(seed, k, top):
    rng = np.random.default_rng(seed)
    x = rng.integers(-top, top + 1, (40, 2, 3))
    code, groups = np.zeros((40, 2), np.uint8), len(V.groups_of(k))
    low, stamp = np.full((40, 2, groups), -1, np.float32), np.zeros((40, 2, groups), np.uint8)
    history = rng.integers(-top, top + 1, (1, 2, k, 3))
    for _ in range(5):
        found = V.assign(x, history, code, low, stamp)
        for p in range(2):
            apart = ((x[:, p, None] - history[-1, p][None]) ** 2).sum(-1)
            assert (code[:, p] == apart.argmin(1)).all() and (found[:, p] == apart.min(1)).all()
        moved = rng.random((1, 2, k, 1)) < 0.5
        history = np.concatenate([history, np.clip(history[-1:] + moved * rng.integers(-2 - top // 20, 3 + top // 20, (1, 2, k, 3)), -top, top)])


def test_edges(spark):
    empty = _frame(spark, _vectors(5, 4, 1)).limit(0)
    got = V.compress(empty)
    assert V.label_errors(got.codes).count() == 0 and got.codebooks.size == 0
    none_left = V.compress(_frame(spark, _odd(4)[:6]))
    assert none_left.codes.count() == 0
    with pytest.raises(ValueError, match="equal parts"):
        V.compress(_frame(spark, _vectors(5, 6, 1)))
    with pytest.raises(ValueError, match="256"):
        V.Compression(entries=300)
    with pytest.raises(ValueError, match="255"):
        V.Compression(rounds=256)
    mixed = _vectors(20, 4, 2) + [(100, [1.0] * 8, 1), (101, [2e5] * 4, 1)]  # another length; beyond the range
    assert V.compress(_frame(spark, mixed)).codes.count() == 20
    same = V.compress(_frame(spark, [(i, [0.25] * 4, None) for i in range(300)]))
    assert {(bytes(r["code"]), r["error"]) for r in same.codes.collect()} == {(b"\0\0\0\0", 0)}


def test_decoded_vectors_lie_near(spark):
    rows = _vectors(200, 8, 9, spread=0.01)
    got = V.compress(_frame(spark, rows), V.Compression(entries=24))
    near = {r["vec_id"]: r["vector"] for r in V.decode(got.codes, got.codebooks).collect()}
    errors = {r["vec_id"]: r["error"] for r in got.codes.collect()}
    for i, v, _ in rows:
        exact = sum((math.floor(1024 * c) - 1024 * d) ** 2 for c, d in zip(v, near[i], strict=True))
        assert exact == errors[i]


def test_label_lookup_without_broadcast(spark):
    got = V.compress(_frame(spark, _vectors(120, 4, 3)))
    plain = sorted(map(repr, V.label_errors(got.codes).collect()))
    for k, v in {"civicspark.broadcastRows": "0", "civicspark.hotSlots": "3"}.items():
        spark.conf.set(k, v)
    try:
        assert sorted(map(repr, V.label_errors(got.codes).collect())) == plain
    finally:
        for k in ("civicspark.broadcastRows", "civicspark.hotSlots"):
            spark.conf.unset(k)


def test_query_matches_oracle(spark):
    assert_matches_oracle(spark, SF_SMALL, "op12_vector_codes")
    row = queries.op12_vector_codes(spark, SF_SMALL).first()
    assert len(row["code"]) == 8 and len(row["codebooks_sha256"]) == len(hashlib.sha256().hexdigest())
    assert queries.op12_vector_codes(spark, SF_SMALL).where(F.col("label_error") < F.col("error")).count() == 0
