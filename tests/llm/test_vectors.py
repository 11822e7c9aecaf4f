"""Whitening, hard negatives and nearest neighbours beside brute force, with odd rows."""

from __future__ import annotations

import numpy as np
import pytest

from driverlens.llm import hardnegatives, hashforest, whitening
from driverlens.llm.bidiagonal import right_vectors
from driverlens.llm.vectors import finite
from pyspark.sql import functions as F

# Extra columns carry names that the operators use inside or return.
SCHEMA = "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT, id STRING, v STRING, x STRING, leaf STRING, whitened STRING, whitening_x STRING, score STRING, asked STRING, n STRING"
EXTRA = ("i", "v", "x", "l", "w", "wx", "s", "a", "n")
NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, *EXTRA) for i, v, label in rows], SCHEMA)


def vectors(n, width, seed=1, groups=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, width))
    which = rng.integers(0, groups, n)
    return centres[which] * 2 + rng.normal(size=(n, width)) * 0.5, which


def odd(width):
    good = [0.5] * width
    return [
        (9001, None, 1), (9002, good[:-1] + [None], 1), (9003, good[:-1] + [NAN], 1), (9004, good[:-1] + [INF], 1), (9005, good[:-1] + [-INF], 2),
    ]


@pytest.fixture(scope="module")
def some():
    x, which = vectors(700, 12)
    x[40:60] = x[40]  # ties
    rows = [(i, [float(c) for c in v], int(g)) for i, (v, g) in enumerate(zip(x, which))]
    return rows + [rows[7], rows[7]]  # repeated rows


@pytest.mark.parametrize("kind", ["random", "graded", "repeated", "flat", "zero", "close"])
def test_right_vectors_beside_a_library(kind):
    rng = np.random.default_rng(4)
    q = np.linalg.qr(rng.normal(size=(24, 24)))[0]
    m = {
        "random": np.triu(rng.normal(size=(24, 24))),
        "graded": np.triu(rng.normal(size=(24, 24))) * 10.0 ** -np.arange(24)[:, None],
        "repeated": q * np.repeat([4.0, 2.0, 1.0], 8),
        "flat": q @ np.diag([3.0, 2.0, 1.0] + [0.0] * 21) @ q.T,
        "zero": np.zeros((24, 24)),
        "close": q @ np.diag(1 + np.arange(24) * 1e-9) @ q.T,
    }[kind]
    values, v = right_vectors(m)
    assert np.abs(values - np.linalg.svd(m, compute_uv=False)).max() < 1e-13 * max(values[0], 1)
    assert np.abs(v.T @ v - np.eye(24)).max() < 1e-11
    assert np.abs(m.T @ (m @ v) - v * values**2).max() < 1e-13 * max(values[0] ** 2, 1)


def test_small_values_keep_their_digits():
    b = np.diag([1.0, 1e-8, 1e-16]) + np.diag([0.5, 1e-9], 1)
    values, _ = right_vectors(b)
    assert np.prod(values) == pytest.approx(1e-24, rel=1e-13)  # the determinant


def whole(rows, scale=whitening.SCALE, offset=whitening.OFFSET):
    width = max(len(v) for _, v, _ in rows)
    return np.array([[int(np.floor(scale * c)) + offset for c in [*v, *[0.0] * (width - len(v))]] for _, v, _ in rows], object)


def check_whitening(spark, rows, given, components=8):
    model = whitening.fit(frame(spark, given).repartition(5), components=components)
    out = whitening.transform(frame(spark, given), model)
    got = sorted((r.vec_id, r.deviation, r.whitened, r.id, r.n) for r in out.collect())
    x = whole(rows)
    n, sums = len(x), x.sum(axis=0)
    deviations = n * x - sums
    centred = np.array(deviations / n, float)
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1][:, :components]
    mine = np.array([g[2] for g in sorted(got, key=lambda g: g[0])])
    order = np.argsort([r[0] for r in rows], kind="stable")
    with np.errstate(invalid="ignore", divide="ignore"):
        want = (centred @ v / np.sqrt(e[:components]))[order]
    spread = e[:components] > 1e-9 * e[0]
    sign = np.sign((mine * want).sum(axis=0))
    assert np.abs((mine * sign - want)[:, spread]).max() < 1e-9
    assert (mine[:, ~spread] == 0).all()
    assert [g[1] for g in got] == sorted_like(got, rows, (deviations**2).sum(axis=1))
    assert model.n == n and {g[3:] for g in got} == {("i", "n")}
    assert model.shares()[: spread.sum()] == pytest.approx(list(e[: spread.sum()] / e.sum()), rel=1e-9)
    assert whitening.identity_error(out, model) < 1e-9


def sorted_like(got, rows, values):
    by = {}
    for r, value in zip(rows, values):
        by[r[0]] = int(value)
    return [by[g[0]] for g in got]


def test_whitening_beside_eigenvectors(spark, some):
    check_whitening(spark, some, some + odd(12))


def test_whitening_of_short_huge_and_flat_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.normal(size=1 + i % 4)], 0) for i in range(90)] + [(91, [], 0)]
    check_whitening(spark, rows, rows)
    flat = [(i, [1.0, float(i), 2.0 * i], 0) for i in range(50)]  # one direction only
    check_whitening(spark, flat, flat)
    huge = [(i, [float(c) * 1e9 for c in rng.normal(size=3)], 0) for i in range(60)]
    check_whitening(spark, huge, huge)


def test_whitening_of_next_to_nothing(spark):
    none = whitening.fit(frame(spark, odd(3)))
    assert none.n == 0 and whitening.transform(frame(spark, odd(3)), none).collect() == []
    one = whitening.fit(frame(spark, [(1, [1.0, 2.0], 0)]))
    (row,) = whitening.transform(frame(spark, [(1, [1.0, 2.0], 0)]), one).collect()
    assert row.whitened == [0.0, 0.0] and row.deviation == 0 and one.shares() == [0.0, 0.0]


def test_factors_of_many_tasks_fold(spark, some, monkeypatch):
    monkeypatch.setattr(whitening, "FANIN", 2)
    many = whitening.fit(frame(spark, some).repartition(9))
    one = whitening.fit(frame(spark, some).coalesce(1))
    assert many.values == pytest.approx(one.values, rel=1e-12) and many.sums == one.sums


def plain_negatives(rows, anchors, positives=5, negatives=10):
    usable = [r for r in rows if r[1] is not None and r[2] is not None and None not in r[1] and np.isfinite(r[1]).all()]
    width = max(len(r[1]) for r in usable)
    v = np.array([[int(c) for c in r[1]] + [0] * (width - len(r[1])) for r in usable], object)
    ids, labels = [r[0] for r in usable], [r[2] for r in usable]
    out = []
    for anchor in sorted({i for i in ids if i in anchors}):
        a = min((labels[k], list(v[k]), k) for k in range(len(ids)) if ids[k] == anchor)[2]
        scored = sorted((-int(v[a] @ v[k]), ids[k], labels[k]) for k in range(len(ids)) if ids[k] != anchor)
        first = [(i, -s) for s, i, label in scored if label == labels[a]][:positives]
        for i, s in first:
            window = [(j, -t) for t, j, label in scored if label != labels[a] and 30 * s <= -100 * t <= 90 * s][:negatives]
            out += [(anchor, i, rank, j, s, t) for rank, (j, t) in enumerate(window, 1)]
    return sorted(out)


def mined(spark, rows, anchors, **settings):
    table = frame(spark, rows).withColumn("whole", F.when(finite(F.col("embedding")), F.transform("embedding", lambda c: F.floor(c))))
    given = table.drop("v")
    index = hardnegatives.Index(given, "vec_id", "label", "whole", **settings)
    found = hardnegatives.mine(given, F.col("vec_id").isin(anchors), vector="whole", index=index)
    return index, sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("settings", [{}, {"sample": 300, "leaf": 16, "fanout": 4}])
def test_hard_negatives_beside_every_pair(spark, some, settings):
    scaled = [(i, [float(np.floor(64 * c)) for c in v], None if i == 33 else label % 3) for i, v, label in some] + odd(12)
    anchors = [0, 7, 33, 45, 100, 200, 300, 650, 9001]
    index, got = mined(spark, scaled, anchors, **settings)
    want = plain_negatives(scaled, anchors)
    assert got == want and len({g[0] for g in got}) >= 5
    if settings:
        assert len(index.tree.paths) > 20


def test_far_leaves_are_never_opened(spark):
    x, which = vectors(600, 6, groups=6)
    rows = [(i, [float(np.floor(40 * c)) for c in v], int(g)) for i, (v, g) in enumerate(zip(x, which))]
    index, _ = mined(spark, rows, [], leaf=20, fanout=6)
    v = np.array([rows[0][1]], np.int64)
    own = np.sort(np.array([r[1] for r in rows]) @ v[0])[-5]
    q = {"query": np.array([0]), "own": np.array([0]), "label": np.array([rows[0][2]]), "low": np.array([int(own)]), "high": np.array([2**63 - 1]), "start": np.array([int(own)]), "v": v}
    search = hardnegatives._Search(index.tree, q, 5, True, True)
    opened = [leaf for leaf in range(len(index.tree.paths)) if len(search.alive(leaf))]
    assert 0 < len(opened) < len(index.tree.paths) / 3


def test_hard_negatives_of_next_to_nothing(spark):
    assert mined(spark, [], [0])[1] == [] and mined(spark, odd(3), [9001])[1] == []
    assert mined(spark, [(0, [1.0, 2.0], 1)], [0])[1] == []
    large = [(i, [3e8 * (1 + i), 1.0], i % 2) for i in range(4)]  # products beyond 2^53
    bound = int(np.sqrt(float(2**63 - 1) / 2)) - 1
    assert mined(spark, large, [0])[1] == plain_negatives([(i, [min(c, bound) for c in v], label) for i, v, label in large], [0])


def plain_nearest(rows, queries, k):
    usable = [r for r in rows if r[1] is not None and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    out = {}
    for i, v, _ in usable:
        if i in queries:
            out[i] = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w, _ in usable if j != i)[:k]
    return out


def test_nearest_beside_every_pair(spark, some):
    rows = some + odd(12) + [(9100, [0.0] * 12, 1), (9101, [1.0], 1)]
    queries = {0, 7, 45, 300, 9001, 9100, 9101}
    got = {}
    found = hashforest.nearest(frame(spark, rows), F.col("vec_id").isin(sorted(queries)), k=10)
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((-r.score, r.id))
        assert r["rank"] == len(got[r.query_id])
    want = plain_nearest(rows, queries, 10)
    assert set(got) == set(want)
    hits = total = 0
    for q, expected in want.items():
        assert got[q] == sorted(got[q]) and len(got[q]) == len(expected)
        hits += len({i for _, i in got[q]} & {i for _, i in expected})
        total += len(expected)
    assert hits >= 0.95 * total


def test_few_candidates_are_all_returned(spark):
    rows = [(i, [float(np.cos(i)), float(np.sin(i))], 0) for i in range(12)]
    found = hashforest.nearest(frame(spark, rows), F.col("vec_id") < 3).collect()
    assert len(found) == 3 * 11
    want = plain_nearest(rows, {0, 1, 2}, 20)
    for r in found:
        assert want[r.query_id][r["rank"] - 1][1] == r.id and r.score == pytest.approx(-want[r.query_id][r["rank"] - 1][0])
    assert hashforest.nearest(frame(spark, []), F.col("vec_id") < 3).collect() == []
    assert hashforest.nearest(frame(spark, odd(2)), F.col("vec_id") > 3).collect() == []


def test_recall_in_blocks_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(hashforest, "BLOCK", 150)
    x = np.random.default_rng(6).normal(size=(900, 24)) * np.random.default_rng(7).uniform(0.5, 2, size=(900, 1))  # lengths differ
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(x)]
    found = hashforest.nearest(frame(spark, rows).repartition(3), F.col("vec_id") % 20 == 0, k=20, chunk=16).collect()
    want = plain_nearest(rows, set(range(0, 900, 20)), 20)
    pairs = {(q, i) for q, best in want.items() for _, i in best}
    assert len(pairs & {(r.query_id, r.id) for r in found}) >= 0.9 * len(pairs)


def test_levels_keep_the_chance_of_a_miss():
    for trees, miss in ((8, 0.1), (64, 0.08)):
        for cosine in (0.1, 0.5, 0.9, 1.0):
            level = hashforest.level_for(np.array([cosine]), trees, 24, miss)[0]
            p = 1 - np.arccos(min(cosine, 1 - 1e-12)) / np.pi
            assert (1 - p**level) ** trees <= miss + 1e-9 or level == 0
            assert level == 24 or (1 - p ** (level + 1)) ** trees > miss
