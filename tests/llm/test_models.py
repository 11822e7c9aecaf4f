"""Held-out accuracy and odd rows of the learned operators."""

from __future__ import annotations

import os
import zlib

import numpy as np
import pytest

from checks.compare import TESTDATA
from driverlens.llm import langid, quality
from driverlens.llm.common import pieces
from fixtures import ROWS, doc, frame, words

SF_DIR = f"{TESTDATA}/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


@needs_tables
def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = langid.predict(docs, langid.fit(docs, sample_rows=400)).collect()
    held = [r for r in found if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 100
    assert np.mean([r.lang_pred == r.lang for r in held]) >= 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_languages_of_odd_rows(spark):
    model = langid.fit(frame(spark))
    out = langid.predict(frame(spark, ROWS + [doc(40, "12 34 !!")]), model).collect()
    assert len(out) == len(ROWS) + 1
    for row in out:
        assert (row.lang_pred == "und") == (not any(map(str.isalpha, row.text or "")))
        assert 0 <= row.score <= 1 and row.key == "k"
    none = langid.fit(frame(spark, []))
    assert {r.lang_pred for r in langid.predict(frame(spark), none).collect()} == {"und"}


def test_held_out_rows_and_null_languages_teach_nothing(spark):
    rows = [doc(i, words(i, 30), "xx" if zlib.crc32(str(i).encode()) % 5 == 0 else None if i % 3 else "en") for i in range(60)] + [doc(None, words(9, 30), "yy")]
    assert langid.fit(frame(spark, rows)).languages == ["en"]


def test_long_texts_in_blocks_count_the_same(monkeypatch):
    text = words(1, 400)
    whole = langid.counts(text)
    monkeypatch.setattr(langid, "BLOCK", 50)
    blocks = langid.counts(text)
    assert blocks.sum() <= whole.sum() * 1.1 and (blocks > 0).sum() >= (whole > 0).sum() * 0.9
    assert "".join(pieces(text, 50)) == text


@needs_tables
def test_quality_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("documents", "labels"))
    found = quality.predict(docs, quality.fit(docs, labels, sample_rows=300)).join(labels, "doc_id").collect()
    held = [r for r in found if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(held) > 80
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.95


def test_quality_of_odd_rows(spark):
    labels = spark.createDataFrame([(0, 1), (2, 0), (6, 1), (6, 0), (8, None), (None, 1), (10, 0), (99, 1), (3, 0), (4, 1)], "doc_id BIGINT, quality INT")
    model = quality.fit(frame(spark), labels)
    out = quality.predict(frame(spark), model).collect()
    assert len(out) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    none = quality.predict(frame(spark), quality.fit(frame(spark), labels.limit(0))).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(1)
    x, sizes = rng.normal(size=(9, quality.FEATURES)), np.array([2, 4, 3])
    starts, owner, y = np.array([0, 2, 6]), np.repeat(np.arange(3), sizes), np.array([0.0, 1.0, 1.0])
    p = quality._start(rng)

    def loss(p):
        total = 0
        for k in range(3):
            h = np.tanh(x[owner == k] @ p["W"] + p["b"])
            e = (np.tanh(h @ p["V"]) / (1 + np.exp(-h @ p["U"]))) @ p["w"]
            a = np.exp(e) / np.exp(e).sum()
            s = 1 / (1 + np.exp(-(a @ h @ p["c"] + p["d"][0])))
            total -= np.log(s if y[k] else 1 - s)
        return total / 3

    g = quality._gradient(p, x, starts, owner, y)
    for name in p:
        at = tuple(rng.integers(0, n) for n in p[name].shape)
        moved = {k: v.copy() for k, v in p.items()}
        moved[name][at] += 1e-5
        assert (loss(moved) - loss(p)) / 1e-5 == pytest.approx(g[name][at], abs=1e-4)


def test_scores_do_not_depend_on_the_pieces(monkeypatch):
    texts = [words(i, 200) for i in range(6)]
    model = quality.train([quality.bag(t) for t in texts], np.array([0, 1, 0, 1, 0, 1]), steps=5)
    x = quality.bag(texts[0])
    one = quality._attend(model, x, -np.inf, 0.0, np.zeros(quality.HIDDEN))
    two = quality._attend(model, x[2:], *quality._attend(model, x[:2], -np.inf, 0.0, np.zeros(quality.HIDDEN)))
    assert one[2] / one[1] == pytest.approx(two[2] / two[1])


def shuffled(spark, rows, seed):
    import random

    mixed = list(rows)
    random.Random(seed).shuffle(mixed)
    return frame(spark, mixed).repartition(1 + seed)


def test_models_do_not_depend_on_the_order_of_repeated_ids(spark):
    """Ids that come with several texts and languages teach with one definite row."""
    rows = [doc(i % 20, words(i, 40 + i), ("en", "de", "fr")[i % 3]) for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id BIGINT, quality INT")
    first, second = (langid.fit(shuffled(spark, rows, seed)) for seed in (0, 4))
    assert first.languages == second.languages and first.temperature == second.temperature
    assert (first.weights == second.weights).all() and (first.idf == second.idf).all()
    one, two = (quality.fit(shuffled(spark, rows, seed), labels) for seed in (0, 4))
    assert all((one[name] == two[name]).all() for name in one)


def test_long_texts_teach_with_passages_of_the_whole_text():
    bag = np.arange(500.0)[:, None]
    places = quality.drawn(bag, quality.PASSAGES)[:, 0].tolist()
    assert len(places) == quality.PASSAGES and places == sorted(places)
    assert max(np.diff([0, *places, len(bag)])) < 5 * len(bag) / quality.PASSAGES  # spread over all of it
    assert (quality.drawn(bag[:7], 32) == bag[:7]).all()


def test_weights_beside_a_scalar_ftrl():
    rng = np.random.default_rng(3)
    rows = [(np.sort(rng.choice(60, 5, replace=False)), rng.random(5), int(rng.integers(3))) for _ in range(40)]
    z, n = {}, {}

    def weight(key):
        if abs(z.get(key, 0.0)) <= langid.L1:
            return 0.0
        value = z[key]
        return -(value - np.sign(value) * langid.L1) / ((langid.BETA + n[key] ** 0.5) / langid.ALPHA + langid.L2)

    for epoch in range(3):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            at, values, label = rows[k]
            entries = [*zip(at.tolist(), values.tolist()), (langid.DIM, 1.0)]
            before = {(i, c): weight((i, c)) for i, _ in entries for c in range(3)}
            scores = [sum(v * before[i, c] for i, v in entries) for c in range(3)]
            chances = [np.exp(s) / sum(np.exp(t) for t in scores) for s in scores]
            for i, v in entries:
                for c in range(3):
                    g = v * (chances[c] - (c == label))
                    old = n.get((i, c), 0.0)
                    z[i, c] = z.get((i, c), 0.0) + g - ((old + g * g) ** 0.5 - old**0.5) / langid.ALPHA * before[i, c]
                    n[i, c] = old + g * g
    got = langid.train(rows, 3, epochs=3)
    for i, c in z:
        assert got[i, c] == pytest.approx(weight((i, c)), abs=1e-12)
    assert (got != 0).any() and (got == 0).any()


def test_score_beside_a_scalar_attention():
    texts = [words(i, 150 + 30 * i) for i in range(4)]
    model = quality.train([quality.bag(t) for t in texts], np.array([0, 1, 1, 0]), steps=8)
    for text in texts:
        weights, hidden = [], []
        for passage in quality.bag(text).astype(float):
            x = [(v - m) / s for v, m, s in zip(passage, model["mean"], model["scale"])]
            h = [np.tanh(sum(a * model["W"][k, j] for k, a in enumerate(x)) + model["b"][j]) for j in range(quality.HIDDEN)]
            t = [np.tanh(sum(a * model["V"][k, j] for k, a in enumerate(h))) for j in range(quality.GATE)]
            u = [1 / (1 + np.exp(-sum(a * model["U"][k, j] for k, a in enumerate(h)))) for j in range(quality.GATE)]
            weights.append(np.exp(sum(a * b * c for a, b, c in zip(t, u, model["w"]))))
            hidden.append(h)
        mean = [sum(w * h[j] for w, h in zip(weights, hidden)) / sum(weights) for j in range(quality.HIDDEN)]
        plain = 1 / (1 + np.exp(-(sum(a * b for a, b in zip(mean, model["c"])) + model["d"][0])))
        assert quality.score(model, text) == pytest.approx(float(plain), abs=1e-6)
