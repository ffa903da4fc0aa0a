from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
from fixtures import documents, mixed_rows
from pyspark.sql import functions as F

from windgrid.llm import scoring, search
from windgrid.llm.dedup import words_of
from windgrid.llm.gru import Gru, lanes_of


def brute_top(rows, k):
    sound = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in sound:
        if q % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in sound if c != q and len(b) == len(a))
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scores[:k])]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    rng = random.Random(4)
    rows = [(k, [rng.gauss(0, 0.3) for _ in range(24)]) for k in range(400)]
    rows += [(1000 + k, rows[7][1]) for k in range(150)]
    rows += [(50_000, None), (50_050, []), (50_100, [float("nan")] * 24), (50_150, [None] * 24), (50_200, [1.0, 2.0]), (50_201, [1.0, 1.0]), (None, rows[0][1]), (50_250, [3e9] * 24)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS score", "2 AS rank")
    got = search.top_k(frame, F.col("_id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 5)
    waves = search.top_k(frame, F.col("_id") % 50 == 0, wave_bytes=1000)
    assert sorted(map(tuple, waves.collect())) == brute_top(rows, 5)
    assert search.top_k(frame.filter("false"), F.col("_id") % 50 == 0).count() == 0


def test_gradients_equal_differences():
    model = Gru.start(np.array([5.0, 4, 3, 2, 1]), 6.0, 4, 2)
    model = Gru({k: v.astype(np.float64) for k, v in model.p.items()}, 2)
    rng = np.random.default_rng(1)
    given, targets = rng.integers(0, 7, (3, 5)), rng.integers(0, 7, (3, 5))
    targets[(targets == 5)] = 4
    targets[1, 3:] = -1
    h = rng.normal(0, 0.1, (3, 4))

    def loss():
        states, s = [], h
        gates = model.inputs()[given]
        for t in range(5):
            s = model.step(gates[:, t], s)[0]
            states.append(s)
        flat = np.stack(states, axis=1)
        return -model.log_probability(flat[targets >= 0], targets[targets >= 0]).sum()

    gradients, _, n = model.window_gradients(given, targets, h)
    assert n == 13
    for name in model.p:
        for at in list(np.ndindex(model.p[name].shape))[:7]:
            old = model.p[name][at]
            model.p[name][at] = old + 1e-5
            up = loss()
            model.p[name][at] = old - 1e-5
            down = loss()
            model.p[name][at] = old
            assert abs((up - down) / 2e-5 - gradients[name][at]) < 1e-4


def test_probabilities_sum_to_one_and_windows_carry_state():
    model = Gru.start(np.arange(1.0, 11.0), 3.0, 4, 4)
    h = np.random.default_rng(0).normal(size=(1, 4)).astype(np.float32)
    outside = len(model.p["wo"])
    every = [*range(outside), outside]
    assert abs(np.exp(model.log_probability(np.repeat(h, len(every), 0), np.array(every))).sum() - 1) < 1e-4
    texts = [np.random.default_rng(k).integers(0, 10, n) for k, n in enumerate((1, 5, 130, 64, 65, 3))]
    assert np.allclose(model.score(texts, 0, window=64), model.score(texts, 0, window=7, together=2), atol=1e-3)


def test_scores_of_documents(spark):
    rows = mixed_rows(9, 60)
    held_out = F.coalesce(F.col("doc_id") % 5 == 0, F.lit(False))
    got = scoring.score(documents(spark, rows), held_out, vocabulary=16, frequent=20).collect()
    counts = Counter()
    for d, t in rows:
        if d is None or d % 5:
            counts.update([*words_of(t), b""])
    n, v = sum(counts.values()), len(counts)
    texts = {}
    for d, t in rows:
        texts.setdefault(d, []).append([*words_of(t), b""])
    assert len(got) == len(rows)
    for r in got:
        options = [(len(w), sum(counts[x] > 0 for x in w), sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) for w in texts[r.doc_id]]
        assert any((a, b) == (r.n_tokens, r.n_known) and abs(c - r.base_score) < 1e-6 * abs(c) for a, b, c in options)
        assert r.train_tokens == n and r.score < 0 and r.held_out == (r.doc_id is not None and r.doc_id % 5 == 0)
    assert scoring.score(documents(spark, []), held_out).count() == 0
    alone = scoring.score(documents(spark, [(5, "a b")]), held_out).collect()
    assert len(alone) == 1 and alone[0].n_known == 0 and alone[0].score <= 0


def rounds_of(spark, monkeypatch, rows):
    met = []

    def spy(part, model, end, trainers):
        met.append((part.count(), part.selectExpr("sum(length(ids) div 2)").first()[0], trainers))
        return model

    monkeypatch.setattr(scoring, "train_round", spy)
    scoring.score(documents(spark, rows, extra=False), F.lit(False), vocabulary=16, frequent=20)
    return met


def test_whole_texts_are_trained_on(spark, monkeypatch):
    rows = [(k, "a b c " * (20 * k)) for k in range(10)]
    assert all(n == 10 and words == 60 * 45 + 10 for n, words, _ in rounds_of(spark, monkeypatch, rows))
    texts = [np.arange(n) % 10 for n in (70, 3, 41)]
    model = Gru.start(np.arange(1.0, 11.0), 3.0, 4, 4)
    assert model.train([texts], 0) == 114


def test_all_rows_are_trained_on_in_each_round_at_any_size(spark, monkeypatch):
    for n in (30, 3500, 12_000):
        assert rounds_of(spark, monkeypatch, [(k, f"a b {k}") for k in range(n)]) == [(n, 4 * n, max(1, n // 1000))] * 3


def plain_log_probability(model, words, end):
    """Word by word, each probability from the two softmaxes written out."""
    h, last, total = np.zeros((1, model.hidden)), end, 0.0
    share = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    for w in words:
        h = model.step(model.inputs()[[last]], h)[0]
        of_class = min(w // model.size, model.n_classes)
        total += math.log(share((h @ model.p["wc"] + model.p["bc"])[0])[of_class])
        if of_class < model.n_classes:
            inside = slice(of_class * model.size, (of_class + 1) * model.size)
            total += math.log(share((h @ model.p["wo"][inside].T + model.p["bo"][inside])[0])[w % model.size])
        last = w
    return total


def test_scores_equal_a_plain_forward_pass():
    rng = np.random.default_rng(3)
    texts = [np.append(rng.integers(1, 13, n), 0).astype(np.uint16) for n in (0, 1, 15, 16, 17, 400, 33)]
    model = Gru.start(np.arange(12.0, 0, -1), 3.0, 6, 4)
    model.train([texts] * 30, 0, lanes=4, lane=64)
    for together in (1, 3, 100):
        found = model.score(texts, 0, window=8, together=together)
        assert np.allclose(found, [plain_log_probability(model, t, 0) for t in texts], rtol=1e-4)
    assert model.score([], 0).shape == (0,)


def test_lanes_hold_every_word_once_and_begin_anew():
    texts = [np.arange(1, n + 1) for n in (5, 0, 1, 70, 9)]
    given, targets, fresh = (np.concatenate(x, axis=1) for x in zip(*lanes_of(texts, 0, 8, 4, 10)))
    assert given.shape[0] == 4 and given.shape[1] == -(-85 // 4)
    assert sorted(targets[targets >= 0]) == sorted(np.concatenate(texts))
    stream, begins, marks = targets.ravel()[:85], given.ravel()[:85], fresh.ravel()[:85]
    for k in range(85):
        starts = k in (0, 5, 6, 76)
        assert begins[k] == (0 if starts else stream[k - 1])
        assert marks[k] == (starts or k % given.shape[1] == 0)
    assert list(lanes_of([], 0, 8, 4, 10)) == [] and Gru.start(np.ones(3), 1.0, 2, 2).train([[], [np.zeros(0)]], 0) == 0


def test_reset_lanes_have_the_gradients_of_texts_apart():
    model = Gru.start(np.array([5.0, 4, 3, 2, 1]), 6.0, 4, 2)
    model = Gru({k: v.astype(np.float64) for k, v in model.p.items()}, 2)
    texts = [np.array([1, 2, 6]), np.array([4, 1, 0, 3, 0])]
    together = model.window_gradients(*next((g, t, np.zeros((1, 4)), f) for g, t, f in lanes_of(texts, 0, 8, 1, 1)))[0]
    apart = [model.window_gradients(np.array([[0, *t[:-1]]]), t[None, :], np.zeros((1, 4)))[0] for t in texts]
    for name in model.p:
        assert np.allclose(together[name], apart[0][name] + apart[1][name])


def test_a_trained_model_beats_the_base_on_held_out_texts(spark):
    rng = random.Random(5)
    verbs = {"cat": "sleeps", "dog": "barks", "bird": "sings", "fish": "swims"}
    rows = [(k, " ".join(f"the {n} {verbs[n]} ." for n in rng.choices(list(verbs), k=rng.randint(20, 120)))) for k in range(300)]
    got = scoring.score(documents(spark, rows, extra=False), F.col("doc_id") % 10 == 0).filter("held_out")
    base, score = got.selectExpr("sum(base_score) / sum(n_tokens)", "sum(score) / sum(n_tokens)").first()
    assert score > base + 0.3
