from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from fixtures import CLASHES, documents, mixed_rows, sentence

from windgrid.llm import codes, mixing, ranked


# Mixing


def sourced(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return frame.selectExpr("doc_id", "text", "source", *[c for c in CLASHES.split(", ")], "9 AS p", "8 AS place", "7 AS target", "6 AS bucket")


def plain_targets(sizes: dict, share=1.5, most=2.0) -> dict:
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    left, open_, out = share * sum(sizes.values()), set(sizes), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        for s in over or open_:
            out[s] = most * sizes[s] if over else left * weight[s] / total
        left -= sum(out[s] for s in over)
        open_ -= over or set(open_)
    return out


def mixing_rows(seed=5):
    rng = random.Random(seed)
    rows = [(k, sentence(rng, int(rng.lognormvariate(4, 1)) + 1), rng.choice(["hot"] * 6 + ["b", "c", "\U0001f600", "￿", None])) for k in range(900)]
    rows += [(1000, None, "b"), (1001, "", "c"), (1002, "", "only empty"), (1003, None, None), (None, "no id", "b"), (1004, "one", "single"), (1005, "twice", "hot"), (1005, "twice", "hot")]
    return rows + [(1006, sentence(rng, 20_000), "long")]


def test_mix_comes_near_each_target_and_agrees_with_itself(spark):
    rows = mixing_rows()
    given = sourced(spark, rows)
    got = [tuple(r) for r in mixing.mix(given, bucket_rows=16, fan_in=3).collect()]
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(((r[0], r[1], r[2]) for r in got), key=repr) == sorted(((d, s, words(t)) for d, t, s in rows), key=repr)
    sizes: Counter = Counter()
    for _, t, s in rows:
        sizes[s] += words(t)
    wanted = plain_targets(dict(sizes))
    taken: Counter = Counter()
    for _, s, size, source_size, target, n in got:
        assert source_size == sizes[s] and target == pytest.approx(wanted[s])
        assert 0 <= n <= 2 * size and (n == 0 or n % size == 0)
        # Every document has its whole copies, and one more at most.
        copies = target / source_size if source_size else 0
        assert size == 0 or n // size in (math.floor(copies + 1e-9), math.ceil(copies - 1e-9))
        taken[s] += n
    for s in sizes:
        longest = max(size for _, x, size, *_ in got if x == s)
        assert abs(taken[s] - wanted[s]) <= longest / 2 + 1e-6
    assert abs(taken["hot"] - wanted["hot"]) <= 0.01 * wanted["hot"]
    again = [tuple(r) for r in mixing.mix(given.repartition(7), bucket_rows=16, fan_in=3).collect()]
    assert sorted(got, key=repr) == sorted(again, key=repr)


def test_mix_of_an_empty_table(spark):
    assert mixing.mix(sourced(spark, [(1, "a", "b")]).limit(0)).collect() == []
    assert [r["taken"] for r in mixing.mix(sourced(spark, [(1, None, "b"), (2, "", None)])).collect()] == [0, 0]


def test_exchange_keeps_words_and_expectations():
    rng = random.Random(1)
    for _ in range(300):
        p, q, s, t = rng.random(), rng.random(), rng.randint(1, 50), rng.randint(1, 50)
        outcomes = Counter(mixing.exchange(p, s, q, t, (k + 0.5) / 400) for k in range(400))
        assert len(outcomes) <= 2
        for a, b in outcomes:
            assert a * s + b * t == pytest.approx(p * s + q * t) and (a in (0, 1) or b in (0, 1))
            assert -1e-9 <= a <= 1 + 1e-9 and -1e-9 <= b <= 1 + 1e-9
        assert sum(a * n for (a, _), n in outcomes.items()) / 400 == pytest.approx(p, abs=0.006)


# Vector codes


def plain_codes(rows, entries, rounds, n_parts):
    kept = sorted(((i, v, label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in kept if len(v) == len(kept[0][1])]
    d = len(kept[0][1])
    cuts = [k * d // n_parts for k in range(n_parts + 1)]
    parts = [[v[a:b] for a, b in zip(cuts, cuts[1:])] for _, v, _ in kept]
    books = [[p[k] for p in parts[:entries]] for k in range(n_parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for k in range(n_parts):
            members: dict = {}
            for p in parts:
                members.setdefault(near(p[k], books[k])[1], []).append(p[k])
            books[k] = [[sum(x) // len(x) for x in zip(*members[e])] if e in members else c for e, c in enumerate(books[k])]
    out = []
    for (i, _, label), p in zip(kept, parts):
        found = [near(p[k], books[k]) for k in range(n_parts)]
        out.append((i, label, "".join(f"{e:02x}" for _, e in found), sum(x for x, _ in found)))
    return out, books


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_codes_equal_plain_rounds(spark, scale):
    rng = random.Random(11)
    vector = lambda: [scale * rng.gauss(0, 1) for _ in range(9)]
    hot = vector()
    rows = [(k, hot if k % 3 == 0 else vector(), rng.choice([None, 1, 2])) for k in range(120)]
    rows += [(500, None, 1), (501, [1.0, None] + [0.0] * 7, 1), (502, [float("nan")] * 9, 2), (503, [float("inf")] * 9, 2), (504, [], 1), (505, [1.0, 2.0], 1)]
    rows += [(None, vector(), None), (7, vector(), 2), (7, rows[7][1], 2)]
    given = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS rid", "2 AS position", "3 AS entry", "4 AS part", "5 AS v")
    wanted, books = plain_codes(rows, 16, 3, 4)
    coded, got_books = codes.compress(given, entries=16, rounds=3)
    assert [b.tolist() for b in got_books] == books
    assert sorted(map(tuple, coded.collect()), key=repr) == sorted(wanted, key=repr)
    sums: Counter = Counter()
    for _, label, _, error in wanted:
        sums[label] += error
    assert {(r["label"], r["label_error"]) for r in codes.with_label_error(coded).collect()} == {(k, min(v, (1 << 63) - 1)) for k, v in sums.items()}


def test_codes_of_few_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    empty, books = codes.compress(spark.createDataFrame([], schema))
    assert empty.collect() == [] and books == []
    one, books = codes.compress(spark.createDataFrame([(3, [0.5, 0.25], 1)], schema))
    assert [tuple(r) for r in one.collect()] == [(3, 1, "00000000", 0)] and [b.tolist() for b in books] == [[[]], [[512]], [[]], [[256]]]


def test_only_parts_with_another_entry_move(spark):
    parts = spark.createDataFrame([(k, k % 4, [k], k % 3, k % 3 if k % 2 else 0) for k in range(60)], "rid long, position int, part array<bigint>, entry int, was int")
    moved = codes.migrated(parts, 3)
    assert sorted(r["rid"] for r in moved.collect()) == list(range(60))
    text = moved._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Union" in text


# Ranked search


def plain_ranking(rows, items, k):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    found = [(d, Counter(terms(t))) for d, t in rows if terms(t)]
    n_docs, n_terms = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in sorted(set((i, t or "") for i, t in items), key=repr):
        scored = []
        for d, c in found:
            m = 10 + (90 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, rank, None if null else d, -score) for rank, (score, null, d) in enumerate(sorted(scored)[:k], 1)]
    return out


@pytest.mark.parametrize("block", [7, 4096])
def test_ranking_equals_plain_scores(spark, block):
    rows = mixed_rows() + [(k, "alpha beta") for k in range(100, 140)] + [(200, "x" * 30_000 + " alpha " + "y9 " * 5000)]
    rng = random.Random(2)
    items = [(k, sentence(rng, rng.randint(1, 12))) for k in range(12)] + [(20, None), (21, ""), (22, "!?"), (23, "absent-word"), (24, "ALPHA, Beta"), (24, "ALPHA, Beta"), (24, "gamma"), (None, "Crème 日本語 brûlée"), (25, sentence(rng, 4000))]
    given = documents(spark, rows).selectExpr("*", "1 AS n", "2 AS terms", "3 AS rank")
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS query", "2 AS doc_id")
    got = ranked.rank(given, asked, k=4, block=block, wave_chars=20_000)
    wanted = plain_ranking(rows, items, 4)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(wanted, key=repr)


def test_ranking_of_empty_tables(spark):
    none, items = documents(spark, [(1, "a")]).limit(0), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked.rank(none, items).collect() == []
    assert ranked.rank(documents(spark, [(1, "a")]), items.limit(0)).collect() == []


def test_pair_bounds_hold_and_are_below_the_sums():
    rng = np.random.default_rng(4)
    for _ in range(200):
        impacts = rng.integers(1, 100, (30, 7)) * (rng.random((30, 7)) < 0.4)
        tops = impacts.max(axis=0).tolist()
        both = [0] + [int(((impacts[:, i - 1] + impacts[:, i]) * (impacts[:, i - 1] > 0) * (impacts[:, i] > 0)).max()) for i in range(1, 7)]
        bounds = ranked.prefix_bounds(tops, both)
        for j in range(8):
            assert impacts[:, :j].sum(axis=1).max(initial=0) <= bounds[j] <= sum(tops[:j])
    assert ranked.prefix_bounds([5, 5, 5, 5], [0, 0, 0, 0]) == [0, 5, 5, 10, 10]
