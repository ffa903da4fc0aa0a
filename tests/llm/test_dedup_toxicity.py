from __future__ import annotations

import random

import pytest
from fixtures import documents, mixed_rows, sentence
from pyspark.sql import functions as F

from windgrid.llm import dedup, toxicity
from windgrid.llm.components import components
from windgrid.llm.toxicity import HARMLESS, ToxicityModel, matcher


def brute_components(rows, size, percent):
    sets, root = {}, {}
    for d, text in rows:
        words = dedup.words_of(text)
        n = min(size, len(words))
        sets[d] = set(zip(*(words[j:] for j in range(n)))) if words else set()

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def near_copies(seed, n, edits):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 9999)}" for _ in range(120)]
    rows = []
    for k in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(120)] = f"x{rng.randint(0, 10**6)}"
        rows.append((10_000 + k, " ".join(words)))
    return rows


@pytest.mark.parametrize("block_rows", [512, 16])
def test_components_equal_brute_force(spark, block_rows):
    rows = [r for r in mixed_rows(21) if r[0] is not None]
    rows += near_copies(1, 60, 5) + [(20_000, rows[3][1].upper()), (30_000, "one"), (30_001, "ONE"), (30_002, "one two")]
    rows += [(40_000 + k, "exactly the same text in a large group") for k in range(60)]
    got = dedup.link(documents(spark, rows), size=3, percent=85, block_rows=block_rows).collect()
    wanted = brute_components(rows, 3, 85)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == wanted
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_null_ids_and_empty_tables(spark):
    got = dedup.link(documents(spark, [(None, "a b c d e f"), (3, "a b c d e f"), (4, None)]), 3, 85).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(None, None, True), (3, 3, True), (4, 4, True)}
    assert dedup.link(documents(spark, []), 3, 85).count() == 0


def test_posterior_bound_and_bands():
    bands, rows = dedup.band_plan(0.8)
    assert (1 - 0.8**rows) ** bands <= 1e-5
    for k, m in dedup.needed_matches(0.8, bands * rows, 1e-5):
        assert 0 < m < 0.8 * k


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 150)] + [(5, 5), (1, 0)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(1000, 1150), 1000)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_toxicity_separates_held_out_rows_and_folds(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for k in range(400):
        toxic = k % 4 == 0
        text = sentence(rng, 40) + (" " + rng.choice(["grumbel", "sneerly"]) + rng.choice(["", "ish", "ity"]) if toxic else "") + " " + sentence(rng, 10)
        rows.append((k, text))
        labels.append((k, 1, int(toxic)))
    frame = documents(spark, rows + [(900, "you GRUMB3L"), (901, "gгumbеl"), (902, None), (903, ""), (904, "fine words")])
    held_out = F.col("doc_id") % 5 == 0
    model = ToxicityModel.fit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), held_out)
    got = {r.doc_id: r for r in frame.select("doc_id", model.column(F.col("text")).alias("t")).select("doc_id", "t.*").collect()}
    assert all(got[k].predicted == int(k % 4 == 0) for k in range(400))
    assert got[900].predicted == 1 and got[902].score == got[903].score == got[904].score < 0.3


def test_harmless_phrases_and_word_beginnings():
    match = matcher({"trash": 5.0, "idiot": 4.0}, HARMLESS)
    assert match("put it in the Trash Can, please")[0] == 0
    assert match("trash trashy 1d10t")[0] == 14
    assert match("nontrash")[0] == 0


def test_toxicity_without_labels(spark):
    frame = documents(spark, mixed_rows())
    model = ToxicityModel.fit(frame, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {r.p for r in frame.select(model.column(F.col("text"))["predicted"].alias("p")).collect()} == {0}


def test_rare_toxic_words_are_learned_in_large_samples(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(8))
    rows = [(k, f"{word()} common {word()}", 0) for k in range(3000)]
    rows += [(10_000 + k, f"{word()} common {'zorkish' if k >= 4 else 'quuxing'} {word()}", 1) for k in range(3000)]
    sample = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = toxicity.learn_lexicon(sample, min_odds=2.0)
    assert any("quuxing".startswith(t) for t in lexicon) and any("zorkish".startswith(t) for t in lexicon)


def naive_weight(text, lexicon, harmless):
    """Every place, every entry, every phrase, one after the other."""
    folded, plain = toxicity.fold(text, toxicity.folding_tables())
    begins = [k for k in range(len(folded)) if k == 0 or not plain[k - 1].isalpha()]
    quiet = {q for k in begins for p in harmless if folded.startswith(p, k) for q in range(k, k + len(p))}
    return sum(max((w for t, w in lexicon.items() if folded.startswith(t, k)), default=0.0) for k in begins if k not in quiet)


def test_signs_before_a_word_and_every_look_alike_fold():
    lexicon = {"idiot": 2.0, "hate": 1.5, "shit": 1.0, "moron": 3.0}
    match = matcher(lexicon, HARMLESS)
    for text in ("idiot", "@idiot", "|idiot|", "!idiot", "wow!idiot", "1diot", "|d!0t", "the ＠ｉｄｉｏｔ", "i​diot", "ïdîöt"):
        assert match(text)[0] == 2.0, text
    assert match("hatз")[0] == 1.5 and match("$hit")[0] == 1.0 and match("5hit @$hit")[0] == 2.0
    for text in ("", None, "whatever chateau", "oxymoron", "1 2 3 !"):
        assert match(text)[0] == 0.0, text
    assert all(v not in toxicity.LOOK_ALIKES for v in toxicity.folding_tables()[1].values())


def test_matches_equal_a_naive_scan():
    lexicon = {"idiot": 2.0, "idioti": 2.5, "hate": 1.5, "clown": 3.0}
    harmless = ("clown fish", "hate to see", "idiot proof")
    match = matcher(lexicon, harmless)
    rng = random.Random(8)
    pieces = ["idiot", "idiotic", "@idiot", "1d1ot", "clown fish", "clown", "hate", "to see", "h8", "proof", "ха", "x", "!", "İ", "ß", "\n", "clownfish"]
    for _ in range(400):
        text = "".join(rng.choice(pieces) + rng.choice([" ", "", " ", "!"]) for _ in range(rng.randint(0, 30)))
        assert abs(match(text)[0] - naive_weight(text, lexicon, harmless)) < 1e-9, text
    long = "clown fish idiot " * 20_000
    assert abs(match(long)[0] - 40_000) < 1e-6


def test_harmless_phrases_are_learned_from_clean_rows(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("bdfgklmnprtv", k=6))
    some = lambda k: " ".join(word() for _ in range(k))
    rows = [(k, f"{some(8)} you grubnax {some(8)}", 1) for k in range(60)]
    rows += [(100 + k, f"{some(8)} the grubnax valley {some(8)}", 0) for k in range(15)]
    rows += [(200 + k, f"grubnax copied line {' '.join(['same'] * 5)}", 0) for k in range(50)]
    rows += [(1000 + k, some(16), 0) for k in range(900)]
    documents = spark.createDataFrame([(d, t) for d, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(d, y) for d, _, y in rows if not 200 <= d < 300], "doc_id long, toxic int")
    model = ToxicityModel.fit(documents, labels)
    assert any(p.startswith("grubnax") for p in model.lexicon) or any("grubnax".startswith(p) for p in model.lexicon)
    assert "grubnax valley" in model.harmless
    got = dict(documents.select("doc_id", model.column(F.col("text"))["predicted"]).collect())
    assert all(got[d] == 1 for d in range(60)) and all(got[d] == 0 for d in range(100, 115))
    every = spark.createDataFrame([(d, y) for d, _, y in rows], "doc_id long, toxic int")
    again = ToxicityModel.fit(documents, every)
    assert "grubnax copied" not in again.harmless and again.lexicon
