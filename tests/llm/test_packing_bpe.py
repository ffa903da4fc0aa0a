from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from fixtures import documents, mixed_rows
from tokenizers import Tokenizer

from windgrid.llm import bpe, packing, tokens

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def test_pieces_hold_every_id_once_and_lie_gapless(spark):
    rows = mixed_rows()
    got = packing.pack_documents(documents(spark, rows), WORD, capacity=64, unit=4).collect()
    library = Tokenizer.from_file(WORD)
    wanted = Counter()
    for doc_id, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        for start in range(0, len(ids), 64):
            wanted[(doc_id, start, len(ids[start : start + 64]), zlib.crc32(ids[start : start + 64].tobytes()), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == wanted
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64


def test_packing_an_empty_table(spark):
    assert packing.pack_documents(documents(spark, []), WORD).count() == 0


@pytest.mark.parametrize("n", [1, 7, 300, 5000])
def test_patterns_cover_the_demand_near_the_bound(n):
    rng = np.random.default_rng(n)
    classes = np.clip(rng.lognormal(3.5, 0.9, n).astype(int), 1, 127)
    histogram = np.bincount(classes, minlength=128)
    sizes = np.flatnonzero(histogram)
    patterns = packing.cutting_stock(sizes, histogram[sizes].astype(float), 128)
    covered = np.zeros(128, int)
    for uses, content in patterns:
        assert sum(sizes[k] * each for k, each in content.items()) <= 128
        for k, each in content.items():
            covered[sizes[k]] += uses * each
    assert (covered == histogram).all()
    assert sum(uses for uses, _ in patterns) <= 1.02 * np.ceil(classes.sum() / 128) + 2


def test_one_length_for_a_third_of_all_rows(spark):
    pieces = spark.range(900).selectExpr("id AS doc_id", "0L AS start", "IF(id % 3 = 0, 40L, 1 + id % 60) AS length", "id AS ids_crc32", "100L AS doc_tokens")
    got = packing.pack(pieces, capacity=64, unit=1)
    assert got.count() == 900 and got.select("doc_id").distinct().count() == 900
    assert got.groupBy("sequence_id").sum("length").filter("`sum(length)` > 64").count() == 0


def test_cached_words_give_the_library_ids():
    texts = [t or "" for _, t in mixed_rows(5)] + ["It's.. <|endoftext|>foo, <|ENDOFTEXT|>! ÀÉ ...x.. 99.5% 'S", "a\x1cb\x1f c"]
    library = Tokenizer.from_file(WORD)
    assert tokens.ids_of_texts(WORD, texts) == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_bpe_equals_the_library(spark):
    rows = mixed_rows(7)
    got = bpe.encode(documents(spark, rows), BYTE).collect()
    library = Tokenizer.from_file(BYTE)

    def digest(text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)

    assert Counter((r.doc_id, bytes(r.ids), r.decoded) for r in got) == Counter((d, *digest(t)) for d, t in rows)
    assert bpe.encode(documents(spark, []), BYTE).count() == 0


def test_joints_of_any_chunks_are_repaired(monkeypatch):
    rng = np.random.default_rng(2)
    parts = ["we'll", "'", "ll", " ", "  ", "\n", "a", "foo", "12", "!!", "é", "日本", "'re", "  x", "😀", "\x85"]
    monkeypatch.setattr(bpe, "LEAST", 4)
    monkeypatch.setattr(bpe, "CUT_BITS", 3)
    monkeypatch.setattr(bpe, "MOST", 40)
    codec, table = bpe.Codec(BYTE), bpe.gear()
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.integers(0, 400)))
        data = text.encode()
        ends = bpe.chunk_ends(data, table)
        known = {key: bpe.packed_words(codec.words(data[a:b].decode())) for key, a, b in zip(bpe.chunk_keys(data, ends), [0, *ends], ends) if rng.random() < 0.7}
        assert bpe.encoded_text(data, known, codec, table).tolist() == codec.library.encode(text, add_special_tokens=False).ids


def test_shared_passages_fall_into_the_same_chunks():
    passage = hashlib.sha512(b"x").hexdigest() * 40
    table = bpe.gear()
    keys = [set(bpe.chunk_keys(t.encode(), bpe.chunk_ends(t.encode(), table))) for t in ("one " + passage, "another beginning " + passage + " end")]
    assert len(keys[0] & keys[1]) >= len(keys[0]) - 2


def test_plain_words_get_the_ids_of_the_whole_tokenizer():
    """Any lower-case Latin word, and the condition that makes both libraries agree: each token's own text is that token."""
    import json
    import random

    path = public_tokenizers.path("word_bpe_49k.json")
    library, plain = tokens.load(path), tokens.load_plain(path)
    vocabulary = json.loads(library.to_str())["model"]["vocab"]
    own = {t[:-4]: k for t, k in vocabulary.items() if t.endswith("</w>") and t[:-4].isascii() and tokens.PLAIN.fullmatch(t[:-4])}
    assert len(own) > 20_000 and tokens.LatinWords.encoded(plain, list(own)) == [k.to_bytes(4, "little") for k in own.values()]
    rng = random.Random(6)
    letters = [chr(c) for c in (*range(0x61, 0x7B), *range(0xDF, 0x100)) if c != 0xF7]
    words = ["".join(rng.choice(letters if rng.random() < 0.3 else "etaoinshrdlu") for _ in range(rng.randint(1, 16))) for _ in range(30_000)]
    words += [a + b for a, b in zip(list(own)[::3], list(own)[1::5])]
    assert plain.encoded(words) == tokens.encoded(library, words)


def test_ids_of_texts_keep_two_generations(monkeypatch):
    monkeypatch.setattr(tokens, "WORDS_KEPT", 5)
    monkeypatch.setattr(tokens, "TEXTS_AT_ONCE", 2)
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["Ça va?! Été... (x). it's. a.b. 12. v2.", "", "one two, three; four: five! six? seven.", "one. One, ONE", "x². 日本. end.", "a\x1cb. c", "<|endoftext|>. <|", "w x.\u0085y, ×. ÷. ÿ."] * 3
    library = tokens.load(path)
    for part in tokens.text_slices(texts):
        assert tokens.ids_of_texts(path, part) == tokens.encoded(library, part)
    state = tokens.worker_state(f"words of {path}")
    assert len(state["old"]) < 60 and len(state["young"]) < 60
    state.clear()
