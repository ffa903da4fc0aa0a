"""Ids of white-space separated words by the tokenizers library, each word encoded once per Python worker.

For tokenizers that drop white space, where no piece crosses a space and upper-case Latin letters equal lower-case ones.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
from array import array
from collections.abc import Iterable, Iterator

import numpy as np

TEXTS_AT_ONCE, CHARS_AT_ONCE, WORDS_KEPT = 512, 1 << 20, 160_000
# White space to Python, but not to the tokenizers.
SEPARATORS = "\x1c\x1d\x1e\x1f"
TAIL = ".,;:!?"
# Lower-case Latin letters that normalizing leaves as they are.
PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")

# Latin-1 letters in lower case, and what each of its characters is.
LOWER = bytes(ord(chr(b).lower()) if chr(b).lower() < "\u0100" else b for b in range(256))
LETTER, MARK, BLANK = 1, 2, 3
KIND = np.array([LETTER if PLAIN.fullmatch(chr(b)) else MARK if chr(b) in TAIL else BLANK if chr(b).isspace() else 0 for b in range(256)], np.uint8)


def worker_state(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, which Spark reuses for many tasks."""
    holder = sys.modules.setdefault("_windgrid_llm_worker", types.ModuleType("_windgrid_llm_worker"))
    return holder.__dict__.setdefault(name, {})


def text_slices(texts: Iterable) -> Iterator[list[str]]:
    """Texts in order, in slices of bounded count and size, one at a time; a null text is empty. Takes an Arrow column or strings."""
    current, size = [], 0
    for text in texts:
        text = (text if isinstance(text, str) else text and text.as_py()) or ""
        if current and (len(current) >= TEXTS_AT_ONCE or size + len(text) > CHARS_AT_ONCE):
            yield current
            current, size = [], 0
        current.append(text)
        size += len(text)
    if current:
        yield current


def load(path: str):
    """The tokenizer of a file, without truncation and padding, loaded once per worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    state = worker_state("libraries")
    if path not in state:
        library = Tokenizer.from_file(path)
        library.no_padding()
        library.no_truncation()
        state[path] = library
    return state[path]


class LatinWords:
    """The same model for lower-case words of Latin letters, which normalizer and word split leave whole, by the tiktoken library.

    That library knows no mark for the end of a word, so a word's last byte gets a code of its own: bytes in words and last bytes together
    are fewer than 256. It joins the two neighbours whose union has the lowest rank, this model those of the lowest merge; both are the same where
    every token's own text is encoded as that token, for then no other two parts of it ever lie side by side.
    """

    def __init__(self, model: dict):
        import tiktoken

        suffix = model["end_of_word_suffix"]
        used = sorted({*range(0x61, 0x7B), 0xC3, *(chr(c).encode()[1] for c in range(0xDF, 0x100) if c != 0xF7)})
        lasts = [b for b in used if b != 0xC3]
        inner, last = ({b: at + k for k, b in enumerate(part)} for part, at in ((used, 0), (lasts, len(used))))
        self.inner = bytes(inner.get(b, 0) for b in range(256))
        self.last = [bytes([last.get(b, 0)]) for b in range(256)]
        # Bytes that are no letters of their own stand for these characters in the model's file.
        spelled = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
        byte_of = {chr(b): b for b in spelled} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in spelled)}

        def coded(token: str) -> bytes | None:
            text, end = (token[: -len(suffix)], last) if token.endswith(suffix) else (token, inner)
            codes = [inner.get(byte_of.get(c)) for c in text[:-1]] + [end.get(byte_of.get(c)) for c in text[-1:]]
            return bytes(codes) if codes and None not in codes else None

        ranks = {bytes([b]): b for b in range(256)}
        self.ids = [0] * 256
        for token, k in model["vocab"].items():
            if (code := coded(token)) is not None and len(code) == 1:
                self.ids[code[0]] = k
        for pair in model["merges"]:
            token = "".join(pair if isinstance(pair, list) else pair.split(" "))
            if (code := coded(token)) is not None:
                ranks[code] = len(self.ids)
                self.ids.append(model["vocab"][token])
        self.pieces = tiktoken.Encoding("latin", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def encoded(self, words: list[str]) -> list[bytes]:
        pieces, ids, inner, last, out = self.pieces, self.ids.__getitem__, self.inner, self.last, []
        for word in words:
            raw = word.encode()
            out.append(array("I", map(ids, pieces(raw[:-1].translate(inner) + last[raw[-1]]))).tobytes())
        return out


def load_plain(path: str) -> LatinWords | None:
    """The model for plain words, or None if the file holds another kind of model."""
    state = worker_state("plain libraries")
    if path not in state:
        given = json.loads(load(path).to_str())
        model, split = given["model"], given["pre_tokenizer"] or {}
        fits = model.get("end_of_word_suffix") and not (model.get("dropout") or model.get("continuing_subword_prefix") or model.get("ignore_merges"))
        state[path] = LatinWords(model) if fits and split.get("type") == "Sequence" and split["pretokenizers"][-1]["type"] == "ByteLevel" else None
    return state[path]


def encoded(library, parts: list[str]) -> list[bytes]:
    return [array("I", x.ids).tobytes() for x in library.encode_batch_fast(parts, add_special_tokens=False)]


def learn_words(library, plain, known: dict[str, bytes], words: Iterable[str]) -> None:
    """Adds words: a word is its base and its closing punctuation, which are pieces of their own after a letter."""
    match = PLAIN.fullmatch
    simple, bases, tails = [], {}, {""}
    for word in words:
        if plain and match(word):
            simple.append(word)
            continue
        base = word.rstrip(TAIL)
        if base != word:
            if base and base[-1].isalpha():
                tails.add(word[len(base) :])
            else:
                base = word
        # A control string counts only as it is written.
        bases[word] = base.lower() if "<|" not in base and (base.isascii() or max(base) < "\u0100") else base
    new = tails.union(bases.values()).difference(known).difference(simple)
    further = [w for w in new if match(w)] if plain else []
    if plain:
        known.update(zip(simple + further, plain.encoded(simple + further)))
    others = list(new.difference(further))
    for at in range(0, len(others), 1024):
        known.update(zip(others[at : at + 1024], encoded(library, others[at : at + 1024])))
    known.update((word, known[base] + known[word[len(base) :]]) for word, base in bases.items())


def words_of_text(text: str) -> list[str]:
    """The words of a text, as pieces whose ids follow each other. Where all letters are Latin ones, they are in lower case, and closing
    punctuation behind a letter is a piece of its own, so that a word is stored once and not once for each mark."""
    if any(c in text for c in SEPARATORS):
        return re.split("[ \\t\\n\\r]+", text)
    if "<|" in text:
        return text.split()
    try:
        raw = text.encode("latin-1").translate(LOWER)
    except UnicodeEncodeError:
        return text.split()
    values = np.frombuffer(raw, np.uint8)
    kind = KIND[values]
    tail = kind == MARK
    starts = np.flatnonzero(tail[1:] & (kind[:-1] == LETTER)) + 1
    if len(starts):
        ends = np.flatnonzero(tail & np.append(~tail[1:], True)) + 1
        behind = np.append(kind, BLANK)[ends[np.searchsorted(ends, starts, side="right")]]
        raw = np.insert(values, starts[behind == BLANK], 32).tobytes()
    return raw.decode("latin-1").split()


def ids_of_texts(path: str, texts: list[str]) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit integers.

    A worker keeps two generations of words: those met since the last change, and those of the generation before, which move up when they
    are met again. So frequent words are never learned twice, and no more than two generations and a slice's words are held.
    """
    state = worker_state(f"words of {path}")
    if len(state.setdefault("young", {})) > WORDS_KEPT:
        state["old"], state["young"] = state["young"], {}
    young, old = state["young"], state.get("old", {})
    split = [words_of_text(text) for text in texts]
    missing = set().union(*split).difference(young)
    again = missing.intersection(old)
    young.update(zip(again, map(old.__getitem__, again)))
    learn_words(load(path), load_plain(path), young, list(missing.difference(again)))
    return [b"".join(map(young.__getitem__, words)) for words in split]
