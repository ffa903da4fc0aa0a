"""Byte-level BPE with reuse of content-defined chunks.

A rolling hash cuts texts where their content says so, so that a passage shared by documents falls into the same chunks. Chunks
seen more than once are encoded once and their ids joined back; what lies between is encoded in place.
At each joint the ids on both sides are kept only up to a word boundary that does not depend on the joint; what is left is
re-encoded over growing windows until its word boundaries agree with those of the next chunk, from where both are
the same. Texts travel compressed, once.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windgrid.llm.common import stored
from windgrid.llm.tokens import load, worker_state

ROLL, CUT_BITS, LEAST, MOST = 32, 9, 128, 4096
#: Words before the end of a chunk that what follows may change (a contraction such as 'll takes two).
BACK = 3
AHEAD = 48
WORDS_KEPT = 300_000
# Fixed value: how the tokenizer splits words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def gear() -> np.ndarray:
    return np.random.default_rng(4_242).integers(0, 1 << 32, 256, dtype=np.uint32)


def chunk_ends(data: bytes, table: np.ndarray) -> list[int]:
    """Ends of content-defined chunks: where the hash of the last 32 bytes has its high bits clear, at least LEAST and at most MOST bytes
    apart, moved to the next character."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    x = np.frombuffer(data, np.uint8)
    h = table[x]
    width = 1
    while width < ROLL:
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    places = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1
    ends, last = [], 0
    for p in places.tolist():
        while p - last > MOST:
            last = character(data, last + MOST)
            ends.append(last)
        if p - last >= LEAST:
            last = character(data, p)
            if last < n:
                ends.append(last)
    while n - last > MOST:
        last = character(data, last + MOST)
        ends.append(last)
    if not ends or ends[-1] < n:
        ends.append(n)
    return ends


def character(data: bytes, at: int) -> int:
    """The next place that begins a character."""
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at += 1
    return at


def chunk_keys(data: bytes, ends: list[int]) -> list[bytes]:
    import xxhash

    return [xxhash.xxh3_128_digest(data[a:b]) for a, b in zip([0, *ends], ends)]


class Codec:
    """A byte-level tokenizer with what chunk joints need of it."""

    def __init__(self, path: str):
        import regex

        self.library = load(path)
        state = worker_state(f"codec of {path}")
        if not state:
            to_byte = {c: b for b, c in byte_letters().items()}
            vocabulary = self.library.get_vocab(with_added_tokens=True)
            added = {t.content for t in self.library.get_added_tokens_decoder().values()}
            pieces = [b""] * (max(vocabulary.values()) + 1)
            for piece, k in vocabulary.items():
                pieces[k] = piece.encode() if piece in added else bytes(to_byte[c] for c in piece)
            state |= {"pieces": pieces, "sizes": np.array([len(p) for p in pieces]), "added": sorted(added, key=len, reverse=True)}
            state |= {"known": {}, "split": regex.compile(WORDS).findall}
        self.pieces, self.sizes, self.added = state["pieces"], state["sizes"], state["added"]
        self.known, self.split = state["known"], state["split"]

    def is_latin(self, text: str) -> bool:
        return text.isascii() or max(text) < "\u0250"

    def word_ids(self, text: str) -> list[bytes]:
        """The ids of each word of a Latin text."""
        known, parts = self.known, self.split(text)
        if len(known) > WORDS_KEPT:
            known.clear()
        try:
            return list(map(known.__getitem__, parts))
        except KeyError:
            new = list(set(parts).difference(known))
        for at in range(0, len(new), 1024):
            part = new[at : at + 1024]
            found = self.library.encode_batch_fast(part, add_special_tokens=False)
            known.update((w, array("H", x.ids).tobytes()) for w, x in zip(part, found))
        return list(map(known.__getitem__, parts))

    def words(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids, the byte where each word begins, and the first id of each word. The text holds no control string.

        Words of Latin texts are split here and looked up, so that the library meets each once per worker; others it splits itself.
        """
        if self.is_latin(text):
            pieces = self.word_ids(text)
            ids = np.frombuffer(b"".join(pieces), "<u2")
            first = np.cumsum([0, *map(len, pieces)])[:-1] // 2
        else:
            found = self.library.encode(text, add_special_tokens=False)
            ids = np.array(found.ids, "<u2")
            first = np.flatnonzero(np.diff(np.array(found.word_ids, np.int64), prepend=-1))
        return ids, begins_of(ids, first, self.sizes), first

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.pieces.__getitem__, ids.tolist())).decode("utf-8", "replace")

    def has_control(self, text: str) -> bool:
        return any(c in text for c in self.added)

    def joined(self, data: bytes, pieces: list[tuple[int, int, tuple]]) -> np.ndarray:
        """Ids of ``data`` from (begin, end, words) of its consecutive pieces."""
        out: list[np.ndarray] = []
        carry = 0  # everything before this byte is in ``out``
        for at, (begin, end, (ids, begins, first)) in enumerate(pieces):
            start = begin
            if carry < begin:
                # Re-encode from the last sure boundary until the boundaries agree with this piece's own.
                reach = AHEAD
                while True:
                    stop = character(data, min(begin + reach, end))
                    seen, places, firsts = self.words(data[carry:stop].decode())
                    whole = stop == end
                    sure = places[: len(places) if whole and at == len(pieces) - 1 else max(0, len(places) - BACK)] + carry
                    both = np.intersect1d(sure[sure >= begin], begins + begin)
                    if len(both):
                        start = int(both[0])
                        out.append(seen[: firsts[np.searchsorted(places, start - carry)]])
                        break
                    if whole:
                        start = -1
                        break
                    reach *= 4
                if start < 0:
                    if at == len(pieces) - 1:
                        out.append(seen)
                        return np.concatenate(out)
                    continue
            if at == len(pieces) - 1:
                out.append(ids[first[np.searchsorted(begins, start - begin)] :] if start < end else ids[:0])
                carry = end
                continue
            low = int(np.searchsorted(begins, start - begin))
            high = max(low, len(begins) - BACK)
            if high == low or high >= len(begins):
                carry = start
            else:
                out.append(ids[first[low] : first[high]])
                carry = begin + int(begins[high])
        return np.concatenate(out) if out else np.empty(0, np.uint16)


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary: itself if visible in Latin-1, else the
    next free one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def split_control(text: str, added: list[str]) -> list[str]:
    """Text and control strings in turn; a text part may be empty."""
    import re

    return re.split("(" + "|".join(map(re.escape, added)) + ")", text)


def begins_of(ids: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes[ids])])[:-1][first] if len(ids) else np.empty(0, np.int64)


def chunk_rows(documents: DataFrame, tokenizer: str) -> DataFrame:
    """key, k of each chunk; texts with control strings have none. A row that a task has met before is left out."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        table, codec, met = gear(), Codec(tokenizer), set()
        for batch in batches:
            keys, owners = [], []
            for k, text in zip(batch.column("k").to_pylist(), batch.column("text")):
                text = text.as_py()
                if k in met or codec.has_control(text):
                    continue
                met.add(k)
                data = text.encode()
                own = set(chunk_keys(data, chunk_ends(data, table)))
                keys += own
                owners += [k] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(owners, pa.int64())], ["key", "k"])

    return documents.select("k", "text").mapInArrow(run, "key binary, k long")


def packed_words(words: tuple) -> bytes:
    """ids, and which of them begin a word, as bytes."""
    ids, _, first = words
    marks = np.zeros(len(ids), np.uint8)
    marks[first] = 1
    return ids.astype("<u2").tobytes() + np.packbits(marks).tobytes() + len(ids).to_bytes(4, "little")


def unpacked_words(packed: bytes, sizes: np.ndarray) -> tuple:
    n = int.from_bytes(packed[-4:], "little")
    ids = np.frombuffer(packed[: 2 * n], "<u2")
    first = np.flatnonzero(np.unpackbits(np.frombuffer(packed[2 * n : -4], np.uint8))[:n])
    return ids, begins_of(ids, first, sizes), first


def shared_words(rows: DataFrame, tokenizer: str) -> DataFrame:
    """key, words: the chunks a document is to encode for all, from (k, z, keys)."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        import zstandard

        table, codec, opener, met = gear(), Codec(tokenizer), zstandard.ZstdDecompressor(), set()
        for batch in batches:
            found: list[tuple[bytes, bytes]] = []
            for k, z, keys in zip(*(batch.column(c).to_pylist() for c in ("k", "z", "keys"))):
                if k in met:
                    continue
                met.add(k)
                data, wanted = opener.decompress(z), set(keys)
                ends = chunk_ends(data, table)
                for key, a, b in zip(chunk_keys(data, ends), [0, *ends], ends):
                    if key in wanted:
                        wanted.discard(key)
                        found.append((key, packed_words(codec.words(data[a:b].decode()))))
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.binary()) for k in (0, 1)], ["key", "words"])

    return rows.select("k", "z", "keys").mapInArrow(run, "key binary, words binary")


def encoded_text(data: bytes, known: dict[bytes, bytes], codec: Codec, table: np.ndarray) -> np.ndarray:
    """All ids of a text without control strings: known chunks from their words, runs of others encoded, joints repaired."""
    if not data:
        return np.empty(0, np.uint16)
    if not known:
        text = data.decode()
        return np.frombuffer(b"".join(codec.word_ids(text)), "<u2") if codec.is_latin(text) else codec.words(text)[0]
    ends = chunk_ends(data, table)
    pieces, run = [], 0
    for key, a, b in zip(chunk_keys(data, ends), [0, *ends], ends):
        if words := known.get(key):
            if run < a:
                pieces.append((run, a, codec.words(data[run:a].decode())))
            pieces.append((a, b, unpacked_words(words, codec.sizes)))
            run = b
    if run < len(data):
        pieces.append((run, len(data), codec.words(data[run:].decode())))
    return codec.joined(data, pieces)


def encode(documents: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit), decoded (text): one row per document.

    The ids are those of the tokenizers library on the whole text without special tokens added; control strings inside
    texts become their own ids, as there. A null or empty text has none. Repeated rows are encoded each.
    """
    given = documents.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    id_type = given.schema["doc_id"].dataType.simpleString()
    keyed = given.withColumn("k", F.xxhash64("doc_id", "text"))
    chunks = chunk_rows(keyed, tokenizer)
    shared = chunks.groupBy("key").agg(F.count("*").alias("n"), F.min("k").alias("k")).filter("n > 1")
    owners = stored(shared.groupBy("k").agg(F.collect_list("key").alias("keys")), "owners")

    def squeeze(batches) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            z = pa.array([packer.compress(x.as_py().encode()) for x in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("k"), z], ["doc_id", "k", "z"])

    texts = keyed.select("doc_id", "k", "text").mapInArrow(squeeze, f"doc_id {id_type}, k long, z binary")
    words = stored(shared_words(texts.join(owners, "k"), tokenizer), "words")
    found = chunks.join(words, "key").groupBy("k").agg(F.collect_list(F.struct("key", "words")).alias("known"))

    def finish(batches) -> Iterator[pa.RecordBatch]:
        import zstandard

        table, codec, opener = gear(), Codec(tokenizer), zstandard.ZstdDecompressor()
        special = {c: codec.library.token_to_id(c) for c in codec.added}
        for batch in batches:
            ids_out, texts_out = [], []
            for z, known in zip(batch.column("z"), batch.column("known")):
                data = opener.decompress(z.as_py())
                text = data.decode()
                if codec.has_control(text):
                    parts = [[special[p]] if p in special else encoded_text(p.encode(), {}, codec, table) for p in split_control(text, codec.added)]
                    ids = reduce(lambda a, b: np.concatenate([a, b]), parts).astype(np.uint16)
                else:
                    ids = encoded_text(data, {x["key"]: x["words"] for x in known.as_py() or ()}, codec, table)
                ids_out.append(ids.astype("<u4").tobytes())
                texts_out.append(codec.decode(ids))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids_out, pa.binary()), pa.array(texts_out, pa.string())], ["doc_id", "ids", "decoded"])

    joined = texts.join(found, "k", "left").select("doc_id", "z", "known")
    return joined.mapInArrow(finish, f"doc_id {id_type}, ids binary, decoded string")
