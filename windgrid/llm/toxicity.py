"""Toxicity by a weighted lexicon matched with Aho-Corasick on folded text.

Folding undoes look-alike letters, accents and digits written for letters. Lexicon entries are word beginnings whose
documents are mostly labelled toxic; their weights are smoothed log odds. A text's weights are set against its length,
and a logistic curve fitted on the same labels turns both into a score. Phrases that hold an entry harmlessly, some given and
others learned from clean documents, are in the same automaton and cancel the match inside them.
"""

from __future__ import annotations

import heapq
import math
import re
import unicodedata
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters of other scripts, digits and signs that are written for Latin letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "з": "3", "і": "i", "ї": "i", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "ј": "j", "ԁ": "d", "ɡ": "g", "ո": "n", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ł": "l", "ø": "o", "đ": "d", "ı": "i",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i",
}
HARMLESS = ("trash can", "trash bin", "trash bag", "clown fish", "clownfish", "pathetic fallacy", "stupid simple")
LETTERS = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6, 7, 8, 9, 10)


def folding_tables() -> tuple[dict[int, str], dict[int, str]]:
    """For str.translate on lower-case text, one after the other: letters with marks to their base letter, wide forms to plain
    ones and invisible characters to nothing; then look-alikes, each one character for another, until none is left."""
    plain = {}
    for code in range(0x80, 0x250):
        base = unicodedata.normalize("NFKD", chr(code))[0]
        if base.isascii() and base.isalpha():
            plain[code] = base.lower()
    plain |= dict.fromkeys([0xAD, *range(0x200B, 0x200E), 0x2060, 0xFEFF, *range(0x300, 0x370)], "")
    for x in range(0xFF01, 0xFF5F):
        plain[x] = chr(x - 0xFEE0).lower()
    alike = {ord(k): LOOK_ALIKES.get(v, v) for k, v in LOOK_ALIKES.items()}
    return {k: v for k, v in plain.items() if k not in alike}, alike


def fold(text: str | None, tables) -> tuple[str, str]:
    """The folded text, and the text of the same places in which look-alikes still are what they were."""
    plain = (text or "").lower().translate(tables[0])
    return plain.translate(tables[1]), plain


def begins_word(plain: str, at: int) -> bool:
    """A word begins behind anything but a letter; a digit or sign before it may be one of its own letters or stand apart."""
    return not at or not plain[at - 1].isalpha()


def starts_of(folded: str, plain: str) -> Iterator[tuple[int, int]]:
    """(start, end) of every run of letters, and from each place inside it where a word may begin as well."""
    for m in LETTERS.finditer(folded):
        a, b = m.span()
        yield a, b
        if not plain[a:b].isalpha():
            yield from ((k, b) for k in range(a + 1, b) if begins_word(plain, k))


def copy_key(folded: str) -> str:
    """Equal for copies and most near copies: three minimum hashes of the words."""
    words = [w.encode() for w in set(LETTERS.findall(folded))] or [b""]
    return ",".join(str(min(zlib.crc32(w, seed) for w in words)) for seed in (1, 2, 3))


def fit_sample(documents: DataFrame, labels: DataFrame, held_out, fit_rows: int) -> DataFrame:
    """doc_id, text, toxic of at most ``fit_rows`` labelled documents a class, smallest hash first, held-out ones left out.

    Labels that are null or neither 0 nor 1 are ignored; a doc_id labelled twice counts as toxic if any label says so.
    Only the ids of the sample, bounded by ``fit_rows``, are broadcast.
    """
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
    known = known.filter(~held_out).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    # A share a little above the wanted one goes on, so that sorting for the limit stays small.
    share = {y: int((1 << 30) * min(1.0, 1.2 * fit_rows / n + 1e-6)) for y, n in sizes.items()}
    draw = [known.filter((F.col("toxic") == y) & (place < share.get(y, 0))).orderBy(place, "doc_id").limit(fit_rows) for y in (0, 1)]
    ids = draw[0].union(draw[1])
    return documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id")


def learn_lexicon(sample: DataFrame, min_documents: int = 3, min_odds: float = 3.0, least: float = 2.0) -> dict[str, float]:
    """Word beginnings and their weights.

    Candidates are beginnings found in ``min_documents`` toxic documents or more, with log odds of ``min_odds`` or more
    by document counts over the sample, which bounds their number. A greedy cover of the toxic
    documents then keeps those that explain ``least`` documents, however large the sample is, where a document counts half as much each time it is explained, and
    near copies (three equal minimum hashes of words) count once. So words that only come with copied documents
    do not get in beside the entries that made them toxic.
    """

    def beginnings(text, tables):
        folded, plain = fold(text, tables)
        return {folded[a : a + n] for a, b in starts_of(folded, plain) for n in PREFIXES if b - a >= n}

    def count(batches):
        tables = folding_tables()
        for batch in batches:
            seen = (Counter(), Counter())
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                seen[toxic].update(beginnings(text, tables))
            terms = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in seen)], ["term", "clean", "toxic"])

    totals = sample.agg(F.count(F.when(F.col("toxic") == 0, 1)).alias("clean"), F.count(F.when(F.col("toxic") == 1, 1)).alias("toxic")).first()
    if not totals["clean"] or not totals["toxic"]:
        return {}
    odds = F.log((F.col("toxic") + 0.5) / (totals["toxic"] + 1.0)) - F.log((F.col("clean") + 0.5) / (totals["clean"] + 1.0))
    counts = sample.mapInArrow(count, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    kept = counts.filter(F.col("toxic") >= min_documents).withColumn("odds", odds).filter(F.col("odds") >= min_odds)
    rows = kept.orderBy(F.desc("toxic"), F.desc("odds"), F.desc(F.length("term")), "term").collect()
    at = {r["term"]: k for k, r in enumerate(rows)}

    def incidence(batches):
        tables = folding_tables()
        for batch in batches:
            found, keys = [], []
            for text in batch.column("text").to_pylist():
                found.append(sorted(at[t] for t in beginnings(text, tables) if t in at))
                keys.append(copy_key(fold(text, tables)[0]))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), pa.array(keys)], ["found", "key"])

    toxic = sample.filter("toxic = 1").mapInArrow(incidence, "found array<int>, key string").groupBy("key").agg(F.max("found").alias("found")).collect()
    documents_of: list[list[int]] = [[] for _ in rows]
    for d, row in enumerate(toxic):
        for k in row["found"]:
            documents_of[k].append(d)
    incident = [np.array(d, dtype=np.int64) for d in documents_of]
    open_share = np.ones(len(toxic))
    lexicon: dict[str, float] = {}
    gain = lambda k: float(open_share[incident[k]].sum())
    ranked = lambda k: (-gain(k) * rows[k]["odds"], -len(rows[k]["term"]), k)
    # Gains only fall, so the first one that is still up to date is the best of all.
    heap = [ranked(k) for k in range(len(rows))]
    heapq.heapify(heap)
    ends: set[str] = set()
    while heap:
        k = heapq.heappop(heap)[2]
        term = rows[k]["term"]
        # A longer or shorter form of a kept entry counts the same words again.
        if gain(k) < least or term in ends or any(term[:n] in lexicon for n in PREFIXES):
            continue
        now = ranked(k)
        if heap and now > heap[0]:
            heapq.heappush(heap, now)
            continue
        lexicon[term] = rows[k]["odds"]
        open_share[incident[k]] /= 2
        ends.update(term[:n] for n in PREFIXES)
    return lexicon


def learn_harmless(sample: DataFrame, lexicon: dict[str, float], harmless: tuple[str, ...], least: int = 3) -> tuple[str, ...]:
    """Words that begin with an entry, alone or with the word before or after, that clean documents hold at least as often as toxic ones.

    A phrase needs ``least`` clean documents, near copies counted once, and smoothed log odds of 0 or less by document counts over the sample, so few toxic rows ask for more clean ones. Shorter phrases make longer
    ones with them needless. Words are parted by one blank.
    """
    if not lexicon:
        return ()

    def run(batches) -> Iterator[pa.RecordBatch]:
        places = finder(lexicon, harmless)
        for batch in batches:
            out = []
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                folded, found = places(text)
                if not found:
                    continue
                key = copy_key(folded)
                words = [(m.start(), m.end()) for m in LETTERS.finditer(folded)]
                starts = [a for a, _ in words]
                phrases = set()
                for place in found:
                    k = bisect_right(starts, place) - 1
                    a, b = place, words[k][1]
                    phrases.add(folded[a:b])
                    if a == starts[k] and k and folded[words[k - 1][1] : a] == " ":
                        phrases.add(folded[words[k - 1][0] : b])
                    if k + 1 < len(words) and folded[b : starts[k + 1]] == " ":
                        phrases.add(folded[a : words[k + 1][1]])
                out += [(p, toxic, key) for p in phrases]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int32()), pa.array([o[2] for o in out], pa.string())], ["phrase", "toxic", "key"])

    totals = sample.agg(F.count(F.when(F.col("toxic") == 0, 1)).alias("clean"), F.count(F.when(F.col("toxic") == 1, 1)).alias("toxic")).first()
    counted = sample.mapInArrow(run, "phrase string, toxic int, key string").groupBy("phrase").agg(
        F.count(F.when(F.col("toxic") == 1, 1)).alias("toxic"), F.count(F.when(F.col("toxic") == 0, 1)).alias("clean"), F.countDistinct(F.when(F.col("toxic") == 0, F.col("key"))).alias("different")
    )
    fair = (F.col("toxic") + 0.5) / (totals["toxic"] + 1.0) <= (F.col("clean") + 0.5) / (totals["clean"] + 1.0)
    kept: list[str] = []
    for r in counted.filter((F.col("different") >= least) & fair).orderBy(F.length("phrase"), "phrase").toLocalIterator():
        if not any(r["phrase"].startswith(p) or f" {p}" in r["phrase"] for p in kept):
            kept.append(r["phrase"])
    return tuple(kept)


def finder(lexicon: dict[str, float], harmless: tuple[str, ...]):
    """From text to (folded text, weight by place of each entry found)."""
    import ahocorasick

    tables = folding_tables()
    automaton = ahocorasick.Automaton()
    for phrase in harmless:
        folded = fold(phrase, tables)[0]
        automaton.add_word(folded, (len(folded), None))
    for term, weight in lexicon.items():
        # An entry that is a phrase as well stays an entry.
        automaton.add_word(term, (len(term), weight))
    automaton.make_automaton()
    some = len(lexicon) > 0

    def places(text: str | None) -> tuple[str, dict[int, float]]:
        folded, plain = fold(text, tables)
        best: dict[int, float] = {}
        quiet: list[tuple[int, int]] = []
        for end, (size, weight) in automaton.iter(folded) if some else ():
            start = end + 1 - size
            if not begins_word(plain, start):
                continue
            if weight is None:
                quiet.append((start, end))
            else:
                best[start] = max(weight, best.get(start, 0.0))
        if quiet and best:
            quiet.sort()
            starts, ends = [a for a, _ in quiet], list(accumulate((b for _, b in quiet), max))
            covered = lambda s: (k := bisect_right(starts, s)) > 0 and ends[k - 1] >= s
            best = {s: w for s, w in best.items() if not covered(s)}
        return folded, best

    return places


def matcher(lexicon: dict[str, float], harmless: tuple[str, ...]):
    """From text to (summed weights, number of words)."""
    places = finder(lexicon, harmless)

    def match(text: str | None) -> tuple[float, int]:
        folded, best = places(text)
        return sum(best.values()), len(folded.split())

    return match


def features(weight, words):
    """Columns: one, summed weight, weight against length."""
    weight, words = np.asarray(weight, float), np.asarray(words, float)
    return np.stack([np.ones(len(weight)), np.log1p(weight), np.log1p(100 * weight / np.maximum(words, 20))], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, share: np.ndarray, ridge: float = 0.1, steps: int = 30) -> np.ndarray:
    """Weighted logistic regression by Newton steps; the ridge keeps separable labels finite."""
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (share * (y - p)) - ridge * beta
        hessian = (x * (share * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        beta += np.clip(np.linalg.solve(hessian, gradient), -5, 5)
    return beta


def match_rows(frame: DataFrame, lexicon: dict[str, float], harmless: tuple[str, ...], extra: str, schema: str) -> DataFrame:
    """Columns of ``extra`` unchanged, then weight and words of the text."""
    names = [x for x in extra.split(",") if x]

    def run(batches) -> Iterator[pa.RecordBatch]:
        match = matcher(lexicon, harmless)
        for batch in batches:
            got = [match(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.int64())], [*names, "weight", "words"]
            )

    return frame.select(*names, *([] if "text" in names else ["text"])).mapInArrow(run, f"{schema}, weight double, words long")


class ToxicityModel:
    """A lexicon, harmless phrases and the curve from matches to a score."""

    def __init__(self, lexicon: dict[str, float], beta: np.ndarray, harmless: tuple[str, ...] = HARMLESS):
        self.lexicon, self.beta, self.harmless = lexicon, [float(b) for b in beta], harmless

    @classmethod
    def fit(cls, documents: DataFrame, labels: DataFrame, held_out=None, fit_rows: int = 20_000, harmless: tuple[str, ...] = HARMLESS) -> ToxicityModel:
        """Learns from at most ``fit_rows`` labelled documents a class. Without labels of both classes the lexicon is
        empty and every score is the share of toxic labels (0 without any)."""
        held_out = F.lit(False) if held_out is None else held_out
        sample = fit_sample(documents, labels, held_out, fit_rows)
        lexicon = learn_lexicon(sample)
        harmless = (*harmless, *learn_harmless(sample, lexicon, harmless))
        rows = match_rows(sample, lexicon, harmless, "toxic", "toxic int").toPandas()
        y = rows["toxic"].to_numpy(float)
        if not lexicon or not 0 < y.sum() < len(y):
            rate = min(max(y.mean() if len(y) else 0.0, 1e-9), 1 - 1e-9)
            return cls({}, np.array([math.log(rate / (1 - rate)), 0.0, 0.0]), harmless)
        every = labels.filter("doc_id IS NOT NULL").filter(~held_out).groupBy("toxic").count().collect()
        count = {int(r["toxic"]): r["count"] for r in every if r["toxic"] in (0, 1)}
        share = np.where(y == 1, count[1] / y.sum(), count[0] / (1 - y).sum())
        x = features(rows["weight"], rows["words"])
        return cls(lexicon, logistic(x, y, share / share.mean()), harmless)

    def column(self, text: Column, threshold: float = 0.3) -> Column:
        """A struct of score (0 to 1) and predicted (1 if the score reaches the threshold). A null text counts as empty,
        which has the score of a text without a match. Repeated rows are scored alike; a text of any length takes one pass."""
        beta, lexicon, harmless = np.array(self.beta), self.lexicon, self.harmless

        @F.arrow_udf("score double, predicted int")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            match = matcher(lexicon, harmless)
            for batch in batches:
                got = [match(text.as_py()) for text in batch]
                x = features([g[0] for g in got], [g[1] for g in got])
                score = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
                yield pa.StructArray.from_arrays([pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))], ["score", "predicted"])

        return run(text)
