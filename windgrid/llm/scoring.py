"""Scores documents with a gated recurrent language model, and with unigram counts as a base.

Counts cover all words of all training texts. The network's vocabulary is the most frequent words; the rest share a
class in which a word gets its share of the smoothed counts. The network is trained on whole texts where the data lies: each task
trains a copy on its rows, window by window with the state carried over, and Spark averages the copies after every round. Counts of frequent words are
broadcast up to a fixed number; those of all others meet the documents in a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windgrid.llm.common import stored
from windgrid.llm.dedup import words_of
from windgrid.llm.gru import Gru

END = ""
VOCABULARY, CLASS_SIZE, HIDDEN, FREQUENT = 1024, 32, 16, 100_000
WINDOW, TOGETHER, ROUNDS, ROWS_A_TRAINER = 16, 1 << 20, 3, 1000
SCORED_AT_ONCE = 1 << 22
COUNTS_AT_ONCE = 300_000


def word_counts(documents: DataFrame) -> DataFrame:
    """word, c over all texts, the end of each counted as the word ``END``."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "c"])

        for batch in batches:
            for text in batch.column(0):
                held.update(words_of(text.as_py()))
                held[b""] += 1
                if len(held) > COUNTS_AT_ONCE:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return documents.select("text").mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def frequent_words(counts: DataFrame, most: int):
    """word, c of at most ``most`` words, the most frequent ones, as a local table; the end of text comes first.

    Words are counted in bins of about equal counts, at most some 2000 of them; whole bins are taken from the top. So no
    task and no driver meets more than the words that are taken, as sorting for a limit would have it.
    """
    in_bin = F.floor(F.log2("c") * 32)
    bins = sorted(counts.groupBy(in_bin.alias("b")).agg(F.count("*").alias("n"), F.min("c").alias("c")).collect(), key=lambda r: -r["b"])
    taken, least = 0, None
    for r in bins:
        if taken + r["n"] > most:
            break
        taken, least = taken + r["n"], r["c"]
    wanted = (F.col("word") == END) | (F.col("c") >= least if least is not None else F.lit(False))
    top = counts.filter(wanted).toPandas()
    return top.assign(later=top["word"] != END, rank=-top["c"]).sort_values(["later", "rank", "word"])[["word", "c"]].head(most)


def id_rows(documents: DataFrame, words: dict[bytes, int], outside: int) -> DataFrame:
    """h, ids: the ids of all words of each text and of its end. Copies of a text have hashes of their own, so that they are dealt to all tasks."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(1):
                ids = [words.get(w, outside) for w in [*words_of(text.as_py()), b""]]
                found.append(np.array(ids, "<u2").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["h", "ids"])

    return documents.select(F.xxhash64("doc_id", "text").alias("h"), "text").mapInArrow(run, "h long, ids binary")


def train_round(rows: DataFrame, model: Gru, end: int, trainers: int) -> Gru:
    """Each task trains a copy of the model on its rows; the copies are averaged by their tokens."""
    flat, params, size = model.flat(), model.p, model.size

    def run(batches) -> Iterator[pa.RecordBatch]:
        own = Gru({k: v.copy() for k, v in params.items()}, size)

        def groups():
            held, words = [], 0
            for batch in batches:
                for ids in batch.column(0):
                    held.append(np.frombuffer(ids.as_py(), "<u2"))
                    words += len(held[-1])
                    if words >= TOGETHER:
                        yield held
                        held, words = [], 0
            if held:
                yield held

        seen = own.train(groups(), end, WINDOW)
        if seen:
            change = (own.flat() - flat).astype(np.float64) * seen
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([change], pa.list_(pa.float64()))], ["seen", "change"])

    dealt = rows.repartition(trainers, "h").sortWithinPartitions("h", "ids").select("ids")
    schema = "seen long, change array<double>"
    copies = stored(dealt.mapInArrow(run, schema), "copies")
    total = copies.agg(F.sum("seen")).first()[0]
    if not total:
        return model

    def add(batches) -> Iterator[pa.RecordBatch]:
        # Copies are added up where they are read, so that the number of weights that are shuffled follows the tasks.
        seen, change = 0, np.zeros(len(flat))
        for batch in batches:
            for k in range(batch.num_rows):
                seen += batch.column(0)[k].as_py()
                change += batch.column(1)[k].values.to_numpy()
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([change], pa.list_(pa.float64()))], ["seen", "change"])

    summed = copies.mapInArrow(add, schema).select(F.posexplode("change")).groupBy("pos").agg(F.sum("col").alias("x")).toPandas()
    change = np.zeros(len(flat))
    change[summed["pos"].to_numpy()] = summed["x"].to_numpy() / total
    return model.with_flat(flat + change)


def score(documents: DataFrame, held_out: Column, vocabulary: int = VOCABULARY, frequent: int = FREQUENT, hidden: int = HIDDEN, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per document.

    A null text counts as empty: its only token is the end. ``held_out`` is a condition on the given columns; counts and
    weights come from the other rows only. Without any training row all words are unknown and both scores are those of one unknown word a token.
    Repeated rows are scored alike, each on its own row.
    """
    given = documents.select(F.col("doc_id"), held_out.alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    training = given.filter(~F.col("held_out"))
    counts = stored(word_counts(training), "counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = frequent_words(counts, frequent)
    place = {w.encode(): k for k, w in enumerate(top["word"])}
    common = top["c"].to_numpy(np.float64)
    size = min(vocabulary, len(place))
    kept = {w: k for w, k in place.items() if k < size}
    end = 0
    tail = float(n - common[:size].sum())
    z_base = n + 0.1 * (v + 1)
    z_tail = tail + 0.1 * (v - size) + 0.1

    model = Gru.start(common[:size], tail, hidden, CLASS_SIZE)
    outside = len(model.p["wo"])  # the id of all words outside the vocabulary
    if n:
        rows = stored(id_rows(training, kept, outside), "ids")
        n_rows = rows.count()
        for _ in range(rounds):
            model = train_round(rows, model, end, max(1, n_rows // ROWS_A_TRAINER))

    params, shared = model.p, (place, np.log10((common + 0.1) / z_base), np.log10((common + 0.1) / z_tail))
    sent = documents.sparkSession.sparkContext.broadcast(shared)

    def run(batches) -> Iterator[pa.RecordBatch]:
        place, base, inner = sent.value
        own = Gru(params, CLASS_SIZE)
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [])
            scores, rows, words = [], [], 0

            def score_rows():
                for k, x in enumerate(own.score(rows, end) / np.log(10)):
                    scores[len(scores) - len(rows) + k] += float(x)

            for text in batch.column("text"):
                tokens = words_of(text.as_py())
                tokens.append(b"")
                at = np.array([place.get(w, -1) for w in tokens])
                known = at >= 0
                rare = [tokens[k].decode() for k in np.flatnonzero(~known)]
                for column, value in zip(columns, (len(tokens), int(known.sum()), float(base[at[known]].sum()), rare)):
                    column.append(value)
                inside = known & (at < size)
                scores.append(float(inner[at[known & ~inside]].sum()))
                rows.append(np.where(inside, at, outside).astype(np.uint16))
                words += len(tokens)
                if words >= SCORED_AT_ONCE:
                    score_rows()
                    rows, words = [], 0
            score_rows()
            arrays = [*(batch.column(c) for c in ("doc_id", "held_out", "k1", "k2")), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64())]
            arrays += [pa.array(columns[2], pa.float64()), pa.array(scores, pa.float64()), pa.array(columns[3], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "k1", "k2", "n_tokens", "known", "base", "gru", "rare"])

    id_type = documents.schema["doc_id"].dataType.simpleString()
    keyed = given.withColumns({"k1": F.xxhash64("doc_id", "text"), "k2": F.crc32(F.col("text").cast("binary"))})
    schema = f"doc_id {id_type}, held_out boolean, k1 long, k2 long, n_tokens long, known long, base double, gru double, rare array<string>"
    scored = stored(keyed.mapInArrow(run, schema), "scored")

    words = scored.select("k1", "k2", F.explode("rare").alias("word")).groupBy("k1", "k2", "word").agg(F.count("*").alias("tf"))
    seen = words.join(counts, "word", "left").select("k1", "k2", "tf", F.coalesce("c", F.lit(0)).alias("c"))
    value = lambda z: F.col("tf") * F.log10((F.col("c") + 0.1) / z)
    parts = seen.select("k1", "k2", F.when(F.col("c") > 0, F.col("tf")).otherwise(0).alias("known"), value(z_base).alias("base"), value(z_tail).alias("gru"), F.lit(0).alias("one"))
    parts = parts.unionByName(scored.select("k1", "k2", F.lit(0).cast("long").alias("known"), F.lit(0.0).alias("base"), F.lit(0.0).alias("gru"), F.lit(1).alias("one")))
    sums = parts.groupBy("k1", "k2").agg(*(F.sum(c).alias(f"r_{c}") for c in ("known", "base", "gru", "one")))
    out = scored.drop("rare").join(sums, ["k1", "k2"])
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + (F.col("r_known") / F.col("r_one")).cast("long")).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("r_base") / F.col("r_one")).alias("base_score"),
        (F.col("gru") + F.col("r_gru") / F.col("r_one")).alias("score"),
    )
