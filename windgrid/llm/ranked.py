"""Ranked lexical search by MaxScore with bounds on pairs of terms.

The index holds blocks of documents. A block has, for each term, the list of its documents with their impacts and the highest impact,
and for pairs of terms their intersection list's highest and k-th highest joint impact. A query's terms are ordered from light to heavy; neighbours form the
pairs. A document's score on the first j terms is at most the sum of their highest impacts, less what disjoint neighbour
pairs save (their joint bound is often far below the sum of two), and the best choice of pairs is found by a recurrence along the
order. Terms whose bound stays below a query's k-th best score bring up no candidate of their own, and candidates are dropped as
soon as their score and the bound of what is left cannot reach it; whole blocks are skipped the same way.

Queries go in waves of bounded text, so what is broadcast (their terms, weights and pairs) is bounded too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windgrid.llm.common import stored

WAVE_CHARS, BLOCK = 8 << 20, 4096
LAST = np.iinfo(np.int64).max
# ASCII letters in lower case and digits stay, other ASCII separates, all bytes of other code points are letters.
FOLD = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))
POSTINGS = "doc_id long, n long, terms array<int>, tfs array<long>"
BLOCKS = "doc_ids array<bigint>, terms array<int>, starts array<int>, places array<int>, impacts array<bigint>, tops array<bigint>, kths array<bigint>, pairs array<int>, pair_tops array<bigint>, pair_kths array<bigint>"


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


def postings(documents: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms), and the document's terms among ``numbers`` with their counts; documents without any term are left out."""
    shared = documents.sparkSession.sparkContext.broadcast(numbers)

    def run(batches) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        known = shared.value
        for batch in batches:
            counts, terms, tfs, keep = [], [], [], []
            for at, text in enumerate(batch.column("text")):
                found = terms_of(text.as_py())
                if found:
                    tf = Counter(filter(known.__contains__, found))
                    keep.append(at)
                    counts.append(len(found))
                    terms.append([known[t] for t in tf])
                    tfs.append(list(tf.values()))
            columns = [batch.column("doc_id").take(pa.array(keep, pa.int64())), pa.array(counts, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "tfs"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, POSTINGS)


def impacts_of(tfs: np.ndarray, weights: np.ndarray, lengths: np.ndarray, n_documents: int, n_terms: int) -> np.ndarray:
    """What a term adds to a document's score, for lengths already repeated per posting."""
    if int(lengths.max(initial=0)) * n_documents < 1 << 56:
        m = 10 + (90 * n_documents * lengths) // n_terms
    else:
        m = np.array([10 + 90 * n_documents * x // n_terms for x in lengths.tolist()], np.int64)
    return weights * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m))


def kth_highest(values: np.ndarray, k: int) -> int:
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else 0


def blocks(found: DataFrame, weights: np.ndarray, pairs: np.ndarray, n_documents: int, n_terms: int, k: int, block: int) -> DataFrame:
    """One row per block of documents: term lists with impacts, and the joint impacts of the listed pairs of terms."""
    shared = found.sparkSession.sparkContext.broadcast((weights, pairs))

    def build(batch: pa.RecordBatch) -> pa.RecordBatch:
        weights, pairs = shared.value
        column = batch.column("terms")
        sizes = column.value_lengths().to_numpy(zero_copy_only=False)
        terms, tfs = (c.flatten().to_numpy(zero_copy_only=False) for c in (column, batch.column("tfs")))
        lengths = np.repeat(batch.column("n").to_numpy(), sizes)
        places = np.repeat(np.arange(batch.num_rows, dtype=np.int32), sizes)
        impacts = impacts_of(tfs, weights[terms], lengths, n_documents, n_terms)
        order = np.lexsort((places, terms))
        terms, places, impacts = terms[order], places[order], impacts[order]
        own, starts = np.unique(terms, return_index=True)
        ends = np.append(starts[1:], len(terms))
        tops = np.maximum.reduceat(impacts, starts) if len(own) else impacts
        kths = [kth_highest(impacts[a:b], k) for a, b in zip(starts, ends)]
        listed, joint_tops, joint_kths = [], [], []
        if len(own):
            left, right = np.searchsorted(own, pairs[:, 0]), np.searchsorted(own, pairs[:, 1])
            last = len(own) - 1
            both = np.flatnonzero((own[np.minimum(left, last)] == pairs[:, 0]) & (own[np.minimum(right, last)] == pairs[:, 1]))
            held, mark = -1, np.zeros(batch.num_rows, np.int64)
            for pair in both.tolist():
                a, b = left[pair], right[pair]
                if a != held:
                    mark[:] = 0
                    mark[places[starts[a] : ends[a]]] = impacts[starts[a] : ends[a]] + 1
                    held = a
                joint = mark[places[starts[b] : ends[b]]]
                joint = (joint + impacts[starts[b] : ends[b]] - 1)[joint > 0]
                if len(joint):
                    listed.append(pair)
                    joint_tops.append(int(joint.max()))
                    joint_kths.append(kth_highest(joint, k))
        ids = batch.column("doc_id").fill_null(int(LAST))
        lists = [(ids, pa.int64()), (own, pa.int32()), (starts, pa.int32()), (places, pa.int32()), (impacts, pa.int64()), (tops, pa.int64()), (kths, pa.int64()), (listed, pa.int32()), (joint_tops, pa.int64()), (joint_kths, pa.int64())]
        arrays = []
        for values, kind in lists:
            flat = values if isinstance(values, pa.Array) else pa.array(values, kind)
            arrays.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat.cast(kind)))
        return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in BLOCKS.split(", ")])

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                yield build(batch.slice(at, block))

    return found.mapInArrow(run, BLOCKS)


def prefix_bounds(tops: list[int], joint: list[int]) -> list[int]:
    """Bounds on the score of the first j terms, j from 0. joint[i] is the joint maximum of terms i - 1 and i (0: never together).

    A document's share of two terms is at most max(joint, either alone); what that is below their sum is saved, and
    each term belongs to one chosen pair at most.
    """
    bounds, total, saved, before = [0], 0, 0, 0
    for i, top in enumerate(tops):
        total += top
        now = saved
        if i:
            now = max(saved, before + tops[i - 1] + top - max(joint[i], tops[i - 1], top))
        before, saved = saved, now
        bounds.append(total - saved)
    return bounds


class Best:
    """A query's k best (score, smaller doc_id first) so far, and the score to reach."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor = k, max(1, floor)
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.k:
            chosen = scores >= kth_highest(scores, self.k)
            scores, ids = scores[chosen], ids[chosen]
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.floor = max(self.floor, int(self.scores[-1]))


def search_block(block: dict[str, np.ndarray], queries: list[tuple[np.ndarray, np.ndarray]], bests: list[Best]) -> None:
    """Meets every query (its terms from light to heavy, the pair before each term) with one block."""
    own, starts, places, impacts = block["terms"], block["starts"], block["places"], block["impacts"]
    if not len(own):
        return
    ends = np.append(starts[1:], len(places))
    scratch = np.zeros(len(block["doc_ids"]), np.int64)
    for (terms, pairs), best in zip(queries, bests):
        at = np.minimum(np.searchsorted(own, terms), len(own) - 1)
        here = own[at] == terms
        tops = np.where(here, block["tops"][at], 0).tolist()
        if sum(tops) < best.floor:
            continue
        joint = [0] * len(terms)
        if len(block["pairs"]):
            of = np.minimum(np.searchsorted(block["pairs"], pairs), len(block["pairs"]) - 1)
            joint = np.where(block["pairs"][of] == pairs, block["pair_tops"][of], 0).tolist()
        bounds = prefix_bounds(tops, joint)
        if bounds[-1] < best.floor:
            continue
        essential = next(j for j in range(len(terms) + 1) if bounds[j] >= best.floor) - 1
        for j in range(essential, len(terms)):
            if here[j]:
                scratch[places[starts[at[j]] : ends[at[j]]]] += impacts[starts[at[j]] : ends[at[j]]]
        live = np.flatnonzero(scratch)
        scores = scratch[live]
        scratch[live] = 0
        for j in range(essential - 1, -1, -1):
            keep = scores + bounds[j + 1] >= best.floor
            if not keep.all():
                live, scores = live[keep], scores[keep]
            if not len(live):
                break
            if here[j]:
                own_places = places[starts[at[j]] : ends[at[j]]]
                to = np.minimum(np.searchsorted(own_places, live), len(own_places) - 1)
                scores = scores + np.where(own_places[to] == live, impacts[starts[at[j]] : ends[at[j]]][to], 0)
        keep = scores >= best.floor
        if keep.any():
            best.add(scores[keep], block["doc_ids"][live[keep]])


def best_documents(index: DataFrame, queries: list[tuple[np.ndarray, np.ndarray]], floors: list[int], k: int) -> DataFrame:
    """query, doc_id, score: each task's best documents of each query."""
    shared = index.sparkSession.sparkContext.broadcast((queries, floors))

    def run(batches) -> Iterator[pa.RecordBatch]:
        queries, floors = shared.value
        bests = [Best(k, floor) for floor in floors]
        for batch in batches:
            for row in range(batch.num_rows):
                search_block({c: batch.column(c)[row].values.to_numpy(zero_copy_only=False) for c in batch.schema.names}, queries, bests)
        numbers = np.repeat(np.arange(len(bests), dtype=np.int32), [len(b.scores) for b in bests])
        ids, scores = (np.concatenate([getattr(b, c) for b in bests] or [np.empty(0, np.int64)]) for c in ("ids", "scores"))
        yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(ids, mask=ids == LAST), pa.array(scores)], ["query", "doc_id", "score"])

    return index.mapInArrow(run, "query int, doc_id long, score long")


def highest(index: DataFrame, key: str, value: str, size: int) -> np.ndarray:
    """The highest value of each number 0..size-1 over all blocks; at most one row each reaches the driver."""
    got = index.select(F.explode(F.arrays_zip(key, value)).alias("x")).groupBy(f"x.{key}").agg(F.max(f"x.{value}").alias("top")).collect()
    out = np.zeros(size, np.int64)
    for row in got:
        out[row[0]] = row["top"]
    return out


def rank(documents: DataFrame, items: DataFrame, k: int = 10, block: int = BLOCK, wave_chars: int = WAVE_CHARS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's k best documents with a score above 0, ties to the smaller doc_id.

    Items are the distinct (item_id, text); a null or empty text has no terms and no results. Null or empty documents have no terms and
    do not count; repeated documents are rows of their own; a null doc_id comes last among ties. Texts are read whole.
    An empty table on either side gives an empty result.
    """
    spark = documents.sparkSession
    items = stored(items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct(), "items")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    waves, found = max(1, -(-chars // wave_chars)), None
    for wave in range(waves):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(waves)) == wave)
        got = rank_wave(documents, [(r["item_id"], terms_of(r["text"])) for r in part.orderBy("item_id", "text").collect()], k, block)
        if got is not None:
            found = got if found is None else found.unionByName(got)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if found is None else found


def rank_wave(documents: DataFrame, items: list[tuple[int | None, list[bytes]]], k: int, block: int) -> DataFrame | None:
    spark = documents.sparkSession
    numbers = {t: i for i, t in enumerate(sorted({t for _, terms in items for t in terms}))}
    found = stored(postings(documents, numbers), "postings")
    total = found.agg(F.count("*").alias("n"), F.sum("n").alias("terms")).first()
    if not numbers or not total["n"]:
        return None
    df = np.zeros(len(numbers), np.int64)
    for row in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[row["term"]] = row["count"]
    weights = np.array([math.floor(1000 * math.log((2 * total["n"] + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    chains = [np.array(sorted({numbers[t] for t in terms}, key=lambda i: (weights[i], i)), np.int32) for _, terms in items]
    known = sorted({(min(a, b), max(a, b)) for c in chains for a, b in zip(c.tolist(), c.tolist()[1:])})
    pair_of = {pair: i for i, pair in enumerate(known)}
    pairs = np.array(known, np.int32).reshape(-1, 2)
    index = stored(blocks(found, weights, pairs, total["n"], total["terms"], k, block), "index")
    kth, pair_kth = highest(index, "terms", "kths", len(numbers)), highest(index, "pairs", "pair_kths", len(known))
    queries, floors = [], []
    for chain in chains:
        before = [-1] + [pair_of[min(a, b), max(a, b)] for a, b in zip(chain.tolist(), chain.tolist()[1:])] if len(chain) else []
        queries.append((chain, np.array(before, np.int32)))
        # k documents of one block reach this already.
        floors.append(int(max([0, *kth[chain], *pair_kth[[p for p in before if p >= 0]]])))
    best = best_documents(index, queries, floors, k)
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    best = best.withColumn("rank", place).filter(F.col("rank") <= k)
    names = spark.createDataFrame(list(enumerate(i for i, _ in items)), "query int, item_id long")
    return best.join(names, "query").select("item_id", "rank", "doc_id", "score")
