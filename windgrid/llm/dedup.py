"""Near-duplicate documents by MinHash bands and sequential Bayesian verification.

Documents with equal shingle sets are one node from the start. Nodes that agree in a band share a bucket. Inside a bucket,
signatures are compared batch by batch; a pair is dropped as soon as the posterior probability of its similarity
reaching the threshold falls below the miss probability, and survivors are verified on their full shingle sets, the most similar
first and only while they are not connected yet. So a bucket gives a spanning forest, never all its pairs.

A bucket larger than a block is split; after the blocks are linked, members outside the bucket's largest component are compared
with the whole bucket, which makes the result that of comparing all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windgrid.llm.common import spread, stored
from windgrid.llm.components import components

MOST_HASHES, BATCH, BLOCK_ROWS, BLOCK_SHINGLES = 160, 25, 512, 4_000_000


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case: what bytes.lower and bytes.split do."""
    return (text or "").encode().lower().split()


def band_plan(threshold: float, miss: float = 1e-5, most_hashes: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the longest bands that miss a pair at the threshold with at most that probability."""
    for rows in range(16, 0, -1):
        bands = math.ceil(math.log(miss) / math.log1p(-(threshold**rows)))
        if bands * rows <= most_hashes or rows == 1:
            return bands, rows
    raise AssertionError


def needed_matches(threshold: float, n_hashes: int, miss: float, batch: int = BATCH) -> list[tuple[int, int]]:
    """(hashes compared, fewest matches to go on). With a uniform prior, P(similarity >= t | m of k match) is the
    probability of at most m successes in k + 1 trials of chance t."""
    found = []
    for k in sorted({*range(batch, n_hashes, batch), n_hashes}):
        total, m = 0.0, -1
        while total < miss and m < k:
            m += 1
            total += math.exp(math.lgamma(k + 2) - math.lgamma(m + 1) - math.lgamma(k + 2 - m) + m * math.log(threshold) + (k + 1 - m) * math.log1p(-threshold))
        found.append((k, m))
    return found


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; the whole sequence is one if it is shorter."""
    import xxhash

    if not words:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    mixed = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        mixed = (mixed ^ each[k : len(words) - size + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(20_011).integers(1 << 62, 1 << 63, (2, n), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(hashes: np.ndarray, by: np.ndarray) -> np.ndarray:
    least = np.full(by.shape[1], 0xFFFFFFFF, np.uint32)
    for at in range(0, len(hashes), 1024):
        part = hashes[at : at + 1024, None] * by[0]
        part += by[1]
        part >>= np.uint64(32)
        np.minimum(least, part.min(axis=0).astype(np.uint32), out=least)
    return least


def signatures(documents: DataFrame, size: int, n_hashes: int) -> DataFrame:
    """doc_id, n_shingles, set_key (equal for equal sets, null for an empty one), sig, h (hash of the text)."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        import xxhash

        by = multipliers(n_hashes)
        for batch in batches:
            counts, keys, sigs = [], [], []
            for text in batch.column("text"):
                hashes = shingle_hashes(words_of(text.as_py()), size)
                counts.append(len(hashes))
                keys.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                sigs.append(signature(hashes, by).tobytes() if len(hashes) else None)
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary()), batch.column("h")]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set_key", "sig", "h"])

    given = documents.select(F.col("doc_id").cast("long"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    return given.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, sig binary, h long")


def packed_texts(documents: DataFrame) -> DataFrame:
    """doc_id, h, z (the compressed text); equal rows of a task once."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze, seen = zstandard.ZstdCompressor(level=1), set()
        for batch in batches:
            rows = []
            for doc_id, h, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if (doc_id, h) not in seen:
                    seen.add((doc_id, h))
                    rows.append((doc_id, h, squeeze.compress((text or "").encode())))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], ["doc_id", "h", "z"])

    given = documents.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")
    return given.mapInArrow(run, "doc_id long, h long, z binary")


class Group:
    """Members of a block: finds verified links that connect what is not connected yet."""

    def __init__(self, rows: list[tuple], size: int, percent: int, needed: list[tuple[int, int]]):
        rows = list({(r[0], r[4]): r for r in rows}.values())
        self.ids = [r[0] for r in rows]
        self.rows, self.size, self.percent, self.needed = rows, size, percent, needed
        self.sets: dict[int, set] = {}

    def shingles(self, k: int) -> set:
        if k not in self.sets:
            import zstandard

            words = zstandard.ZstdDecompressor().decompress(self.rows[k][2]).lower().split()
            n = min(self.size, len(words))
            self.sets[k] = set(zip(*(words[j:] for j in range(n))))
        return self.sets[k]

    def candidates(self) -> list[tuple[int, int, int]]:
        """(matches, i, j) of the pairs that the sequential comparison leaves."""
        sigs = np.stack([np.frombuffer(r[1], np.uint32) for r in self.rows])
        labels = np.array([r[3] for r in self.rows])
        asks = np.array([r[4] is None or r[4] == 1 for r in self.rows])
        answers = np.array([r[4] is None or r[4] == 0 for r in self.rows])
        found = []
        for i in np.flatnonzero(asks):
            live = np.flatnonzero(answers & (labels != labels[i]))
            if self.rows[i][4] is None:
                live = live[live > i]
            matches, start = np.zeros(len(live), np.int32), 0
            for k, least in self.needed:
                if not len(live):
                    break
                matches += (sigs[live, start:k] == sigs[i, start:k]).sum(axis=1, dtype=np.int32)
                keep = matches >= least
                live, matches, start = live[keep], matches[keep], k
            found += zip(matches.tolist(), [int(i)] * len(live), live.tolist())
        return sorted(found, key=lambda x: (-x[0], x[1], x[2]))

    def links(self) -> Iterator[tuple[int, int]]:
        root: dict = {}

        def find(x):
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for _, i, j in self.candidates():
            a, b = find(self.rows[i][3]), find(self.rows[j][3])
            if a == b:
                continue
            both = len(self.shingles(i) & self.shingles(j))
            if 100 * both >= self.percent * (len(self.shingles(i)) + len(self.shingles(j)) - both):
                root[a] = b
                yield self.ids[i], self.ids[j]


def link_groups(rows: DataFrame, keys: list[str], size: int, percent: int, needed: list[tuple[int, int]]) -> DataFrame:
    """Verified links (a, b) inside groups of (rep, sig, z, label, side); groups are bounded by the block size."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
            out: list[tuple[int, int]] = []
            for row in zip(*columns):
                key = row[: len(keys)]
                if key != current:
                    if len(held) > 1:
                        out += Group(held, size, percent, needed).links()
                    current, held = key, []
                held.append(row[len(keys) :])
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])
        out = list(Group(held, size, percent, needed).links()) if len(held) > 1 else []
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    dealt = rows.select(*keys, "rep", "sig", "z", "label", "side").repartition(spread(rows.sparkSession), *keys).sortWithinPartitions(*keys, "rep")
    return dealt.mapInArrow(run, "a long, b long")


def link(documents: DataFrame, size: int = 5, percent: int = 80, miss: float = 1e-5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, text_hash (xxhash64), kept: one row per document.

    Documents are linked if 100 * common >= percent * all of their distinct shingles of ``size`` words; component_id is the
    smallest doc_id reachable. A text without words, or null, has an empty set and stays alone. Rows of equal doc_id are
    told apart by their sets; a null doc_id links with nothing, has a null component and is kept. ``miss`` bounds the
    probability of missing a link at the threshold, once for the bands and once for each batch.
    """
    bands, rows = band_plan(percent / 100, miss)
    n_hashes = bands * rows
    needed = needed_matches(percent / 100, n_hashes, miss)
    signed = stored(signatures(documents, size, n_hashes), "signatures")
    sets = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_key").agg(
        F.min(F.struct("doc_id", "h")).alias("first"), F.max("sig").alias("sig"), F.max("n_shingles").alias("n_shingles")
    )
    nodes = sets.select("set_key", F.col("first.doc_id").alias("rep"), F.col("first.h").alias("h"), "sig", "n_shingles")
    in_band = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda k: F.xxhash64(k, F.substr(F.col("sig"), k * (4 * rows) + 1, F.lit(4 * rows))))
    banded = nodes.select("rep", "n_shingles", F.explode(in_band).alias("key"))
    buckets = banded.groupBy("key").agg(
        F.count("*").alias("n"), F.sum("n_shingles").alias("mass"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "rep")).alias("y")
    )
    # Buckets with the same members say the same.
    buckets = buckets.filter("n > 1").groupBy("n", "mass", "x", "y").agg(F.min("key").alias("key"))
    parts = F.greatest(F.ceil(F.col("n") / block_rows), F.ceil(F.col("mass") / BLOCK_SHINGLES)).cast("int")
    members = stored(banded.join(buckets.select("key", parts.alias("parts")), "key").select("key", "rep", "parts"), "members")
    block = F.pmod(F.xxhash64("rep", "key"), F.col("parts")).cast("int")

    wanted = members.select("rep").distinct().join(nodes.select("rep", "h", "sig"), "rep")
    texts = packed_texts(documents).withColumnRenamed("doc_id", "rep")
    load = stored(wanted.join(texts, ["rep", "h"]).select("rep", "sig", "z"), "load")
    placed = members.withColumn("block", block).join(load, "rep")
    links = stored(link_groups(placed.select("key", "block", "rep", "sig", "z", F.col("rep").alias("label"), F.lit(None).cast("int").alias("side")), ["key", "block"], size, percent, needed), "links")
    found = components(links)

    large = members.filter("parts > 1")
    if not large.isEmpty():
        labelled = large.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", "parts", F.coalesce("component", "rep").alias("label"), block.alias("block"))
        labelled = stored(labelled, "labelled")
        sizes = labelled.groupBy("key", "label").count().groupBy("key").agg(F.max(F.struct("count", "label")).alias("top"), F.sum("count").alias("n"))
        sizes = sizes.select("key", F.col("top.label").alias("main"), (F.col("n") - F.col("top.count")).alias("others")).filter("others > 0")
        chunks = F.ceil(F.col("others") / block_rows).cast("int")
        scope = labelled.join(sizes.select("key", "main", chunks.alias("chunks")), "key")
        asks = scope.filter("label <> main").withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
        asks = asks.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("side", F.lit(1))
        answers = scope.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("side", F.lit(0))
        columns = ["key", "chunk", "block", "rep", "label", "side"]
        crossed = asks.select(columns).unionByName(answers.select(columns)).join(load, "rep")
        more = stored(link_groups(crossed, ["key", "chunk", "block"], size, percent, needed), "links")
        found = components(links.unionByName(more))

    node_of = nodes.select("set_key", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    node_of = node_of.select("set_key", F.coalesce("component", "rep").alias("component_id"))
    out = signed.select("doc_id", "n_shingles", "set_key", "h").join(node_of, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("h").alias("text_hash"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
