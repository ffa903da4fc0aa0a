"""Exact top-k inner products by columnar branch-and-bound.

Candidates lie in vertical layout, one row of numbers per dimension. Scores are accumulated one block of dimensions at a
time. After each block a bound on what the remaining dimensions can add (Cauchy-Schwarz on the remaining masses)
drops candidates that cannot reach a query's k-th best score so far, and the survivors are compacted.

Queries are answered in waves of bounded size; a wave is broadcast and meets every candidate block once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windgrid.llm.common import stored

WAVE_BYTES = 16 << 20
QUERIES_AT_ONCE, CANDIDATES_AT_ONCE = 64, 8192
EXACT = 1 << 52
LONGS = np.iinfo(np.int64)


def quantized(vectors: DataFrame, id_column: str, vector_column: str, scale: float = 256.0) -> DataFrame:
    """_id and _v (floor(scale * x) as doubles). Rows with a null id, a null or empty vector or a null or non-finite
    component take no part."""
    given = vectors.select(F.col(id_column).cast("long").alias("_id"), F.transform(vector_column, lambda v: v.cast("double")).alias("_raw"))
    sound = F.col("_id").isNotNull() & (F.size("_raw") > 0) & ~F.exists("_raw", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    # ceil and floor of Spark end at long; whole doubles above 2^53 stay as they are.
    floor = F.transform("_raw", lambda v: F.when(F.abs(v * scale) < 2.0**53, F.floor(v * scale).cast("double")).otherwise(v * scale))
    return given.filter(F.coalesce(sound, F.lit(False))).select("_id", floor.alias("_v"))


def matrix(column: pa.ListArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows of a list column by vector length: positions and a row-major matrix."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    found = {}
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        found[int(size)] = (at, values[offsets[at][:, None] + np.arange(size)])
    return found


class Best:
    """The k best (score, smaller id first) of each query so far."""

    def __init__(self, floor: np.ndarray, k: int):
        self.k, self.floor = k, floor.copy()
        self.scores: list[np.ndarray] = [np.empty(0, np.int64)] * len(floor)
        self.ids: list[np.ndarray] = [np.empty(0, np.int64)] * len(floor)

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[query], scores]), np.concatenate([self.ids[query], ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores[query], self.ids[query] = scores[order], ids[order]
        if len(order) == self.k:
            self.floor[query] = max(self.floor[query], float(self.scores[query][-1]))


def scan(best: Best, queries: np.ndarray, query_ids: np.ndarray, members: np.ndarray, columns: np.ndarray, ids: np.ndarray, block: int) -> None:
    """Meets a few queries (``members``) with candidates in vertical layout (dimension, candidate)."""
    n_dims = len(columns)
    starts = list(range(0, n_dims, block))
    q = queries[members]
    rest_q = np.sqrt(np.stack([(q[:, s:] ** 2).sum(axis=1) for s in [*starts[1:], n_dims]]))
    rest_c = np.sqrt(np.stack([(columns[s:] ** 2).sum(axis=0) for s in [*starts[1:], n_dims]]))
    live = np.arange(columns.shape[1])
    partial = np.zeros((len(members), columns.shape[1]))
    held = columns
    for turn, start in enumerate(starts):
        partial += q[:, start : start + block] @ held[start : start + block]
        reach = rest_q[turn][:, None] * rest_c[turn][live]
        possible = partial + reach * (1 + 1e-9) + 1e-6 >= best.floor[members][:, None]
        keep = possible.any(axis=0)
        if not keep.any():
            return
        if keep.mean() < 0.75:
            live, partial, possible, held = live[keep], partial[:, keep], possible[:, keep], held[:, keep]
    for row, member in enumerate(members):
        at = live[possible[row] & (ids[live] != query_ids[member])]
        scores = partial[row][possible[row] & (ids[live] != query_ids[member])]
        if len(at) > best.k:
            cut = np.partition(scores, len(scores) - best.k)[len(scores) - best.k]
            chosen = scores >= cut
            at, scores = at[chosen], scores[chosen]
        if len(at):
            best.add(member, scores.astype(np.int64), ids[at])


def scan_large(best: Best, queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> None:
    """Whole-number arithmetic for components whose products leave a double's exact range; scores end at long's limits."""
    exact = [[int(x) for x in r] for r in rows]
    for member, q in enumerate(queries):
        q = [int(x) for x in q]
        others = np.flatnonzero(ids != query_ids[member])
        scores = [min(max(sum(a * b for a, b in zip(q, exact[i])), LONGS.min + 1), LONGS.max) for i in others]
        if scores:
            best.add(member, np.array(scores, np.int64), ids[others])


def top_k(vectors: DataFrame, is_query: Column, id_column: str = "vec_id", vector_column: str = "embedding", k: int = 5, scale: float = 256.0, block: int = 8, wave_bytes: int = WAVE_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest inner products of quantized vectors, ties to the smaller id.

    ``is_query`` is a condition on ``_id``. A query never meets rows of its own id, and only vectors of its own length.
    Repeated rows are rows of their own; a query id that comes twice is answered for its largest vector.
    Queries with fewer than k partners return all. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    table = quantized(vectors, id_column, vector_column, scale)
    queries = stored(table.filter(is_query).groupBy("_id").agg(F.max("_v").alias("_v")), "queries")
    size = queries.agg(F.count("*").alias("n"), F.max(F.size("_v")).alias("d")).first()
    schema = "query_id long, score long, vec_id long"
    if not size["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    waves = -(-size["n"] * size["d"] * 8 // wave_bytes)
    found = None
    for wave in range(waves):
        part = queries.filter(F.pmod(F.xxhash64("_id"), F.lit(waves)) == wave).orderBy("_id").toArrow()
        shared, got = wave_results(spark, table, part, k, block, schema)
        # Only one wave is held at a time: its results are stored before its queries go.
        got = stored(got, "wave")
        shared.destroy()
        found = got if found is None else found.unionByName(got)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def wave_results(spark, table: DataFrame, part: pa.Table, k: int, block: int, schema: str):
    """The broadcast queries of a wave, and each task's k best candidates of each of them."""
    column = part.column("_v").combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.list_(pa.float64()))
    all_ids = part.column("_id").to_numpy()
    sent = {}
    for d, (at, rows) in (matrix(column) if len(column) else {}).items():
        ids = all_ids[at]
        safe = float(np.abs(rows).max()) ** 2 * d < EXACT
        floor = np.full(len(ids), -np.inf)
        if safe and len(ids) > k:
            # Queries are candidates too: their scores with each other are a first bound.
            for s in range(0, len(ids), 256):
                scores = rows[s : s + 256] @ rows[:4096].T
                scores[ids[s : s + 256][:, None] == ids[None, :4096]] = -np.inf
                if scores.shape[1] > k:
                    floor[s : s + 256] = np.partition(scores, scores.shape[1] - k - 1, axis=1)[:, -k - 1 :].min(axis=1)
        # Dimensions with much mass first, so that bounds fall early; queries near each other together.
        order = np.argsort(-(rows**2).sum(axis=0), kind="stable")
        near = np.argsort(rows[:, order[0]], kind="stable")
        sent[d] = (ids[near], np.ascontiguousarray(rows[near][:, order]), floor[near], order)
    shared = spark.sparkContext.broadcast(sent)

    def search(batches) -> Iterator[pa.RecordBatch]:
        given = shared.value
        bests = {d: Best(floor, k) for d, (_, _, floor, _) in given.items()}
        for batch in batches:
            column = batch.column("_v")
            all_ids = batch.column("_id").to_numpy()
            for d, (at, rows) in matrix(column).items():
                if d not in given:
                    continue
                query_ids, queries, _, order = given[d]
                best = bests[d]
                top = max(np.abs(rows).max(), np.abs(queries).max())
                if top * top * d >= EXACT:
                    scan_large(best, queries[:, np.argsort(order)], query_ids, rows, all_ids[at])
                    continue
                for c in range(0, len(rows), CANDIDATES_AT_ONCE):
                    columns = np.ascontiguousarray(rows[c : c + CANDIDATES_AT_ONCE][:, order].T)
                    for m in range(0, len(queries), QUERIES_AT_ONCE):
                        members = np.arange(m, min(m + QUERIES_AT_ONCE, len(queries)))
                        scan(best, queries, query_ids, members, columns, all_ids[at][c : c + CANDIDATES_AT_ONCE], block)
        for d, best in bests.items():
            query_ids = given[d][0]
            counts = [len(s) for s in best.scores]
            if sum(counts):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(query_ids, counts)), pa.array(np.concatenate(best.scores)), pa.array(np.concatenate(best.ids))], ["query_id", "score", "vec_id"]
                )

    return shared, table.mapInArrow(search, schema)
