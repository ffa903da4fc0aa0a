"""Packs documents into sequences of fixed length by cutting-stock column generation.

Documents are cut into full-length pieces and one remainder. Remainder lengths form a histogram of at most
``capacity / unit`` classes, the only thing that reaches the driver. A linear program over patterns of that
histogram is solved by column generation, with a knapsack dynamic program pricing new patterns; the rounded
patterns are then filled with pieces ranked inside their class, as joins on the executors.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windgrid.llm.common import spread, stored
from windgrid.llm.tokens import ids_of_texts, text_slices

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def document_pieces(documents: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 4096) -> DataFrame:
    """One row per piece of a document's ids: full pieces of ``capacity`` and the remainder.

    A null text is empty, so its document is the end id alone. Columns other than doc_id and text are ignored.
    """

    def cut(batches):
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            rows = ([], [], [], [], [])
            keys = iter(batch.column(0).to_pylist())
            for texts in text_slices(batch.column(1)):
                for found in ids_of_texts(tokenizer, texts):
                    ids = found + end
                    doc_id, n = next(keys), len(ids) // 4
                    for start in range(0, n, capacity):
                        piece = ids[4 * start : 4 * (start + capacity)]
                        for column, value in zip(rows, (doc_id, start, len(piece) // 4, zlib.crc32(piece), n)):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in rows], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def best_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The unbounded knapsack: the multiset of sizes (ascending) within capacity with the largest value."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if n := fits[room]:
            totals = best[room - sizes[:n]] + values[:n]
            k = int(totals.argmax())
            if totals[k] > best[room] + 1e-12:
                best[room], choice[room] = totals[k], k
    pattern = np.zeros(len(sizes))
    room = capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            pattern[choice[room]] += 1
            room -= sizes[choice[room]]
    return float(best[capacity]), pattern


def inverted(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan with row exchange, in this thread."""
    n = len(matrix)
    both = np.hstack([matrix, np.eye(n)])
    for k in range(n):
        at = k + int(np.abs(both[k:, k]).argmax())
        if at != k:
            both[[k, at]] = both[[at, k]]
        both[k] /= both[k, k]
        factor = both[:, k].copy()
        factor[k] = 0
        both -= factor[:, None] * both[k]
    return both[:, n:]


def cutting_stock(sizes: np.ndarray, demand: np.ndarray, capacity: int, max_columns: int = 6000) -> list[tuple[int, dict[int, int]]]:
    """Patterns with their number of uses, covering the demand of each size (ascending, distinct, within capacity).

    The linear program is solved by the revised simplex method on an explicit basis inverse. ``max_columns`` bounds
    the pricing rounds; whatever the basis is then, it is feasible. Fractions are rounded down and what is
    left is packed best fit, largest first.
    """
    if not len(sizes):
        return []
    m = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    cost = np.ones(m)
    inverse = np.diag(1.0 / (capacity // sizes))
    # einsum stays in this thread; threads of a linear-algebra library would wait for busy cores.
    times = lambda a, b: np.einsum("ij,j->i", a, b)
    uses = times(inverse, demand)
    for turn in range(max_columns):
        prices = times(inverse.T, cost)
        lowest = int(prices.argmin())
        if prices[lowest] < -1e-9:
            column, column_cost = np.zeros(m), 0.0
            column[lowest] = -1
        else:
            value, column = best_pattern(prices, sizes, capacity)
            column_cost = 1.0
            # By Farley's bound no solution is below total / value: what is left to gain is half a sequence, or nothing.
            total = float(cost @ uses)
            if value <= 1 + 1e-7 or total - total / value < max(0.5, 2e-4 * total):
                break
        direction = times(inverse, column)
        ahead = np.flatnonzero(direction > 1e-9)
        if not len(ahead):
            break
        leave = ahead[(uses[ahead] / direction[ahead]).argmin()]
        basis[:, leave], cost[leave] = column, column_cost
        pivot = inverse[leave] / direction[leave]
        inverse -= np.outer(direction, pivot)
        inverse[leave] = pivot
        if turn % 200 == 199:
            inverse = inverted(basis)
        uses = np.maximum(times(inverse, demand), 0)
    left = demand.astype(int).copy()
    patterns = []
    for k in np.argsort(-uses):
        n = math.floor(uses[k] + 1e-6)
        if cost[k] and n:
            column = basis[:, k].astype(int)
            held = column > 0
            n = min(n, int((left[held] // column[held]).min()))
            if n:
                left -= n * column
                patterns.append((n, {int(i): int(column[i]) for i in np.flatnonzero(held)}))
    return patterns + best_fit(sizes, left, capacity)


def best_fit(sizes: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Best fit, largest first; equal bins in a row become one pattern."""
    room_of: dict[tuple, int] = {}
    bins: dict[tuple, int] = {(): 0}
    del bins[()]
    for k in range(len(sizes) - 1, -1, -1):
        size, n = int(sizes[k]), int(left[k])
        while n:
            fitting = [b for b in bins if room_of[b] >= size]
            if fitting:
                chosen = min(fitting, key=lambda b: (room_of[b], b))
                each = min(room_of[chosen] // size, n)
                many = min(bins[chosen], n // each)
                room = room_of[chosen] - each * size
                bins[chosen] -= many
                if not bins[chosen]:
                    del bins[chosen]
                content = (*chosen, (k, each))
            else:
                each = min(capacity // size, n)
                many = n // each
                room, content = capacity - each * size, ((k, each),)
            n -= each * many
            bins[content] = bins.get(content, 0) + many
            room_of[content] = room
    return [(n, dict(content)) for content, n in bins.items()]


def pack(pieces: DataFrame, capacity: int = 4096, unit: int = 8) -> DataFrame:
    """Gives each piece a sequence and an offset; ``pieces`` has doc_id, start, length (1 to capacity) and more columns.

    Lengths are rounded up to ``unit`` for planning only; pieces lie gapless. Repeated rows are pieces of their own.
    Ties in a class are ranked by a hash of the row and its columns. An empty table gives an empty result.
    The plan, of at most a few thousand rows for any input, is broadcast.
    """
    spark = pieces.sparkSession
    given = pieces.columns
    ranked = pieces.withColumn("_class", F.ceil(F.col("length") / unit).cast("int")).withColumn(
        "_bucket", F.pmod(F.xxhash64("doc_id", "start", "length"), F.lit(spread(spark))).cast("int")
    )
    counts = ranked.groupBy("_class", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_class").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    histogram = {r["_class"]: r["n"] for r in counts.groupBy("_class").agg(F.sum("_n").alias("n")).collect()}

    room = capacity // unit
    classes = np.array(sorted(c for c in histogram if c < room), dtype=int)
    patterns = cutting_stock(classes, np.array([histogram[c] for c in classes], dtype=float), room)
    rows, first, base = [], dict.fromkeys(histogram, 0), 0
    for n, content in patterns:
        for k, each in content.items():
            c = int(classes[k])
            rows.append((c, first[c], first[c] + n * each, each, base))
            first[c] += n * each
        base += n
    if full := histogram.get(room):
        rows.append((room, 0, full, 1, base))
    plan = spark.createDataFrame(rows, "_class int, _from long, _to long, _each long, _base long")

    within = Window.partitionBy("_class", "_bucket").orderBy(*given)
    ranked = (
        ranked.join(counts.drop("_n"), ["_class", "_bucket"])
        .withColumn("_rank", F.row_number().over(within) - 1 + F.col("_before"))
        .join(F.broadcast(plan), (ranked["_class"] == plan["_class"]) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
        .drop(plan["_class"])
        .withColumn("_at", F.col("_rank") - F.col("_from"))
        .withColumn("sequence_id", F.col("_base") + F.floor(F.col("_at") / F.col("_each")))
    )
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("_class"), "_at")
    offset = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    return ranked.withColumn("offset", offset).select(*given, "sequence_id", "offset")


def pack_documents(documents: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 4096, unit: int = 8) -> DataFrame:
    """Tokenizes, cuts and packs whole documents; one row per piece."""
    pieces = stored(document_pieces(documents, tokenizer, end_id, capacity), "pieces")
    return pack(pieces, capacity, unit)
