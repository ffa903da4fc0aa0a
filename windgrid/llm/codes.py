"""Vector code compression: codebooks of vector parts by member-resident Lloyd rounds.

A part lives where the owner of its codebook entry is: rows are partitioned by (position, entry, salt). In each round every task
assigns the parts that it holds, only parts whose entry changed go through the shuffle, to their new owner, and owners sum their
resident members for the next codebook. Entries with many members have several owners (the salt). The codebooks
are what every task and the driver hold: entries * vector length numbers, whatever the table's size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windgrid.llm.common import spread, stored

ROWS_AT_ONCE = 2048
LONG_MAX = (1 << 63) - 1
PART = "rid long, position int, part array<bigint>, entry int"


def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str, label_column: str, scale: float) -> DataFrame:
    """rid, vec_id, label, v (floor(scale * x), ending at the limits of long): sound vectors, each row with an id of its own."""
    given = vectors.select(F.col(id_column).alias("vec_id"), F.col(label_column).alias("label"), F.transform(vector_column, lambda x: x.cast("double")).alias("v"))
    sound = (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    limit = 2.0**62
    whole = F.transform("v", lambda x: F.floor(F.least(F.greatest(x * scale, F.lit(-limit)), F.lit(limit))))
    return given.filter(F.coalesce(sound, F.lit(False))).select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", whole.alias("v"))


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, list[int] | np.ndarray]:
    """The nearest entry of each part (ties to the lower index) and its squared distance, exactly."""
    top = max(int(np.abs(parts).max(initial=0)), int(np.abs(book).max(initial=0)))
    if 4 * top * top * max(1, parts.shape[1]) < 1 << 52:
        # Whole numbers below 2^53 are exact in doubles.
        c = book.astype(np.float64)
        of_book, entries, distances = (c * c).sum(axis=1), [], []
        for at in range(0, len(parts), ROWS_AT_ONCE):
            x = parts[at : at + ROWS_AT_ONCE].astype(np.float64)
            d = of_book - 2 * (x @ c.T)
            entry = d.argmin(axis=1)
            entries.append(entry)
            distances.append(d[np.arange(len(x)), entry] + (x * x).sum(axis=1))
        return np.concatenate(entries), np.concatenate(distances).astype(np.int64)
    found = [min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(book.tolist())) for x in parts.tolist()]
    return np.array([k for _, k in found]), [min(d, LONG_MAX) for d, _ in found]


def by_position(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Position, places in the batch and the matrix of parts."""
    column = batch.column("part")
    sizes, offsets = column.value_lengths().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    positions = batch.column("position").to_numpy()
    for position in np.unique(positions):
        at = np.flatnonzero(positions == position)
        yield int(position), at, values[offsets[at][:, None] + np.arange(sizes[at[0]])]


def assigned(resident: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """The parts with their new entry, the former one (was) and the squared distance, each in the task that held it."""
    shared = resident.sparkSession.sparkContext.broadcast(books)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            entry, distance = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int64)
            for position, at, parts in by_position(batch):
                entry[at], distance[at] = nearest(parts, shared.value[position])
            columns = [batch.column("rid"), batch.column("position"), batch.column("part"), pa.array(entry), batch.column("entry"), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["rid", "position", "part", "entry", "was", "distance"])

    return resident.mapInArrow(run, PART + ", was int, distance long")


def resident_sums(resident: DataFrame) -> DataFrame:
    """position, entry, sums (the count first): what the owners' members add up to; a row per owner task first."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            entries = batch.column("entry").to_numpy()
            for position, at, parts in by_position(batch) if batch.num_rows else ():
                order = np.argsort(entries[at], kind="stable")
                found, starts, counts = np.unique(entries[at][order], return_index=True, return_counts=True)
                safe = int(np.abs(parts).max(initial=0)) < 1 << 44
                rows = parts[order] if safe else parts[order].astype(object)
                sums = np.add.reduceat(rows, starts, axis=0) if rows.shape[1] else rows[starts]
                for e, n, total in zip(found.tolist(), counts.tolist(), sums.tolist()):
                    total = [n, *total]
                    old = held.get((position, e))
                    held[position, e] = total if old is None else [a + b for a, b in zip(old, total)]
        kinds = [pa.int32(), pa.int32(), pa.list_(pa.decimal128(38, 0))]
        rows = [(p, e, [Decimal(x) for x in total]) for (p, e), total in held.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(3)], ["position", "entry", "sums"])

    each = resident.select("position", "entry", "part").mapInArrow(run, "position int, entry int, sums array<decimal(38,0)>")
    sums = each.select("position", "entry", F.posexplode("sums").alias("k", "x")).groupBy("position", "entry", "k").agg(F.sum("x").cast("decimal(38,0)").alias("x"))
    sums = sums.groupBy("position", "entry").agg(F.array_sort(F.collect_list(F.struct("k", "x"))).alias("sums"))
    return sums.select("position", "entry", F.col("sums.x").alias("sums"))


def migrated(parts: DataFrame, entries: int) -> DataFrame:
    """Parts where their entry's owners are: those that kept their entry as they lie, the others through a shuffle."""
    spark = parts.sparkSession
    counts = {(r["position"], r["entry"]): r["count"] for r in parts.groupBy("position", "entry").count().collect()}
    goal = max(1, sum(counts.values()) // spread(spark))
    positions = 1 + max((p for p, _ in counts), default=0)
    owners = F.lit([-(-counts.get((p, e), 1) // goal) for p in range(positions) for e in range(entries)])
    salt = F.pmod(F.col("rid"), F.get(owners, F.col("position") * entries + F.col("entry")))
    names = [c.split()[0] for c in PART.split(", ")]
    moving = parts.filter("entry <> was").select(*names, salt.alias("salt")).repartition(spread(spark), "position", "entry", "salt")
    return parts.filter("entry = was").select(names).unionByName(stored(moving.select(names), "moved"))


def compress(vectors: DataFrame, n_parts: int = 4, entries: int = 256, rounds: int = 4, scale: float = 1024.0, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) of every sound vector, and the codebooks (one matrix per part position).

    A vector that is null, empty or holds a null or non-finite component is left out, and so is one whose length is not that of the smallest
    vec_id's. Codebooks start as the parts of the smallest vec_ids (nulls last; of rows of equal id the smaller vector first); fewer
    rows than ``entries`` give smaller codebooks. Ties go to the lower index. Repeated rows are rows of their own, a null vec_id too.
    A length that ``n_parts`` does not divide is cut at floor(k * length / n_parts). An empty table gives no rows and no codebooks.
    """
    base = stored(whole_vectors(vectors, id_column, vector_column, label_column, scale), "vectors")
    by_id = [F.asc_nulls_last("vec_id"), "v"]
    first = base.orderBy(*by_id).select(F.size("v")).first()
    code = F.concat(*(F.lpad(F.lower(F.hex(F.max(F.when(F.col("position") == p, F.col("entry"))))), 2, "0") for p in range(n_parts)))
    if first is None:
        return base.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), []
    length = first[0]
    base = base.filter(F.size("v") == length)
    start = np.array([r["v"] for r in base.orderBy(*by_id).limit(entries).select("v").collect()], np.int64)
    cuts = [k * length // n_parts for k in range(n_parts + 1)]
    books = [start[:, a:b] for a, b in zip(cuts, cuts[1:])]
    parts = F.array(*(F.slice("v", a + 1, b - a) for a, b in zip(cuts, cuts[1:])))
    resident = base.select("rid", F.posexplode(parts).alias("position", "part"), F.lit(-1).alias("entry"))
    for _ in range(rounds):
        resident = migrated(stored(assigned(resident, books), "assigned"), entries)
        books = [book.copy() for book in books]
        for row in resident_sums(resident).collect():
            books[row["position"]][row["entry"]] = [int(x) // int(row["sums"][0]) for x in row["sums"][1:]]
    done = assigned(resident, books).groupBy("rid").agg(code.alias("code"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("error"))
    error = F.least(F.col("error"), F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long")
    return base.select("rid", "vec_id", "label").join(done, "rid").select("vec_id", "label", "code", error.alias("error")), books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds label_error: the error summed over rows of equal label, nulls together."""
    coded = stored(coded, "coded")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long")
    sums = stored(coded.groupBy("label").agg(total.alias("label_error")), "labels").withColumnRenamed("label", "_label")
    return coded.join(sums, coded["label"].eqNullSafe(sums["_label"]), "left").drop("_label")
