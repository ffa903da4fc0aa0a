"""Mixing sources to target weights by pivotal dependent rounding.

A source's target divided by its size is the number of copies every document of it should have: some whole copies and a
probability of one more. Two documents of a source at a time exchange probability, in words, in a random direction that keeps
both expectations, until one of them is zero or one. The words of the source stay what they were, so only
the last document left open moves the source off its target. Documents are dealt into buckets; each bucket leaves at
most one open document, and these are combined level by level in a reduction tree.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windgrid.llm.common import WORD_PATTERN, spread, stored

BUCKET_ROWS, FAN_IN = 512, 64
TRIES = 16
OPEN = "source string, bucket long, doc_id long, h long, size long, source_size long, target double, whole long, p double"
NAMES = [c.split()[0] for c in OPEN.split(", ")]
KINDS = [{"string": pa.string(), "long": pa.int64(), "double": pa.float64()}[c.split()[1]] for c in OPEN.split(", ")]


def sized(documents: DataFrame) -> DataFrame:
    """doc_id, source, size (words), h (hash of the text)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long").alias("size")
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size, F.xxhash64(text).alias("h"))


def numbered(sources: DataFrame) -> DataFrame:
    """The sources with their place (from 0) in code point order, null last, found by ranges in parallel."""
    ordered = stored(sources.orderBy(F.asc_nulls_last("source")).withColumn("range", F.spark_partition_id()), "sources")
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    starts = ordered.groupBy("range").agg(F.count("*").alias("n")).select("range", F.coalesce(before, F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("range").orderBy(F.asc_nulls_last("source"))) - 1
    return ordered.withColumn("within", within).join(starts, "range").withColumn("place", F.col("start") + F.col("within")).drop("range", "within", "start")


def targets(sources: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, target, of a table with one row (source, source_size) per source.

    Sources in code point order, null last, weigh ``weights``, repeating, and share ``share`` of all sizes; a target stops at
    ``most`` times its source's size, and the excess goes to the others by weight. Sources without words get 0.
    """
    if most < share:
        raise ValueError("sources cannot hold the share")
    weight = F.element_at(F.lit([float(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = stored(numbered(sources).select("source", "source_size", weight.alias("weight")), "weights")
    whole = sources.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    level, last = 0.0, None
    if whole["size"]:
        level = share * whole["size"] / whole["weight"]
        # The level only rises, so every round but the last stops further sources.
        while level != last:
            full = F.col("weight") * level > most * F.col("source_size")
            now = sources.agg(F.sum(F.when(full, F.col("source_size"))).alias("size"), F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
            last, level = level, max(level, (share * whole["size"] - most * (now["size"] or 0)) / now["weight"]) if now["weight"] else level
    return sources.select("source", "source_size", F.least(F.col("weight") * level, most * F.col("source_size")).alias("target"))


def chance(a: tuple[int, int], b: tuple[int, int], seed: int) -> float:
    """A number from 0 to 1 that depends on two documents and the seed alone."""
    import xxhash

    return xxhash.xxh3_64_intdigest(repr((seed, a, b)).encode()) / 2.0**64


def exchange(p: float, size: int, q: float, other: int, u: float) -> tuple[float, float]:
    """Probabilities of two documents after words went from one to the other until one probability is 0 or 1.

    p * size + q * other stays, and so does the expectation of each.
    """
    up_whole, up_empty = (1 - p) * size, q * other
    down_empty, down_whole = p * size, (1 - q) * other
    up, down = min(up_whole, up_empty), min(down_empty, down_whole)
    if u * (up + down) < down:
        return (1.0 if up_whole <= up_empty else p + up / size), (0.0 if up_empty <= up_whole else q - up / other)
    return (0.0 if down_empty <= down_whole else p - down / size), (1.0 if down_whole <= down_empty else q + down / other)


def one_pass(rows: Iterable[tuple], seed: int) -> Iterator[tuple]:
    """Rows (p last) with p 0 or 1 in all but one at most, which comes last. Keeps one row at a time."""
    held, near = None, 1e-12
    for row in rows:
        if held is None:
            held = row
            continue
        p, q = exchange(held[-1], held[4], row[-1], row[4], chance((held[2], held[3]), (row[2], row[3]), seed))
        both, held = [(*held[:-1], p), (*row[:-1], q)], None
        for r in both:
            if near < r[-1] < 1 - near:
                held = r
            else:
                yield (*r[:-1], float(round(r[-1])))
    if held is not None:
        yield held


def closed(rows: list[tuple], seed: int, tries: int) -> list[tuple]:
    """All rows with p 0 or 1: the last open one takes the nearer. Of a few passes with chances of their own, the
    first whose words miss by less than half the shortest row counts, else the one that misses least."""
    wanted, best = sum(r[4] * r[-1] for r in rows), None
    for turn in range(tries):
        done = [(*r[:-1], 1.0 if r[-1] >= 0.5 else 0.0) for r in one_pass(rows, seed * 1009 + turn)]
        miss = abs(sum(r[4] * r[-1] for r in done) - wanted)
        if best is None or miss < best[0]:
            best = miss, done
        if 2 * miss <= rows[-1][4]:
            break
    return best[1]


def settle(rows: DataFrame, seed: int, last: bool, tries: int) -> DataFrame:
    """One level: rows of a (source, bucket) meet from the longest document to the shortest, so that what stays open tends
    to be short. The last level has one bucket a source, of bounded size, and leaves none open."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        given = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        groups = (closed(list(g), seed, tries) if last else one_pass(g, seed) for _, g in itertools.groupby(given, key=lambda r: r[:2]))
        done = itertools.chain.from_iterable(groups)
        while part := list(itertools.islice(done, 8192)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), KINDS)], NAMES)

    dealt = rows.select(NAMES).repartition(spread(rows.sparkSession), "source", "bucket")
    return dealt.sortWithinPartitions("source", "bucket", F.desc("size"), "doc_id", "h").mapInArrow(run, OPEN)


def mix(documents: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 13, bucket_rows: int = BUCKET_ROWS, fan_in: int = FAN_IN, tries: int = TRIES) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: one row per document; taken is its size times its copies.

    A source's taken words miss its target by at most half of one of its documents; the last level tries a few passes for less. Null texts have size 0 and are taken 0
    times; a null source is a source of its own, the last one. Rows of equal doc_id are documents of their own; chances depend on
    doc_id and text, so reruns agree. A hot source is dealt over as many buckets as its rows need. An empty table gives an empty result.
    """
    sizes = stored(sized(documents), "sizes")
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sources = stored(sources, "sources")
    aims = stored(targets(sources.select("source", "source_size"), weights, share, most), "targets")
    aims = aims.join(sources.select(F.col("source").alias("_s"), "n"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    buckets = F.ceil(F.col("n") / bucket_rows)
    aims = stored(aims.select(F.col("source").alias("_s"), "source_size", "target", buckets.cast("long").alias("buckets")), "targets")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(copies + 1e-12)
    each = sizes.join(aims, sizes["source"].eqNullSafe(aims["_s"]), "left").withColumns({"whole": whole, "p": F.greatest(copies - whole, F.lit(0.0))})
    each = each.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "h"), F.col("buckets")))
    sure = (F.col("p") < 1e-12) | (F.col("size") == 0)
    settled = each.filter(sure).withColumn("p", F.lit(0.0)).select(NAMES)
    rest = each.filter(~sure).select(NAMES)
    left = sources.agg(F.max("n")).first()[0] or 0
    left = math.ceil(left / bucket_rows)
    while left:
        done = stored(settle(rest, seed, left == 1, tries), "mixed")
        settled = settled.unionByName(done.filter("p IN (0, 1)"))
        rest = done.filter("p NOT IN (0, 1)").withColumn("bucket", F.floor(F.col("bucket") / fan_in))
        left = math.ceil(left / fan_in) if left > 1 else 0
    taken = (F.col("size") * (F.col("whole") + F.col("p").cast("long"))).alias("taken")
    return settled.select("doc_id", "source", "size", "source_size", "target", taken)
