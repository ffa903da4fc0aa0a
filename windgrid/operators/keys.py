"""Dense surrogate keys without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SEPARATOR = "\x01"


def hash_order(natural: Sequence[str]) -> Column:
    """A text hash of the natural key: the same on every run, and evenly spread whatever the names."""
    return F.md5(F.concat_ws(_SEPARATOR, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in natural]))


def add_surrogate_key(
    distinct: DataFrame, natural: Sequence[str], key: str, bucket: Column | None = None
) -> DataFrame:
    """Numbers distinct rows 1..n.

    Rows are numbered inside buckets in parallel, then shifted by the number of rows in the buckets
    before. Only the bucket sizes pass through one task. Without ``bucket`` the order is that of a hash
    of the natural key, in 4096 buckets by its first three digits. A given ``bucket`` must be non-null,
    few in number and ordered as the natural key is; the numbers then follow the natural order.

    Keys depend on the data alone, so a lost task recomputes the same ones.
    """
    natural = list(natural)
    in_order = [F.col(c).asc_nulls_last() for c in natural]
    if bucket is None:
        rows = distinct.withColumn("_hash", hash_order(natural)).withColumn("_bucket", F.substring("_hash", 1, 3))
        in_order = [F.col("_hash").asc(), *in_order]
    else:
        rows = distinct.withColumn("_bucket", bucket)
    sizes = rows.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_bucket").alias("_offset_bucket"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    position = F.row_number().over(Window.partitionBy("_bucket").orderBy(*in_order))
    numbered = rows.withColumn("_position", position).join(offsets, F.col("_bucket") == F.col("_offset_bucket"), "inner")
    return numbered.select(*distinct.columns, (F.col("_offset") + F.col("_position")).cast("bigint").alias(key))


def extend_surrogate_key(stored: DataFrame, distinct: DataFrame, natural: Sequence[str], key: str, bucket: Column | None = None) -> DataFrame:
    """A stored dimension with the natural keys it lacks added: stored keys stay, new rows get the numbers after them.

    ``distinct`` has other columns of the dimension too; null natural keys are equal to null. Facts stored with the old keys
    stay valid. ``bucket`` is that of ``add_surrogate_key``. The result is another table than ``stored``: write it to a place of its own.
    """
    last = stored.agg(F.max(key)).first()[0] or 0
    known = stored.select(*[F.col(c).alias(f"_known_{c}") for c in natural])
    same = [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in natural]
    fresh = distinct.join(known, reduce(and_, same), "left_anti")
    numbered = add_surrogate_key(fresh, natural, key, bucket).withColumn(key, F.col(key) + F.lit(last).cast("bigint"))
    return stored.unionByName(numbered)
