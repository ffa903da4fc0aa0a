"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windgrid.session import shared_folder

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
GAP_PATTERN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written below the shared checkpoint folder and read back: cuts lineage, survives lost executors."""
    path = shared_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def spread(spark: SparkSession) -> int:
    """How many buckets a hot key is split into: as many as a shuffle has partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def crc_residue(column: str, modulus: int) -> Column:
    """crc32 of a column's text, modulo; a null counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)
