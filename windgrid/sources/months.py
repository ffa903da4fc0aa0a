"""Month ranges and the months a landing zone lacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windgrid.schemas import TS


def month_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """All months that begin between two dates, both ends included, as year and two-digit month."""
    return spark.range(1).select(_months(F.lit(start).cast("date"), F.lit(end).cast("date"))).select(*_parts())


def month_span(df: DataFrame, ts: str = TS) -> DataFrame:
    """All months from a table's first to its last timestamp."""
    first, last = F.trunc(F.min(ts), "month"), F.max(ts).cast("date")
    return df.agg(first.alias("_first"), last.alias("_last")).select(_months(F.col("_first"), F.col("_last"))).select(*_parts())


def months_present(df: DataFrame, ts: str = TS) -> DataFrame:
    """The months a table has rows for."""
    month = F.trunc(ts, "month").alias("_month")
    return df.select(month).dropna().distinct().select(*_parts())


def missing_months(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Expected months without data. A missing month is a finding, not an error."""
    return expected.join(present, ["year", "month"], "left_anti")


def _months(start: Column, end: Column) -> Column:
    first = F.trunc(start, "month")
    first = F.when(first < start, F.add_months(first, 1)).otherwise(first)
    months = F.when(first <= end, F.sequence(first, F.when(first <= end, end).otherwise(first), F.expr("interval 1 month")))
    return F.explode(months).alias("_month")


def _parts() -> list[Column]:
    return [F.year("_month").alias("year"), F.lpad(F.month("_month").cast("string"), 2, "0").alias("month")]
