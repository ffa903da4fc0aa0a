"""Daily sums by project and reason, from which the questions over any range of days are answered without the joined rows.

Rows of one day are one row of the rollup, or two: those of its first moment are kept apart, since a range that ends with a date
ends at that date's midnight. Values are added as whole numbers of 10**-scale, so sums of sums are exact.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windgrid.functions import month_number, period
from windgrid.functions.ratios import whole_units
from windgrid.functions.timing import PERIODS
from windgrid.operators.metrics import NO_REASON, is_below
from windgrid.schemas import TS

SCALE = 6


def daily_rollup(joined: DataFrame, scale: int = SCALE, ts: str = TS) -> DataFrame:
    """year, month, projeto, cod_razaorestricao, day, midnight; then hours and units of generation, and rows, hours and units below
    the reference. ``joined`` has year and month. Rows without a timestamp have a null day."""
    day = F.col(ts).cast("date")
    lost = F.col("val_geracaoreferencia") - F.col("val_geracao")
    keys = ["year", "month", "projeto", "cod_razaorestricao", day.alias("day"), (F.col(ts) == day.cast("timestamp_ntz")).alias("midnight")]
    return joined.groupBy(*keys).agg(
        F.count(ts).alias("hours"),
        F.sum(whole_units(F.col("val_geracao"), scale)).alias("generation"),
        F.count_if(is_below()).alias("below_rows"),
        F.count(F.when(is_below(), F.col(ts))).alias("below_hours"),
        F.sum(F.when(is_below(), whole_units(lost, scale))).alias("lost"),
    )


def generation(rollup: DataFrame, project: str, start: str | None = None, end: str | None = None, frequency: str = "daily", scale: int = SCALE) -> DataFrame:
    """``metrics.generation`` from the rollup; the range is given by dates."""
    if frequency not in PERIODS:
        raise ValueError("frequency must be 'daily' or 'monthly'")
    rows = in_days(rollup.filter(F.col("projeto") == project), start, end).filter(F.col("day").isNotNull())
    total = F.coalesce(F.sum("generation").cast("double") / 10**scale, F.lit(0.0))
    return rows.groupBy(period(F.col("day"), frequency).alias("period")).agg(total.alias("total_generation")).withColumn("projeto", F.lit(project)).orderBy("period")


def restrictions_summary(rollup: DataFrame, project: str | None = None, start: str | None = None, end: str | None = None, default_label: str = NO_REASON, scale: int = SCALE) -> DataFrame:
    """``metrics.restrictions_summary`` from the rollup; the range is given by dates."""
    rows = in_days(rollup.filter(F.col("projeto") == project) if project else rollup, start, end)
    return (
        rows.filter("below_rows > 0")
        .groupBy(F.coalesce("cod_razaorestricao", F.lit(default_label)).alias("cod_razaorestricao"))
        .agg(F.sum("below_hours").alias("total_hours"), (F.sum("lost").cast("double") / 10**scale).alias("total_mwh_restricted"))
        .orderBy("cod_razaorestricao")
    )


def in_days(rollup: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Days between two dates; of the last one only its midnight. Folders of other months are not read."""
    bounds = [date.fromisoformat(b) if b else None for b in (start, end)]
    number = month_number(F.col("year"), F.col("month"))
    if bounds[0]:
        rollup = rollup.filter((F.col("day") >= F.lit(bounds[0])) & (number >= bounds[0].year * 100 + bounds[0].month))
    if bounds[1]:
        inside = (F.col("day") < F.lit(bounds[1])) | ((F.col("day") == F.lit(bounds[1])) & F.col("midnight"))
        rollup = rollup.filter(inside & (number <= bounds[1].year * 100 + bounds[1].month))
    return rollup
