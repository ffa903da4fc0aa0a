"""The three analytical questions over the joined table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windgrid.functions import decimal_sum, month_number, period
from windgrid.functions.timing import PERIODS
from windgrid.schemas import TS

# Fixed value: label of rows without a restriction reason.
NO_REASON = "WITHOUT_RESTRICTION"


def projects(joined: DataFrame) -> DataFrame:
    """Distinct projects with state and subsystem, ordered by project with null last."""
    return (
        joined.select("projeto", "nom_estado", "nom_subsistema").distinct().orderBy(F.col("projeto").asc_nulls_last())
    )


def is_known_project(joined: DataFrame, project: str) -> bool:
    """Whether any row belongs to the project; stops at the first one found."""
    return not joined.filter(F.col("projeto") == project).isEmpty()


def generation(
    joined: DataFrame,
    project: str,
    start: str | None = None,
    end: str | None = None,
    frequency: str = "daily",
    ts: str = TS,
    sum_scale: int | None = None,
) -> DataFrame:
    """Generation of a project per day or month, ordered by period.

    A period whose values are all null totals 0.0; a range without rows gives no periods. The complex's
    value is on each of its plants' rows and counts once per plant. ``sum_scale`` adds up in decimals.
    """
    if frequency not in PERIODS:
        raise ValueError("frequency must be 'daily' or 'monthly'")
    rows = in_range(joined.filter(F.col("projeto") == project), start, end, ts)
    total = F.coalesce(decimal_sum(F.col("val_geracao"), sum_scale), F.lit(0.0))
    return (
        rows.filter(F.col(ts).isNotNull())
        .groupBy(period(F.col(ts), frequency).alias("period"))
        .agg(total.alias("total_generation"))
        .withColumn("projeto", F.lit(project))
        .orderBy("period")
    )


def restrictions_summary(
    joined: DataFrame,
    project: str | None = None,
    start: str | None = None,
    end: str | None = None,
    default_label: str = NO_REASON,
    ts: str = TS,
    sum_scale: int | None = None,
) -> DataFrame:
    """Rows and energy below the reference generation per restriction reason, ordered by reason.

    ``total_hours`` counts rows with a timestamp, whatever their spacing. An empty ``project`` means all.
    """
    rows = in_range(joined.filter(F.col("projeto") == project) if project else joined, start, end, ts)
    lost = F.col("val_geracaoreferencia") - F.col("val_geracao")
    return (
        rows.filter(is_below())
        .groupBy(F.coalesce("cod_razaorestricao", F.lit(default_label)).alias("cod_razaorestricao"))
        .agg(F.count(ts).alias("total_hours"), decimal_sum(lost, sum_scale).alias("total_mwh_restricted"))
        .orderBy("cod_razaorestricao")
    )


def is_below() -> Column:
    """Generation below the reference. NaN sorts above every number in Spark; in a table of other origin it is a missing value."""
    return (F.col("val_geracao") < F.col("val_geracaoreferencia")) & ~F.isnan("val_geracaoreferencia")


def in_range(
    df: DataFrame, start: str | None, end: str | None, ts: str = TS, year: str = "year", month: str = "month"
) -> DataFrame:
    """Rows between two moments, both ends included and optional; a date alone means its midnight.

    On a table stored by year and month the same bounds are put on those columns, so Spark skips the
    other folders. The stored year and month must come from ``ts``.
    """
    stored = year in df.columns and month in df.columns
    for bound, inside in ((start, "__ge__"), (end, "__le__")):
        if not bound:
            continue
        moment = F.lit(bound).cast("timestamp_ntz")
        df = df.filter(getattr(F.col(ts), inside)(moment))
        if stored:
            edge = month_number(F.year(moment), F.month(moment))
            df = df.filter(getattr(month_number(F.col(year), F.col(month)), inside)(edge))
    return df
