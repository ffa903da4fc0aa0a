"""Data quality report over raw rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windgrid.functions import is_bad_timestamp, is_uncastable, percent, to_double
from windgrid.operators.clean import COPIES, count_copies, is_valid_flag, typed_columns
from windgrid.operators.longform import long_rows
from windgrid.schemas import COMPLEX_NUMERIC, FLAG, PLANT_NUMERIC, TS


def null_percentages(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of nulls per column as rows (``column_name``, ``null_pct``); one pass, zero for an empty table."""
    names = list(columns or df.columns)
    shares = [(c, _null_share(F.col(c).isNull(), F.count("*"))) for c in names]
    return long_rows(df, ["column_name"], shares, "null_pct")


def level_quality(
    raw: DataFrame,
    prefix: str,
    numeric: Sequence[str],
    ts: str = TS,
    flag: str | None = None,
    rules: str = "raw",
    zero_dates: bool = False,
    count_nulls: bool | None = None,
    event_time: str | None = "data_hora",
) -> DataFrame:
    """Null shares of the clean table and cleaning statistics of one level, as report rows.

    ``rules="raw"`` counts flag 1, bad dates and uncastable numbers over all raw rows, copies included.
    ``rules="cleaned"`` counts them as the cleaning meets them: every flag but zero after duplicate
    removal, then null dates and null numbers among the rows kept. ``count_nulls`` overrides whether
    nulls that were null before count as bad numbers. ``zero_dates`` reports no bad dates.

    One shuffle: everything derives from the distinct rows and their copy counts. Pass the stored result
    of ``count_copies`` to share it with the cleaning.
    """
    return report_of_counts(level_counts(raw, prefix, numeric, ts, flag, rules, zero_dates, count_nulls, event_time))


def level_counts(
    raw: DataFrame,
    prefix: str,
    numeric: Sequence[str],
    ts: str = TS,
    flag: str | None = None,
    rules: str = "raw",
    zero_dates: bool = False,
    count_nulls: bool | None = None,
    event_time: str | None = "data_hora",
    by: Sequence[str] = (),
) -> DataFrame:
    """The counts behind ``level_quality`` as rows (``by``, ``section``, ``metric``, ``key``, ``n``), nulls of the clean table included.

    ``by`` are columns that equal rows share, such as year and month of the timestamp: counts of different months can be stored
    apart and added, and ``report_of_counts`` makes the report of all.
    """
    if rules not in ("raw", "cleaned"):
        raise ValueError(f"rules must be 'raw' or 'cleaned', not {rules!r}")
    counted = raw if COPIES in raw.columns else count_copies(raw)
    names = [c for c in counted.columns if c not in (COPIES, *by)]
    from_raw = rules == "raw"
    count_nulls = (not from_raw) if count_nulls is None else count_nulls
    kept = F.lit(True) if flag is None else is_valid_flag(counted, flag)
    typed = typed_columns(counted.drop(*by), [*numeric, *([flag] if flag else [])], ts, "coerce", event_time)
    copies = F.col(COPIES)

    def rows(condition: Column) -> Column:
        weight = copies if from_raw else kept.cast("bigint")
        return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0))

    metrics = [("initial_rows", "", F.coalesce(F.sum(copies), F.lit(0)))]
    metrics.append(("duplicates_removed", "", F.coalesce(F.sum(copies - 1), F.lit(0))))
    if flag:
        flagged = rows(_equals_one(counted, flag)) if from_raw else F.count_if(~kept)
        metrics.append(("invalid_wind_filtered", "", flagged))
    bad_dates = F.lit(0) if zero_dates else rows(is_bad_timestamp(F.col(ts)))
    metrics.append(("invalid_dates", "", bad_dates))
    for name in numeric:
        if name in names:
            bad = typed[name].isNull() if count_nulls else is_uncastable(F.col(name))
            metrics.append(("invalid_numeric_values", name, rows(bad)))
    metrics.append(("final_rows", "", F.count_if(kept)))
    lines = [(f"{prefix}_stats", metric, key, value) for metric, key, value in metrics]
    lines += [(f"{prefix}_nulls", "null_pct", name, F.count_if(kept & column.isNull())) for name, column in typed.items()]
    return long_rows(counted, ["section", "metric", "key"], lines, "n", "bigint", by)


def report_of_counts(counts: DataFrame) -> DataFrame:
    """The report's rows (``section``, ``metric``, ``key``, ``value``) from the result of ``level_counts``, or from several of them:
    counts are added, and null shares are taken of the sums. A few dozen rows, whatever the number of months."""
    level = F.substring_index("section", "_", 1).alias("_level")
    sums = counts.groupBy(level, "section", "metric", "key").agg(F.sum("n").alias("n"))
    final = F.max(F.when(F.col("metric") == "final_rows", F.col("n"))).over(Window.partitionBy("_level"))
    share = F.coalesce(percent(F.col("n"), final, scale_first=True), F.lit(0.0))
    return sums.withColumn("value", F.when(F.col("metric") == "null_pct", share).otherwise(F.col("n").cast("double"))).select("section", "metric", "key", "value")


def quality_report(
    spe: DataFrame,
    wind: DataFrame,
    rules: str = "raw",
    zero_wind_dates: bool = False,
    plant_numeric: Sequence[str] = PLANT_NUMERIC,
    complex_numeric: Sequence[str] = COMPLEX_NUMERIC,
    flag: str = FLAG,
    ts: str = TS,
) -> DataFrame:
    """Both levels' null shares and statistics as rows (``section``, ``metric``, ``key``, ``value``)."""
    plants = level_quality(spe, "spe", plant_numeric, ts, flag, rules)
    complexes = level_quality(wind, "wind", complex_numeric, ts, None, rules, zero_dates=zero_wind_dates)
    return plants.unionByName(complexes)


def _null_share(is_null: Column, total: Column) -> Column:
    return F.coalesce(percent(F.count_if(is_null), total, scale_first=True), F.lit(0.0))


def _equals_one(df: DataFrame, flag: str) -> Column:
    return to_double(F.col(flag)) == 1
