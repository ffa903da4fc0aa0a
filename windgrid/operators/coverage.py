"""Hour coverage of grouped time series: continuity, completeness and missing hours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windgrid.functions import hour_number, percent
from windgrid.functions.timing import hour_start
from windgrid.schemas import TS

SERIES_KEYS = ("projeto", "nom_usina")


def hour_coverage(df: DataFrame, keys: Sequence[str] = SERIES_KEYS, ts: str = TS) -> DataFrame:
    """Per group: distinct hours received, hours expected between first and last, and number of gaps.

    A group's hours are kept as 64-hour bit sets, built by ``bit_or`` inside each task before the
    shuffle. The shuffle therefore carries one row per group and 64 hours, spread by group and hours, and
    the per-group step sees about 137 rows per year however many input rows a group has. A gap is a
    step of more than one hour between neighbouring distinct hours, so a group has one gap less than it
    has runs of consecutive hours. Groups with a null key are left out; null timestamps are ignored.
    """
    return coverage_of_sets(hour_sets(df, keys, ts), keys)


def hour_sets(df: DataFrame, keys: Sequence[str] = SERIES_KEYS, ts: str = TS, by: Sequence[str] = ()) -> DataFrame:
    """Per group and 64 hours: the set of hours with a row as bits, and the first and last one.

    Sets of the same hours can be merged by ``bit_or``. ``by`` keeps apart what further columns of ``df`` tell apart, such as year and
    month: stored by month, the sets of a month can be replaced, and hours of two months in one set are merged by ``coverage_of_sets``.
    """
    keys = list(keys)
    return (
        _with_keys(df, keys)
        .select(*by, *keys, hour_number(F.col(ts)).alias("_hour"))
        .groupBy(*by, *keys, F.shiftright("_hour", 6).alias("_set"))
        .agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("_hour", F.lit(64)).cast("int"))).alias("_bits"),
            F.min("_hour").alias("_first"),
            F.max("_hour").alias("_last"),
        )
    )


def coverage_of_sets(sets: DataFrame, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """``hour_coverage`` from the result of ``hour_sets``, or from stored parts of it."""
    keys = list(keys)
    if set(sets.columns) != {*keys, "_set", "_bits", "_first", "_last"}:
        merged = [F.bit_or("_bits").alias("_bits"), F.min("_first").alias("_first"), F.max("_last").alias("_last")]
        sets = sets.groupBy(*keys, "_set").agg(*merged)
    in_order = Window.partitionBy(*keys).orderBy("_set")
    bits = F.col("_bits")
    # A run starts at a set bit whose lower neighbour is unset; bit 63 of the set before may continue it.
    continued = (
        (F.lag("_set").over(in_order) == F.col("_set") - 1)
        & (F.lag("_bits").over(in_order) < 0)
        & (bits.bitwiseAND(F.lit(1)) == 1)
    )
    starts = F.bit_count(bits.bitwiseAND(F.bitwise_not(F.shiftleft(bits, 1))))
    runs = sets.select(
        *keys,
        "_first",
        "_last",
        F.bit_count(bits).alias("_received"),
        (starts - F.when(continued, 1).otherwise(0)).alias("_starts"),
    )
    received = F.coalesce(F.sum("_received"), F.lit(0))
    return runs.groupBy(*keys).agg(
        received.cast("bigint").alias("received_hours"),
        (F.max("_last") - F.min("_first") + 1).alias("expected_hours"),
        F.greatest(F.coalesce(F.sum("_starts"), F.lit(0)) - 1, F.lit(0)).cast("bigint").alias("gap_count"),
    )


def timestamp_continuity(df: DataFrame, keys: Sequence[str] = SERIES_KEYS, ts: str = TS) -> DataFrame:
    """Gaps of more than one hour per group, groups without gaps included."""
    return hour_coverage(df, keys, ts).select(*keys, "gap_count")


def completeness(
    df: DataFrame, keys: Sequence[str] = SERIES_KEYS, ts: str = TS, threshold: float = 95
) -> DataFrame:
    """Received hours as a percentage of expected hours per group, and whether that calls for an alert.

    A group without any valid timestamp has no percentage and always raises the alert.
    """
    return with_alert(hour_coverage(df, keys, ts), threshold).drop("gap_count")


def with_alert(coverage: DataFrame, threshold: float = 95) -> DataFrame:
    """Adds percentage and alert to the result of ``hour_coverage``; exactly the threshold passes."""
    share = percent(F.col("received_hours"), F.col("expected_hours"))
    return coverage.withColumn("completeness_pct", share).withColumn(
        "below_threshold", F.coalesce(F.col("completeness_pct") < F.lit(float(threshold)), F.lit(True))
    )


def missing_hours(df: DataFrame, keys: Sequence[str] = SERIES_KEYS, ts: str = TS) -> DataFrame:
    """Each run of absent hours per group as one row: first and last absent hour and their number.

    Works on distinct hours, so the window's group size is bounded by the calendar, not by the rows.
    """
    keys = list(keys)
    seen = _with_keys(df, [*keys, ts])
    hours = seen.select(*keys, hour_number(F.col(ts)).alias("_hour")).distinct()
    before = F.lag("_hour").over(Window.partitionBy(*keys).orderBy("_hour"))
    return (
        hours.withColumn("_before", before)
        .filter(F.col("_hour") - F.col("_before") > 1)
        .select(
            *keys,
            hour_start(F.col("_before") + 1).alias("gap_start"),
            hour_start(F.col("_hour") - 1).alias("gap_end"),
            (F.col("_hour") - F.col("_before") - 1).alias("missing_hours"),
        )
    )


def list_missing_hours(df: DataFrame, keys: Sequence[str] = SERIES_KEYS, ts: str = TS) -> DataFrame:
    """Every absent hour per group as one row; expanded in steps of at most 4096 hours per array.

    The steps of one long gap are dealt out over all tasks before they are expanded.
    """
    step = 4096
    runs = missing_hours(df, keys, ts)
    first = hour_number(F.col("gap_start"))
    last = hour_number(F.col("gap_end"))
    chunks = runs.select(*keys, last.alias("_last"), F.explode(F.sequence(first, last, F.lit(step).cast("bigint"))).alias("_from"))
    # With a number, adaptive execution does not put the small unexpanded steps together again.
    chunks = chunks.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, "_from")
    upto = F.least(F.col("_from") + (step - 1), F.col("_last"))
    return chunks.select(*keys, F.explode(F.sequence(F.col("_from"), upto)).alias("_hour")).select(
        *keys, hour_start(F.col("_hour")).alias("missing_hour")
    )


def _with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df
