"""Duplicate removal, flag filter and typing of raw rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windgrid.functions import timestamp_column, to_double
from windgrid.schemas import COMPLEX_NUMERIC, FLAG, PLANT_NUMERIC, TS

COPIES = "_copies"


def count_copies(raw: DataFrame) -> DataFrame:
    """Each distinct row once, with the number of its copies.

    Copies are counted before the shuffle, so a row that fills a third of the input travels once per
    task. Clean rows and the quality report both derive from this result without another shuffle.
    """
    return raw.groupBy(*raw.columns).agg(F.count("*").alias(COPIES))


def is_valid_flag(df: DataFrame, flag: str) -> Column:
    """True for flag zero; false for another value and for null."""
    return F.coalesce(_number(df, flag) == 0, F.lit(False))


def typed_columns(
    df: DataFrame, numeric: Sequence[str], ts: str = TS, mode: str = "coerce", event_time: str | None = None
) -> dict[str, Column]:
    """The clean table's columns as expressions over the raw columns, by name and in order."""
    columns = {}
    for name in df.columns:
        if name == COPIES:
            continue
        if name == ts:
            columns[name] = timestamp_column(df, name, mode)
        elif name in numeric:
            columns[name] = _number(df, name)
        else:
            columns[name] = F.col(name)
    if event_time:
        columns[event_time] = timestamp_column(df, ts, mode)
    return columns


def clean_spe(
    raw: DataFrame,
    numeric: Sequence[str] = PLANT_NUMERIC,
    ts: str = TS,
    flag: str = FLAG,
    mode: str = "coerce",
    event_time: str | None = "data_hora",
) -> DataFrame:
    """Plant rows: distinct, flag zero, typed. ``raw`` may be raw rows or the result of ``count_copies``."""
    kept = raw.filter(is_valid_flag(raw, flag))
    return _typed(kept, [*numeric, flag], ts, mode, event_time)


def clean_wind(
    raw: DataFrame,
    numeric: Sequence[str] = COMPLEX_NUMERIC,
    ts: str = TS,
    mode: str = "coerce",
    event_time: str | None = "data_hora",
) -> DataFrame:
    """Complex rows: distinct and typed; there is no flag to filter on."""
    return _typed(raw, numeric, ts, mode, event_time)


def _typed(
    rows: DataFrame, numeric: Sequence[str], ts: str, mode: str, event_time: str | None
) -> DataFrame:
    distinct = rows if COPIES in rows.columns else rows.distinct()
    columns = typed_columns(distinct, numeric, ts, mode, event_time)
    return distinct.select(*[c.alias(name) for name, c in columns.items()])


def _number(df: DataFrame, name: str) -> Column:
    return to_double(F.col(name), numeric=df.schema[name].dataType.typeName() != "string")
