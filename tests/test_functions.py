from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from windgrid.functions import (
    asset_code,
    decimal_sum,
    hour_floor,
    hour_number,
    is_bad_timestamp,
    is_uncastable,
    normalize,
    percent,
    period,
    to_double,
    to_timestamp,
)
from windgrid.functions.timing import hour_start


def values(spark, rows, expression, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], schema).select(expression).collect()]


def test_normalize_default_trims_spaces_only(spark):
    assert values(spark, [" Conj.  a ", "\tb\t", None], normalize("x")) == ["CONJ.  A", "\tB\t", None]


def test_normalize_collapse_takes_all_white_space(spark):
    rows = ["\t Conj.    a \n", "b\x1cc", "Conj. a", "   ", None]
    assert values(spark, rows, normalize("x", collapse_ws=True)) == ["CONJ. A", "B C", "CONJ. A", "", None]


@pytest.mark.parametrize("text", ["a  b", "\x1f x\x85y ", "　z  q　", "straße  1", "no​break"])
def test_normalize_collapse_equals_python(spark, text):
    assert values(spark, [text], normalize("x", True)) == [" ".join(text.strip().upper().split())]


def test_asset_code(spark):
    rows = ["EOL.CV.RN.037102-5.01", "1234567-8", "12345-6", "99037102-5", "", None]
    assert values(spark, rows, asset_code("x")) == ["037102-5", "1234567-8", "", "9037102-5", "", None]


def test_numbers(spark):
    rows = ["12.5", "-3", "1e3", " 7 ", "12,5", "NaN", "abc", "", "12d", "1.5F", "0x1p3", "inf", None]
    assert values(spark, rows, to_double(F.col("x"))) == [
        12.5, -3.0, 1000.0, 7.0, None, None, None, None, None, None, None, float("inf"), None,
    ]
    bad = values(spark, rows, is_uncastable(F.col("x")))
    assert bad == [False, False, False, False, True, False, True, True, True, True, True, False, False]


def test_numbers_given_as_numbers(spark):
    rows = [1.5, float("nan"), None]
    assert values(spark, rows, to_double(F.col("x"), numeric=True), "x double") == [1.5, None, None]


def test_timestamps(spark):
    rows = ["2026-01-31 00:30:00", "2026-01-31", "bad", "2026-13-01 00:00:00", None]
    good = [datetime(2026, 1, 31, 0, 30), datetime(2026, 1, 31)]
    assert values(spark, rows, to_timestamp(F.col("x"))) == [*good, None, None, None]
    assert values(spark, rows, is_bad_timestamp(F.col("x"))) == [False, False, True, True, True]
    assert values(spark, [rows[0], None], to_timestamp(F.col("x"), "strict")) == [good[0], None]
    with pytest.raises(PySparkException):
        values(spark, rows, to_timestamp(F.col("x"), "strict"))
    with pytest.raises(ValueError):
        to_timestamp(F.col("x"), "other")


def test_hours_ignore_the_session_time_zone(spark):
    # In this zone the clock jumped from 00:00 to 01:00 on that night.
    moment = datetime(2018, 11, 4, 0, 30)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ '2018-11-04 00:30:00' AS x")
        row = df.select(
            hour_floor(F.col("x")).cast("string"),
            hour_start(hour_number(F.col("x"))).cast("string"),
            period(F.col("x"), "daily"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert list(row) == [f"{moment:%Y-%m-%d} 00:00:00", f"{moment:%Y-%m-%d} 00:00:00", "2018-11-04"]


def test_hour_number_is_gapless_before_1970(spark):
    rows = [datetime(1969, 12, 31, 22, 59), datetime(1969, 12, 31, 23, 1), datetime(1970, 1, 1, 0, 59)]
    assert values(spark, rows, hour_number(F.col("x")), "x timestamp_ntz") == [-2, -1, 0]
    starts = values(spark, rows, hour_start(hour_number(F.col("x"))), "x timestamp_ntz")
    assert starts == [r.replace(minute=0) for r in rows]


def test_period(spark):
    rows = [datetime(2026, 1, 31, 23, 30), None]
    assert values(spark, rows, period(F.col("x"), "daily"), "x timestamp_ntz") == ["2026-01-31", None]
    assert values(spark, rows, period(F.col("x"), "monthly"), "x timestamp_ntz") == ["2026-01", None]
    with pytest.raises(ValueError):
        period(F.col("x"), "weekly")


def test_percent(spark):
    row = spark.range(1).select(
        percent(F.lit(1), F.lit(800), scale_first=True), percent(F.lit(95), F.lit(100)), percent(F.lit(1), F.lit(0))
    )
    assert list(row.first()) == [0.13, 95.0, None]


def test_decimal_sum_is_exact_and_never_drops(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(None,)], "x double")
    assert df.agg(decimal_sum(F.col("x"), 6)).first()[0] == 1.0
    assert df.agg(decimal_sum(F.col("x"), None)).first()[0] == pytest.approx(1.0)
    with pytest.raises(PySparkException):
        spark.createDataFrame([(1e30,)], "x double").agg(decimal_sum(F.col("x"), 6)).collect()
