from __future__ import annotations

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windgrid.operators import coverage, validate

SERIES = "projeto string, nom_usina string, din_instante timestamp_ntz"
START = datetime(2026, 1, 1)


def series(spark, hours, project="P", plant="U"):
    rows = [(project, plant, None if h is None else START + timedelta(hours=h)) for h in hours]
    return spark.createDataFrame(rows, SERIES)


def brute_force(frame: pd.DataFrame) -> dict:
    found = {}
    for key, group in frame.groupby(["projeto", "nom_usina"]):
        hours = sorted({t.floor("h") for t in pd.to_datetime(group["din_instante"]) if not pd.isna(t)})
        gaps = sum(b - a > pd.Timedelta(hours=1) for a, b in zip(hours, hours[1:]))
        expected = int((hours[-1] - hours[0]) / pd.Timedelta(hours=1)) + 1 if hours else None
        found[key] = (len(hours), expected, gaps)
    return found


def covered(df):
    return {
        (r.projeto, r.nom_usina): (r.received_hours, r.expected_hours, r.gap_count)
        for r in coverage.hour_coverage(df).collect()
    }


def test_continuity_edges(spark):
    df = series(spark, [0, 0.5, 1, 3])  # two rows in one hour, a step of one hour, a step of two
    assert covered(df) == {("P", "U"): (3, 4, 1)}
    assert covered(series(spark, [None])) == {("P", "U"): (0, None, 0)}
    assert covered(series(spark, [5])) == {("P", "U"): (1, 1, 0)}
    assert covered(series(spark, [1], project=None)) == {}


def test_gaps_across_bit_set_borders(spark):
    assert covered(series(spark, range(-70, 200)))[("P", "U")] == (270, 270, 0)
    for missing in (61, 62, 63, 64, 65, 126, 127, 128, 129):
        hours = [h for h in range(0, 200) if h != missing]
        assert covered(series(spark, hours))[("P", "U")] == (199, 200, 1), missing


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-300, 300)), min_size=1, max_size=80))
def test_coverage_equals_brute_force(spark, rows):
    data = [("P", plant, START + timedelta(minutes=20 * step)) for plant, step in rows]
    df = spark.createDataFrame(data, SERIES)
    frame = pd.DataFrame(data, columns=["projeto", "nom_usina", "din_instante"])
    assert covered(df) == brute_force(frame)
    runs = coverage.missing_hours(df).groupBy("projeto", "nom_usina").agg(F.count("*"), F.sum("missing_hours")).collect()
    want = {k: (gaps, expected - got) for k, (got, expected, gaps) in brute_force(frame).items() if gaps}
    assert {(r[0], r[1]): (r[2], r[3]) for r in runs} == want


def test_hot_series_equals_brute_force(spark):
    """One series with most rows, many copies of the same hours."""
    rng = random.Random(7)
    data = [("P", "hot", START + timedelta(hours=rng.choice(range(0, 4000, 3)), minutes=rng.randrange(60))) for _ in range(20000)]
    data += [("P", f"u{i}", START + timedelta(hours=i)) for i in range(500)]
    frame = pd.DataFrame(data, columns=["projeto", "nom_usina", "din_instante"])
    assert covered(spark.createDataFrame(data, SERIES)) == brute_force(frame)


def test_missing_hours_are_listed(spark):
    df = series(spark, [0, 1, 4, 5, 9000])
    runs = [(r.gap_start, r.gap_end, r.missing_hours) for r in coverage.missing_hours(df).orderBy("gap_start").collect()]
    assert runs == [
        (START + timedelta(hours=2), START + timedelta(hours=3), 2),
        (START + timedelta(hours=6), START + timedelta(hours=8999), 8994),
    ]
    listed = [r.missing_hour for r in coverage.list_missing_hours(df).orderBy("missing_hour").collect()]
    assert listed == [START + timedelta(hours=h) for h in [2, 3, *range(6, 9000)]]


def test_completeness_threshold_is_strict(spark):
    exactly = series(spark, [h for h in range(20) if h != 7])
    row = coverage.completeness(exactly).first()
    assert (row.completeness_pct, row.below_threshold) == (95.0, False)
    below = series(spark, [h for h in range(10000) if not 1 <= h <= 501])
    row = coverage.completeness(below).first()
    assert (row.completeness_pct, row.below_threshold) == (94.99, True)
    row = coverage.completeness(series(spark, [None])).first()
    assert (row.completeness_pct, row.below_threshold) == (None, True)
    assert coverage.completeness(exactly, threshold=96).first().below_threshold


RULES = (
    "projeto string, nom_usina string, din_instante timestamp_ntz, val_geracao double, val_geracaoestimada double, "
    "val_geracaoverificada double, val_ventoverificado double, val_geracaoreferencia double, val_disponibilidade double, year int, month int"
)


def test_business_rules(spark):
    h = [START + timedelta(hours=i) for i in range(9)]
    rows = [
        ("P", "U", h[0], -1.0, -1.0, -1.0, -1.0, 5.0, -1.0),
        ("P", "U", h[1], 6.0, 0.0, 0.0, 0.0, 5.0, 0.0),
        ("P", "U", h[2], 6.0, None, None, 40.0, None, None),
        ("P", "U", h[3], None, 1.0, 1.0, 41.0, 5.0, 1.0),
        ("P", "U", h[4], 5.0, 1.0, 1.0, None, 5.0, 1.0),
        (None, "U", h[5], 1.0, 1.0, 1.0, 1.0, 5.0, 1.0),
        (None, "U", h[5], 1.0, 1.0, 1.0, 1.0, 5.0, 1.0),
        (None, "U", None, 1.0, 1.0, 1.0, 1.0, 5.0, 1.0),
        (None, "U", None, 1.0, 1.0, 1.0, 1.0, 5.0, 1.0),
        (None, "U", None, 1.0, 1.0, 1.0, 1.0, 5.0, 1.0),
    ]
    df = spark.createDataFrame([(*r, 2026, 1) for r in rows], RULES)
    assert [tuple(r) for r in validate.business_rules(df).collect()] == [
        ("negative_generation", 1),
        ("invalid_estimated_generation", 1),
        ("invalid_verified_generation", 1),
        ("invalid_wind_speed", 3),
        ("generation_reference_invalid", 1),
        ("invalid_availability", 1),
        ("duplicate_timestamps", 3),
        ("null_projects", 5),
    ]
    assert {r.violations for r in validate.business_rules(df.limit(0)).collect()} == {0}


def test_freshness(spark):
    df = spark.createDataFrame([(2025, 12), (2026, 2), (None, 7)], "year int, month int")
    assert tuple(validate.freshness(df).first()) == (2026, 2, True)
    assert tuple(validate.freshness(df, expected_month=202602).first()) == (2026, 2, True)
    assert tuple(validate.freshness(df, expected_month=202603).first()) == (2026, 2, False)
    assert tuple(validate.freshness(df.limit(0), expected_month=202603).first()) == (None, None, False)


EXPECTED = T.StructType(
    [T.StructField("a", T.StringType()), T.StructField("b", T.DoubleType()), T.StructField("c", T.DoubleType())]
)


def test_schema_check(spark):
    df = spark.createDataFrame([("x", 1, 2.0), (None, 1, 2.0)], "a string, b int, extra double")
    assert [tuple(r) for r in validate.check_schema(df, EXPECTED, with_counts=True).collect()] == [
        ("a", "string", "string", "ok", 1),
        ("b", "double", "int", "invalid_type", 2),
        ("c", "double", "", "missing", 0),
    ]
    assert "non_null_rows" not in validate.check_schema(df, EXPECTED).columns
    assert not validate.schema_valid(df, EXPECTED)
    assert validate.schema_valid(df, T.StructType([EXPECTED["a"]]))


def test_validation_report(spark):
    h = [START, START + timedelta(hours=1), START + timedelta(hours=3)]
    rows = [("P", "U", t, 1.0, 1.0, 1.0, 50.0, 5.0, 1.0, 2026, 1) for t in h]
    df = spark.createDataFrame(rows, RULES)
    expected = T.StructType([*df.schema.fields[:2], T.StructField("x", T.StringType()), T.StructField("month", T.StringType())])
    report = {(r.section, r.metric, r.key): (r.value, r.detail) for r in validate.validation_report(df, expected).collect()}
    assert report[("schema_validation", "schema_valid", "")] == (0.0, "")
    assert report[("schema_validation", "missing_columns", "x")] == (1.0, "expected string")
    assert report[("schema_validation", "invalid_types", "month")] == (1.0, "expected string; found int")
    assert report[("freshness_validation", "latest_month", "")] == (1.0, "")
    assert report[("business_rules", "invalid_wind_speed", "")] == (3.0, "")
    assert report[("timestamp_continuity", "gap_count", "P | U")] == (1.0, "")
    assert report[("completeness_validation", "completeness_percentage", "P | U")] == (75.0, "below threshold")
    assert report[("completeness_validation", "threshold", "")] == (95.0, "")
    assert len(report) == 3 + 3 + 8 + 3


@pytest.mark.parametrize("name", ["year", "month"])
def test_joined_contract_has_integer_partitions(name):
    from windgrid.schemas import JOINED_SCHEMA

    assert JOINED_SCHEMA[name].dataType == T.IntegerType() and len(JOINED_SCHEMA) == 22
