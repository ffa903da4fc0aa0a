from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.errors import PySparkException

from windgrid.operators.clean import clean_spe, clean_wind, count_copies
from windgrid.operators.quality import level_quality, null_percentages, quality_report
from windgrid.schemas import COMPLEX_NUMERIC, PLANT_NUMERIC

SPE = "nom_usina string, din_instante string, flg_dadoventoinvalido string, val_ventoverificado string, val_geracaoestimada string, val_geracaoverificada string"
WIND = "nom_usina string, din_instante string, val_geracao string, val_geracaolimitada string"

SPE_ROWS = [
    ("A", "2026-01-01 00:00:00", "0", "5", None, "1"),
    ("A", "2026-01-01 00:00:00", "0", "5", None, "1"),
    ("A", "2026-01-01 01:00:00", "1", "5", "2", "1"),
    ("A", "2026-01-01 01:00:00", "1", "5", "2", "1"),
    ("A", "2026-01-01 02:00:00", None, "5", "2", "1"),
    ("B", "bad", "0.0", "12,5", "2", "NaN"),
    ("B", "bad", "1", "12,5", "2", "1"),
    ("B", None, "0", None, "2", "1"),
]
WIND_ROWS = [
    ("C", "2026-01-01 00:00:00", "1", None),
    ("C", "2026-01-01 00:00:00", "1", None),
    ("C", "bad", "x", "2"),
    ("C", None, None, "2"),
]


@pytest.fixture(scope="module")
def spe(spark):
    return spark.createDataFrame(SPE_ROWS, SPE)


@pytest.fixture(scope="module")
def wind(spark):
    return spark.createDataFrame(WIND_ROWS, WIND)


def report(df):
    return {(r.section, r.metric, r.key): r.value for r in df.collect()}


def test_clean_spe_keeps_flag_zero_once(spe):
    rows = sorted(map(tuple, clean_spe(spe).collect()), key=str)
    start = datetime(2026, 1, 1)
    assert rows == [
        ("A", start, 0.0, 5.0, None, 1.0, start),
        ("B", None, 0.0, None, 2.0, 1.0, None),
        ("B", None, 0.0, None, 2.0, None, None),
    ]
    assert dict(clean_spe(spe).dtypes)["din_instante"] == "timestamp_ntz"


def test_clean_from_copy_counts_equals_clean_from_raw(spe, wind):
    for clean, raw in ((clean_spe, spe), (clean_wind, wind)):
        assert sorted(map(str, clean(count_copies(raw)).collect())) == sorted(map(str, clean(raw).collect()))
        assert clean(count_copies(raw)).columns == clean(raw).columns


def test_copy_counts(spe):
    counted = {(r.nom_usina, r.din_instante, r.flg_dadoventoinvalido): r["_copies"] for r in count_copies(spe).collect()}
    assert counted[("A", "2026-01-01 00:00:00", "0")] == 2
    assert sum(counted.values()) == len(SPE_ROWS) and len(counted) == 6


def test_strict_mode_fails_on_bad_text_but_keeps_null(spark, spe, wind):
    with pytest.raises(PySparkException):
        clean_spe(spe, mode="strict").collect()
    with pytest.raises(PySparkException):
        clean_wind(wind, mode="strict").collect()
    fine = spark.createDataFrame([("A", None, "0", "1", "1", "1")], SPE)
    assert clean_spe(fine, mode="strict").first().data_hora is None


def test_clean_wind_has_no_flag_filter(wind):
    rows = sorted(map(tuple, clean_wind(wind).collect()), key=str)
    start = datetime(2026, 1, 1)
    assert rows == [("C", None, None, 2.0, None), ("C", None, None, 2.0, None), ("C", start, 1.0, None, start)]


def test_quality_on_raw_rows(spe, wind):
    found = report(quality_report(spe, wind))
    assert found[("spe_stats", "initial_rows", "")] == 8
    assert found[("spe_stats", "duplicates_removed", "")] == 2
    assert found[("spe_stats", "invalid_wind_filtered", "")] == 3
    assert found[("spe_stats", "invalid_dates", "")] == 3
    assert found[("spe_stats", "invalid_numeric_values", "val_ventoverificado")] == 2
    assert found[("spe_stats", "invalid_numeric_values", "val_geracaoestimada")] == 0
    assert found[("spe_stats", "final_rows", "")] == 3
    assert found[("spe_nulls", "null_pct", "din_instante")] == 66.67
    assert found[("spe_nulls", "null_pct", "data_hora")] == 66.67
    assert found[("spe_nulls", "null_pct", "nom_usina")] == 0
    assert found[("wind_stats", "invalid_dates", "")] == 2
    assert found[("wind_stats", "invalid_numeric_values", "val_geracao")] == 1
    assert ("wind_stats", "invalid_wind_filtered", "") not in found
    assert ("wind_stats", "invalid_numeric_values", "val_disponibilidade") not in found


def test_quality_on_cleaned_rows(spe, wind):
    found = report(quality_report(spe, wind, rules="cleaned"))
    assert found[("spe_stats", "invalid_wind_filtered", "")] == 3  # flags 1, 1 and null after duplicate removal
    assert found[("spe_stats", "invalid_dates", "")] == 2
    assert found[("spe_stats", "invalid_numeric_values", "val_ventoverificado")] == 2  # bad text and null
    assert found[("spe_stats", "invalid_numeric_values", "val_geracaoverificada")] == 1  # NaN
    assert found[("spe_stats", "invalid_numeric_values", "val_geracaoestimada")] == 1
    assert found[("wind_stats", "invalid_dates", "")] == 2
    assert found[("wind_stats", "invalid_numeric_values", "val_geracao")] == 2
    assert found[("wind_stats", "final_rows", "")] == 3


def test_quality_options(spe, wind):
    found = report(quality_report(spe, wind, zero_wind_dates=True))
    assert found[("wind_stats", "invalid_dates", "")] == 0
    counted = report(level_quality(wind, "wind", COMPLEX_NUMERIC, count_nulls=True))
    assert counted[("wind_stats", "invalid_numeric_values", "val_geracao")] == 2
    assert counted[("wind_stats", "invalid_numeric_values", "val_geracaolimitada")] == 2
    only_bad = report(level_quality(spe, "spe", PLANT_NUMERIC, flag="flg_dadoventoinvalido", rules="cleaned", count_nulls=False))
    assert only_bad[("spe_stats", "invalid_numeric_values", "val_ventoverificado")] == 1
    with pytest.raises(ValueError):
        level_quality(wind, "wind", COMPLEX_NUMERIC, rules="other")


def test_quality_of_empty_tables(spark):
    found = report(quality_report(spark.createDataFrame([], SPE), spark.createDataFrame([], WIND)))
    assert set(found.values()) == {0.0}
    assert {r.null_pct for r in null_percentages(spark.createDataFrame([], SPE)).collect()} == {0.0}


def test_null_percentages(spe):
    shares = {r.column_name: r.null_pct for r in null_percentages(spe).collect()}
    assert shares["din_instante"] == 12.5 and shares["val_geracaoestimada"] == 25.0 and shares["nom_usina"] == 0.0
    assert [r.column_name for r in null_percentages(spe, ["nom_usina"]).collect()] == ["nom_usina"]


def test_null_percentages_of_odd_column_names(spark):
    df = spark.createDataFrame([(None, "x")], "`it's` string, `a\\b` string")
    assert [tuple(r) for r in null_percentages(df).collect()] == [("it's", 100.0), ("a\\b", 0.0)]
