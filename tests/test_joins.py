from __future__ import annotations

from datetime import datetime

import pytest

from windgrid.operators.assets import attach_project, distinct_names, filter_assets, restrict_to_names
from windgrid.operators.levels import dedupe_then_join, first_per_name, join_levels, join_metrics

T0, T1 = datetime(2026, 1, 1, 0), datetime(2026, 1, 1, 1)
SPE = "id int, nom_conjuntousina string, ceg string, din_instante timestamp_ntz"
WIND = "nom_usina string, din_instante timestamp_ntz, nom_estado string, val_geracao double"
PAYLOAD = ["nom_estado", "val_geracao"]
MAPPING = "projeto string, spe string, ceg string"


def spe_rows(spark):
    return spark.createDataFrame(
        [
            (1, "Conj. A", "EOL.CV.037102-5.1", T0),
            (2, " conj.  a ", "EOL.CV.037102-5.1", T0),
            (3, "Conj. A\t", "EOL.CV.037103-3.1", T1),
            (4, None, "EOL.CV.037103-3.1", T0),
            (5, "Conj. A", "none", None),
            (6, "Conj. B", None, T0),
        ],
        SPE,
    )


def wind_rows(spark):
    return spark.createDataFrame(
        [
            ("CONJ. A", T1, "RN", 3.0),
            ("CONJ. A", T0, "RN", 1.0),
            ("CONJ. A ", T0, "RN", 2.0),
            (None, T0, "XX", 9.0),
            ("CONJ. A", None, "RN", 8.0),
            ("CONJ. C", T0, "CE", 7.0),
        ],
        WIND,
    )


def pairs(df):
    return sorted((r.id, r.val_geracao) for r in df.select("id", "val_geracao").collect() if r.val_geracao is not None)


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize("salt", [1, 5])
def test_join_levels_default(spark, salt):
    out = join_levels(spe_rows(spark), wind_rows(spark), payload=PAYLOAD, salt=salt)
    assert ids(out) == [1, 1, 2, 3, 4, 5, 6]  # two complex rows multiply plant row 1, no row is lost
    assert pairs(out) == [(1, 1.0), (1, 2.0)]
    assert out.columns == [*spe_rows(spark).columns, *PAYLOAD]


@pytest.mark.parametrize("salt", [1, 5])
def test_join_levels_collapsed(spark, salt):
    out = join_levels(spe_rows(spark), wind_rows(spark), payload=PAYLOAD, collapse_ws=True, salt=salt)
    assert ids(out) == [1, 1, 2, 2, 3, 4, 5, 6]
    assert pairs(out) == [(1, 1.0), (1, 2.0), (2, 1.0), (2, 2.0), (3, 3.0)]


def test_first_per_name_is_the_earliest_with_null_last(spark):
    firsts = {r._right_name: r.val_geracao for r in first_per_name(wind_rows(spark), payload=PAYLOAD).collect()}
    assert firsts == {"CONJ. A": 1.0, "CONJ. C": 7.0, None: 9.0}


def test_dedupe_then_join_matches_null_and_keeps_row_count(spark):
    out = dedupe_then_join(spe_rows(spark), wind_rows(spark), payload=PAYLOAD)
    assert pairs(out) == [(1, 1.0), (2, 1.0), (3, 1.0), (4, 9.0), (5, 1.0)]
    assert ids(out) == [1, 2, 3, 4, 5, 6]


def test_join_metrics(spark):
    out = join_levels(spe_rows(spark), wind_rows(spark), payload=PAYLOAD)
    assert tuple(join_metrics(out).first()) == (7, 2, 28.57)
    assert tuple(join_metrics(out.limit(0)).first()) == (0, 0, None)


def test_hot_names_and_null_names_lose_nothing(spark):
    """A third of the rows in one (name, timestamp), a third without a name."""
    rows = [(i, "Hot" if i % 3 == 0 else None if i % 3 == 1 else f"N{i}", "x", T0) for i in range(3000)]
    wind = [("HOT", T0, "RN", 1.0), ("HOT", T0, "RN", 2.0)] + [(f"n{i}", T0, "CE", 0.0) for i in range(3000)]
    left, right = spark.createDataFrame(rows, SPE), spark.createDataFrame(wind, WIND)
    for salt in (1, 16):
        out = join_levels(left, right, payload=PAYLOAD, salt=salt)
        assert out.count() == 4000
        assert join_metrics(out).first().matched_records == 3000


def mapping_rows(spark):
    return spark.createDataFrame([("P1", "S1", "037102-5"), ("P2", "S2", "037103-3"), ("P3", "S3", None), ("P4", "S4", "")], MAPPING)


@pytest.mark.parametrize("method", ["inner", "member"])
def test_attach_project(spark, method):
    out = attach_project(spe_rows(spark), mapping_rows(spark), method=method)
    assert sorted((r.id, r.projeto) for r in out.collect()) == [(1, "P1"), (2, "P1"), (3, "P2"), (4, "P2")]
    assert out.columns == [*spe_rows(spark).columns, "projeto"]


def test_attach_project_unknown_method(spark):
    with pytest.raises(ValueError):
        attach_project(spe_rows(spark), mapping_rows(spark), method="other")


def test_restrict_to_names(spark):
    wind, spe = wind_rows(spark), spe_rows(spark)
    narrow = spe.filter("id = 2")
    assert restrict_to_names(wind, distinct_names(narrow)).count() == 0
    kept = restrict_to_names(wind, distinct_names(narrow, collapse_ws=True), collapse_ws=True)
    assert sorted(r.val_geracao for r in kept.collect()) == [1.0, 2.0, 3.0, 8.0]
    assert kept.columns == wind.columns
    assert [r._name for r in distinct_names(spe.filter("id = 4")).collect()] == []


def test_filter_assets(spark):
    owned, complexes = filter_assets(spe_rows(spark), wind_rows(spark), mapping_rows(spark))
    assert ids(owned) == [1, 2, 3, 4]
    assert {r.nom_usina.strip() for r in complexes.collect()} == {"CONJ. A"}
