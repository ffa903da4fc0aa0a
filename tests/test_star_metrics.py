from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from windgrid.operators import metrics, star
from windgrid.operators.keys import add_surrogate_key
from windgrid.plans import build_star
from windgrid.schemas import GENERATION_SCHEMA, JOINED_SCHEMA, PROJECTS_SCHEMA, RESTRICTIONS_SCHEMA
from windgrid.sinks import write_partitioned
from windgrid.sources.files import read_partitioned

T0 = datetime(2026, 1, 31)


def joined(spark, rows):
    """Rows given as dicts over the joined contract; columns not given are null."""
    schema = JOINED_SCHEMA.__class__([f for f in JOINED_SCHEMA.fields if f.name not in ("year", "month")])
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)


def row(ts, project="P", gen=1.0, ref=2.0, reason=None, **more):
    base = {"projeto": project, "nom_usina": "U", "nom_conjuntousina": "C", "din_instante": ts}
    return {**base, "val_geracao": gen, "val_geracaoreferencia": ref, "cod_razaorestricao": reason, **more}


def types(schema):
    return [(f.name, f.dataType) for f in schema.fields]


def test_projects(spark):
    df = joined(spark, [row(T0, "Z"), row(T0, "A", nom_estado="RN"), row(T0, "A"), row(T0, "A"), row(T0, None)])
    out = metrics.projects(df)
    assert [r.projeto for r in out.collect()] == ["A", "A", "Z", None]
    assert types(out.schema) == types(PROJECTS_SCHEMA)


def test_generation(spark):
    half = T0 + timedelta(minutes=30)
    rows = [row(T0, gen=1.0), row(half, gen=2.0), row(T0 - timedelta(days=1), gen=None), row(None, gen=5.0), row(T0, "Q", gen=9.0)]
    df = joined(spark, rows)
    daily = metrics.generation(df, "P")
    assert [tuple(r) for r in daily.collect()] == [("2026-01-30", 0.0, "P"), ("2026-01-31", 3.0, "P")]
    assert types(daily.schema) == types(GENERATION_SCHEMA)
    assert [tuple(r) for r in metrics.generation(df, "P", frequency="monthly", sum_scale=6).collect()] == [("2026-01", 3.0, "P")]
    # A date alone is its midnight: the 00:30 row of the last day is out, the 00:00 row is in.
    assert [r.total_generation for r in metrics.generation(df, "P", "2026-01-31", "2026-01-31").collect()] == [1.0]
    assert metrics.generation(df, "P", "2030-01-01").collect() == []
    assert metrics.generation(df, "P", "", "").count() == 2
    assert metrics.generation(df, "none").collect() == []
    assert metrics.is_known_project(df, "P") and not metrics.is_known_project(df, "none")
    with pytest.raises(ValueError):
        metrics.generation(df, "P", frequency="weekly")


def test_restrictions_summary(spark):
    rows = [
        row(T0, gen=1.0, ref=3.0, reason="REL"),
        row(None, gen=1.0, ref=2.5, reason="REL"),
        row(T0, gen=2.0, ref=3.0),
        row(T0, gen=3.0, ref=3.0, reason="CNF"),
        row(T0, gen=None, ref=3.0, reason="CNF"),
        row(T0, gen=1.0, ref=None, reason="CNF"),
        row(T0, "Q", gen=1.0, ref=2.0, reason="ENE"),
    ]
    df = joined(spark, rows)
    out = metrics.restrictions_summary(df)
    assert [tuple(r) for r in out.collect()] == [("ENE", 1, 1.0), ("REL", 1, 3.5), ("WITHOUT_RESTRICTION", 1, 1.0)]
    assert types(out.schema) == types(RESTRICTIONS_SCHEMA)
    assert [r.cod_razaorestricao for r in metrics.restrictions_summary(df, "P", default_label="NONE", sum_scale=3).collect()] == ["NONE", "REL"]
    assert metrics.restrictions_summary(df, "").count() == 3
    assert metrics.restrictions_summary(df, "P", "2026-02-01").count() == 0


def test_stored_months_are_pruned(spark, tmp_path):
    stamps = [datetime(2025, 11, 30, 23), datetime(2025, 12, 1), datetime(2026, 1, 31), datetime(2026, 2, 1)]
    write_partitioned(joined(spark, [row(t) for t in stamps]), str(tmp_path / "j"), "din_instante")
    stored = read_partitioned(spark, str(tmp_path / "j"))
    for start, end, want in (("2025-12-01", "2026-01-31", 2), ("2025-12-02", None, 2), (None, "2025-11-30 22:00:00", 0)):
        for out in (metrics.generation(stored, "P", start, end), metrics.restrictions_summary(stored, "P", start, end)):
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "PartitionFilters: [isnotnull(year" in plan
            assert "PushedFilters: []" not in plan
        assert sum(r.total_hours for r in metrics.restrictions_summary(stored, "P", start, end).collect()) == want


def star_rows():
    out = []
    for i in range(40):
        out.append(
            row(
                T0 + timedelta(hours=i % 7),
                f"P{i % 2}",
                reason=None if i % 4 else "REL",
                nom_usina=f"U{i % 3}",
                id_ons=None if i % 3 == 0 else f"O{i % 3}",
                ceg=f"G{i % 3}",
                nom_conjuntousina=None if i % 5 == 0 else f"C{i % 5}",
                nom_estado="RN" if i % 5 == 1 and i < 20 else None,
            )
        )
    out.append(row(None))
    return out


def test_dimensions_are_dense_and_distinct(spark):
    df = joined(spark, star_rows())
    for dim, key in ((star.dim_spe(df), "spe_key"), (star.dim_conjunto(df), "conjunto_key"), (star.dim_tempo(df), "tempo_key")):
        rows = dim.collect()
        assert sorted(r[key] for r in rows) == list(range(1, len(rows) + 1))
        natural = [c for c in dim.columns if c != key]
        assert dim.select(natural).distinct().count() == len(rows)
        assert sorted(map(str, rows)) == sorted(map(str, dim.repartition(3).collect()))


def test_dim_tempo_is_in_time_order_with_null_last(spark):
    rows = star.dim_tempo(joined(spark, star_rows())).orderBy("tempo_key").collect()
    assert [r.din_instante for r in rows] == [T0 + timedelta(hours=i) for i in range(7)] + [None]
    assert (rows[1].ano, rows[1].mes, rows[1].dia, rows[1].hora) == (2026, 1, 31, 1)
    assert rows[-1].ano is None


def test_full_lookup_keeps_the_row_count_and_short_lookup_fans_out(spark, tmp_path):
    df = joined(spark, star_rows())
    full = build_star(df, str(tmp_path / "full"))
    fact = full["fact_generation"]
    assert fact.count() == 41
    assert fact.filter("spe_key IS NULL OR conjunto_key IS NULL OR tempo_key IS NULL").count() == 0
    assert fact.groupBy("cod_razaorestricao").count().orderBy("count").collect()[0].cod_razaorestricao == "REL"
    assert {r[0] for r in fact.select("cod_razaorestricao").distinct().collect()} == {"REL", "SEM_RESTRICAO"}
    # Each plant occurs in two projects (rows double); complex C1 occurs with and without a state.
    short = star.fact_generation(df, full["dim_spe"], full["dim_conjunto"], full["dim_tempo"], lookup="short", default_label="none")
    counts = {}
    for r in df.select("nom_usina", "id_ons", "ceg", "nom_conjuntousina").collect():
        counts[tuple(r)] = counts.get(tuple(r), 0) + 1
    spe_hits = {}
    for r in full["dim_spe"].collect():
        spe_hits[(r.nom_usina, r.id_ons, r.ceg)] = spe_hits.get((r.nom_usina, r.id_ons, r.ceg), 0) + 1
    conj_hits = {}
    for r in full["dim_conjunto"].collect():
        conj_hits[r.nom_conjuntousina] = conj_hits.get(r.nom_conjuntousina, 0) + 1
    want = sum(n * spe_hits[k[:3]] * conj_hits[k[3]] for k, n in counts.items())
    assert want > 82 and short.count() == want
    with pytest.raises(ValueError):
        star.fact_generation(df, full["dim_spe"], full["dim_conjunto"], full["dim_tempo"], lookup="other")


def test_surrogate_keys_need_no_single_task_over_the_rows(spark):
    df = spark.range(5000).select(F.concat(F.lit("n"), "id").alias("name"))
    keyed = add_surrogate_key(df, ["name"], "k")
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1  # the bucket sizes, at most 4096 rows
    assert sorted(r.k for r in keyed.collect()) == list(range(1, 5001))
