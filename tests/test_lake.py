"""A lake kept by deliveries: equal to a whole run, other months left alone, all tables changing at one moment."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from driver_queries import adapter
from windgrid.operators import coverage, metrics, quality, rollup
from windgrid.plans import lake, read_lake, run_delivery, run_pipeline
from windgrid.sinks import versions, write_csv
from windgrid.streaming import read_bronze

SF = "/root/testdata/sf0.001"


def later(df):
    """Rows of January as rows of March, of which the last day's midnight is the first of April."""
    return df.withColumn("din_instante", F.regexp_replace("din_instante", "^2024-01", "2024-03"))


def data_files(root, table):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{root}/out/{table}") for f in names if f.startswith("part-")}


def valid_files(spark, root, table):
    return set(read_lake(spark, f"{root}/out")[table].inputFiles())


@pytest.fixture(scope="module")
def delivered(spark, tmp_path_factory):
    """A lake after a delivery for two months and a later one for the second of them, with what was valid in between."""
    root = str(tmp_path_factory.mktemp("lake"))
    spe, wind = adapter.raw_spe(spark, SF), adapter.raw_wind(spark, SF)
    first, second = F.col("din_instante").rlike("^2024-01-0[1-9] .*:"), F.col("din_instante").rlike("^2024-01-1.* .*:")
    write_csv(adapter.mapping(spark, SF), f"{root}/in/mapping")
    args = [spark, f"{root}/in/spe/*", f"{root}/in/wind/*", f"{root}/in/mapping", f"{root}/out", adapter.RAW_SPE_COLUMNS, adapter.RAW_WIND_COLUMNS]
    parts = [[rows.filter(first), later(rows.filter(first)), later(rows.filter(second))] for rows in (spe, wind)]
    for name, (a, b, _) in zip(("spe", "wind"), parts):
        write_csv(a.unionByName(b), f"{root}/in/{name}/a", sep=";")
    run_delivery(*args)
    before = {t: (valid_files(spark, root, t), read_lake(spark, f"{root}/out")[t].collect()) for t in ("joined", "fact_generation", "dim_spe", "dim_tempo")}
    for name, (_, _, c) in zip(("spe", "wind"), parts):
        write_csv(c, f"{root}/in/{name}/b", sep=";")
    tables = run_delivery(*args)
    raw = [a.unionByName(b).unionByName(c) for a, b, c in parts]
    whole = run_pipeline(*raw, adapter.mapping(spark, SF), f"{root}/whole")
    return root, args, before, tables, raw, whole


def same(left, right) -> bool:
    right = right.select(*left.columns)
    return left.count() == right.count() and left.exceptAll(right).isEmpty()


def test_lake_equals_a_whole_run(spark, delivered):
    root, _, _, tables, raw, whole = delivered
    assert tables["joined"].count() > 0 and same(tables["joined"], whole["joined"])
    assert same(tables["quality"].drop("detail"), quality.quality_report(*raw))
    assert same(coverage.coverage_of_sets(tables["hours"]), coverage.hour_coverage(whole["joined"]))
    project = whole["joined"].first()["projeto"]
    for start, end in ((None, None), ("2024-01-03", "2024-03-05"), ("2024-03-12", None), (None, "2024-01-07")):
        for frequency in ("daily", "monthly"):
            assert same(rollup.generation(tables["rollup"], project, start, end, frequency), metrics.generation(whole["joined"], project, start, end, frequency, sum_scale=6))
        assert same(rollup.restrictions_summary(tables["rollup"], None, start, end), metrics.restrictions_summary(whole["joined"], None, start, end, sum_scale=6))
    assert same(tables["places"].select("projeto", "nom_estado", "nom_subsistema").distinct(), metrics.projects(whole["joined"]))
    run = {(r.section, r.metric, r.key): r.value for r in tables["run"].collect()}
    assert run["join", "total_records", ""] == whole["joined"].count() and run["spe", "missing_month", "2024-02"] == 1.0


def test_other_months_keep_their_files_and_keys(spark, delivered):
    root, _, before, tables, *_ = delivered
    for table in ("joined", "fact_generation"):
        now = valid_files(spark, root, table)
        january = {f for f in before[table][0] if "/year=2024/month=1/" in f}
        assert january and january <= now and not {f for f in before[table][0] - january} & now
    for table, key in (("dim_spe", "spe_key"), ("dim_tempo", "tempo_key")):
        old, new = before[table][1], {r[key]: r for r in tables[table].collect()}
        assert len(new) > len(old) or table == "dim_spe"
        assert all(new[r[key]] == r for r in old)
        assert sorted(new) == list(range(1, len(new) + 1))
    facts, joined = tables["fact_generation"], tables["joined"]
    assert facts.count() == joined.count() and facts.filter("spe_key IS NULL OR conjunto_key IS NULL OR tempo_key IS NULL").isEmpty()


def test_a_delivery_reads_its_months_only(spark, delivered):
    root, *_ = delivered
    rows = read_bronze(spark, f"{root}/out/bronze/spe", "", adapter.RAW_SPE_COLUMNS, months=["2024-03"])
    opened = {r.p for r in rows.select(F.input_file_name().alias("p")).distinct().collect()}
    assert opened and all("bronze_month=2024-03" in p for p in opened)
    assert "2024-03" in rows._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_nothing_new_changes_nothing(spark, delivered):
    root, args, *_ = delivered
    files = {t: data_files(root, t) for t in ("joined", "rollup", "manifest")}
    run_delivery(*args)
    assert files == {t: data_files(root, t) for t in files}


def test_a_failed_run_leaves_the_former_state(spark, delivered, monkeypatch):
    root, args, *_ = delivered
    before = {t: sorted(map(repr, df.collect())) for t, df in read_lake(spark, f"{root}/out").items()}
    write_csv(later(adapter.raw_spe(spark, SF).filter(F.col("din_instante").rlike("^2024-01-2.* .*:"))), f"{root}/in/spe/c", sep=";")
    with monkeypatch.context() as patched:
        def fail(*_, **__):
            raise RuntimeError("lost")

        patched.setattr(lake, "fact_generation", fail)
        with pytest.raises(RuntimeError, match="lost"):
            run_delivery(*args)
    assert before == {t: sorted(map(repr, df.collect())) for t, df in read_lake(spark, f"{root}/out").items()}
    done = run_delivery(*args)
    assert done["joined"].count() > len(before["joined"]) and done["fact_generation"].count() == done["joined"].count()


def test_published_months_replace_and_empty(spark, tmp_path):
    root = str(tmp_path)
    frame = lambda *rows: spark.createDataFrame(list(rows), "v int, year int, month int")
    versions.publish(spark, root, 0, {"t": versions.stage(frame((1, 2024, 1), (2, 2024, 2), (3, None, None)), root, "t", 0)}, ["2024-01", "2024-02", "none"], {"n": 7})
    staged = versions.stage(frame((9, 2024, 2)), root, "t", 1)
    read = lambda: sorted(r.v for r in versions.current(spark, root, "t", staged.schema).collect())
    assert read() == [1, 2, 3]
    versions.publish(spark, root, 1, {"t": staged}, ["2024-02", "none"], {})
    assert read() == [1, 9] and versions.manifest(spark, root)[1]["", "n"] == 7
    assert versions.current(spark, root, "absent", staged.schema).collect() == []


def test_rollup_of_nulls(spark):
    rows = spark.sql("""SELECT * FROM VALUES ('P', 'R', TIMESTAMP_NTZ'2024-01-01 00:00:00', CAST(NULL AS DOUBLE), 2D, 2024, 1),
        ('P', NULL, CAST(NULL AS TIMESTAMP_NTZ), 1D, 3D, CAST(NULL AS INT), CAST(NULL AS INT)), (NULL, 'R', TIMESTAMP_NTZ'2024-01-02 10:00:00', 1D, double('NaN'), 2024, 1),
        ('P', NULL, TIMESTAMP_NTZ'2024-01-02 10:00:00', 0.1D, 0.3D, 2024, 1) AS v(projeto, cod_razaorestricao, din_instante, val_geracao, val_geracaoreferencia, year, month)""")
    made = rollup.daily_rollup(rows)
    assert same(rollup.restrictions_summary(made), metrics.restrictions_summary(rows, sum_scale=6))
    assert same(rollup.generation(made, "P"), metrics.generation(rows, "P", sum_scale=6))
    with pytest.raises(ValueError):
        rollup.generation(made, "P", frequency="weekly")
