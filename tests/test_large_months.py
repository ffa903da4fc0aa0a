"""A large month is written by several tasks, a small one by one; steps side by side; lines without quotes."""

from __future__ import annotations

import os
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from driver_queries import catalog
from driver_queries.adapter import RAW_SPE_COLUMNS, RAW_WIND_COLUMNS
from windgrid.operators import star
from windgrid.operators.coverage import hour_sets
from windgrid.plans import lake, pipeline
from windgrid.session import at_once
from windgrid.sinks import files, versions, write_partitioned
from windgrid.sources.files import headers_of, union_by_name


def month_files(root):
    found = {}
    for folder, _, names in os.walk(root):
        parts = [n for n in names if n.startswith("part-") and n.endswith(".parquet")]
        if parts:
            found[os.path.relpath(folder, root)] = len(parts)
    return found


def test_a_large_month_is_cut_and_a_small_one_is_not(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "ROWS_A_PIECE", 10)
    rows = spark.range(300).select(
        F.concat(F.lit("P"), (F.col("id") % 50).cast("string")).alias("projeto"),
        F.when(F.col("id") < 200, F.expr("TIMESTAMP_NTZ'2024-01-05 00:00:00'")).when(F.col("id") < 260, F.expr("TIMESTAMP_NTZ'2024-02-05 00:00:00'")).alias("din_instante"),
        F.rand(1).alias("v"),
    )
    rows = rows.localCheckpoint()
    sizes = {"2024-01": 200, "2024-02": 10, "none": 40}
    # The rows are far too few for adaptive execution to leave pieces apart.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_partitioned(rows, f"{tmp_path}/joined", "din_instante", rows=sizes)
        staged = versions.stage(spark.read.parquet(f"{tmp_path}/joined"), str(tmp_path), "t", 0, ("projeto",), sizes)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for root in (f"{tmp_path}/joined", f"{tmp_path}/t/run=0"):
        made = month_files(root)
        assert made["year=2024/month=1"] > 1 and made["year=2024/month=2"] == 1
        assert sorted(made) == ["year=2024/month=1", "year=2024/month=2", "year=__HIVE_DEFAULT_PARTITION__/month=__HIVE_DEFAULT_PARTITION__"]
    assert staged.count() == 300 and staged.select(*rows.columns).exceptAll(rows).isEmpty()


def test_all_steps_end_before_an_error_is_raised(spark):
    ended = []

    def fail():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        at_once(spark, fail, lambda: ended.append(spark.range(10).count()))
    assert ended == [10]
    assert at_once(spark, lambda: 1, lambda: 2) == [1, 2]


def test_lines_without_quotes(spark, tmp_path):
    lines = {"1;2;3": None, ";;": None, "1;2": "too few fields", "1;2;3;4": "too many fields", "1;2;3;4;5": "too many fields", '1;"2;3": ': "broken quotes", '1;"2;x";3': None}
    (tmp_path / "a.csv").write_text("a;b;c\n" + "\n".join(lines) + "\n")
    rows = union_by_name(spark, headers_of(spark, [f"{tmp_path}/a.csv"]), checked=True).collect()
    assert sorted(str(r["_reason"]) for r in rows) == sorted(str(v) for v in lines.values())
    assert {r["_line"] for r in rows if r["_reason"]} == {k for k, v in lines.items() if v}


def test_the_level_join_reads_typed_rows(spark, tmp_path, monkeypatch):
    """Both sides of the join are stored; parsing them in the join's own generated method passes the size that the JVM compiles."""
    plans = []
    join_levels = pipeline.join_levels

    def seen(left, right, **options):
        plans.extend(side._jdf.queryExecution().executedPlan().toString() for side in (left, right))
        return join_levels(left, right, **options)

    monkeypatch.setattr(pipeline, "join_levels", seen)
    monkeypatch.setattr(lake, "join_levels", seen)
    spe = [("SS0", "E0", "Tipo", " conj 1 ", "U1", "ID1", "EOL.CV.0000001-1.01", "2024-01-05 01:00:00", "1.5", "0", "2", "3")]
    wind = [("CONJ 1", "2024-01-05 01:00:00", "SUB", "EST", "CJ1", "5", "6", "7", "8", "9", "REL"), ("CONJ 2", "2024-01-05 01:00:00", "SUB", "EST", "CJ2", "5", "6", "7", "8", "9", "REL")]
    mapping = spark.createDataFrame([("P1", "A", "0000001-1")], "projeto string, spe string, ceg string")
    raw = {"spe": spark.createDataFrame(spe, RAW_SPE_COLUMNS), "wind": spark.createDataFrame(wind, RAW_WIND_COLUMNS)}
    for rules in ("raw", None):
        layers = pipeline.run_pipeline(raw["spe"], raw["wind"], mapping, f"{tmp_path}/{rules}", report_rules=rules)
        assert [(r["projeto"], r["val_geracao"]) for r in layers["joined"].collect()] == [("P1", 5.0)]
        assert layers["wind_owned"].count() == 1
    made = lake._tables(spark, f"{tmp_path}/lake", 0, raw, mapping, False, "coerce", "din_instante")
    assert [(r["projeto"], r["val_geracao"]) for r in made["joined"].collect()] == [("P1", 5.0)]
    assert len(plans) == 6 and not any("RLIKE" in p for p in plans)


def test_a_lake_follows_its_input(spark, monkeypatch):
    """No lake of a former call is read again: the tables at a path may have changed."""
    inputs = []
    monkeypatch.setattr(catalog, "deliver", lambda spark, sf_dir, root, run: inputs.append(root))
    monkeypatch.setattr(catalog, "read_lake", lambda spark, root: {"root": root})
    found = [catalog.lake(spark, "tables")["root"] for _ in range(2)]
    assert found == [f"{root}/out" for root in inputs] and found[0] != found[1]


def test_what_needs_plant_columns_alone_is_made_before_the_join(spark, tmp_path, monkeypatch):
    """Plants, times and hour sets read each plant row once, however many complex rows it matches."""
    read = {}
    for name in ("dim_spe", "dim_tempo", "hour_sets"):
        def seen(rows, *rest, made=getattr(lake, name), name=name, **options):
            read[name] = rows.count()
            return made(rows, *rest, **options)

        monkeypatch.setattr(lake, name, seen)
    spe = [("SS0", "E0", "Tipo", " conj 1 ", f"U{k}", "ID1", "EOL.CV.0000001-1.01", "2024-01-05 01:00:00", "1.5", "0", "2", "3") for k in range(3)]
    spe.append(("SS0", "E0", "Tipo", None, "U9", None, "EOL.CV.0000001-1.01", None, "1.5", "0", "2", "3"))
    wind = [("CONJ 1", "2024-01-05 01:00:00", "SUB", "EST", "CJ1", str(k), "6", "7", "8", "9", "REL") for k in range(20)]
    mapping = spark.createDataFrame([("P1", "A", "0000001-1")], "projeto string, spe string, ceg string")
    raw = {"spe": spark.createDataFrame(spe, RAW_SPE_COLUMNS), "wind": spark.createDataFrame(wind, RAW_WIND_COLUMNS)}
    made = lake._tables(spark, f"{tmp_path}/lake", 0, raw, mapping, False, "coerce", "din_instante")
    assert made["joined"].count() == made["fact_generation"].count() == 61
    assert read == {"dim_spe": 4, "dim_tempo": 4, "hour_sets": 4}
    joined = made["joined"]
    keys = ("projeto", "nom_usina")
    as_rows = lambda df: sorted(map(repr, df.select(sorted(df.columns)).collect()))
    assert as_rows(made["hours"]) == as_rows(hour_sets(joined, keys, "din_instante", by=("year", "month")))
    assert as_rows(made["dim_spe"]) == as_rows(star.dim_spe(joined)) and as_rows(made["dim_tempo"]) == as_rows(star.dim_tempo(joined))
    assert made["fact_generation"].filter("spe_key IS NULL OR tempo_key IS NULL OR conjunto_key IS NULL").isEmpty()


def test_both_levels_are_taken_in_side_by_side(spark, tmp_path, monkeypatch):
    both = Barrier(2, timeout=20)

    class Met(Exception):
        pass

    def ingest(*_, **__):
        both.wait()
        raise Met

    (tmp_path / "mapping.csv").write_text("projeto,spe,ceg\nP1,A,0000001-1\n")
    for module, run in ((lake, lake.run_delivery), (pipeline, pipeline.run_new_months), (pipeline, pipeline.run_from_landing)):
        monkeypatch.setattr(module, "ingest_landing", ingest)
        with pytest.raises(Met):
            run(spark, f"{tmp_path}/spe", f"{tmp_path}/wind", f"{tmp_path}/mapping.csv", f"{tmp_path}/out", RAW_SPE_COLUMNS, RAW_WIND_COLUMNS)
