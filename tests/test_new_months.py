"""Runs over new months only, keys that stay, join sides planned with their true size, and odd spellings."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from driver_queries import adapter, catalog
from windgrid.functions import is_bad_timestamp, to_timestamp
from windgrid.operators import coverage, levels, metrics, star
from windgrid.plans import run_new_months, run_pipeline
from windgrid.sinks import write_csv, write_layer

SF = "/root/testdata/sf0.001"


def month_files(root):
    return {(d.removeprefix(root), f) for d, _, names in os.walk(root) for f in names if f.startswith("part-")}


def test_other_months_keep_their_files(spark, tmp_path):
    root = str(tmp_path)
    spe, wind = adapter.raw_spe(spark, SF), adapter.raw_wind(spark, SF)
    write_csv(adapter.mapping(spark, SF), f"{root}/in/mapping")
    # Two months: the later one is the first, 40 days on.
    later = lambda df: df.withColumn("din_instante", F.regexp_replace("din_instante", "^2024-01", "2024-03"))
    args = [spark, f"{root}/in/spe/*", f"{root}/in/wind/*", f"{root}/in/mapping", f"{root}/out", adapter.RAW_SPE_COLUMNS, adapter.RAW_WIND_COLUMNS]
    write_csv(spe.filter("din_instante LIKE '2024-%'"), f"{root}/in/spe/a", sep=";")
    write_csv(wind.filter("din_instante LIKE '2024-%'"), f"{root}/in/wind/a", sep=";")
    run_new_months(*args)
    before = month_files(f"{root}/out/joined")
    run_new_months(*args)
    assert month_files(f"{root}/out/joined") == before
    write_csv(later(spe.filter("din_instante LIKE '2024-01-1%:%'")), f"{root}/in/spe/b", sep=";")
    joined = run_new_months(*args)
    assert before < month_files(f"{root}/out/joined")
    whole = run_pipeline(
        spe.filter("din_instante LIKE '2024-%'").unionByName(later(spe.filter("din_instante LIKE '2024-01-1%:%'"))),
        wind.filter("din_instante LIKE '2024-%'"),
        adapter.mapping(spark, SF),
        f"{root}/whole",
        report_rules=None,
    )["joined"]
    assert joined.count() == whole.count() and joined.exceptAll(whole).isEmpty()
    # Another mapping concerns all months.
    write_csv(adapter.mapping(spark, SF).filter("projeto <> 'P1'"), f"{root}/in/mapping", sep=",")
    assert run_new_months(*args).filter("projeto = 'P1'").isEmpty()
    assert not before & month_files(f"{root}/out/joined")


def test_appended_keys_follow_the_stored_ones(spark):
    rows = spark.createDataFrame([(c, "x", None) for c in "abcdef"], "a string, b string, c string")
    stored = star.add_surrogate_key(rows.filter("a < 'd'"), ["a", "b", "c"], "k")
    grown = star.append_dimension(stored, rows, ["a", "b", "c"], "k")
    old, new = ({r.a: r.k for r in df.collect()} for df in (stored, grown))
    assert {a: new[a] for a in old} == old and sorted(new.values()) == [1, 2, 3, 4, 5, 6]
    assert star.append_dimension(stored.limit(0), rows, ["a", "b", "c"], "k").agg(F.max("k")).first()[0] == 6


def test_stored_sides_leave_the_large_side_in_place(spark, tmp_path):
    spe = write_layer(catalog.spe_kept(spark, SF), f"{tmp_path}/spe")
    wind = write_layer(adapter.wind(spark, SF), f"{tmp_path}/wind")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        joined = levels.dedupe_then_join(spe, wind, store=f"{tmp_path}/firsts")
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_salted_first_join_equals_the_plain_one(spark):
    spe, wind = catalog.spe_kept(spark, SF), adapter.wind(spark, SF)
    plain, salted = levels.dedupe_then_join(spe, wind), levels.dedupe_then_join(spe, wind, salt=5)
    assert plain.count() == salted.count() and plain.exceptAll(salted).isEmpty()


def test_bad_timestamps_are_those_of_try_cast(spark):
    spellings = ["2024", "2024-01", "2024-01-05", "2024-01-05 10", "2024-01-05 10:30", "2024-01-05T10:30:00", "2024-01-05 24:00:00", "2024-01-05 24:00:01", "2024-01-05 24:00", "2024-12-31 24:00:00.0", "2024/01/05 10:30", "2024 01 05", "2024\\01\\05 1:2:3", "2024-01/05", "2024-01-05   10:30", "2024-01-05 10:30:00Z", "2024-01-05 24:00:00Z", "2024-01-05 10:30:00+02:00", "+2024-01-05", "05/01/2024", "20240105", "2024-02-30", "2024-01-05T", "2024-01-05 10:30:60", "2024-1-5", "2024-01-05 10:30:00.5", "2024/01/05", "2024-13-05 24:00:00", "10:30:00", "T10:30", "bad", "", None]
    rows = spark.createDataFrame([(k, s) for k, s in enumerate(spellings)], "k int, s string")
    got = {r.k: (r.b, r.t) for r in rows.select("k", is_bad_timestamp(F.col("s")).alias("b"), to_timestamp(F.col("s")).alias("t")).collect()}
    db = duckdb.connect()
    for k, s in enumerate(spellings):
        wanted = db.execute("SELECT TRY_CAST(? AS TIMESTAMP)", [s]).fetchall()[0][0]
        assert got[k] == (wanted is None, wanted), s
        strict = rows.filter(F.col("k") == k).select(to_timestamp(F.col("s"), "strict"))
        if s is None or wanted:
            assert strict.first()[0] == wanted, s
        else:
            with pytest.raises(Exception, match="not a timestamp"):
                strict.collect()


def test_nan_reference_is_no_restriction(spark):
    rows = spark.sql("SELECT 'P' AS projeto, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS din_instante, v.* FROM VALUES (1D, 3D, 'REL'), (1D, double('NaN'), 'REL'), (5D, 3D, 'REL') AS v(val_geracao, val_geracaoreferencia, cod_razaorestricao)")
    assert [tuple(r) for r in metrics.restrictions_summary(rows).collect()] == [("REL", 1, 2.0)]


def test_one_long_gap_is_spread(spark):
    rows = spark.sql("SELECT 'a' AS nom_usina, 'P' AS projeto, t AS din_instante FROM VALUES (TIMESTAMP_NTZ'2000-01-01 00:00:00'), (TIMESTAMP_NTZ'2020-01-01 00:00:00') AS v(t)")
    hours = coverage.list_missing_hours(rows, keys=["nom_usina"])
    assert hours.count() == 175_319
    assert hours.select(F.spark_partition_id()).distinct().count() > 1
