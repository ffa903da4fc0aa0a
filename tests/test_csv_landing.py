"""CSV text as written, header drift, bad files, and sums that do not fit."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from windgrid.functions import decimal_sum
from windgrid.operators import levels, metrics
from windgrid.sinks import write_csv
from windgrid.sources import files
from windgrid.streaming import ingest_landing, ledger, malformed_rows, read_bronze, rejected_files, touched_months

HAND_WRITTEN = 'name;n\n"say ""hi""; ok";1\n"a\nb";2\n"C:\\";3\n" lead and trail ";4\n;5\n'


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write(text)


def test_doubled_quotes_read_as_duckdb_reads_them(spark, tmp_path):
    put(tmp_path / "in", "x.csv", HAND_WRITTEN)
    wanted = duckdb.connect().execute(f"SELECT * FROM read_csv('{tmp_path}/in/x.csv', delim=';', header=true, all_varchar=true, quote='\"', escape='\"')").fetchall()
    assert sorted(map(repr, map(tuple, files.read_raw_csv(spark, str(tmp_path / "in"), multi_line=True).collect()))) == sorted(map(repr, wanted))
    by_name = files.read_csv_by_name(spark, str(tmp_path / "in"), multi_line=True)
    assert sorted(map(repr, map(tuple, by_name.collect()))) == sorted(map(repr, wanted))


def test_text_comes_back_as_written(spark, tmp_path):
    rows = [(' Conj "3"; norte ', "\\"), ("end\\", '"'), ("a,b;c", "'"), (None, " ")]
    frame = spark.createDataFrame(rows, "a string, b string")
    write_csv(frame, f"{tmp_path}/out", sep=";")
    assert sorted(map(repr, map(tuple, files.read_raw_csv(spark, f"{tmp_path}/out").collect()))) == sorted(map(repr, rows))


def test_empty_text_is_a_missing_value(spark, tmp_path):
    write_csv(spark.createDataFrame([("", "x"), (None, "y")], "a string, b string"), f"{tmp_path}/out", sep=";")
    assert {r.a for r in files.read_raw_csv(spark, f"{tmp_path}/out").collect()} == {None}


def test_jobs_grow_with_headers_not_with_files(spark, tmp_path):
    for k in range(200):
        put(tmp_path / "in", f"f{k}.csv", f"a;b\n{k};x\n" if k % 2 else f"b;c\ny;{k}\n")
    spark.sparkContext.setJobGroup("headers", "count")
    try:
        frame = files.read_csv_by_name(spark, str(tmp_path / "in"))
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 6
    assert frame.count() == 200 and frame.columns == ["b", "c", "a"]


def test_other_errors_are_not_called_an_empty_folder(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)scheme|filesystem") as error:
        files.csv_files(spark, "nosuchscheme://x/y")
    assert not str(error.value).startswith("No CSV files found")


def test_the_list_of_new_files_reads_no_content(spark, tmp_path):
    """The stream only names the new files. Loading one whole, which this limit refuses, would need an executor as large as the file."""
    landing, bronze, checkpoint = (str(tmp_path / n) for n in ("in", "bronze", "checkpoint"))
    put(landing, "a.csv", "a;b\n" + "1;2\n" * 50)
    put(landing, "b c.csv", "b;a\n4;3\n")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "4")
    try:
        taken = ingest_landing(spark, landing, bronze, checkpoint, ["a", "b"])
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert sorted(map(tuple, taken.select("a", "b").collect())) == [("1", "2")] * 50 + [("3", "4")]
    assert rejected_files(spark, bronze).isEmpty()


def test_bad_file_is_set_aside_and_the_next_goes_on(spark, tmp_path):
    landing, bronze, checkpoint = (str(tmp_path / n) for n in ("in", "bronze", "checkpoint"))
    put(landing, "a.csv", "a;b\n1;2\n")
    put(landing, "empty.csv", "\n")
    put(landing, "nothing.csv", "")
    put(landing, "other.csv", "x;y\n1;2\n")
    first = ingest_landing(spark, landing, bronze, checkpoint, ["a", "b"])
    assert [tuple(r) for r in first.collect()] == [("1", "2", "a.csv")]
    assert {os.path.basename(r.path) for r in rejected_files(spark, bronze).collect()} == {"empty.csv", "other.csv"}
    put(landing, "b.csv", "b;extra;a\n4;more;3\n")
    put(landing, "c.csv", "a\n5\n")
    again = ingest_landing(spark, landing, bronze, checkpoint, ["a", "b"])
    assert again.columns == ["a", "b", "extra", "source_file"]
    assert sorted(map(repr, map(tuple, again.collect()))) == sorted(map(repr, [("1", "2", None, "a.csv"), ("3", "4", "more", "b.csv"), ("5", None, None, "c.csv")]))
    assert rejected_files(spark, bronze).count() == 2


def test_empty_landing_is_named(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    with pytest.raises(ValueError, match="No CSV files found in: .*in"):
        ingest_landing(spark, str(tmp_path / "in"), str(tmp_path / "bronze"), str(tmp_path / "checkpoint"), ["a"])


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_do_not_clamp(spark, ansi):
    frame = spark.createDataFrame([(1e14,), (1.0,), (None,), (3e20,)], "v double")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert frame.filter("v < 1e15 OR v IS NULL").agg(decimal_sum(F.col("v"), 6)).first()[0] == 1e14 + 1
        assert frame.agg(decimal_sum(F.col("v"), 4)).first()[0] == 3e20 + 1e14
        for bad in (1e30, float("nan"), float("inf")):
            with pytest.raises(Exception, match="cannot hold the value"):
                spark.createDataFrame([(bad,)], "v double").agg(decimal_sum(F.col("v"), 6)).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_level_join_reads_only_what_is_asked_for(spark, tmp_path):
    spe = "SELECT 'P' AS projeto, 'U' AS nom_usina, 'C' AS nom_conjuntousina, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS din_instante, 'E1' AS id_estado, 'big' AS unused, 1D AS val_geracaoverificada"
    spark.sql(spe).write.parquet(f"{tmp_path}/spe")
    payload = ", ".join(f"'1' AS {c}" for c in levels.COMPLEX_PAYLOAD)
    spark.sql(f"SELECT 'C' AS nom_usina, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS din_instante, {payload}").write.parquet(f"{tmp_path}/wind")
    joined = levels.join_levels(spark.read.parquet(f"{tmp_path}/spe"), spark.read.parquet(f"{tmp_path}/wind"))
    plan = metrics.projects(joined)._jdf.queryExecution().executedPlan().toString() if {"id_estado"} <= set(joined.columns) else ""
    assert "unused" not in plan and "val_geracaoverificada" not in plan


ODD = '''a;b;c
1;2;3
1;2;3;4
1;2;3;
1;2
1;"abc;3
1;2;"abc
1;2;"ab"c
"1";"2";"""abc"
1;a"b;3
1;2;"x""
;;
1;"x
y";3
1; "q";'
'''


def test_rows_that_do_not_fit_are_marked_with_their_text(spark, tmp_path):
    put(tmp_path / "in", "x.csv", ODD)
    put(tmp_path / "in", "y.csv", "c;new\n5;6\n7\n")
    read = files.read_csv_by_name(spark, str(tmp_path / "in"), checked=True)
    bad = {r._line: r._reason for r in read.filter("_line IS NOT NULL").collect()}
    assert bad == {
        "1;2;3;4": "too many fields",
        "1;2;3;": "too many fields",
        "1;2": "too few fields",
        '1;"abc;3': "broken quotes",
        '1;2;"abc': "broken quotes",
        '1;2;"ab"c': "broken quotes",
        '1;2;"x""': "broken quotes",
        '1;"x': "broken quotes",
        'y";3': "too few fields",
        "7": "too few fields",
    }
    good = [tuple(r) for r in read.filter("_reason IS NULL").drop("_line", "_reason").collect()]
    wanted = [("1", "2", "3", None), ("1", "2", '"abc', None), ("1", 'a"b', "3", None), (None, None, None, None), ("1", ' "q"', "'", None), (None, None, "5", "6")]
    assert sorted(good, key=repr) == sorted(wanted, key=repr)


def test_quoted_line_breaks_fit_with_multi_line(spark, tmp_path):
    put(tmp_path / "in", "x.csv", 'a;b;c\n1;"x\ny";3\n1;2\n1;"p;q";"r ""s"""\n')
    read = files.read_csv_by_name(spark, str(tmp_path / "in"), multi_line=True, checked=True)
    assert sorted(map(tuple, read.collect()), key=repr) == sorted([("1", "x\ny", "3", None, None), ("1", "p;q", 'r "s"', None, None), ("1", "2", None, "1;2", "too few fields")], key=repr)


def test_a_long_quoted_field_fits(spark, tmp_path):
    put(tmp_path / "in", "x.csv", 'a;b\n1;"' + 'x""' * 60_000 + '"\n2;' + "y" * 300_000 + "\n")
    assert files.read_csv_by_name(spark, str(tmp_path / "in"), checked=True).filter("_line IS NULL").count() == 2


def test_months_and_malformed_rows_are_in_the_ledger(spark, tmp_path):
    landing, bronze, checkpoint = (str(tmp_path / n) for n in ("in", "bronze", "checkpoint"))
    put(landing, "a b.csv", "a;din_instante\n1;2024/01/31\n2;2024-01-31 24:00:00\n3;2024\n4;2024-02-01;x\n5\n")
    put(landing, "clash.csv", "a;batch\n1;2\n")
    run = lambda: ingest_landing(spark, landing, bronze, checkpoint, ["a", "din_instante"])
    assert sorted(r.a for r in run().collect()) == ["1", "2", "3"]
    rows = lambda **k: sorted(r.a for r in read_bronze(spark, bronze, landing, ["a", "din_instante"], **k).collect())
    assert [rows(months=[m]) for m in ("2024-01", "2024-02", "none")] == [["1"], ["2"], ["3"]]
    assert {(r.month, r.n_rows) for r in ledger(spark, bronze).collect()} == {("2024-01", 1), ("2024-02", 1), ("none", 1), ("malformed", 2)}
    assert {(r.line, r.reason) for r in malformed_rows(spark, bronze).collect()} == {("4;2024-02-01;x", "too many fields"), ("5", "too few fields")}
    assert [os.path.basename(r.path) for r in rejected_files(spark, bronze).collect()] == ["clash.csv"]
    put(landing, "c.csv", "a;din_instante\n9;2024-02-02\n")
    run()
    assert [r.month for r in touched_months(spark, bronze, after=0).collect()] == ["2024-02"] and rows(months=["2024-02"]) == ["2", "9"]
    plan = read_bronze(spark, bronze, landing, ["a"], months=["2024-02"])
    opened = plan.inputFiles()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bronze_month" in text and opened
    plan.collect()
    assert {r.p for r in plan.select(F.input_file_name().alias("p")).collect()} == {f for f in opened if "bronze_month=2024-02" in f}
