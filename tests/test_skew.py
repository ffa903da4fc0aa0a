"""Hot groups on a session with tiny thresholds, so that what a cluster does for large data happens here."""

from __future__ import annotations

import os
from contextlib import contextmanager
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from windgrid.operators import clean, levels
from windgrid.sinks import write_layer, write_partitioned

T0 = datetime(2026, 1, 1)


@contextmanager
def settings(spark, **conf):
    keys = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot_levels(spark, tmp_path):
    """60,000 plant rows: a third in one (name, timestamp), a third without a name."""
    i = F.col("id")
    spe = spark.range(60000).select(
        i.alias("plant"),
        F.when(i % 3 == 0, "Hot").when(i % 3 == 1, F.concat(F.lit("N"), (i % 500).cast("string"))).alias("nom_conjuntousina"),
        F.when(i % 3 == 0, F.lit(T0)).otherwise(F.lit(T0) + F.make_dt_interval(hours=(i % 700).cast("int"))).cast("timestamp_ntz").alias("din_instante"),
        F.sha2(i.cast("string"), 256).alias("filler"),
    )
    wind = spark.range(501 * 700).select(
        F.when(i % 501 == 500, "HOT").otherwise(F.concat(F.lit("N"), (i % 501).cast("string"))).alias("nom_usina"),
        (F.lit(T0) + F.make_dt_interval(hours=(i / 501).cast("int"))).cast("timestamp_ntz").alias("din_instante"),
        i.cast("double").alias("val_geracao"),
    )
    return write_layer(spe, str(tmp_path / "spe")), write_layer(wind, str(tmp_path / "wind"))


def test_hot_pair_is_split_by_adaptive_join_or_salt(spark, tmp_path):
    spe, wind = hot_levels(spark, tmp_path)
    tiny = {
        "spark__sql__autoBroadcastJoinThreshold": "-1",
        "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "64KB",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "64KB",
    }
    counts = []
    with settings(spark, **tiny):
        out = levels.join_levels(spe, wind, payload=["val_geracao"])
        counts.append((len(out.collect()), out.filter("val_geracao IS NOT NULL").count()))
        out = levels.join_levels(spe, wind, payload=["val_geracao"])
        rows = out.collect()
        assert "skew=true" in final_plan(out)
    salted = levels.join_levels(spe, wind, payload=["val_geracao"], salt=8)
    assert sorted(map(tuple, salted.collect()), key=str) == sorted(map(tuple, rows), key=str)
    assert counts == [(60000, 40000)]


def test_null_names_and_salted_pairs_spread_over_tasks(spark, tmp_path):
    """With eight slots no shuffle partition gets more than about its share, though adaptive splitting is off."""
    spe, wind = hot_levels(spark, tmp_path)
    off = {
        "spark__sql__adaptive__enabled": "false",
        "spark__sql__autoBroadcastJoinThreshold": "-1",
        "spark__sql__shuffle__partitions": "16",
    }

    def largest(salt):
        out = levels.join_levels(spe, wind, payload=["val_geracao"], salt=salt)
        return max(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())

    with settings(spark, **off):
        assert largest(salt=1) > 20000  # the hot pair alone
        assert largest(salt=32) < 12000


def test_copies_are_counted_before_the_shuffle(spark):
    raw = spark.range(300000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 1000).cast("string")).alias("v"))
    counted = clean.count_copies(raw)
    assert counted.agg(F.sum("_copies"), F.count("*"), F.max("_copies")).first()[:] == (300000, 1001, 100000)
    assert "partial_count" in final_plan(counted)


def test_a_large_month_is_written_by_several_tasks(spark, tmp_path):
    i = F.col("id")
    df = spark.range(200000).select(
        F.when(i % 100 != 0, F.lit(T0)).otherwise(F.lit(T0 + timedelta(days=40))).cast("timestamp_ntz").alias("data_hora"),
        F.sha2(i.cast("string"), 256).alias("filler"),
    )
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="1MB"):
        write_partitioned(df.repartition(8), str(tmp_path / "p"))
    files = {m: [f for f in os.listdir(tmp_path / "p" / "year=2026" / f"month={m}") if f.endswith(".parquet")] for m in (1, 2)}
    assert len(files[1]) > 3 and len(files[2]) == 1
    assert spark.read.parquet(str(tmp_path / "p")).count() == 200000


def test_hot_pairs_found_by_the_sketch_spread_without_adaptive_execution(spark, tmp_path):
    """One pair has a third of all rows: cut into its slots, no task has more than a few shares."""
    spe, wind = hot_levels(spark, tmp_path)
    off = {"spark__sql__adaptive__enabled": "false", "spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__shuffle__partitions": "16"}
    with settings(spark, **off):
        hot = levels.hot_pairs(spe)
        assert len(hot) == 1 and list(hot.values()) == [8]  # 20,000 rows, 2,500 a slot
        out = levels.join_levels(spe, wind, payload=["val_geracao"], hot=hot)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        plain = levels.join_levels(spe, wind, payload=["val_geracao"])
        largest = max(r["count"] for r in plain.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert sum(sizes) == 60000 and largest > 20000 and max(sizes) < 13000
        assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_no_hot_pairs_change_nothing(spark):
    rows = spark.createDataFrame([(k, None if k < 3 else f"n{k}", T0) for k in range(50)], "plant int, nom_conjuntousina string, din_instante timestamp_ntz")
    assert levels.hot_pairs(rows, rows_per_slot=2) == {} == levels.hot_pairs(rows.limit(0))
