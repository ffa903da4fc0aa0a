"""A lake kept up to date by deliveries: only the months that a delivery has rows for are read and made anew."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windgrid.functions import percent, to_timestamp
from windgrid.operators.assets import attach_project, distinct_names, restrict_to_names
from windgrid.operators.clean import clean_spe, clean_wind, count_copies
from windgrid.operators.coverage import SERIES_KEYS, hour_sets
from windgrid.operators.levels import join_levels
from windgrid.operators.longform import long_rows
from windgrid.operators.quality import level_counts, report_of_counts
from windgrid.operators.rollup import daily_rollup
from windgrid.operators.star import append_dimension, append_tempo, dim_conjunto, dim_spe, dim_tempo, fact_generation
from windgrid.plans.pipeline import set_aside
from windgrid.schemas import COMPLEX_NUMERIC, DIM_CONJUNTO, DIM_SPE, FLAG, PLANT_NUMERIC, TS
from windgrid.session import at_once
from windgrid.sinks import partition_columns, write_layer, write_report
from windgrid.sinks.versions import current, manifest, publish, stage
from windgrid.sources.files import read_mapping, read_report
from windgrid.sources.months import missing_months, month_range, month_span, months_present
from windgrid.streaming import ingest_landing, ledger, read_bronze, touched_months
from windgrid.streaming.ingest import MALFORMED, last_batch, month_rows

LEVELS = ("spe", "wind")


def run_delivery(
    spark: SparkSession,
    landing_spe: str,
    landing_wind: str,
    mapping_path: str,
    root: str,
    spe_columns: Sequence[str],
    wind_columns: Sequence[str],
    collapse_ws: bool = False,
    mode: str = "coerce",
    multi_line: bool = False,
    expected_months: tuple[str, str] | None = None,
    ts: str = TS,
) -> dict[str, DataFrame]:
    """Takes in what is new in the landing folders and brings every table and report of the lake up to date.

    The ledger of bronze tells which months the new files have rows for; only the folders of these months are read. Equal rows
    share their timestamp, so duplicates never cross months, and everything stored is by month: the joined table, the facts, the daily
    rollup, the hour sets, the counts behind the quality report and those of the join. Dimensions only grow: stored keys stay, so the
    facts of other months stay valid. All tables change at one moment (``windgrid.sinks.versions``); a failed run leaves the lake
    as it was, and is simply repeated. A changed mapping means all months. Returns the tables and the two reports by name.
    """
    mapping = read_mapping(spark, mapping_path)
    mapped = mapping.agg(F.bit_xor(F.xxhash64(*mapping.columns)), F.count("*")).first()
    last, valid = manifest(spark, root)
    bronze = {name: f"{root}/bronze/{name}" for name in LEVELS}
    landings = {"spe": (landing_spe, spe_columns), "wind": (landing_wind, wind_columns)}
    ingest = lambda name, landing, columns: ingest_landing(spark, landing, bronze[name], f"{root}/checkpoints/{name}", columns, multi_line=multi_line, ts=ts)
    at_once(spark, *(partial(ingest, name, *level) for name, level in landings.items()))
    notes = {**{name: last_batch(spark, bronze[name]) for name in LEVELS}, "mapping": mapped[0] or 0, "mapped": mapped[1]}
    every = any(valid.get(("", k)) != notes[k] for k in ("mapping", "mapped"))
    new = [touched_months(spark, bronze[name], -1 if every else valid[("", name)]) for name in LEVELS]
    months = sorted(r["month"] for r in new[0].unionByName(new[1]).distinct().collect())
    run = last + 1
    if months or last < 0:
        raw = {name: read_bronze(spark, bronze[name], landing, columns, months=months).drop("source_file") for name, (landing, columns) in landings.items()}
        staged = _tables(spark, root, run, raw, mapping, collapse_ws, mode, ts)
        publish(spark, root, run, staged, months, notes)
    elif any(valid.get(("", k)) != n for k, n in notes.items()):
        # Files without a row, or with malformed rows only.
        publish(spark, root, run, {}, [], notes)
    tables = read_lake(spark, root)
    at_once(
        spark,
        lambda: write_report(report_of_counts(tables["quality_counts"]), f"{root}/reports/quality"),
        lambda: write_report(delivery_report(spark, root, tables["matches"], expected_months), f"{root}/reports/run"),
    )
    return {**tables, **{name: read_report(spark, f"{root}/reports/{name}") for name in ("quality", "run")}}


def _tables(spark: SparkSession, root: str, run: int, raw: dict[str, DataFrame], mapping: DataFrame, collapse_ws: bool, mode: str, ts: str) -> dict[str, DataFrame]:
    """The touched months of every table, stored but not yet published."""
    work = f"{root}/work/run={run}"
    copies = dict(zip(raw, at_once(spark, *(partial(write_layer, count_copies(rows), f"{work}/{name}") for name, rows in raw.items()))))
    of_month = month_rows(spark, *(f"{root}/bronze/{name}" for name in raw))
    by_month = lambda rows: rows.withColumns({"year": F.year(to_timestamp(F.col(ts))), "month": F.month(to_timestamp(F.col(ts)))})
    counts = [
        level_counts(by_month(copies[name]), name, numeric, ts, flag, by=("year", "month"))
        for name, numeric, flag in (("spe", PLANT_NUMERIC, FLAG), ("wind", COMPLEX_NUMERIC, None))
    ]

    def join() -> tuple[DataFrame, DataFrame]:
        # Both sides are stored typed: parsing and joining in one generated method pass the size that the JVM compiles.
        owned_spe = write_layer(attach_project(clean_spe(copies["spe"], mode=mode), mapping), f"{work}/owned_spe")
        names = write_layer(distinct_names(owned_spe, collapse_ws=collapse_ws), f"{work}/names")
        owned_wind = write_layer(clean_wind(restrict_to_names(copies["wind"], names, collapse_ws=collapse_ws), mode=mode), f"{work}/owned_wind")
        pairs = join_levels(owned_spe, owned_wind, collapse_ws=collapse_ws)
        return partition_columns(owned_spe, "data_hora"), stage(partition_columns(pairs, "data_hora"), root, "joined", run, ("projeto", ts), of_month)

    (owned, joined), counted = at_once(spark, join, lambda: stage(counts[0].unionByName(counts[1]), root, "quality_counts", run))
    _, valid = manifest(spark, root)
    # The join keeps every plant row and repeats it for each of its matches. What needs the plant's columns alone is made from the rows
    # before it, so that it does not grow with the matches.
    source = {"dim_spe": owned, "dim_conjunto": joined, "dim_tempo": owned}
    fresh = {"dim_spe": dim_spe(owned), "dim_conjunto": dim_conjunto(joined), "dim_tempo": dim_tempo(owned, ts)}

    def dimension(name: str) -> DataFrame:
        made, rows = fresh[name], source[name]
        if (name, "") in valid:
            stored = current(spark, root, name, made.schema, valid)
            made = append_tempo(stored, rows, ts) if name == "dim_tempo" else append_dimension(stored, rows, DIM_SPE if name == "dim_spe" else DIM_CONJUNTO, made.columns[-1])
        return stage(made, root, name, run)

    def star() -> dict[str, DataFrame]:
        dims = dict(zip(fresh, at_once(spark, *(partial(dimension, name) for name in fresh))))
        facts = fact_generation(joined, *dims.values(), ts=ts, keep=("year", "month"))
        return {**dims, "fact_generation": stage(facts, root, "fact_generation", run, ("spe_key", "tempo_key"), of_month)}

    matched = [F.count("*").alias("total_records"), F.count("nom_estado").alias("matched_records")]
    sums = {
        "hours": hour_sets(owned, SERIES_KEYS, ts, by=("year", "month")),
        "rollup": daily_rollup(joined, ts=ts),
        "places": joined.select("year", "month", "projeto", "nom_estado", "nom_subsistema").distinct(),
        "matches": joined.groupBy("year", "month").agg(*matched),
    }
    stars, *done = at_once(spark, star, *(partial(stage, rows, root, name, run) for name, rows in sums.items()))
    return {"joined": joined, "quality_counts": counted, **dict(zip(sums, done)), **stars}


def read_lake(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Every table of the lake as last published."""
    _, valid = manifest(spark, root)

    def table(name: str) -> DataFrame:
        run = max(run for (table, _), run in valid.items() if table == name)
        schema = spark.read.parquet(f"{root}/{name}/run={run}").schema
        return current(spark, root, name, schema, valid)

    names = sorted({table for table, _ in valid if table})
    return dict(zip(names, at_once(spark, *(partial(table, name) for name in names)))) if names else {}


def delivery_report(spark: SparkSession, root: str, matches: DataFrame, expected_months: tuple[str, str] | None = None) -> DataFrame:
    """The run report from stored counts and the ledgers: match rate, missing months, files set aside, malformed rows.

    Without ``expected_months``, two dates, the months from a level's first to its last one are expected.
    """
    total, matched = (F.coalesce(F.sum(c), F.lit(0)) for c in ("total_records", "matched_records"))
    lines = [("join", "total_records", "", total), ("join", "matched_records", "", matched), ("join", "match_rate_pct", "", percent(matched, total))]
    report = long_rows(matches, ["section", "metric", "key"], lines).withColumn("detail", F.lit(None).cast("string"))
    for name in LEVELS:
        bronze = f"{root}/bronze/{name}"
        seen = ledger(spark, bronze).filter(F.col("month") != MALFORMED).select(to_timestamp(F.concat("month", F.lit("-01"))).alias("moment"))
        expected = month_range(spark, *expected_months) if expected_months else month_span(seen, "moment")
        missing = missing_months(expected, months_present(seen, "moment"))
        key = F.concat_ws("-", F.col("year").cast("string"), "month").alias("key")
        rows = missing.select(F.lit(name).alias("section"), F.lit("missing_month").alias("metric"), key, F.lit(1.0).alias("value"), F.lit(None).cast("string").alias("detail"))
        report = report.unionByName(rows).unionByName(set_aside(spark, bronze, name))
    return report
