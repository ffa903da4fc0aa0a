"""Raw rows to partitioned joined table, reports and star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windgrid.functions import percent, timestamp_column
from windgrid.operators.assets import attach_project, distinct_names, keep_mapped, restrict_to_names
from windgrid.operators.clean import clean_spe, clean_wind, count_copies
from windgrid.operators.levels import first_per_name, join_first, join_levels
from windgrid.operators.longform import long_rows
from windgrid.operators.quality import quality_report
from windgrid.operators.star import dim_conjunto, dim_spe, dim_tempo, fact_generation
from windgrid.operators.validate import validation_report
from windgrid.schemas import TS
from windgrid.session import at_once
from windgrid.sinks import write_layer, write_partitioned, write_report, write_star
from windgrid.sources.files import read_mapping, read_partitioned, read_report
from windgrid.sources.months import missing_months, month_range, month_span, months_present
from windgrid.streaming import ingest_landing, ledger, read_bronze, rejected_files, touched_months
from windgrid.streaming.ingest import MALFORMED, last_batch, month_rows


def run_pipeline(
    raw_spe: DataFrame,
    raw_wind: DataFrame,
    mapping: DataFrame,
    root: str,
    collapse_ws: bool = False,
    level_join: str = "name_and_time",
    mode: str = "coerce",
    report_rules: str | None = "raw",
    month_sizes: Mapping[str, int] | None = None,
) -> dict[str, DataFrame]:
    """Clean, report, filter, join and export below ``root``; returns the stored tables by name.

    With a report, each level is shuffled once for duplicate removal and stored with its copy counts; the
    clean rows and the report both read that. ``report_rules=None`` leaves the report out, and then only
    the owned assets' rows are shuffled at all. The owned rows of both levels and the complex names are stored in either case, so
    that nothing is parsed twice and the filter on names is planned with their true size. ``level_join="first_per_name"`` attaches one complex
    row per name instead of the row of the same time. ``month_sizes``, the raw rows of each month, lets several tasks write a
    large month (``by_month``).
    """
    if level_join not in ("name_and_time", "first_per_name"):
        raise ValueError(f"level_join must be 'name_and_time' or 'first_per_name', not {level_join!r}")
    spark = raw_spe.sparkSession
    if report_rules:
        layers = {"spe": count_copies(raw_spe), "wind": count_copies(raw_wind)}
        raw_spe, raw_wind = at_once(spark, *(partial(write_layer, rows, f"{root}/distinct/{name}") for name, rows in layers.items()))
        mapped = clean_spe(raw_spe, mode=mode)
    else:
        mapped = clean_spe(keep_mapped(raw_spe, mapping), mode=mode)

    def join() -> tuple[DataFrame, DataFrame]:
        # Both sides are stored typed: parsing and joining in one generated method pass the size that the JVM compiles.
        owned_spe = write_layer(attach_project(mapped, mapping), f"{root}/owned/spe")
        names = write_layer(distinct_names(owned_spe, collapse_ws=collapse_ws), f"{root}/owned/names")
        owned_wind = write_layer(clean_wind(restrict_to_names(raw_wind, names, collapse_ws=collapse_ws), mode=mode), f"{root}/owned/wind")
        if level_join == "name_and_time":
            joined = join_levels(owned_spe, owned_wind, collapse_ws=collapse_ws)
        else:
            firsts = write_layer(first_per_name(owned_wind, collapse_ws=collapse_ws), f"{root}/owned/firsts")
            joined = join_first(owned_spe, firsts, collapse_ws=collapse_ws)
        write_partitioned(joined, f"{root}/joined", rows=month_sizes)
        return owned_spe, owned_wind

    def report() -> None:
        if report_rules:
            write_report(quality_report(raw_spe, raw_wind, rules=report_rules), f"{root}/reports/quality")

    (owned_spe, owned_wind), _ = at_once(spark, join, report)
    layers = {
        "spe_owned": owned_spe,
        "wind_owned": owned_wind,
        "joined": read_partitioned(spark, f"{root}/joined"),
    }
    if report_rules:
        layers["spe_clean"] = clean_spe(raw_spe, mode=mode)
        layers["wind_clean"] = clean_wind(raw_wind, mode=mode)
        layers["quality"] = read_report(spark, f"{root}/reports/quality")
    return layers


def run_from_landing(
    spark: SparkSession,
    landing_spe: str,
    landing_wind: str,
    mapping_path: str,
    root: str,
    spe_columns: Sequence[str],
    wind_columns: Sequence[str],
    expected_months: tuple[str, str] | None = None,
    multi_line: bool = False,
    **options: str | bool | None,
) -> dict[str, DataFrame]:
    """``run_pipeline`` over two landing folders, of which only new files are read into bronze.

    The run's own report is stored too: match rate of the level join, months without rows, files set aside and malformed rows per file.
    ``multi_line`` reads line breaks inside quotes.
    ``expected_months`` are two dates; without them the months from the first to the last one of each level are expected.
    """
    levels = (("spe", landing_spe, spe_columns), ("wind", landing_wind, wind_columns))
    ingest = lambda name, landing, columns: ingest_landing(spark, landing, f"{root}/bronze/{name}", f"{root}/checkpoints/{name}", columns, multi_line=multi_line)
    bronze = at_once(spark, *(partial(ingest, *level) for level in levels))
    raw_spe, raw_wind = (rows.drop("source_file") for rows in bronze)
    sizes = month_rows(spark, *(f"{root}/bronze/{name}" for name, _, _ in levels))
    layers = run_pipeline(raw_spe, raw_wind, read_mapping(spark, mapping_path), root, month_sizes=sizes, **options)
    expected = month_range(spark, *expected_months) if expected_months else None
    report = run_report(layers["joined"], {"spe": raw_spe, "wind": raw_wind}, expected)
    for name in ("spe", "wind"):
        report = report.unionByName(set_aside(spark, f"{root}/bronze/{name}", name))
    write_report(report, f"{root}/reports/run")
    return {**layers, "run": read_report(spark, f"{root}/reports/run")}


def run_new_months(
    spark: SparkSession,
    landing_spe: str,
    landing_wind: str,
    mapping_path: str,
    root: str,
    spe_columns: Sequence[str],
    wind_columns: Sequence[str],
    collapse_ws: bool = False,
    mode: str = "coerce",
    ts: str = TS,
    multi_line: bool = False,
) -> DataFrame:
    """The joined table after a delivery, with only the months made anew that its files have rows for.

    The ledger of bronze tells the months, and only their folders are read. Equal rows share their timestamp, so duplicates never
    cross months: each touched month is cleaned, joined and written from all its rows, old and new, and the folders of other months keep their files. Rows without a readable timestamp are a month of
    their own. A changed mapping means all months. What was done is recorded after the months are written, so an interrupted run is
    simply repeated. Only the touched months, a bounded list, reach the driver. ``run_delivery`` keeps reports and star schema as well.
    """
    mapping = read_mapping(spark, mapping_path)
    print_of = mapping.agg(F.bit_xor(F.xxhash64(*mapping.columns)), F.count("*")).first()
    state = _read_state(spark, f"{root}/state")
    levels = {"spe": (landing_spe, spe_columns), "wind": (landing_wind, wind_columns)}
    bronze = {name: f"{root}/bronze/{name}" for name in levels}
    ingest = lambda name, landing, columns: ingest_landing(spark, landing, bronze[name], f"{root}/checkpoints/{name}", columns, multi_line=multi_line, ts=ts)
    at_once(spark, *(partial(ingest, name, *level) for name, level in levels.items()))
    every = not state or (state["mapping"], state["mapped"]) != tuple(print_of)
    new = [touched_months(spark, bronze[name], -1 if every else state[name]) for name in levels]
    months = sorted(r["month"] for r in new[0].unionByName(new[1]).distinct().collect())
    if months:
        raw = [read_bronze(spark, bronze[name], landing, columns, months=months).drop("source_file") for name, (landing, columns) in levels.items()]
        run_pipeline(*raw, mapping, root, collapse_ws=collapse_ws, mode=mode, report_rules=None, month_sizes=month_rows(spark, *bronze.values()))
    row = (last_batch(spark, bronze["spe"]), last_batch(spark, bronze["wind"]), *print_of, int(state["run"]) + 1 if state else 0)
    # A state of its own for each run: an interrupted write leaves the one before.
    spark.createDataFrame([row], STATE).write.mode("overwrite").parquet(f"{root}/state/run={row[-1]}")
    return read_partitioned(spark, f"{root}/joined")


STATE = "spe long, wind long, mapping long, mapped long, run long"


def _read_state(spark: SparkSession, path: str):
    """The latest recorded run, or None."""
    try:
        return spark.read.schema(STATE).option("recursiveFileLookup", True).parquet(path).orderBy(F.desc("run")).first()
    except AnalysisException:
        return None


def run_report(joined: DataFrame, raw: Mapping[str, DataFrame], expected: DataFrame | None = None, ts: str = TS) -> DataFrame:
    """Join metrics and missing months as report rows (``section``, ``metric``, ``key``, ``value``, ``detail``).

    A level whose timestamps are all unreadable lacks every expected month, and none if nothing else is expected.
    """
    total, matched = F.count("*"), F.count("nom_estado")
    lines = [("join", "total_records", "", total), ("join", "matched_records", "", matched), ("join", "match_rate_pct", "", percent(matched, total))]
    report = long_rows(joined, ["section", "metric", "key"], lines)
    for name, rows in raw.items():
        dated = rows.select(timestamp_column(rows, ts).alias(ts))
        missing = missing_months(month_span(dated, ts) if expected is None else expected, months_present(dated, ts))
        key = F.concat_ws("-", F.col("year").cast("string"), "month").alias("key")
        report = report.unionByName(missing.select(F.lit(name).alias("section"), F.lit("missing_month").alias("metric"), key, F.lit(1.0).alias("value")))
    return report.withColumn("detail", F.lit(None).cast("string"))


def set_aside(spark: SparkSession, bronze: str, level: str) -> DataFrame:
    """Files set aside and the number of malformed rows of the others, as report rows."""
    bad = ledger(spark, bronze).filter(F.col("month") == MALFORMED)
    bad = bad.select(F.lit(level).alias("section"), F.lit("malformed_rows").alias("metric"), F.col("path").alias("key"), F.col("n_rows").cast("double").alias("value"), F.lit("set aside").alias("detail"))
    return rejected_rows(rejected_files(spark, bronze), level).unionByName(bad)


def rejected_rows(rejected: DataFrame, level: str) -> DataFrame:
    """Files set aside as report rows."""
    return rejected.select(
        F.lit(level).alias("section"), F.lit("rejected_file").alias("metric"), F.col("path").alias("key"), F.lit(1.0).alias("value"), F.col("reason").alias("detail")
    )


def build_star(joined: DataFrame, root: str, lookup: str = "full") -> dict[str, DataFrame]:
    """Stores the three dimensions, then the fact table looked up from them."""
    dims = write_star(
        {"dim_spe": dim_spe(joined), "dim_conjunto": dim_conjunto(joined), "dim_tempo": dim_tempo(joined)}, root
    )
    fact = fact_generation(joined, dims["dim_spe"], dims["dim_conjunto"], dims["dim_tempo"], lookup)
    return {**dims, **write_star({"fact_generation": fact}, root)}


def run_validation(
    spark: SparkSession, joined_path: str, report_path: str, threshold: float = 95, expected_month: int | None = None
) -> DataFrame:
    """All checks over the stored joined table, written as one report."""
    joined = read_partitioned(spark, joined_path)
    write_report(validation_report(joined, threshold=threshold, expected_month=expected_month), report_path)
    return read_report(spark, report_path)
