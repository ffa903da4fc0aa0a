"""Checks over the joined table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windgrid.functions import month_number
from windgrid.operators.coverage import SERIES_KEYS, hour_coverage, with_alert
from windgrid.operators.longform import long_rows
from windgrid.schemas import JOINED_SCHEMA, TS

WIND_SPEED_RANGE = (0, 40)


def check_schema(df: DataFrame, expected: T.StructType = JOINED_SCHEMA, with_counts: bool = False) -> DataFrame:
    """One row per expected column: its expected and found type and its status.

    Columns beyond the expected ones are not looked at. Everything comes from ``df.schema`` and no data is
    read, unless ``with_counts`` adds each column's non-null rows, in one aggregation over those columns.
    """
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows, counts = [], []
    for field in expected.fields:
        want, have = field.dataType.simpleString(), found.get(field.name)
        row = {
            "column_name": field.name,
            "expected_type": want,
            "found_type": have or "",
            "status": "missing" if have is None else "ok" if have == want else "invalid_type",
        }
        cells = [F.lit(value).alias(name) for name, value in row.items()]
        if with_counts:
            filled = F.lit(0).cast("bigint") if have is None else F.count(F.col(field.name))
            counts.append(filled.alias(f"_{field.name}"))
            cells.append(F.col(f"_{field.name}").alias("non_null_rows"))
        rows.append(F.struct(*cells))
    base = df.agg(*counts) if with_counts else df.sparkSession.range(1)
    return base.select(F.inline(F.array(*rows)))


def schema_valid(df: DataFrame, expected: T.StructType = JOINED_SCHEMA) -> bool:
    """Whether all expected columns are there with the expected types; reads metadata only."""
    found = {f.name: f.dataType for f in df.schema.fields}
    return all(found.get(f.name) == f.dataType for f in expected.fields)


def freshness(
    df: DataFrame, year: str = "year", month: str = "month", expected_month: int | None = None
) -> DataFrame:
    """The latest year and the latest month within it.

    ``freshness_valid`` is true unless ``expected_month`` (such as 202601) is given and not reached.
    """
    latest = F.max(month_number(F.col(year).cast("bigint"), F.col(month).cast("bigint")))
    valid = F.lit(True) if expected_month is None else F.coalesce(F.col("_latest") >= expected_month, F.lit(False))
    return df.agg(latest.alias("_latest")).select(
        F.floor(F.col("_latest") / 100).alias("latest_year"),
        F.pmod("_latest", F.lit(100)).alias("latest_month"),
        valid.alias("freshness_valid"),
    )


def row_rules() -> dict[str, Column]:
    """The rules that one row can break, as conditions. Null breaks only the range and the project rule."""
    low, high = WIND_SPEED_RANGE
    in_range = F.coalesce(F.col("val_ventoverificado").between(low, high), F.lit(False))
    return {
        "negative_generation": F.col("val_geracao") < 0,
        "invalid_estimated_generation": F.col("val_geracaoestimada") < 0,
        "invalid_verified_generation": F.col("val_geracaoverificada") < 0,
        "invalid_wind_speed": ~in_range,
        # NaN, which Spark sorts above every number, breaks no rule.
        "generation_reference_invalid": (F.col("val_geracao") > F.col("val_geracaoreferencia")) & ~F.isnan("val_geracao"),
        "invalid_availability": F.col("val_disponibilidade") < 0,
        "null_projects": F.col("projeto").isNull(),
    }


def business_rules(df: DataFrame, unique: Sequence[str] = (*SERIES_KEYS, TS)) -> DataFrame:
    """Violations per rule, as rows (``rule``, ``violations``).

    One scan and one shuffle: rows are first counted per ``unique`` key together with the other rules'
    violations, inside each task before the shuffle, so copies of one key never travel one by one. The
    first row of a key is no duplicate, null keys are equal.
    """
    # The names of the rules, here and in row_rules.
    rules = row_rules()
    per_key = df.groupBy(*unique).agg(
        F.count("*").alias("_rows"), *[F.count_if(broken).alias(name) for name, broken in rules.items()]
    )
    lines = [(name, F.coalesce(F.sum(name), F.lit(0))) for name in rules]
    lines.insert(6, ("duplicate_timestamps", F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0))))
    return long_rows(per_key, ["rule"], lines, "violations", "bigint")


def validation_report(
    df: DataFrame,
    expected: T.StructType = JOINED_SCHEMA,
    keys: Sequence[str] = SERIES_KEYS,
    ts: str = TS,
    threshold: float = 95,
    expected_month: int | None = None,
) -> DataFrame:
    """All checks as rows (``section``, ``metric``, ``key``, ``value``, ``detail``).

    Each section reads only its own columns. Pass a stored table: a lazy plan would run once per section.
    """
    schema = check_schema(df, expected)
    broken = schema.filter(F.col("status") != "ok").select(
        F.lit("schema_validation").alias("section"),
        F.when(F.col("status") == "missing", "missing_columns").otherwise("invalid_types").alias("metric"),
        F.col("column_name").alias("key"),
        F.lit(1.0).alias("value"),
        F.concat_ws("; ", F.concat(F.lit("expected "), "expected_type"), F.concat(F.lit("found "), F.nullif("found_type", F.lit("")))).alias("detail"),
    )
    verdict = schema.agg(F.min((F.col("status") == "ok").cast("double")).alias("value")).select(
        *_labels("schema_validation", "schema_valid"), "value", F.lit("").alias("detail")
    )
    fresh = freshness(df, expected_month=expected_month).select(
        F.inline(
            F.array(*[_line("freshness_validation", m, F.lit(""), F.col(m)) for m in ("latest_year", "latest_month", "freshness_valid")])
        )
    )
    rules = business_rules(df, (*keys, ts)).select(
        *_labels("business_rules"), F.col("rule").alias("metric"), F.lit("").alias("key"), F.col("violations").cast("double").alias("value"), F.lit("").alias("detail")
    )
    series = F.concat_ws(" | ", *keys)
    covered = with_alert(hour_coverage(df, keys, ts), threshold)
    alert = F.when(F.col("below_threshold"), F.lit("below threshold")).otherwise(F.lit(""))
    coverage = covered.select(
        F.inline(
            F.array(
                _line("timestamp_continuity", "gap_count", series, F.col("gap_count")),
                _line("completeness_validation", "completeness_percentage", series, F.col("completeness_pct"), alert),
            )
        )
    )
    limit = verdict.select(
        *_labels("completeness_validation", "threshold"), F.lit(float(threshold)).alias("value"), F.lit("").alias("detail")
    )
    report = broken
    for part in (verdict, fresh, rules, coverage, limit):
        report = report.unionByName(part)
    return report


def _labels(section: str, metric: str | None = None) -> list[Column]:
    labels = [F.lit(section).alias("section")]
    if metric is not None:
        labels += [F.lit(metric).alias("metric"), F.lit("").alias("key")]
    return labels


def _line(section: str, metric: str, key: Column, value: Column, detail: Column | None = None) -> Column:
    return F.struct(
        F.lit(section).alias("section"),
        F.lit(metric).alias("metric"),
        key.alias("key"),
        value.cast("double").alias("value"),
        (F.lit("") if detail is None else detail).alias("detail"),
    )
