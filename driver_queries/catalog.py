"""Every registered query with its SQL twin. Names are the same on both sides."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driver_queries import adapter as a
from windgrid.functions import decimal_sum, is_bad_timestamp, is_uncastable, to_double, to_timestamp
from windgrid.operators import assets, clean, coverage, levels, metrics, quality, rollup, star, validate
from windgrid.plans import build_star, read_lake, run_delivery, run_from_landing, run_new_months, run_pipeline, run_report, run_validation
from windgrid.schemas import COMPLEX_NUMERIC, COMPLEX_PAYLOAD, PLANT_NUMERIC
from windgrid.session import at_once, shared_folder
from windgrid.sinks import (
    partition_columns,
    write_csv,
    write_layer,
    write_partitioned,
    write_report,
    write_table,
)
from windgrid.sources import files, months
from windgrid.streaming import ingest_landing, malformed_rows

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        ORACLES[name] = sql
        return query

    return add


def bigints(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def with_tables(*tables: str) -> str:
    return "WITH " + ",".join(tables)


# --- joined tables ------------------------------------------------------------------------------

PAYLOAD_SQL = ", ".join(f"w.{c}" for c in COMPLEX_PAYLOAD)
SPE_KEEP = "spe_kept AS (SELECT * FROM spe WHERE flg_dadoventoinvalido = 0)"
JOINED_SQL = f"""
joined AS (
  SELECT s.*, {PAYLOAD_SQL}
  FROM spe_kept s LEFT JOIN wind w
    ON UPPER(TRIM(s.nom_conjuntousina)) = UPPER(TRIM(w.nom_usina)) AND s.din_instante = w.din_instante
)"""
JOINED = with_tables(a.SPE_SQL, SPE_KEEP, a.WIND_SQL, JOINED_SQL)
COLLAPSED = "UPPER(TRIM(regexp_replace({0}, '\\s+', ' ', 'g')))"


def spe_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.spe(spark, sf_dir)
    return rows.filter(clean.is_valid_flag(rows, "flg_dadoventoinvalido"))


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return levels.join_levels(spe_kept(spark, sf_dir), a.wind(spark, sf_dir))


def stored_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined table as readers see it: stored by year and month."""
    path = shared_folder(spark, "joined")
    write_partitioned(joined(spark, sf_dir), path, "din_instante")
    return files.read_partitioned(spark, path)


# --- assets -------------------------------------------------------------------------------------

CODED_SQL = f"""
coded AS (
  SELECT c_custkey, c_name,
         CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN 'NO CODE'
              ELSE 'EOL.CV.RN.' || {a.CODE_SQL.format("c_custkey")} || '.1' END AS ceg
  FROM customer
)"""


def coded_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    code = F.concat(F.lit("EOL.CV.RN."), a.code_of("c_custkey"), F.lit(".1"))
    ceg = F.when(key % 17 == 0, None).when(key % 19 == 0, "NO CODE").otherwise(code)
    return a.table(spark, sf_dir, "customer").select("c_custkey", "c_name", ceg.alias("ceg"))


ASSET_SQL = with_tables(CODED_SQL, a.MAPPING_SQL) + r"""
SELECT c.*, m.projeto FROM coded c JOIN mapping m ON regexp_extract(c.ceg, '(\d{6,7}-\d)') = m.ceg"""


@register("asset_code_join", ASSET_SQL)
def asset_code_join(spark, sf_dir):
    return assets.attach_project(coded_customers(spark, sf_dir), a.mapping(spark, sf_dir))


@register(
    "membership_left",
    with_tables(CODED_SQL, a.MAPPING_SQL)
    + r""", members AS (
  SELECT *, regexp_extract(ceg, '(\d{6,7}-\d)') AS code FROM coded
  WHERE regexp_extract(ceg, '(\d{6,7}-\d)') IN (SELECT ceg FROM mapping)
)
SELECT c.c_custkey, c.c_name, c.ceg, m.projeto FROM members c LEFT JOIN mapping m ON c.code = m.ceg""",
)
def membership_left(spark, sf_dir):
    return assets.attach_project(coded_customers(spark, sf_dir), a.mapping(spark, sf_dir), method="member")


@register(
    "asset_semi",
    with_tables(a.SPE_SQL, a.WIND_SQL)
    + " SELECT * FROM wind WHERE UPPER(TRIM(nom_usina)) IN (SELECT DISTINCT UPPER(TRIM(nom_conjuntousina)) FROM spe)",
)
def asset_semi(spark, sf_dir):
    return assets.restrict_to_names(a.wind(spark, sf_dir), assets.distinct_names(a.spe(spark, sf_dir)))


@register(
    "asset_semi_collapse",
    with_tables(a.SPE_SQL, a.WIND_SQL)
    + f" SELECT * FROM wind WHERE {COLLAPSED.format('nom_usina')} IN"
    + f" (SELECT DISTINCT {COLLAPSED.format('nom_conjuntousina')} FROM spe)",
)
def asset_semi_collapse(spark, sf_dir):
    names = assets.distinct_names(a.spe(spark, sf_dir), collapse_ws=True)
    return assets.restrict_to_names(a.wind(spark, sf_dir), names, collapse_ws=True)


# --- joins of the two levels --------------------------------------------------------------------


@register("level_join", JOINED + " SELECT * FROM joined")
def level_join(spark, sf_dir):
    return joined(spark, sf_dir)


@register(
    "level_join_salted_collapse",
    with_tables(a.SPE_SQL, SPE_KEEP, a.WIND_SQL)
    + f""" SELECT s.*, {PAYLOAD_SQL} FROM spe_kept s LEFT JOIN wind w
  ON {COLLAPSED.format("s.nom_conjuntousina")} = {COLLAPSED.format("w.nom_usina")} AND s.din_instante = w.din_instante""",
)
def level_join_salted_collapse(spark, sf_dir):
    return levels.join_levels(spe_kept(spark, sf_dir), a.wind(spark, sf_dir), collapse_ws=True, salt=4)


@register("level_join_hot_pairs", JOINED + " SELECT * FROM joined")
def level_join_hot_pairs(spark, sf_dir):
    """Pairs of more than two rows found by the sketch are cut into slots."""
    rows = spe_kept(spark, sf_dir)
    return levels.join_levels(rows, a.wind(spark, sf_dir), hot=levels.hot_pairs(rows, rows_per_slot=2, most=200))


@register(
    "level_join_dedupe",
    with_tables(a.SPE_SQL, SPE_KEEP, a.WIND_SQL)
    + f""", ranked AS (
  SELECT *, {COLLAPSED.format("nom_usina")} AS k, row_number() OVER (
    PARTITION BY {COLLAPSED.format("nom_usina")} ORDER BY din_instante NULLS LAST, nom_usina NULLS LAST) AS rn
  FROM wind
)
SELECT s.*, {PAYLOAD_SQL} FROM spe_kept s LEFT JOIN (SELECT * FROM ranked WHERE rn = 1) w
  ON {COLLAPSED.format("s.nom_conjuntousina")} IS NOT DISTINCT FROM w.k""",
)
def level_join_dedupe(spark, sf_dir):
    return levels.dedupe_then_join(spe_kept(spark, sf_dir), a.wind(spark, sf_dir), store=shared_folder(spark, "firsts"))


@register(
    "join_metrics",
    JOINED
    + """ SELECT COUNT(*) AS total_records, COUNT(nom_estado) AS matched_records,
  ROUND(COUNT(nom_estado)::DOUBLE / NULLIF(COUNT(*), 0)::DOUBLE * 100, 2) AS match_rate_pct FROM joined""",
)
def join_metrics(spark, sf_dir):
    return levels.join_metrics(joined(spark, sf_dir))


# --- cleaning -----------------------------------------------------------------------------------


def number_sql(c: str) -> str:
    return f"CASE WHEN NOT isnan(TRY_CAST({c} AS DOUBLE)) THEN TRY_CAST({c} AS DOUBLE) END"


def typed_sql(columns: Sequence[str], numeric: Sequence[str]) -> str:
    def typed(c: str) -> str:
        if c == "din_instante":
            return "TRY_CAST(din_instante AS TIMESTAMP) AS din_instante"
        return f"{number_sql(c)} AS {c}" if c in numeric else c

    return ", ".join(map(typed, columns)) + ", TRY_CAST(din_instante AS TIMESTAMP) AS data_hora"


CLEAN_SPE_SQL = f"""
spe_clean AS (
  SELECT {typed_sql(a.RAW_SPE_COLUMNS, [*PLANT_NUMERIC, "flg_dadoventoinvalido"])}
  FROM (SELECT DISTINCT * FROM raw_spe WHERE TRY_CAST(flg_dadoventoinvalido AS DOUBLE) = 0)
)"""
CLEAN_WIND_SQL = f"""
wind_clean AS (
  SELECT {typed_sql(a.RAW_WIND_COLUMNS, COMPLEX_NUMERIC)} FROM (SELECT DISTINCT * FROM raw_wind)
)"""


@register("clean_spe", with_tables(a.RAW_SPE_SQL, CLEAN_SPE_SQL) + " SELECT * FROM spe_clean")
def clean_spe(spark, sf_dir):
    return clean.clean_spe(a.raw_spe(spark, sf_dir))


@register("clean_wind", with_tables(a.RAW_WIND_SQL, CLEAN_WIND_SQL) + " SELECT * FROM wind_clean")
def clean_wind(spark, sf_dir):
    return clean.clean_wind(a.raw_wind(spark, sf_dir))


@register(
    "cast_audit",
    with_tables(a.RAW_SPE_SQL)
    + f""" SELECT COUNT(*) AS n_rows,
  COUNT(*) FILTER (val_ventoverificado IS NOT NULL AND TRY_CAST(val_ventoverificado AS DOUBLE) IS NULL) AS bad_speed,
  COUNT(*) FILTER (val_geracaoestimada IS NOT NULL AND TRY_CAST(val_geracaoestimada AS DOUBLE) IS NULL) AS bad_estimate,
  COUNT(*) FILTER (TRY_CAST(din_instante AS TIMESTAMP) IS NULL) AS bad_dates,
  COUNT({number_sql("val_ventoverificado")}) AS good_speed,
  CAST(SUM(CAST({number_sql("val_ventoverificado")} AS DECIMAL(28,6))) AS DOUBLE) AS total_speed,
  MIN(TRY_CAST(din_instante AS TIMESTAMP)) AS first_ts, MAX(TRY_CAST(din_instante AS TIMESTAMP)) AS last_ts
FROM raw_spe""",
)
def cast_audit(spark, sf_dir):
    speed, estimate, ts = F.col("val_ventoverificado"), F.col("val_geracaoestimada"), F.col("din_instante")
    return a.raw_spe(spark, sf_dir).agg(
        F.count("*").alias("n_rows"),
        F.count_if(is_uncastable(speed)).alias("bad_speed"),
        F.count_if(is_uncastable(estimate)).alias("bad_estimate"),
        F.count_if(is_bad_timestamp(ts)).alias("bad_dates"),
        F.count(to_double(speed)).alias("good_speed"),
        F.sum(to_double(speed).cast("decimal(28,6)")).cast("double").alias("total_speed"),
        F.min(to_timestamp(ts)).alias("first_ts"),
        F.max(to_timestamp(ts)).alias("last_ts"),
    )


# --- quality ------------------------------------------------------------------------------------

LONG = "SELECT '{s}' AS section, '{m}' AS metric, '{k}' AS key, CAST(({v}) AS DOUBLE) AS value"


def _long(section: str, metric: str, key: str, value: str) -> str:
    return LONG.format(s=section, m=metric, k=key, v=value)


def _quality_sql(level: str, numeric: Sequence[str], columns: Sequence[str], flag: bool, from_raw: bool) -> str:
    raw, kept = f"raw_{level}", f"{level}_clean"
    distinct = f"(SELECT DISTINCT * FROM {raw})"
    valid = " WHERE TRY_CAST(flg_dadoventoinvalido AS DOUBLE) = 0" if flag else ""
    kept_raw = f"(SELECT DISTINCT * FROM {raw}{valid})"
    stats = f"{level}_stats"
    lines = [
        _long(stats, "initial_rows", "", f"SELECT COUNT(*) FROM {raw}"),
        _long(stats, "duplicates_removed", "", f"(SELECT COUNT(*) FROM {raw}) - (SELECT COUNT(*) FROM {distinct})"),
    ]
    if flag:
        flagged = (
            f"SELECT COUNT(*) FROM {raw} WHERE flg_dadoventoinvalido = '1'"
            if from_raw
            else f"(SELECT COUNT(*) FROM {distinct}) - (SELECT COUNT(*) FROM {kept_raw})"
        )
        lines.append(_long(stats, "invalid_wind_filtered", "", flagged))
    source = raw if from_raw else kept_raw
    lines.append(_long(stats, "invalid_dates", "", f"SELECT COUNT(*) FROM {source} WHERE TRY_CAST(din_instante AS TIMESTAMP) IS NULL"))
    for c in numeric:
        bad = f"{c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL" if from_raw else f"({number_sql(c)}) IS NULL"
        lines.append(_long(stats, "invalid_numeric_values", c, f"SELECT COUNT(*) FROM {source} WHERE {bad}"))
    lines.append(_long(stats, "final_rows", "", f"SELECT COUNT(*) FROM {kept}"))
    for c in [*columns, "data_hora"]:
        share = f"SELECT ROUND(100.0::DOUBLE * SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) / COUNT(*), 2) FROM {kept}"
        lines.append(_long(f"{level}_nulls", "null_pct", c, share))
    return " UNION ALL ".join(lines)


def _report_sql(from_raw: bool, raw: Sequence[str] = (a.RAW_SPE_SQL, a.RAW_WIND_SQL)) -> str:
    ctes = with_tables(*raw, CLEAN_SPE_SQL, CLEAN_WIND_SQL)
    plants = _quality_sql("spe", PLANT_NUMERIC, a.RAW_SPE_COLUMNS, True, from_raw)
    complexes = _quality_sql("wind", COMPLEX_NUMERIC, a.RAW_WIND_COLUMNS, False, from_raw)
    return f"{ctes} {plants} UNION ALL {complexes}"


@register("quality_report_long", _report_sql(from_raw=True))
def quality_report_long(spark, sf_dir):
    path = shared_folder(spark, "quality")
    write_report(quality.quality_report(a.raw_spe(spark, sf_dir), a.raw_wind(spark, sf_dir)), path)
    return files.read_report(spark, path).drop("detail")


@register("quality_counts", _report_sql(from_raw=False))
def quality_counts(spark, sf_dir):
    return quality.quality_report(a.raw_spe(spark, sf_dir), a.raw_wind(spark, sf_dir), rules="cleaned")


@register(
    "null_pct",
    with_tables(a.SPE_SQL)
    + " "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, ROUND(100.0::DOUBLE * COUNT(*) FILTER ({c} IS NULL) / COUNT(*), 2) AS null_pct FROM spe"
        for c in [*a.RAW_SPE_COLUMNS, "projeto"]
    ),
)
def null_pct(spark, sf_dir):
    return quality.null_percentages(a.spe(spark, sf_dir))


# --- validation ---------------------------------------------------------------------------------

RULES_SQL = """
rules AS (
  SELECT 'negative_generation' AS rule, COUNT(*) FILTER (val_geracao < 0) AS violations FROM joined
  UNION ALL SELECT 'invalid_estimated_generation', COUNT(*) FILTER (val_geracaoestimada < 0) FROM joined
  UNION ALL SELECT 'invalid_verified_generation', COUNT(*) FILTER (val_geracaoverificada < 0) FROM joined
  UNION ALL SELECT 'invalid_wind_speed', COUNT(*) FILTER (NOT COALESCE(val_ventoverificado BETWEEN 0 AND 40, FALSE)) FROM joined
  UNION ALL SELECT 'generation_reference_invalid', COUNT(*) FILTER (val_geracao > val_geracaoreferencia) FROM joined
  UNION ALL SELECT 'invalid_availability', COUNT(*) FILTER (val_disponibilidade < 0) FROM joined
  UNION ALL SELECT 'duplicate_timestamps', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT)
    FROM (SELECT COUNT(*) AS n FROM joined GROUP BY projeto, nom_usina, din_instante)
  UNION ALL SELECT 'null_projects', COUNT(*) FILTER (projeto IS NULL) FROM joined
)"""


@register("business_rules", f"{JOINED},{RULES_SQL} SELECT * FROM rules")
def business_rules(spark, sf_dir):
    return validate.business_rules(joined(spark, sf_dir))


@register(
    "freshness",
    """SELECT MAX(year(ts)) AS latest_year,
  MAX(month(ts)) FILTER (year(ts) = (SELECT MAX(year(ts)) FROM events)) AS latest_month, TRUE AS freshness_valid FROM events""",
)
def freshness(spark, sf_dir):
    return validate.freshness(partition_columns(a.table(spark, sf_dir, "events"), "ts"))


def _gaps_sql(keys: str, source: str, ts: str) -> str:
    return f"""
hours AS (SELECT DISTINCT {keys}, date_trunc('hour', {ts}) AS h FROM {source}),
steps AS (SELECT *, lag(h) OVER (PARTITION BY {keys} ORDER BY h) AS prev FROM hours),
gaps AS (SELECT {keys}, COUNT(*) FILTER (h - prev > INTERVAL 1 HOUR) AS gap_count FROM steps GROUP BY ALL),
extent AS (
  SELECT {keys}, COUNT(*) AS received_hours, date_diff('hour', MIN(h), MAX(h)) + 1 AS expected_hours FROM hours GROUP BY ALL
),
complete AS (
  SELECT *, ROUND(received_hours::DOUBLE / expected_hours::DOUBLE * 100, 2) AS completeness_pct FROM extent
)"""


@register("continuity", f"WITH {_gaps_sql('event_type, user_id', 'events', 'ts')} SELECT * FROM gaps")
def continuity(spark, sf_dir):
    return coverage.timestamp_continuity(a.table(spark, sf_dir, "events"), ["event_type", "user_id"], "ts")


@register(
    "completeness",
    f"WITH {_gaps_sql('event_type', 'events', 'ts')} SELECT *, completeness_pct < 95 AS below_threshold FROM complete",
)
def completeness(spark, sf_dir):
    return coverage.completeness(a.table(spark, sf_dir, "events"), ["event_type"], "ts")


@register(
    "missing_hours",
    """WITH seen AS (SELECT DISTINCT event_type, date_trunc('hour', ts) AS h FROM events),
spans AS (SELECT event_type, MIN(h) AS first_h, MAX(h) AS last_h FROM seen GROUP BY 1),
grid AS (SELECT event_type, unnest(generate_series(first_h, last_h, INTERVAL 1 HOUR)) AS missing_hour FROM spans)
SELECT g.event_type, g.missing_hour FROM grid g ANTI JOIN seen s ON g.event_type = s.event_type AND g.missing_hour = s.h""",
)
def missing_hours(spark, sf_dir):
    return coverage.list_missing_hours(a.table(spark, sf_dir, "events"), ["event_type"], "ts")


@register(
    "gap_ranges",
    f"""WITH {_gaps_sql("event_type, user_id", "events", "ts")}
SELECT event_type, user_id, prev + INTERVAL 1 HOUR AS gap_start, h - INTERVAL 1 HOUR AS gap_end,
  date_diff('hour', prev, h) - 1 AS missing_hours
FROM steps WHERE h - prev > INTERVAL 1 HOUR""",
)
def gap_ranges(spark, sf_dir):
    return coverage.missing_hours(a.table(spark, sf_dir, "events"), ["event_type", "user_id"], "ts")


EXPECTED_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("region", T.StringType()),
    ]
)


def _schema_line(column: str, expected: str) -> str:
    found = f"CASE any_value(typeof({column})) WHEN 'BIGINT' THEN 'bigint' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' END"
    return (
        f"SELECT '{column}' AS column_name, '{expected}' AS expected_type, {found} AS found_type,"
        f" CASE WHEN {found} = '{expected}' THEN 'ok' ELSE 'invalid_type' END AS status,"
        f" COUNT({column}) AS non_null_rows FROM events"
    )


@register(
    "schema_check",
    " UNION ALL ".join(
        _schema_line(c, t)
        for c, t in (("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "string"), ("value", "double"))
    )
    + " UNION ALL SELECT 'region', 'string', '', 'missing', 0",
)
def schema_check(spark, sf_dir):
    return validate.check_schema(a.table(spark, sf_dir, "events"), EXPECTED_EVENTS, with_counts=True)


def _as_report(section: str, metric: str, key: str, value: str, source: str, detail: str = "''") -> str:
    return f"SELECT '{section}' AS section, {metric} AS metric, {key} AS key, CAST({value} AS DOUBLE) AS value, {detail} AS detail FROM {source}"


SERIES_SQL = "projeto || ' | ' || nom_usina"


@register(
    "validation_report",
    f"{JOINED},{RULES_SQL},{_gaps_sql('projeto, nom_usina', 'joined', 'din_instante')} "
    + " UNION ALL ".join(
        [
            _as_report("schema_validation", "'schema_valid'", "''", "1", "(SELECT 1)"),
            _as_report("freshness_validation", "'latest_year'", "''", "MAX(year(din_instante))", "joined"),
            _as_report(
                "freshness_validation",
                "'latest_month'",
                "''",
                "MAX(year(din_instante) * 100 + month(din_instante)) % 100",
                "joined",
            ),
            _as_report("freshness_validation", "'freshness_valid'", "''", "1", "(SELECT 1)"),
            _as_report("business_rules", "rule", "''", "violations", "rules"),
            _as_report("timestamp_continuity", "'gap_count'", SERIES_SQL, "gap_count", "gaps"),
            _as_report(
                "completeness_validation",
                "'completeness_percentage'",
                SERIES_SQL,
                "completeness_pct",
                "complete",
                "CASE WHEN completeness_pct < 95 THEN 'below threshold' ELSE '' END",
            ),
            _as_report("completeness_validation", "'threshold'", "''", "95", "(SELECT 1)"),
        ]
    ),
)
def validation_report(spark, sf_dir):
    path = shared_folder(spark, "joined")
    write_partitioned(joined(spark, sf_dir), path, "din_instante")
    return run_validation(spark, path, shared_folder(spark, "validation"))


# --- questions ----------------------------------------------------------------------------------


@register("projects", JOINED + " SELECT DISTINCT projeto, nom_estado, nom_subsistema FROM joined")
def projects(spark, sf_dir):
    return metrics.projects(joined(spark, sf_dir))


def _generation_sql(pattern: str, condition: str) -> str:
    return (
        f"{JOINED} SELECT strftime(din_instante, '{pattern}') AS period,"
        " COALESCE(CAST(SUM(CAST(val_geracao AS DECIMAL(28,6))) AS DOUBLE), 0.0::DOUBLE) AS total_generation, 'click' AS projeto"
        f" FROM joined WHERE projeto = 'click' {condition} GROUP BY 1"
    )


@register(
    "generation_daily",
    _generation_sql("%Y-%m-%d", "AND din_instante >= TIMESTAMP '2024-01-05' AND din_instante <= TIMESTAMP '2024-01-25'"),
)
def generation_daily(spark, sf_dir):
    table = stored_joined(spark, sf_dir)
    return metrics.generation(table, "click", "2024-01-05", "2024-01-25", sum_scale=6)


@register("generation_monthly", _generation_sql("%Y-%m", ""))
def generation_monthly(spark, sf_dir):
    return metrics.generation(joined(spark, sf_dir), "click", frequency="monthly", sum_scale=6)


FLAGSHIP_SQL = (
    JOINED
    + """ SELECT COALESCE(cod_razaorestricao, 'WITHOUT_RESTRICTION') AS cod_razaorestricao,
  COUNT(din_instante) AS total_hours,
  CAST(SUM(CAST(val_geracaoreferencia - val_geracao AS DECIMAL(28,6))) AS DOUBLE) AS total_mwh_restricted
FROM joined WHERE val_geracao < val_geracaoreferencia GROUP BY 1"""
)


@register("restrictions_by_reason", FLAGSHIP_SQL)
def restrictions_by_reason(spark, sf_dir):
    return metrics.restrictions_summary(joined(spark, sf_dir), sum_scale=6)


@register(
    "restrictions_summary",
    """SELECT COALESCE(NULLIF(l_returnflag, 'N'), 'WITHOUT_RESTRICTION') AS cod_razaorestricao,
  COUNT(l_shipdate) AS total_hours,
  CAST(SUM(CAST(l_extendedprice - l_extendedprice * (1 - l_discount) AS DECIMAL(28,4))) AS DOUBLE) AS total_mwh_restricted
FROM lineitem WHERE l_extendedprice * (1 - l_discount) < l_extendedprice GROUP BY 1""",
)
def restrictions_summary(spark, sf_dir):
    rows = a.table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("din_instante"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("val_geracao"),
        F.col("l_extendedprice").alias("val_geracaoreferencia"),
        F.nullif("l_returnflag", F.lit("N")).alias("cod_razaorestricao"),
    )
    return metrics.restrictions_summary(rows, sum_scale=4)


# --- star schema --------------------------------------------------------------------------------


def _dim_sql(name: str, key: str, columns: Sequence[str]) -> str:
    text = ", ".join(f"COALESCE({c}, '')" for c in columns)
    order = ", ".join(f"{c} NULLS LAST" for c in columns)
    names = ", ".join(columns)
    return f"""
{name} AS (
  SELECT {names}, row_number() OVER (ORDER BY md5(concat_ws(chr(1), {text})), {order}) AS {key}
  FROM (SELECT DISTINCT {names} FROM joined)
)"""


DIM_SPE_SQL = _dim_sql("dim_spe", "spe_key", star.DIM_SPE)
DIM_CONJUNTO_SQL = _dim_sql("dim_conjunto", "conjunto_key", star.DIM_CONJUNTO)
DIM_TEMPO_SQL = """
dim_tempo AS (
  SELECT din_instante, row_number() OVER (ORDER BY din_instante) AS tempo_key, year(din_instante) AS ano,
         month(din_instante) AS mes, day(din_instante) AS dia, hour(din_instante) AS hora
  FROM (SELECT DISTINCT din_instante FROM {0})
)"""


@register("dim_spe", f"{JOINED},{DIM_SPE_SQL} SELECT * FROM dim_spe")
def dim_spe(spark, sf_dir):
    return star.dim_spe(joined(spark, sf_dir))


@register(
    "dim_append",
    f"""{JOINED}, first AS (SELECT * FROM joined WHERE projeto = 'click'), {_dim_sql("dim_spe", "spe_key", star.DIM_SPE).replace("FROM joined", "FROM first")},
later AS (SELECT * FROM joined j WHERE NOT EXISTS (SELECT 1 FROM dim_spe s WHERE {" AND ".join(f"j.{c} IS NOT DISTINCT FROM s.{c}" for c in star.DIM_SPE)})),
{_dim_sql("dim_new", "spe_key", star.DIM_SPE).replace("FROM joined", "FROM later")}
SELECT * FROM dim_spe UNION ALL BY NAME SELECT * REPLACE (spe_key + (SELECT COUNT(*) FROM dim_spe) AS spe_key) FROM dim_new""",
)
def dim_append(spark, sf_dir):
    """Plants of one project first, then those of all: the first ones keep their keys."""
    rows = joined(spark, sf_dir)
    first = write_layer(star.dim_spe(rows.filter("projeto = 'click'")), shared_folder(spark, "dim"))
    return star.append_dimension(first, rows, star.DIM_SPE, "spe_key")


@register("dim_conjunto", f"{JOINED},{DIM_CONJUNTO_SQL} SELECT * FROM dim_conjunto")
def dim_conjunto(spark, sf_dir):
    return star.dim_conjunto(joined(spark, sf_dir))


@register(
    "dim_tempo",
    "WITH dates AS (SELECT o_orderdate AS din_instante FROM orders),"
    + DIM_TEMPO_SQL.format("dates")
    + " SELECT * FROM dim_tempo",
)
def dim_tempo(spark, sf_dir):
    dates = a.table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("din_instante"))
    return bigints(star.dim_tempo(dates), "ano", "mes", "dia", "hora")


def _fact_sql(spe_keys: Sequence[str], conjunto_keys: Sequence[str]) -> str:
    def on(dim: str, keys: Sequence[str]) -> str:
        return " AND ".join(f"j.{k} IS NOT DISTINCT FROM {dim}.{k}" for k in keys)

    measures = ", ".join(f"j.{c}" for c in star.FACT_MEASURES)
    return f"""{JOINED},{DIM_SPE_SQL},{DIM_CONJUNTO_SQL},{DIM_TEMPO_SQL.format("joined")}
SELECT s.spe_key, c.conjunto_key, t.tempo_key, {measures}, COALESCE(j.cod_razaorestricao, 'SEM_RESTRICAO') AS cod_razaorestricao
FROM joined j LEFT JOIN dim_spe s ON {on("s", spe_keys)} LEFT JOIN dim_conjunto c ON {on("c", conjunto_keys)}
LEFT JOIN dim_tempo t ON j.din_instante IS NOT DISTINCT FROM t.din_instante"""


@register("fact_generation", _fact_sql(star.DIM_SPE, star.DIM_CONJUNTO))
def fact_generation(spark, sf_dir):
    return build_star(stored_joined(spark, sf_dir), shared_folder(spark, "star"))["fact_generation"]


@register("fact_generation_subset", _fact_sql(star.SHORT_SPE, star.SHORT_CONJUNTO))
def fact_generation_subset(spark, sf_dir):
    return build_star(stored_joined(spark, sf_dir), shared_folder(spark, "star"), lookup="short")["fact_generation"]


# --- months -------------------------------------------------------------------------------------


@register(
    "month_range",
    """SELECT year(m) AS year, lpad(CAST(month(m) AS VARCHAR), 2, '0') AS month FROM (
  SELECT unnest(generate_series(date_trunc('month', MIN(o_orderdate)), MAX(o_orderdate), INTERVAL 1 MONTH)) AS m FROM orders)""",
)
def month_range(spark, sf_dir):
    return bigints(months.month_span(a.table(spark, sf_dir, "orders"), "o_orderdate"), "year")


@register(
    "month_coverage",
    """WITH expected AS (
  SELECT unnest(generate_series(TIMESTAMP '1991-07-01', TIMESTAMP '2003-02-01', INTERVAL 1 MONTH)) AS m)
SELECT year(m) AS year, lpad(CAST(month(m) AS VARCHAR), 2, '0') AS month FROM expected
WHERE m NOT IN (SELECT date_trunc('month', o_orderdate) FROM orders)""",
)
def month_coverage(spark, sf_dir):
    expected = months.month_range(spark, "1991-06-15", "2003-02-10")
    present = months.months_present(a.table(spark, sf_dir, "orders"), "o_orderdate")
    return bigints(months.missing_months(expected, present), "year")


@register("partition_columns", "SELECT *, year(o_orderdate) AS year, month(o_orderdate) AS month FROM orders")
def partition_columns_query(spark, sf_dir):
    return bigints(partition_columns(a.table(spark, sf_dir, "orders"), "o_orderdate"), "year", "month")


# --- files --------------------------------------------------------------------------------------


def _by_name_sql(as_timestamp: bool) -> str:
    """Both levels' raw rows, one below the other by name."""
    ts = "TRY_CAST(din_instante AS TIMESTAMP)" if as_timestamp else "din_instante"
    every = [*a.RAW_SPE_COLUMNS, *[c for c in a.RAW_WIND_COLUMNS if c not in a.RAW_SPE_COLUMNS]]
    part = lambda own: ", ".join(f"{ts} AS {c}" if c == "din_instante" else c if c in own else f"CAST(NULL AS VARCHAR) AS {c}" for c in every)
    return with_tables(a.RAW_SPE_SQL, a.RAW_WIND_SQL) + f" SELECT {part(a.RAW_SPE_COLUMNS)} FROM raw_spe UNION ALL SELECT {part(a.RAW_WIND_COLUMNS)} FROM raw_wind"


@register("concat_by_name", _by_name_sql(as_timestamp=True))
def concat_by_name(spark, sf_dir):
    folder = shared_folder(spark, "by-name")
    write_csv(a.raw_spe(spark, sf_dir), f"{folder}/first", sep=";")
    write_csv(a.raw_wind(spark, sf_dir).select(*reversed(a.RAW_WIND_COLUMNS)), f"{folder}/second", sep=";")
    return files.read_csv_by_name(spark, f"{folder}/*")


@register("csv_roundtrip", with_tables(a.RAW_SPE_SQL, CLEAN_SPE_SQL) + " SELECT * FROM spe_clean")
def csv_roundtrip(spark, sf_dir):
    path = shared_folder(spark, "csv")
    write_csv(a.raw_spe(spark, sf_dir), path, sep=";")
    return clean.clean_spe(files.read_raw_csv(spark, path))


@register("mapping_roundtrip", ASSET_SQL)
def mapping_roundtrip(spark, sf_dir):
    path = shared_folder(spark, "mapping")
    write_csv(a.mapping(spark, sf_dir), path)
    return assets.attach_project(coded_customers(spark, sf_dir), files.read_mapping(spark, path))


@register(
    "partitioned_roundtrip",
    JOINED + " SELECT *, year(din_instante) AS year, month(din_instante) AS month FROM joined",
)
def partitioned_roundtrip(spark, sf_dir):
    path = shared_folder(spark, "partitioned")
    rows = write_layer(joined(spark, sf_dir), shared_folder(spark, "layer"))
    write_partitioned(rows, path, "din_instante")
    write_partitioned(rows, path, "din_instante")
    return bigints(files.read_partitioned(spark, path), "year", "month")


@register("stream_ingest", _by_name_sql(as_timestamp=False))
def stream_ingest(spark, sf_dir):
    """Two deliveries and three runs: the second run finds nothing new, the third only the second delivery."""
    folder = shared_folder(spark, "landing")
    for month, rows in (("m1", a.raw_spe(spark, sf_dir)), ("m2", a.raw_wind(spark, sf_dir))):
        write_csv(rows, f"{folder}/in/{month}", sep=";")
        for _ in range(2 if month == "m1" else 1):
            bronze = ingest_landing(spark, f"{folder}/in/*", f"{folder}/bronze", f"{folder}/checkpoint", a.RAW_SPE_COLUMNS)
    return bronze.drop("source_file")


@register(
    "ingest_drift",
    with_tables(a.RAW_WIND_SQL)
    + f""" SELECT {", ".join(a.RAW_WIND_COLUMNS)}, id_ons || '+' AS extra FROM raw_wind
UNION ALL SELECT {", ".join("NULL" if c == "cod_razaorestricao" else c for c in a.RAW_WIND_COLUMNS)}, NULL FROM raw_wind
UNION ALL SELECT {", ".join(a.RAW_WIND_COLUMNS)}, NULL FROM raw_wind""",
)
def ingest_drift(spark, sf_dir):
    """Three deliveries: one more column, one column less, columns in another order."""
    folder, rows = shared_folder(spark, "drift"), a.raw_wind(spark, sf_dir)
    deliveries = (rows.withColumn("extra", F.concat("id_ons", F.lit("+"))), rows.drop("cod_razaorestricao"), rows.select(*reversed(rows.columns)))
    for k, delivery in enumerate(deliveries):
        write_csv(delivery, f"{folder}/in/m{k}", sep=";")
        bronze = ingest_landing(spark, f"{folder}/in/*", f"{folder}/bronze", f"{folder}/checkpoint", a.RAW_WIND_COLUMNS)
    return bronze.drop("source_file")


@register(
    "ingest_malformed",
    with_tables(a.DELIVERY_SQL)
    + """ SELECT nom_usina, din_instante, note, val_geracao, NULL AS reason, NULL AS line FROM delivered WHERE reason IS NULL
UNION ALL SELECT NULL, NULL, NULL, NULL, reason, nom_usina || ';' || din_instante || ';' ||
  CASE WHEN event_id % 13 = 0 THEN quoted || ';' || val_geracao || ';more' WHEN event_id % 17 = 0 THEN quoted WHEN event_id % 19 = 0 THEN '"' || event_type || ';' || val_geracao
       WHEN event_id % 23 = 0 THEN quoted || ';"' || val_geracao ELSE '"a"b;' || val_geracao END
FROM delivered WHERE reason IS NOT NULL""",
)
def ingest_malformed(spark, sf_dir):
    """Rows that fit the header, and beside them the text of those that do not, after two runs."""
    folder = shared_folder(spark, "malformed")
    lines = a.delivery_lines(spark, sf_dir)
    # One column whose name is the header line, written without any quoting: the lines as they are.
    lines.write.options(header=True, sep="\x01", quote="", escape="\x02", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{folder}/in/m")
    for _ in range(2):
        bronze = ingest_landing(spark, f"{folder}/in/*", f"{folder}/bronze", f"{folder}/checkpoint", a.DELIVERY_COLUMNS)
    return bronze.drop("source_file").unionByName(malformed_rows(spark, f"{folder}/bronze").select("reason", "line"), allowMissingColumns=True)


@register(
    "large_sums",
    """SELECT o_orderpriority, CAST(SUM(CAST(o_totalprice AS DECIMAL(38,2)) * 100000000000000) AS DOUBLE) / 100 AS exact_sum, COUNT(*) AS n
FROM orders GROUP BY o_orderpriority""",
)
def large_sums(spark, sf_dir):
    """Sums of values above 1e13 at scale 2, which pass the range of whole 64-bit numbers."""
    value = (F.col("o_totalprice").cast("decimal(18,2)") * F.lit(10**12).cast("decimal(14,0)")).cast("double")
    return a.table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(decimal_sum(value, 2).alias("exact_sum"), F.count("*").alias("n"))


PIPELINE_SQL = (
    with_tables(a.RAW_SPE_SQL, CLEAN_SPE_SQL, a.RAW_WIND_SQL, CLEAN_WIND_SQL, a.MAPPING_SQL)
    + rf""", spe_owned AS (
  SELECT s.*, m.projeto FROM spe_clean s JOIN mapping m ON regexp_extract(s.ceg, '(\d{{6,7}}-\d)') = m.ceg
),
wind_owned AS (
  SELECT * FROM wind_clean WHERE UPPER(TRIM(nom_usina)) IN (SELECT DISTINCT UPPER(TRIM(nom_conjuntousina)) FROM spe_owned)
)
SELECT s.*, {PAYLOAD_SQL}, year(s.data_hora) AS year, month(s.data_hora) AS month
FROM spe_owned s LEFT JOIN wind_owned w
  ON UPPER(TRIM(s.nom_conjuntousina)) = UPPER(TRIM(w.nom_usina)) AND s.din_instante = w.din_instante"""
)


@register("full_run", PIPELINE_SQL)
def full_run(spark, sf_dir):
    root = shared_folder(spark, "run")
    layers = run_pipeline(a.raw_spe(spark, sf_dir), a.raw_wind(spark, sf_dir), a.mapping(spark, sf_dir), root)
    return bigints(layers["joined"], "year", "month")


@register("full_run_without_report", PIPELINE_SQL)
def full_run_without_report(spark, sf_dir):
    root = shared_folder(spark, "run")
    raw = a.raw_spe(spark, sf_dir), a.raw_wind(spark, sf_dir)
    return bigints(run_pipeline(*raw, a.mapping(spark, sf_dir), root, report_rules=None)["joined"], "year", "month")


@register(
    "run_report",
    PIPELINE_SQL.split("SELECT s.*, w.")[0]
    + """SELECT 'join' AS section, metric, '' AS key, value FROM (
  SELECT COUNT(*)::DOUBLE AS total_records, COUNT(w.nom_estado)::DOUBLE AS matched_records,
         ROUND(COUNT(w.nom_estado)::DOUBLE / NULLIF(COUNT(*), 0)::DOUBLE * 100, 2) AS match_rate_pct
  FROM spe_owned s LEFT JOIN wind_owned w ON UPPER(TRIM(s.nom_conjuntousina)) = UPPER(TRIM(w.nom_usina)) AND s.din_instante = w.din_instante
) UNPIVOT (value FOR metric IN (total_records, matched_records, match_rate_pct))
UNION ALL SELECT level, 'missing_month', strftime(m, '%Y-%m'), 1.0::DOUBLE
FROM (SELECT unnest(generate_series(TIMESTAMP '2023-11-01', TIMESTAMP '2024-03-01', INTERVAL 1 MONTH)) AS m) CROSS JOIN (VALUES ('spe'), ('wind')) AS l(level)
WHERE NOT EXISTS (SELECT 1 FROM (
  SELECT 'spe' AS l, TRY_CAST(din_instante AS TIMESTAMP) AS t FROM raw_spe UNION ALL SELECT 'wind', TRY_CAST(din_instante AS TIMESTAMP) FROM raw_wind
) WHERE l = level AND date_trunc('month', t) = m)""",
)
def run_report_query(spark, sf_dir):
    """Match rate, and the months from November 2023 to March 2024 that a level lacks."""
    raw = {"spe": a.raw_spe(spark, sf_dir), "wind": a.raw_wind(spark, sf_dir)}
    layers = run_pipeline(raw["spe"], raw["wind"], a.mapping(spark, sf_dir), shared_folder(spark, "run"), report_rules=None)
    return run_report(layers["joined"], raw, months.month_range(spark, "2023-11-01", "2024-03-01")).drop("detail")


def deliver(spark: SparkSession, sf_dir: str, root: str, run: Callable) -> object:
    """Three deliveries: most rows; the rest with rows that came before; a late file for the first months. The last run's result."""
    write_csv(a.mapping(spark, sf_dir), f"{root}/in/mapping")
    spe, wind = a.raw_spe(spark, sf_dir), a.raw_wind(spark, sf_dir)
    digit = F.substring(F.md5(F.concat_ws(" ", "nom_usina", "din_instante")), 1, 1)
    part = F.instr(F.lit("0123456789abcdef"), digit) % 4
    late = F.coalesce(F.col("din_instante") < "2024-01-10", F.lit(False)) & (part == 3)
    for k, kept in enumerate((~late & (part != 2), ~late & (part != 1), late)):
        at_once(spark, *(partial(write_csv, rows.filter(kept), f"{root}/in/{name}/m{k}", sep=";") for name, rows in (("spe", spe), ("wind", wind))))
        done = run(spark, f"{root}/in/spe/*", f"{root}/in/wind/*", f"{root}/in/mapping", f"{root}/out", a.RAW_SPE_COLUMNS, a.RAW_WIND_COLUMNS)
    return done


# Rows that come in two of these deliveries.
TWICE_SQL = """
raw_{0} AS (
  SELECT * FROM raw_{0}_once UNION ALL SELECT * FROM raw_{0}_once
  WHERE instr('0123456789abcdef', md5(concat_ws(' ', nom_usina, din_instante))[1]) % 4 IN (CASE WHEN din_instante < '2024-01-10' THEN 0 ELSE 3 END, 0)
)"""
DELIVERED_SQL = (
    a.RAW_SPE_SQL.replace("raw_spe AS (", "raw_spe_once AS ("),
    TWICE_SQL.format("spe"),
    a.RAW_WIND_SQL.replace("raw_wind AS (", "raw_wind_once AS ("),
    TWICE_SQL.format("wind"),
)


@register("full_run_incremental", PIPELINE_SQL)
def full_run_incremental(spark, sf_dir):
    return bigints(deliver(spark, sf_dir, shared_folder(spark, "months"), run_new_months), "year", "month")


def lake(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The lake after three deliveries. Each query makes its own: a kept one would be another input's once the tables at ``sf_dir`` change,
    and a query's time would depend on which ran before it."""
    root = shared_folder(spark, "lake")
    deliver(spark, sf_dir, root, run_delivery)
    return read_lake(spark, f"{root}/out")


LAKE_JOINED = PIPELINE_SQL.replace("SELECT s.*, w.", ", joined AS (SELECT s.*, w.") + ")"


@register("lake_joined", PIPELINE_SQL)
def lake_joined(spark, sf_dir):
    return bigints(lake(spark, sf_dir)["joined"], "year", "month")


@register(
    "fact_incremental",
    LAKE_JOINED
    + f""" SELECT {", ".join(dict.fromkeys([*star.DIM_SPE, *star.DIM_CONJUNTO]))}, din_instante, {", ".join(star.FACT_MEASURES)},
  COALESCE(cod_razaorestricao, 'SEM_RESTRICAO') AS cod_razaorestricao FROM joined""",
)
def fact_incremental(spark, sf_dir):
    """The facts of three deliveries with their keys resolved; keys that were given first stay, so they are not those of a whole build."""
    tables = lake(spark, sf_dir)
    facts = tables["fact_generation"]
    for name, key in (("dim_spe", "spe_key"), ("dim_conjunto", "conjunto_key"), ("dim_tempo", "tempo_key")):
        facts = facts.join(tables[name], key)
    return facts.select(*star.DIM_SPE, *star.DIM_CONJUNTO, "din_instante", *star.FACT_MEASURES, "cod_razaorestricao")


@register("quality_incremental", _report_sql(from_raw=True, raw=DELIVERED_SQL))
def quality_incremental(spark, sf_dir):
    return quality.report_of_counts(lake(spark, sf_dir)["quality_counts"])


@register(
    "coverage_incremental",
    f"""{LAKE_JOINED},{_gaps_sql("projeto, nom_usina", "(SELECT * FROM joined WHERE projeto IS NOT NULL AND nom_usina IS NOT NULL AND din_instante IS NOT NULL)", "din_instante")}
SELECT projeto, nom_usina, gap_count, received_hours, expected_hours, completeness_pct, completeness_pct < 95 AS below_threshold FROM gaps JOIN complete USING (projeto, nom_usina)""",
)
def coverage_incremental(spark, sf_dir):
    """Gaps and completeness from the stored hour sets of three deliveries; series without any timestamp apart."""
    return coverage.with_alert(coverage.coverage_of_sets(lake(spark, sf_dir)["hours"])).filter("received_hours > 0")


@register(
    "generation_rollup",
    LAKE_JOINED
    + """ SELECT strftime(din_instante, '%Y-%m-%d') AS period,
  COALESCE(CAST(SUM(CAST(val_geracao AS DECIMAL(28,6))) AS DOUBLE), 0.0::DOUBLE) AS total_generation, 'P1' AS projeto
FROM joined WHERE projeto = 'P1' AND din_instante >= TIMESTAMP '2024-01-05' AND din_instante <= TIMESTAMP '2024-01-25' GROUP BY 1""",
)
def generation_rollup(spark, sf_dir):
    return rollup.generation(lake(spark, sf_dir)["rollup"], "P1", "2024-01-05", "2024-01-25")


@register(
    "restrictions_rollup",
    LAKE_JOINED
    + """ SELECT COALESCE(cod_razaorestricao, 'WITHOUT_RESTRICTION') AS cod_razaorestricao, COUNT(din_instante) AS total_hours,
  CAST(SUM(CAST(val_geracaoreferencia - val_geracao AS DECIMAL(28,6))) AS DOUBLE) AS total_mwh_restricted
FROM joined WHERE val_geracao < val_geracaoreferencia AND din_instante <= TIMESTAMP '2024-01-20' GROUP BY 1""",
)
def restrictions_rollup(spark, sf_dir):
    return rollup.restrictions_summary(lake(spark, sf_dir)["rollup"], end="2024-01-20")


@register("projects_rollup", LAKE_JOINED + " SELECT DISTINCT projeto, nom_estado, nom_subsistema FROM joined")
def projects_rollup(spark, sf_dir):
    return metrics.projects(lake(spark, sf_dir)["places"])


@register("full_run_from_landing", PIPELINE_SQL)
def full_run_from_landing(spark, sf_dir):
    root = shared_folder(spark, "landing-run")
    write_csv(a.raw_spe(spark, sf_dir), f"{root}/in/spe", sep=";")
    write_csv(a.raw_wind(spark, sf_dir), f"{root}/in/wind", sep=";")
    write_csv(a.mapping(spark, sf_dir), f"{root}/in/mapping")
    layers = run_from_landing(
        spark,
        f"{root}/in/spe",
        f"{root}/in/wind",
        f"{root}/in/mapping",
        f"{root}/out",
        a.RAW_SPE_COLUMNS,
        a.RAW_WIND_COLUMNS,
    )
    return bigints(layers["joined"], "year", "month")


@register("filter_assets", PIPELINE_SQL.split("SELECT s.*, w.")[0] + "SELECT 'spe' AS level, * FROM spe_owned UNION ALL BY NAME SELECT 'wind' AS level, * FROM wind_owned")
def filter_assets(spark, sf_dir):
    spe, wind = clean.clean_spe(a.raw_spe(spark, sf_dir)), clean.clean_wind(a.raw_wind(spark, sf_dir))
    owned = assets.filter_assets(spe, wind, a.mapping(spark, sf_dir), store=shared_folder(spark, "names"))
    parts = [rows.withColumn("level", F.lit(level)) for level, rows in zip(("spe", "wind"), owned)]
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


@register("replace_table", JOINED + " SELECT * FROM joined")
def replace_table(spark, sf_dir):
    """Creates the table, then replaces it with the same rows."""
    path = shared_folder(spark, "table")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    rows = joined(spark, sf_dir)
    write_table(rows, name, path)
    return write_table(rows, name, path)
