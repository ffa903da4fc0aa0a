"""Wind-shaped tables derived from the given tables, as DataFrames and as equal SQL."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windgrid.functions import hour_floor


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is taken from the file once per process: each lookup is a Spark job."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def code_of(key: str) -> Column:
    """A core code such as 0000042-2."""
    return F.concat(F.lpad(_text(key), 7, "0"), F.lit("-"), _text(F.col(key) % 10))


CODE_SQL = "lpad(CAST({0} AS VARCHAR), 7, '0') || '-' || CAST({0} % 10 AS VARCHAR)"


def spe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plant rows: one per event, in ten complexes. Complexes 3 and 7 are spelled with two inner blanks."""
    e = table(spark, sf_dir, "events")
    n = F.col("user_id") % 10
    blanks = F.when(n.isin(3, 7), F.lit(" Conj  ")).otherwise(F.lit(" Conj "))
    return e.select(
        F.concat(F.lit("SS"), _text(n % 3)).alias("id_subsistema"),
        F.concat(F.lit("E"), _text(n % 4)).alias("id_estado"),
        F.when(F.col("user_id") % 2 == 0, "Tipo I").otherwise("Tipo II").alias("nom_modalidadeoperacao"),
        F.when(F.col("event_id") % 53 != 0, F.concat(blanks, _text(n), F.lit(" "))).alias("nom_conjuntousina"),
        F.concat(F.lit("U"), _text("user_id")).alias("nom_usina"),
        F.concat(F.lit("ID"), _text(F.col("user_id") % 7)).alias("id_ons"),
        F.concat(F.lit("EOL.CV."), code_of("user_id"), F.lit(".01")).alias("ceg"),
        hour_floor(F.col("ts")).alias("din_instante"),
        F.when(F.col("event_id") % 23 != 0, F.col("value") - 1).alias("val_ventoverificado"),
        F.when(F.col("event_id") % 10 == 0, 1.0).when(F.col("event_id") % 37 != 0, 0.0).alias("flg_dadoventoinvalido"),
        (F.col("value") - 5).alias("val_geracaoestimada"),
        F.col("value").alias("val_geracaoverificada"),
        F.col("event_type").alias("projeto"),
    )


SPE_SQL = f"""
spe AS (
  SELECT 'SS' || CAST(user_id % 10 % 3 AS VARCHAR) AS id_subsistema,
         'E' || CAST(user_id % 10 % 4 AS VARCHAR) AS id_estado,
         CASE WHEN user_id % 2 = 0 THEN 'Tipo I' ELSE 'Tipo II' END AS nom_modalidadeoperacao,
         CASE WHEN event_id % 53 <> 0 THEN
           CASE WHEN user_id % 10 IN (3, 7) THEN ' Conj  ' ELSE ' Conj ' END || CAST(user_id % 10 AS VARCHAR) || ' '
         END AS nom_conjuntousina,
         'U' || CAST(user_id AS VARCHAR) AS nom_usina,
         'ID' || CAST(user_id % 7 AS VARCHAR) AS id_ons,
         'EOL.CV.' || {CODE_SQL.format("user_id")} || '.01' AS ceg,
         date_trunc('hour', ts) AS din_instante,
         CASE WHEN event_id % 23 <> 0 THEN value - 1 END AS val_ventoverificado,
         CASE WHEN event_id % 10 = 0 THEN 1.0::DOUBLE WHEN event_id % 37 <> 0 THEN 0.0::DOUBLE END AS flg_dadoventoinvalido,
         value - 5 AS val_geracaoestimada,
         value AS val_geracaoverificada,
         event_type AS projeto
  FROM events
)"""


def wind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complex rows: one per complex and hour. Complex 9 has a name that no plant uses."""
    e = table(spark, sf_dir, "events")
    per_hour = e.groupBy((F.col("user_id") % 10).alias("n"), hour_floor(F.col("ts")).alias("din_instante")).agg(
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("val_geracao")
    )
    hour = F.hour("din_instante")
    target = F.col("val_geracao") * (F.lit(90.0) + F.lit(10.0) * (hour % 4)) / F.lit(100.0)
    return per_hour.select(
        F.when(F.col("n") == 9, "CONJ OTHER").otherwise(F.concat(F.lit("CONJ "), _text("n"))).alias("nom_usina"),
        "din_instante",
        F.concat(F.lit("SUB "), _text(F.col("n") % 3)).alias("nom_subsistema"),
        F.concat(F.lit("EST "), _text(F.col("n") % 4)).alias("nom_estado"),
        F.concat(F.lit("CJ"), _text("n")).alias("id_ons"),
        "val_geracao",
        (F.col("val_geracao") / 2).alias("val_geracaolimitada"),
        (F.col("val_geracao") - 100).alias("val_disponibilidade"),
        target.alias("val_geracaoreferencia"),
        (target - 1).alias("val_geracaoreferenciafinal"),
        F.when(hour % 3 == 0, "REL").when(hour % 3 == 1, "CNF").alias("cod_razaorestricao"),
    )


WIND_SQL = """
wind_hours AS (
  SELECT user_id % 10 AS n, date_trunc('hour', ts) AS din_instante,
         CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS val_geracao
  FROM events GROUP BY 1, 2
),
wind AS (
  SELECT CASE WHEN n = 9 THEN 'CONJ OTHER' ELSE 'CONJ ' || CAST(n AS VARCHAR) END AS nom_usina,
         din_instante,
         'SUB ' || CAST(n % 3 AS VARCHAR) AS nom_subsistema,
         'EST ' || CAST(n % 4 AS VARCHAR) AS nom_estado,
         'CJ' || CAST(n AS VARCHAR) AS id_ons,
         val_geracao,
         val_geracao / 2 AS val_geracaolimitada,
         val_geracao - 100 AS val_disponibilidade,
         val_geracao * (90.0::DOUBLE + 10.0::DOUBLE * (hour(din_instante) % 4)) / 100.0::DOUBLE AS val_geracaoreferencia,
         val_geracao * (90.0::DOUBLE + 10.0::DOUBLE * (hour(din_instante) % 4)) / 100.0::DOUBLE - 1 AS val_geracaoreferenciafinal,
         CASE hour(din_instante) % 3 WHEN 0 THEN 'REL' WHEN 1 THEN 'CNF' END AS cod_razaorestricao
  FROM wind_hours
)"""

RAW_SPE_COLUMNS = [
    "id_subsistema",
    "id_estado",
    "nom_modalidadeoperacao",
    "nom_conjuntousina",
    "nom_usina",
    "id_ons",
    "ceg",
    "din_instante",
    "val_ventoverificado",
    "flg_dadoventoinvalido",
    "val_geracaoestimada",
    "val_geracaoverificada",
]


# How files spell timestamps, by a divisor of the event's id: slashes, the next day's midnight, one-digit parts, several blanks
# and a T; then a day alone; then a bare hour, a month and a year, which are none; else the usual spelling.
SPELLINGS = [
    (67, "yyyy/MM/dd HH:mm:ss"),
    (71, "yyyy-MM-dd '24:00:00'"),
    (73, "yyyy-M-d H:mm"),
    (79, "yyyy-MM-dd'T'HH:mm:ss.SSS"),
    (83, "yyyy/MM/dd   '24:00'"),
    (89, "yyyy-MM-dd"),
    (97, "yyyy-MM-dd HH"),
    (101, "yyyy-MM"),
    (103, "yyyy"),
    (1, "yyyy-MM-dd HH:mm:ss"),
]
_STRFTIME = {"yyyy": "%Y", "MM": "%m", "dd": "%d", "HH": "%H", "mm": "%M", "ss": "%S", "SSS": "%g", "M": "%-m", "d": "%-d", "H": "%-H"}
SPELLINGS_SQL = " ".join(
    f"WHEN event_id % {every} = 0 THEN strftime(ts, '{re.sub("'([^']*)'|([A-Za-z]+)", lambda m: m[1] or _STRFTIME[m[2]], pattern)}')" for every, pattern in SPELLINGS
)
SPELLINGS_SQL = f"CASE {SPELLINGS_SQL} END"


def raw_spe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plant rows as files hold them: text, with spoiled values and one to three copies of each row."""
    e = table(spark, sf_dir, "events")
    n, i = F.col("user_id") % 10, F.col("event_id")
    blanks = F.when(n.isin(3, 7), F.lit(" Conj  ")).otherwise(F.lit(" Conj "))
    ts = F.lit(None).cast("string")
    for every, pattern in reversed(SPELLINGS):
        ts = F.when(i % every == 0, F.date_format("ts", pattern)).otherwise(ts)
    value = _text("value")
    rows = e.select(
        F.concat(F.lit("SS"), _text(n % 3)).alias("id_subsistema"),
        F.concat(F.lit("E"), _text(n % 4)).alias("id_estado"),
        F.when(F.col("user_id") % 2 == 0, ' Tipo "I"; norte ').otherwise("Tipo II\\").alias("nom_modalidadeoperacao"),
        F.when(i % 53 != 0, F.concat(blanks, _text(n), F.lit(" "))).alias("nom_conjuntousina"),
        F.concat(F.lit("U"), _text("user_id")).alias("nom_usina"),
        F.concat(F.lit("ID"), _text(F.col("user_id") % 7)).alias("id_ons"),
        F.when(i % 61 != 0, F.concat(F.lit("EOL.CV."), code_of("user_id"), F.lit(".01"))).alias("ceg"),
        F.when(i % 41 == 0, "bad").when(i % 43 != 0, ts).alias("din_instante"),
        F.when(i % 29 == 0, "12,5").when(i % 31 == 0, "NaN").when(i % 23 != 0, value).alias("val_ventoverificado"),
        F.when(i % 10 == 0, "1").when(i % 37 != 0, "0").alias("flg_dadoventoinvalido"),
        F.when(i % 47 == 0, "12d").otherwise(value).alias("val_geracaoestimada"),
        value.alias("val_geracaoverificada"),
        F.explode(F.sequence(F.lit(0), (i % 3).cast("int"))).alias("copy"),
    )
    return rows.drop("copy")


RAW_SPE_SQL = f"""
raw_spe AS (
  SELECT 'SS' || CAST(user_id % 10 % 3 AS VARCHAR) AS id_subsistema,
         'E' || CAST(user_id % 10 % 4 AS VARCHAR) AS id_estado,
         CASE WHEN user_id % 2 = 0 THEN ' Tipo "I"; norte ' ELSE 'Tipo II\\' END AS nom_modalidadeoperacao,
         CASE WHEN event_id % 53 <> 0 THEN
           CASE WHEN user_id % 10 IN (3, 7) THEN ' Conj  ' ELSE ' Conj ' END || CAST(user_id % 10 AS VARCHAR) || ' '
         END AS nom_conjuntousina,
         'U' || CAST(user_id AS VARCHAR) AS nom_usina,
         'ID' || CAST(user_id % 7 AS VARCHAR) AS id_ons,
         CASE WHEN event_id % 61 <> 0 THEN 'EOL.CV.' || {CODE_SQL.format("user_id")} || '.01' END AS ceg,
         CASE WHEN event_id % 41 = 0 THEN 'bad' WHEN event_id % 43 <> 0 THEN {SPELLINGS_SQL} END AS din_instante,
         CASE WHEN event_id % 29 = 0 THEN '12,5' WHEN event_id % 31 = 0 THEN 'NaN'
              WHEN event_id % 23 <> 0 THEN CAST(value AS VARCHAR) END AS val_ventoverificado,
         CASE WHEN event_id % 10 = 0 THEN '1' WHEN event_id % 37 <> 0 THEN '0' END AS flg_dadoventoinvalido,
         CASE WHEN event_id % 47 = 0 THEN '12d' ELSE CAST(value AS VARCHAR) END AS val_geracaoestimada,
         CAST(value AS VARCHAR) AS val_geracaoverificada
  FROM events, generate_series(0, event_id % 3)
)"""

RAW_WIND_COLUMNS = [
    "nom_usina",
    "din_instante",
    "nom_subsistema",
    "nom_estado",
    "id_ons",
    "val_geracao",
    "val_geracaolimitada",
    "val_disponibilidade",
    "val_geracaoreferencia",
    "val_geracaoreferenciafinal",
    "cod_razaorestricao",
]


def raw_wind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complex rows as files hold them: text, one per event, so that an hour can hold several."""
    e = table(spark, sf_dir, "events")
    n, i = F.col("user_id") % 10, F.col("event_id")
    value = _text("value")
    rows = e.select(
        F.when(n == 9, "CONJ OTHER").otherwise(F.concat(F.lit("CONJ "), _text(n))).alias("nom_usina"),
        F.when(i % 59 == 0, "bad").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("din_instante"),
        F.concat(F.lit("SUB "), _text(n % 3)).alias("nom_subsistema"),
        F.concat(F.lit("EST "), _text(n % 4)).alias("nom_estado"),
        F.concat(F.lit("CJ"), _text(n)).alias("id_ons"),
        value.alias("val_geracao"),
        F.when(i % 47 == 0, "n/a").otherwise(value).alias("val_geracaolimitada"),
        value.alias("val_disponibilidade"),
        F.when(i % 2 == 0, "250.5").otherwise("20.25").alias("val_geracaoreferencia"),
        F.when(i % 19 != 0, value).alias("val_geracaoreferenciafinal"),
        F.when(i % 3 == 0, "REL").when(i % 3 == 1, "CNF").alias("cod_razaorestricao"),
        F.explode(F.sequence(F.lit(0), (i % 2).cast("int"))).alias("copy"),
    )
    return rows.drop("copy")


RAW_WIND_SQL = """
raw_wind AS (
  SELECT CASE WHEN user_id % 10 = 9 THEN 'CONJ OTHER' ELSE 'CONJ ' || CAST(user_id % 10 AS VARCHAR) END AS nom_usina,
         CASE WHEN event_id % 59 = 0 THEN 'bad' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS din_instante,
         'SUB ' || CAST(user_id % 10 % 3 AS VARCHAR) AS nom_subsistema,
         'EST ' || CAST(user_id % 10 % 4 AS VARCHAR) AS nom_estado,
         'CJ' || CAST(user_id % 10 AS VARCHAR) AS id_ons,
         CAST(value AS VARCHAR) AS val_geracao,
         CASE WHEN event_id % 47 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS val_geracaolimitada,
         CAST(value AS VARCHAR) AS val_disponibilidade,
         CASE WHEN event_id % 2 = 0 THEN '250.5' ELSE '20.25' END AS val_geracaoreferencia,
         CASE WHEN event_id % 19 <> 0 THEN CAST(value AS VARCHAR) END AS val_geracaoreferenciafinal,
         CASE event_id % 3 WHEN 0 THEN 'REL' WHEN 1 THEN 'CNF' END AS cod_razaorestricao
  FROM events, generate_series(0, event_id % 2)
)"""


# A delivery as lines of text: quoted fields with separators and doubled quotes, and rows that do not fit the header.
DELIVERY_COLUMNS = ["nom_usina", "din_instante", "note", "val_geracao"]


def delivery_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per event: every 11th quoted, every 13th with a field too many, every 17th with one too few, every 19th unclosed in
    the middle, every 23rd unclosed at the end, every 29th with text behind its closing quote."""
    i = F.col("event_id")
    name, ts, value = F.concat(F.lit("U"), _text("user_id")), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), _text("value")
    note = F.when(i % 11 == 0, F.concat(F.lit('"say ""'), F.col("event_type"), F.lit('""; ok"'))).otherwise(F.col("event_type"))
    line = (
        F.when(i % 13 == 0, F.concat_ws(";", name, ts, note, value, F.lit("more")))
        .when(i % 17 == 0, F.concat_ws(";", name, ts, note))
        .when(i % 19 == 0, F.concat_ws(";", name, ts, F.concat(F.lit('"'), F.col("event_type")), value))
        .when(i % 23 == 0, F.concat_ws(";", name, ts, note, F.concat(F.lit('"'), value)))
        .when(i % 29 == 0, F.concat_ws(";", name, ts, F.lit('"a"b'), value))
        .otherwise(F.concat_ws(";", name, ts, note, value))
    )
    return table(spark, sf_dir, "events").select(line.alias(";".join(DELIVERY_COLUMNS)))


DELIVERY_SQL = """
delivered AS (
  SELECT *, 'U' || CAST(user_id AS VARCHAR) AS nom_usina, strftime(ts, '%Y-%m-%d %H:%M:%S') AS din_instante, CAST(value AS VARCHAR) AS val_geracao,
         CASE WHEN event_id % 11 = 0 THEN 'say "' || event_type || '"; ok' ELSE event_type END AS note,
         CASE WHEN event_id % 11 = 0 THEN '"say ""' || event_type || '""; ok"' ELSE event_type END AS quoted,
         CASE WHEN event_id % 13 = 0 THEN 'too many fields' WHEN event_id % 17 = 0 THEN 'too few fields'
              WHEN event_id % 19 = 0 OR event_id % 23 = 0 OR event_id % 29 = 0 THEN 'broken quotes' END AS reason
  FROM events
)"""


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The owned assets: one code per supplier."""
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("P"), _text(F.col("s_nationkey") % 7)).alias("projeto"),
        F.col("s_name").alias("spe"),
        code_of("s_suppkey").alias("ceg"),
    )


MAPPING_SQL = f"""
mapping AS (
  SELECT 'P' || CAST(s_nationkey % 7 AS VARCHAR) AS projeto, s_name AS spe, {CODE_SQL.format("s_suppkey")} AS ceg
  FROM supplier
)"""
