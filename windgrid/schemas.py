"""Column contracts of the wind domain."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of the joined table and their types, as its readers expect them.
JOINED_SCHEMA = T.StructType(
    [
        T.StructField("id_subsistema", T.StringType()),
        T.StructField("id_estado", T.StringType()),
        T.StructField("nom_modalidadeoperacao", T.StringType()),
        T.StructField("nom_conjuntousina", T.StringType()),
        T.StructField("nom_usina", T.StringType()),
        T.StructField("id_ons", T.StringType()),
        T.StructField("ceg", T.StringType()),
        T.StructField("din_instante", T.TimestampNTZType()),
        T.StructField("val_ventoverificado", T.DoubleType()),
        T.StructField("flg_dadoventoinvalido", T.DoubleType()),
        T.StructField("val_geracaoestimada", T.DoubleType()),
        T.StructField("val_geracaoverificada", T.DoubleType()),
        T.StructField("projeto", T.StringType()),
        T.StructField("nom_subsistema", T.StringType()),
        T.StructField("nom_estado", T.StringType()),
        T.StructField("val_geracao", T.DoubleType()),
        T.StructField("val_disponibilidade", T.DoubleType()),
        T.StructField("val_geracaoreferencia", T.DoubleType()),
        T.StructField("val_geracaoreferenciafinal", T.DoubleType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("cod_razaorestricao", T.StringType()),
    ]
)

MAPPING_SCHEMA = T.StructType(
    [
        T.StructField("projeto", T.StringType()),
        T.StructField("spe", T.StringType()),
        T.StructField("ceg", T.StringType()),
    ]
)

PROJECTS_SCHEMA = T.StructType(
    [
        T.StructField("projeto", T.StringType()),
        T.StructField("nom_estado", T.StringType()),
        T.StructField("nom_subsistema", T.StringType()),
    ]
)

GENERATION_SCHEMA = T.StructType(
    [
        T.StructField("period", T.StringType()),
        T.StructField("total_generation", T.DoubleType()),
        T.StructField("projeto", T.StringType()),
    ]
)

RESTRICTIONS_SCHEMA = T.StructType(
    [
        T.StructField("cod_razaorestricao", T.StringType()),
        T.StructField("total_hours", T.LongType()),
        T.StructField("total_mwh_restricted", T.DoubleType()),
    ]
)

TS = "din_instante"
FLAG = "flg_dadoventoinvalido"

# Numeric columns of the two raw files.
PLANT_NUMERIC = ["val_ventoverificado", "val_geracaoestimada", "val_geracaoverificada"]
COMPLEX_NUMERIC = [
    "val_geracao",
    "val_geracaolimitada",
    "val_disponibilidade",
    "val_geracaoreferencia",
    "val_geracaoreferenciafinal",
]

# Date columns a raw file may hold.
DATE_COLUMNS = ["din_instante", "dat_inicio", "dat_fim"]

# What the join takes from the complex level.
COMPLEX_PAYLOAD = [
    "nom_subsistema",
    "nom_estado",
    "val_geracao",
    "val_disponibilidade",
    "val_geracaoreferencia",
    "val_geracaoreferenciafinal",
    "cod_razaorestricao",
]

# Natural keys of the dimensions and measures of the fact table.
DIM_SPE = ["nom_usina", "id_ons", "ceg", "projeto", "nom_modalidadeoperacao"]
DIM_CONJUNTO = ["nom_conjuntousina", "id_subsistema", "nom_subsistema", "id_estado", "nom_estado"]
FACT_MEASURES = [
    "val_ventoverificado",
    "val_geracaoestimada",
    "val_geracaoverificada",
    "val_geracao",
    "val_disponibilidade",
    "val_geracaoreferencia",
    "val_geracaoreferenciafinal",
]
