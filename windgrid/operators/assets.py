"""Restriction to one owner's assets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windgrid.functions import asset_code, normalize
from windgrid.sinks.files import write_layer


def keep_mapped(spe: DataFrame, mapping: DataFrame, code: str = "ceg", mapping_code: str = "ceg") -> DataFrame:
    """Rows whose core code the mapping lists, each once however often the code is listed."""
    codes = _listed(mapping, mapping_code).select("_code")
    return spe.withColumn("_code", asset_code(code)).join(codes, "_code", "left_semi").select(*spe.columns)


def attach_project(
    spe: DataFrame,
    mapping: DataFrame,
    code: str = "ceg",
    mapping_code: str = "ceg",
    project: str = "projeto",
    method: str = "inner",
) -> DataFrame:
    """Rows whose core code the mapping lists, with the mapping's project.

    ``method="inner"`` joins once. ``"member"`` first keeps the listed codes, then joins left; both give
    the same rows. The mapping is a small file, which Spark broadcasts on its file size; a mapping above
    ``spark.sql.autoBroadcastJoinThreshold`` is shuffled instead.
    """
    if method not in ("inner", "member"):
        raise ValueError(f"method must be 'inner' or 'member', not {method!r}")
    listed = _listed(mapping, mapping_code).withColumnRenamed(project, "_project")
    rows = spe if method == "inner" else keep_mapped(spe, mapping, code, mapping_code)
    joined = rows.withColumn("_code", asset_code(code)).join(listed, "_code", "inner" if method == "inner" else "left")
    return joined.select(*spe.columns, F.col("_project").alias(project))


def _listed(mapping: DataFrame, mapping_code: str) -> DataFrame:
    return mapping.filter(F.col(mapping_code) != "").withColumnRenamed(mapping_code, "_code")


def distinct_names(spe: DataFrame, name: str = "nom_conjuntousina", collapse_ws: bool = False) -> DataFrame:
    """The distinct normalised complex names, one column ``_name``. Null is left out: it matches nothing."""
    return spe.select(normalize(name, collapse_ws).alias("_name")).dropna().distinct()


def restrict_to_names(
    wind: DataFrame, names: DataFrame, name: str = "nom_usina", collapse_ws: bool = False
) -> DataFrame:
    """Complex rows whose normalised name is among ``names``, the result of ``distinct_names``.

    No row is duplicated: it is a semi join. Names are few, so a stored ``names`` table is broadcast on
    its size and the complex rows stay in place.
    """
    keyed = wind.withColumn("_name", normalize(name, collapse_ws))
    return keyed.join(names, "_name", "left_semi").select(*wind.columns)


def filter_assets(
    spe: DataFrame,
    wind: DataFrame,
    mapping: DataFrame,
    collapse_ws: bool = False,
    method: str = "inner",
    store: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Both levels cut down to the mapped assets: plants by code, complexes by the plants' names.

    With ``store``, a folder, the names are written there and read back, so that the filter is planned with their true size.
    """
    owned_spe = attach_project(spe, mapping, method=method)
    names = distinct_names(owned_spe, collapse_ws=collapse_ws)
    names = write_layer(names, store) if store else names
    owned_wind = restrict_to_names(wind, names, collapse_ws=collapse_ws)
    return owned_spe, owned_wind
