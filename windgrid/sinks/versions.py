"""Stored tables of a lake that change together.

A run writes its tables, or those months of them that it made anew, to folders of its own (``stage``), which no reader looks at. Then
one small manifest names, for every table and month, the run whose files are valid (``publish``). It is a single file,
so readers see all of a run or nothing of it; a run that fails on the way leaves the former state, and months that a run did not touch
keep their files. Folders of former runs stay for readers that began before; nothing here deletes them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windgrid.session import at_once
from windgrid.sinks.files import by_month

BY_MONTH = ("year", "month")
MANIFEST = "table string, part string, run long"
_NULL = "__HIVE_DEFAULT_PARTITION__"


def month_folder(label: str) -> str:
    """The folder of a month label such as 2024-01, or of rows without a month (``none``)."""
    year, _, month = label.partition("-")
    return f"year={int(year)}/month={int(month)}" if month else f"year={_NULL}/month={_NULL}"


def manifest(spark: SparkSession, root: str) -> tuple[int, dict[tuple[str, str], int]]:
    """The last published run, -1 before the first, and the run of each (table, part). Grows with tables and months only."""
    try:
        rows = spark.read.schema(MANIFEST + ", published long").parquet(f"{root}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1, {}
    last = rows.agg(F.max("published")).first()[0]
    if last is None:
        return -1, {}
    return last, {(r["table"], r["part"]): r["run"] for r in rows.filter(F.col("published") == last).collect()}


def stage(df: DataFrame, root: str, table: str, run: int, sort_by: Sequence[str] = (), rows: Mapping[str, int] | None = None) -> DataFrame:
    """Writes a table, by month if it has the columns year and month, below the run's own folder, and reads it back.

    Months are gathered as ``by_month`` does, with its ``rows``.
    """
    path = f"{root}/{table}/run={run}"
    if set(BY_MONTH) <= set(df.columns):
        by_month(df, sort_by, rows).write.mode("overwrite").partitionBy(*BY_MONTH).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish(spark: SparkSession, root: str, run: int, staged: Mapping[str, DataFrame], months: Sequence[str], notes: Mapping[str, int]) -> None:
    """Makes the staged tables valid: tables by month in the given months (labels) alone, others as a whole.

    A month that a staged table has no rows for is empty from now on. ``notes`` are numbers that the next run wants to know.
    """
    _, valid = manifest(spark, root)
    months_of = {table: rows.select(*BY_MONTH).distinct() for table, rows in staged.items() if set(BY_MONTH) <= set(rows.columns)}
    found = dict(zip(months_of, at_once(spark, *(rows.collect for rows in months_of.values())))) if months_of else {}
    for table in staged:
        if table in found:
            made = {month_folder("none") if r["year"] is None else f"year={r['year']}/month={r['month']}" for r in found[table]}
            for label in months:
                valid.pop((table, month_folder(label)), None)
            valid.update({(table, part): run for part in made})
        else:
            valid[table, ""] = run
    valid.update({("", name): number for name, number in notes.items()})
    rows = spark.createDataFrame([(*key, number) for key, number in valid.items()], MANIFEST)
    rows.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/published={run}")


def current(spark: SparkSession, root: str, table: str, schema: T.StructType, valid: Mapping[tuple[str, str], int] | None = None) -> DataFrame:
    """A table as last published; empty if it never was. ``valid`` is that of ``manifest``, if it has been read."""
    valid = manifest(spark, root)[1] if valid is None else valid
    paths = [f"{root}/{table}/run={run}" + (f"/{part}" if part else "") for (name, part), run in valid.items() if name == table]
    if not paths:
        return spark.createDataFrame([], schema)
    whole = T.StructType([*schema.fields, T.StructField("run", T.LongType())])
    return spark.read.option("basePath", f"{root}/{table}").schema(whole).parquet(*sorted(paths)).select(*schema.names)
