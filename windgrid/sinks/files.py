"""Writers. Each replaces what an earlier run wrote, so a rerun changes nothing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windgrid.functions import month_number
from windgrid.schemas import TS

# Fixed value: raw rows of a month for which one more task writes it.
ROWS_A_PIECE = 1 << 17


def write_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Creates or replaces a catalog table, stored at ``path`` if given, and returns it."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def write_layer(df: DataFrame, path: str) -> DataFrame:
    """Stores an intermediate result and reads it back: lineage ends here and its size is known."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partition_columns(df: DataFrame, ts: str) -> DataFrame:
    """Adds year and month of ``ts``; null where it is null."""
    return df.withColumns({"year": F.year(ts), "month": F.month(ts)})


def by_month(df: DataFrame, sort_by: Sequence[str], rows: Mapping[str, int] | None = None) -> DataFrame:
    """Rows with year and month, gathered by month for writing and sorted.

    The rebalance gathers each month into files of the advisory size, but a month below that size is one task's. ``rows``, the raw
    rows of each month (label), tells the months that are worth more tasks: these are cut by a hash of ``sort_by``, small ones stay whole.
    """
    sort_by = [c for c in sort_by if c in df.columns]
    pieces = {label: -(-n // ROWS_A_PIECE) for label, n in (rows or {}).items() if n > ROWS_A_PIECE}
    piece = F.pmod(F.xxhash64(*sort_by), _pieces(pieces)) if pieces and sort_by else F.lit(0)
    rows = df.withColumn("_piece", piece).hint("rebalance", F.col("year"), F.col("month"), F.col("_piece"))
    return rows.sortWithinPartitions("year", "month", *sort_by).drop("_piece")


def _pieces(pieces: Mapping[str, int]) -> Column:
    """The number of pieces of a row's month; rows without a month are of month 0."""
    number = lambda label: int(label[:-3]) * 100 + int(label[-2:]) if "-" in label else 0
    known = F.create_map(*[F.lit(x) for label in sorted(pieces) for x in (number(label), pieces[label])])
    month = F.coalesce(month_number(F.col("year"), F.col("month")), F.lit(0)).cast("int")
    return F.coalesce(F.try_element_at(known, month), F.lit(1)).cast("bigint")


def write_partitioned(
    df: DataFrame, path: str, ts: str = "data_hora", sort_by: Sequence[str] = ("projeto", TS), rows: Mapping[str, int] | None = None
) -> None:
    """Writes by year and month of ``ts``, replacing the months at hand and leaving the others alone.

    The rebalance gathers each month into files of the advisory size and splits a large month over
    several tasks, so there are neither many small files nor one task per month. Rows are sorted inside
    each file, so that readers of one project or a short time range skip row groups. ``rows`` is that of ``by_month``.
    """
    (
        by_month(partition_columns(df, ts), sort_by, rows)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(path)
    )


def write_star(tables: Mapping[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Stores dimensions under ``dimensions/`` and facts under ``facts/`` and returns the stored tables."""
    return {
        name: write_layer(df, f"{root}/{'facts' if name.startswith('fact') else 'dimensions'}/{name}")
        for name, df in tables.items()
    }


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """CSV files with a header; one file per task.

    Text is written as it is: outer blanks stay, and a quote inside quotes is doubled, as common readers expect. CSV
    does not tell empty text from a missing value; both come back as null.
    """
    writer = df.write.mode("overwrite").option("header", True).option("sep", sep).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_report(report: DataFrame, path: str) -> None:
    """Report rows as JSON lines."""
    report.write.mode("overwrite").json(path)
