"""File readers. Raw files are read as text, so bad values stay countable."""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windgrid.functions import timestamp_column, to_timestamp
from windgrid.schemas import DATE_COLUMNS, MAPPING_SCHEMA, TS


# Columns of a checked read: the text of a row that does not fit its header, and why.
LINE, REASON = "_line", "_reason"


def read_raw_csv(spark: SparkSession, path: str | list[str], sep: str = ";", multi_line: bool = False) -> DataFrame:
    """All files with one common header, every column as text.

    Quotes inside quoted text are doubled; a backslash is a letter like any other. ``multi_line`` reads line breaks inside
    quotes, for which a file cannot be split over tasks. A file whose header differs fails the read; use
    ``read_csv_by_name`` for such folders.
    """
    return _text_csv(spark, path, sep, multi_line)


def read_csv_by_name(
    spark: SparkSession,
    folder: str,
    sep: str = ";",
    date_columns: tuple[str, ...] | None = tuple(DATE_COLUMNS),
    multi_line: bool = False,
    checked: bool = False,
) -> DataFrame:
    """All CSV files of a folder put together by column name; a column a file lacks is null there.

    Files are grouped by header and each group is one scan, so plan and jobs grow with the number of
    different headers and not with the number of files. Only header lines are read ahead, without a job. Date
    columns present become timestamps, null where unreadable; pass ``None`` to keep text. ``checked`` adds the columns of
    ``checked_csv``: rows that do not fit their file's header come with their text and the reason.
    """
    combined = union_by_name(spark, headers_of(spark, csv_files(spark, folder), sep), sep, multi_line, checked)
    present = [c for c in date_columns or () if c in combined.columns]
    return combined.withColumns({c: to_timestamp(F.col(c)) for c in present}) if present else combined


def headers_of(spark: SparkSession, files: Iterable[str], sep: str = ";") -> dict[tuple[str, ...], list[str]]:
    """The files by their header; those without a header line are under the empty one."""
    files = list(files)
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    with ThreadPoolExecutor(16) as pool:
        for file, line in zip(files, pool.map(lambda f: _first_line(spark, f), files)):
            groups[tuple(next(csv.reader([line], delimiter=sep), ()))].append(file)
    return dict(groups)


def union_by_name(spark: SparkSession, groups: dict[tuple[str, ...], list[str]], sep: str = ";", multi_line: bool = False, checked: bool = False) -> DataFrame:
    """One scan for each header, put together by column name."""
    combined = None
    for header, paths in groups.items():
        if header:
            part = (checked_csv if checked else _text_csv)(spark, paths, sep, multi_line, header)
            combined = part if combined is None else combined.unionByName(part, allowMissingColumns=True)
    if combined is None:
        raise ValueError(f"No header line in: {', '.join(f for paths in groups.values() for f in paths[:3])}")
    return combined


def checked_csv(spark: SparkSession, path: str | list[str], sep: str, multi_line: bool, header: tuple[str, ...]) -> DataFrame:
    """Rows as text with two more columns, null in a well-formed row: ``_line``, the row's text, and ``_reason``: ``too few
    fields``, ``too many fields`` or ``broken quotes``.

    A well-formed row has as many fields as the header; a quoted field ends at its closing quote, where the next separator or the end
    of the row follows, and quotes inside are doubled. Without ``multi_line`` a quoted line break makes two malformed rows. The reader
    is given one column too many, so that it hands over the text of every row: only the text tells an unclosed
    last quote from plain text. A row with just one field too many has no such text, so it is put together from its fields.
    """
    further = "_further"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, further, LINE)])
    reader = spark.read.options(header=True, sep=sep, encoding="UTF-8", escape='"', multiLine=multi_line, mode="PERMISSIVE", columnNameOfCorruptRecord=LINE, columnPruning=False)
    rows = reader.schema(schema).csv(path)
    s = re.escape(sep)
    field = f'(?:"[^"]*+(?:""[^"]*+)*+"|[^"{s}][^{s}]*+|)'
    # Empty for a missing text: a null test would be pushed into the reader, which fills in the text only after its filters.
    line, more = F.coalesce(F.col(LINE), F.lit("")), len(header) - 1
    values = [F.coalesce(_named(c), F.lit("")) for c in (*header, further)]
    plain = [~(v.contains(sep) | v.startswith('"') | v.contains("\n")) for v in values]
    quoted = [F.when(p, v).otherwise(F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))) for p, v in zip(plain, values)]
    # A line without quotes is well-formed if it has as many separators as the header; only others meet the pattern.
    fits = (F.length(line) - F.length(F.replace(line, F.lit(sep), F.lit("")))) == more * len(sep)
    fits = F.when(line.contains('"'), line.rlike(rf"\A{field}(?:{s}{field}){{{more}}}\z")).otherwise(fits)
    reason = (
        F.when(fits & (line != "") & F.col(further).isNull(), None)
        .when(line == "", "too many fields")
        .when(~line.rlike(rf"\A{field}(?:{s}{field})*+\z"), "broken quotes")
        .when(line.rlike(rf"\A(?:{field}{s}){{{more + 1}}}"), "too many fields")
        .otherwise("too few fields")
    )
    rows = rows.withColumn(REASON, reason)
    # Inside a function over an array, the rarely needed text stays out of the generated method of all rows, which would pass the size that the JVM compiles.
    text = lambda known: F.when(known.isNotNull(), F.when(line == "", F.concat_ws(sep, *quoted)).otherwise(line))
    return rows.withColumn(LINE, F.get(F.transform(F.array(REASON), text), F.lit(0))).drop(further)


def csv_files(spark: SparkSession, folder: str) -> list[str]:
    """The folder's CSV files in name order; an error that names the folder if there are none. Other errors pass."""
    try:
        files = spark.read.option("pathGlobFilter", "*.csv").text(folder).inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = []
    if not files:
        raise ValueError(f"No CSV files found in: {folder}")
    return sorted(unquote(f) for f in files)


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """The asset mapping (project, plant, code). The schema is given: inference reads codes as dates."""
    return spark.read.schema(MAPPING_SCHEMA).options(header=True, enforceSchema=False, escape='"').csv(path)


def read_partitioned(spark: SparkSession, path: str, ts: str = TS) -> DataFrame:
    """The joined table from its year/month folders, with ``ts`` as a zone-less timestamp."""
    df = spark.read.parquet(path)
    if df.schema[ts].dataType.typeName() == "timestamp_ntz":
        return df
    return df.withColumn(ts, timestamp_column(df, ts, "strict"))


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """Report rows; ``detail`` is null in a quality report."""
    return spark.read.schema("section string, metric string, key string, value double, detail string").json(path)


def _text_csv(spark: SparkSession, path: str | list[str], sep: str, multi_line: bool = False, header: tuple[str, ...] = ()) -> DataFrame:
    """With a known header no job looks for it."""
    reader = spark.read.options(header=True, sep=sep, encoding="UTF-8", escape='"', multiLine=multi_line, enforceSchema=False)
    if header and len({h.lower() for h in header}) == len(header) and all(header):
        reader = reader.schema(T.StructType([T.StructField(h, T.StringType()) for h in header]))
    return reader.csv(path)


def _named(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def _first_line(spark: SparkSession, file: str) -> str:
    """Read through Spark's file systems, so that every store works that Spark can read."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        return (jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine() or "").removeprefix("\ufeff")
    finally:
        stream.close()
