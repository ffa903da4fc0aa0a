"""Landing zone to bronze table, each file once."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windgrid.functions import month_label, to_timestamp
from windgrid.functions.timing import NO_MONTH
from windgrid.schemas import TS
from windgrid.sources.files import LINE, REASON, headers_of, union_by_name

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
REJECTED = "path string, reason string, batch long"
# What the ledger holds of each batch: its files' columns, and how many rows of which month each file brought.
FILES = "path string, columns array<string>, batch long"
MONTHS = "path string, month string, n_rows long, batch long"
# Partition columns of bronze and the file name that the rows carry. Malformed rows are a month of their own.
BATCH, MONTH, PATH = "batch", "bronze_month", "source_path"
MALFORMED = "malformed"
OWN = {BATCH, MONTH, PATH, "source_file", LINE, REASON, "_further"}


def ingest_landing(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    columns: Sequence[str],
    sep: str = ";",
    max_files: int = 1000,
    multi_line: bool = False,
    with_batch: bool = False,
    ts: str = TS,
) -> DataFrame:
    """Appends the CSV files not seen before to the bronze table and returns the whole table.

    Files are put together by column name: a column of ``columns`` that a file lacks is null, and a further one is kept. Columns stay
    text, with the source file's name added. A file that cannot be read is set aside and listed (``rejected_files``); the others
    go on. Rows that do not fit their file's header are set aside too, as text (``malformed_rows``). The checkpoint remembers the files,
    and each batch replaces what an interrupted try of it has left, so a rerun adds nothing.
    A backlog is taken in batches of ``max_files``. The age limit is lifted: a month delivered late with an old file date is
    still read. A landing folder that never held a CSV file is an error that names it.

    Bronze lies in folders by batch and month of ``ts``, and a ledger beside it tells which file brought rows of which month
    (``ledger``), so that later readers open only the months that they need.
    """

    def append(batch: DataFrame, number: int) -> None:
        files = sorted(unquote(r["path"]) for r in batch.collect())
        if not files:
            return
        groups = headers_of(spark, files, sep)
        refused = [(f, "no header line", number) for f in groups.pop((), [])]
        for header in [h for h in groups if len({c.lower() for c in h}) < len(h) or not all(h) or not set(columns) & set(h)]:
            refused += [(f, "column names missing, repeated or all unknown", number) for f in groups.pop(header)]
        for header in [h for h in groups if OWN & {c.lower() for c in h}]:
            refused += [(f, "a column name that bronze uses itself", number) for f in groups.pop(header)]
        try:
            _write(spark, groups, bronze, number, columns, sep, multi_line, ts)
        except PySparkException:
            # Some file fails: try them one by one and set aside those that do.
            good: dict[tuple[str, ...], list[str]] = {}
            for header, paths in groups.items():
                for path in paths:
                    try:
                        union_by_name(spark, {header: [path]}, sep, multi_line, checked=True).write.format("noop").mode("overwrite").save()
                        good.setdefault(header, []).append(path)
                    except PySparkException as error:
                        refused.append((path, (error.getCondition() or "unreadable") if hasattr(error, "getCondition") else "unreadable", number))
            groups = good
            _write(spark, groups, bronze, number, columns, sep, multi_line, ts)
        root = bronze.rstrip("/")
        known = [(path, list(header), number) for header, paths in groups.items() for path in paths]
        _log(spark.createDataFrame(known, FILES), f"{root}_ledger/files/batch={number}")
        if known:
            rows = spark.read.schema(f"{PATH} string, {MONTH} string").parquet(f"{root}/{BATCH}={number}")
            counts = rows.groupBy(F.col(PATH).alias("path"), F.col(MONTH).alias("month")).agg(F.count("*").alias("n_rows"))
            _log(counts.withColumn(BATCH, F.lit(number).cast("long")), f"{root}_ledger/months/batch={number}")
        _log(spark.createDataFrame(refused, REJECTED), f"{root}_rejected/batch={number}")

    stream = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", "36500d")
        .load(landing)
        # Before the batch is planned: a column dropped inside foreachBatch is read all the same, and this one is each file's whole content.
        .select("path")
    )
    query = stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return read_bronze(spark, bronze, landing, columns, with_batch)


def read_bronze(spark: SparkSession, bronze: str, landing: str, columns: Sequence[str], with_batch: bool = False, months: Sequence[str] | None = None) -> DataFrame:
    """All batches by name: the expected columns first, then further ones as they first came, then source_file and, if asked for,
    the batch. ``months`` (labels such as 2024-01, ``none`` for rows without a readable timestamp) reads their folders only.
    Schema and columns come from the ledger, so no data file is opened to plan the read."""
    files = _logged(spark, f"{bronze.rstrip('/')}_ledger/files", FILES)
    first = files.select(BATCH, F.posexplode("columns").alias("at", "name")).groupBy("name").agg(F.min(F.struct(BATCH, "at")).alias("first"))
    every = [r["name"] for r in first.orderBy("first", "name").collect()]
    names = [*columns, *[c for c in every if c not in columns]]
    if not every:
        if rejected_files(spark, bronze).isEmpty():
            raise ValueError(f"No CSV files found in: {landing}")
        table = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in (*names, PATH, MONTH)])).withColumn(BATCH, F.lit(0).cast("long"))
    else:
        table = _partitions(spark, bronze, names).filter(F.col(MONTH) != MALFORMED)
        if months is not None:
            table = table.filter(F.col(MONTH).isin(list(months)))
    source = F.element_at(F.split(PATH, "/"), -1).alias("source_file")
    return table.select(*[F.col(f"`{c}`") for c in names], source, *([BATCH] if with_batch else []))


def ledger(spark: SparkSession, bronze: str) -> DataFrame:
    """path, month, n_rows, batch: the rows that each file brought to each month; the month of malformed rows is ``malformed``."""
    return _logged(spark, f"{bronze.rstrip('/')}_ledger/months", MONTHS)


def month_rows(spark: SparkSession, *bronzes: str) -> dict[str, int]:
    """The raw rows of each month, of the largest of the tables. Grows with months only."""
    found: dict[str, int] = {}
    for bronze in bronzes:
        for r in ledger(spark, bronze).groupBy("month").agg(F.sum("n_rows").alias("n")).collect():
            found[r["month"]] = max(r["n"], found.get(r["month"], 0))
    found.pop(MALFORMED, None)
    return found


def touched_months(spark: SparkSession, bronze: str, after: int = -1) -> DataFrame:
    """month: those that batches after a given one have rows for."""
    return ledger(spark, bronze).filter((F.col(BATCH) > after) & (F.col("month") != MALFORMED)).select("month").distinct()


def last_batch(spark: SparkSession, bronze: str) -> int:
    """The number of the last batch, -1 before the first one."""
    found = _logged(spark, f"{bronze.rstrip('/')}_ledger/files", FILES).agg(F.max(BATCH)).first()[0]
    return -1 if found is None else found


def malformed_rows(spark: SparkSession, bronze: str) -> DataFrame:
    """Rows set aside so far: path, batch, reason and the row's text."""
    if ledger(spark, bronze).filter(F.col("month") == MALFORMED).isEmpty():
        return spark.createDataFrame([], "path string, batch long, reason string, line string")
    rows = _partitions(spark, bronze, []).filter(F.col(MONTH) == MALFORMED)
    return rows.select(F.col(PATH).alias("path"), BATCH, F.col(REASON).alias("reason"), F.col(LINE).alias("line"))


def rejected_files(spark: SparkSession, bronze: str) -> DataFrame:
    """Files set aside so far: path, reason, batch."""
    return _logged(spark, f"{bronze.rstrip('/')}_rejected", REJECTED)


def _partitions(spark: SparkSession, bronze: str, names: Sequence[str]) -> DataFrame:
    fields = [T.StructField(c, T.StringType()) for c in (*names, PATH, LINE, REASON)]
    return spark.read.schema(T.StructType([*fields, T.StructField(BATCH, T.LongType()), T.StructField(MONTH, T.StringType())])).parquet(bronze)


def _log(rows: DataFrame, path: str) -> None:
    # A few rows for each file: one task and one file, not one for each core.
    rows.coalesce(1).write.mode("overwrite").parquet(path)


def _logged(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _write(spark: SparkSession, groups: dict, bronze: str, number: int, columns: Sequence[str], sep: str, multi_line: bool, ts: str) -> None:
    if not groups:
        return
    rows = union_by_name(spark, groups, sep, multi_line, checked=True)
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in columns if c not in rows.columns})
    month = month_label(to_timestamp(F.col(ts))) if ts in rows.columns else F.lit(NO_MONTH)
    rows = rows.withColumns({PATH: F.input_file_name(), MONTH: F.when(F.col(LINE).isNotNull(), MALFORMED).otherwise(month)})
    rows.write.mode("overwrite").partitionBy(MONTH).parquet(f"{bronze.rstrip('/')}/{BATCH}={number}")
