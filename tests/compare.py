"""Compares registered queries with their SQL twins in DuckDB."""

from __future__ import annotations

import math
import time
from datetime import date, datetime

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    return repr(v)


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark, connection, query, sql, sf_dir) -> tuple[list[str], int, float, float]:
    """What differs, rows, Spark seconds and DuckDB seconds."""
    start = time.time()
    df = query(spark, sf_dir)
    spark_rows = df.collect()
    spark_sec = time.time() - start
    start = time.time()
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    duck_types = {d[0]: str(d[1]) for d in result.description}
    duck_rows = result.fetchall()
    duck_sec = time.time() - start
    found = []
    spark_names, left = _sorted_rows(df.columns, spark_rows)
    duck_names, right = _sorted_rows(names, duck_rows)
    if spark_names != duck_names:
        found.append(f"columns {spark_names} != {duck_names}")
    if len(left) != len(right):
        found.append(f"rows {len(left)} != {len(right)}")
    if left != right:
        only_left = sorted(set(left) - set(right))[:2]
        only_right = sorted(set(right) - set(left))[:2]
        found.append(f"values: spark only {only_left}, duckdb only {only_right}")
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "int": "INTEGER"}
    for name, kind in df.dtypes:
        if kinds.get(kind) != duck_types.get(name):
            found.append(f"type of {name}: {kind} / {duck_types.get(name)}")
    return found, len(left), spark_sec, duck_sec
