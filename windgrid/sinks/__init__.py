"""Writers: tables, partitioned Parquet, CSV and report JSON."""

from windgrid.sinks.files import (
    partition_columns,
    write_csv,
    write_layer,
    write_partitioned,
    write_report,
    write_star,
    write_table,
)

__all__ = [
    "partition_columns",
    "write_csv",
    "write_layer",
    "write_partitioned",
    "write_report",
    "write_star",
    "write_table",
]
