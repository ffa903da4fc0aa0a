"""Readers: raw CSV, mapping, partitioned Parquet and month ranges."""
