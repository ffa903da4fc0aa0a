"""Incremental ingest of a landing zone."""

from windgrid.streaming.ingest import ingest_landing, ledger, malformed_rows, read_bronze, rejected_files, touched_months

__all__ = ["ingest_landing", "ledger", "malformed_rows", "read_bronze", "rejected_files", "touched_months"]
