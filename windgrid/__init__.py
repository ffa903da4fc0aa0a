"""Spark-native analytics over plant-level and complex-level wind generation data."""

from windgrid.session import build_session, shared_folder

__all__ = ["build_session", "shared_folder"]
