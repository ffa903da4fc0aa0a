"""Whole runs built from the operators."""

from windgrid.plans.lake import read_lake, run_delivery
from windgrid.plans.pipeline import build_star, run_from_landing, run_new_months, run_pipeline, run_report, run_validation

__all__ = ["build_star", "read_lake", "run_delivery", "run_from_landing", "run_new_months", "run_pipeline", "run_report", "run_validation"]
