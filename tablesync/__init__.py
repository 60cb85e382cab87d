"""Replicating operational tables into published analytics tables, on Spark."""

from .plans import SPECS, TableSpec, delta, next_state, run_job, run_jobs, spec

__all__ = ["SPECS", "TableSpec", "delta", "next_state", "run_job", "run_jobs", "spec"]
