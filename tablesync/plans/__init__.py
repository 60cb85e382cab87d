"""Table specs and the flow that runs them."""

from .runner import JobResult, delta, next_state, run_job, run_jobs
from .spec import Join, TableSpec
from .tables import SPECS, spec

__all__ = ["JobResult", "Join", "SPECS", "TableSpec", "delta", "next_state", "run_job", "run_jobs", "spec"]
