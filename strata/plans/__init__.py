"""The query catalogue over the driver's testdata.

Importing this package registers every query (``common.REGISTRY``) and its
DuckDB oracle SQL (``common.ORACLES``).
"""

from strata.plans import bronze, commits, job_rows, reach, release, runs, silver, typed, validation, workbooks  # noqa: F401
from strata.plans.common import ORACLES, REGISTRY

__all__ = ["ORACLES", "REGISTRY"]
