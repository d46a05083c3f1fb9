"""Driver queries: each key has a Spark callable and, where SQL can say it, the same in SQL."""

from jobmart.catalog import enrich, flows, jobs, pages, population, report, streams  # noqa: F401  (they register)
from jobmart.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
