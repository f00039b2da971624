"""All queries and oracles."""

from checks import crawling, evaluation, older_jobs, packing  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
