"""Registered queries over the test tables, with SQL to compare them to."""

from tripmart.checks import cleaning, demand, marts, storage  # noqa: F401  (register their queries)
from tripmart.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
