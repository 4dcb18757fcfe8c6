"""Queries over the driver's tables and the SQL they are checked against."""

from gate import operators, results, sources
from gate.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "operators", "results", "sources"]
