"""Registered queries, one module per domain."""

from brightloom.plans import checks, churn, files, flood, geo, indices, learning, marts, people, retail  # noqa: F401
from brightloom.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
