"""Operators for training-data pipelines; nothing else in the library imports them."""

from brightloom.llm.queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
