"""Imports every module that registers queries."""

from boxweave.plans import queries_audit, queries_convert, queries_dedup, queries_review, queries_select, queries_sources  # noqa: F401
from boxweave.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
