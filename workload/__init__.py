"""Registered queries: each applies library operators to the test tables, with the
same result stated in SQL. All of them run over whole tables."""

from workload import deliveries, ingest, measures, quality, tables  # noqa: F401
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
