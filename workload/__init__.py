"""Queries over the driver's tables, each with its SQL check."""

from workload import dedup_queries, expert_queries, finish_queries, geo_queries, reader_queries, resolve_queries, text_queries  # noqa: F401
from workload.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
