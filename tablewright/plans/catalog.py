"""All queries by name."""

from tablewright.plans import model_queries, order_queries, table_queries, usage_queries  # noqa: F401
from tablewright.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
