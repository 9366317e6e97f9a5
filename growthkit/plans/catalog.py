"""All registered queries."""

from growthkit.plans import data_queries, dirty_queries, explore_queries, group_queries, product_queries  # noqa: F401
from growthkit.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
