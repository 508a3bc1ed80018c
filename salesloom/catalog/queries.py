"""All registered queries."""

from salesloom.catalog import (  # noqa: F401
    queries_analysis,
    queries_gold,
    queries_measures,
    queries_quality,
    queries_silver,
    queries_sources,
)
from salesloom.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
