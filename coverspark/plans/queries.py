"""All queries of the package's own operators."""

from coverspark.plans import cover_queries, file_queries, polygon_queries, rules_queries, series_queries, spatial_queries, synthesis_queries, table_queries  # noqa: F401  they register themselves
from coverspark.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
