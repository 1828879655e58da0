"""All queries of the library but those of the llm subpackage, with their SQL."""

from terrafold.plans import features, models, relational, rows, summaries
from terrafold.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "features", "models", "relational", "rows", "summaries"]
