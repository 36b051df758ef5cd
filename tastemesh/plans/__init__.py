"""Named queries and their DuckDB oracles.

Importing this package registers every query module.
"""

from tastemesh.plans import content_queries  # noqa: F401
from tastemesh.plans import hybrid_queries  # noqa: F401
from tastemesh.plans import model_queries  # noqa: F401
from tastemesh.plans import preprocess_queries  # noqa: F401
from tastemesh.plans import social_queries  # noqa: F401
from tastemesh.plans.registry import QUERIES, oracle_sql

__all__ = ["QUERIES", "oracle_sql"]
